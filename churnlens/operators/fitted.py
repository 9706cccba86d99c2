"""Fitted transforms (family D): label encoding, scaling, training and
serving preparation.

Fitting runs distributed aggregates and returns *parameters* (small tables or
dicts); applying them is a projection, so the serving plan has no fitting job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import encode_binary
from churnlens.operators import clean as C
from churnlens.operators.quality import sorted_distinct, validate_schema
from churnlens.session import materialize


def fit_label_encoder(df: DataFrame, cols: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """(column, value, code) with code = position in the sorted distinct values."""
    cols = [c for c in cols if c not in set(exclude)]
    return sorted_distinct(df, cols).select("column", "value", F.col("position").alias("code"))


def apply_label_encoder(df: DataFrame, params: DataFrame, cols: Sequence[str] | None = None,
                        unseen: int = -1) -> DataFrame:
    """Map values (compared as text, Q3) to fitted codes; unseen and null → −1.

    One left join per column with the column's rows of ``params``, at any size
    of the encoder; Spark broadcasts a small one (``prepare_training`` keeps
    it as a written table, so its size is known)."""
    if cols is None:
        cols = sorted(r[0] for r in params.select("column").distinct().collect())  # one row per column
    out = df
    for c in cols:
        code_df = params.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"),
                                                            F.col("code").alias(f"_code_{c}"))
        out = (out.join(code_df, F.col(c).cast("string") == F.col(f"_v_{c}"), "left")
               .withColumn(c, F.coalesce(F.col(f"_code_{c}"), F.lit(unseen)).cast("bigint"))
               .drop(f"_v_{c}", f"_code_{c}"))
    return out


def fit_minmax(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """D3 fit: per column (min, max − min) in one aggregate."""
    row = df.agg(*[F.min(c).alias(f"mn_{c}") for c in cols], *[F.max(c).alias(f"mx_{c}") for c in cols]).first()
    return {c: (row[f"mn_{c}"], (row[f"mx_{c}"] - row[f"mn_{c}"])
                if row[f"mx_{c}"] is not None else None) for c in cols}


def fit_standard(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """D4 fit: per column (mean, population std) in one aggregate."""
    row = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_affine(df: DataFrame, params: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(x − a) / b with b = 0 (constant column) treated as 1, so it maps to 0."""
    exprs = {}
    for c, (a, b) in params.items():
        den = 1.0 if (b is None or b == 0) else float(b)
        exprs[c] = (F.col(c).cast("double") - F.lit(a)) / F.lit(den)
    return df.withColumns(exprs)


def prepare_training(df: DataFrame, spec: Mapping, fit_on: DataFrame | None = None) -> tuple[DataFrame, dict]:
    """Validate → clean → encode → select → scale; returns (features, params).

    ``spec`` keys: id, target, numeric_text, numeric, categorical, drop,
    scaled, scaler ('minmax'|'standard'), fill, hooks (functions on the frame,
    applied after encoding, D7).  ``fit_on`` fits the
    parameters on another frame (e.g. the training part, Q5).
    """
    validate_schema(df, spec["expected"]) if spec.get("expected") else None
    fit_src = fit_on if fit_on is not None else df
    clean_params = C.fit_cleaning(fit_src, spec["numeric_text"], spec["numeric"], spec["categorical"],
                                  spec.get("fill", "zero"))
    params = {"cleaning": clean_params}
    cleaned_fit = _encode_target(C.apply_cleaning(fit_src, clean_params), spec)
    enc_cols = [c for c in spec["categorical"] if c not in (spec["target"], spec.get("id"))]
    encoder = params["encoder"] = materialize(fit_label_encoder(cleaned_fit, enc_cols), "encoder")
    encoded_fit = apply_label_encoder(cleaned_fit, encoder, enc_cols)
    selected_fit = C.drop_if_present(hooks(encoded_fit, *spec.get("hooks", ())), spec["drop"])
    fit = fit_minmax if spec.get("scaler", "minmax") == "minmax" else fit_standard
    params["scaler"] = fit(selected_fit, spec["scaled"])
    params["spec"] = dict(spec)
    return prepare_serving(df, params), params


def _encode_target(df: DataFrame, spec: Mapping) -> DataFrame:
    t = spec["target"]
    return df.withColumn(t, encode_binary(t)) if t in df.columns else df


def prepare_serving(df: DataFrame, params: Mapping, refit: bool = False) -> DataFrame:
    """The same plan with saved parameters, no fitting job.

    ``refit=True`` reproduces the batch-statistics imputation of the
    reference serving path (Q4).
    """
    spec = params["spec"]
    cp = params["cleaning"]
    if refit:
        cp = C.fit_cleaning(df, spec["numeric_text"], spec["numeric"], spec["categorical"], cp.get("fill", "zero"))
    out = _encode_target(C.apply_cleaning(df, cp), spec)
    enc_cols = [c for c in spec["categorical"] if c not in (spec["target"], spec.get("id"))]
    out = apply_label_encoder(out, params["encoder"], enc_cols)
    out = hooks(out, *spec.get("hooks", ()))
    out = C.drop_if_present(out, spec["drop"])
    return apply_affine(out, params["scaler"])


def hooks(df: DataFrame, *fns: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Chain extension points with ``df.transform``."""
    for fn in fns:
        df = df.transform(fn)
    return df
