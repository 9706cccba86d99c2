"""Projection, filter, cleaning and scalar rules (family C).

Fitted fill values (median, mode) are computed by distributed aggregates and
returned as a small dict; applying them is a plain ``fillna`` so the same
values can be reused at serving time (train/serve equality).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions import columns as X
from churnlens.operators.ordered import exact_quantiles
from churnlens.operators.reshape import melt


def to_numeric(df: DataFrame, cols: str | Sequence[str]) -> DataFrame:
    """Text columns to double, bad text to null."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.withColumns({c: X.to_numeric(c) for c in cols})


def fill_constant(df: DataFrame, cols: str | Sequence[str], value) -> DataFrame:
    """Nulls to a constant."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.fillna(value, subset=cols)


def fit_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """Exact medians of numeric columns (nulls ignored), one distributed pass."""
    if not cols:
        return {}
    long = melt(df, cols, as_type="double").where(F.col("value").isNotNull())
    rows = exact_quantiles(long, "value", [0.5], by=["column"], names=["median"]).collect()
    return {r["column"]: r["median"] for r in rows}


def fit_modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, ties to the smallest value.

    Counts per (column, value) are combined map-side; the pick per column is
    a ``min_by`` over (−count, value), so no column is collected in one task.
    """
    if not cols:
        return {}
    long = melt(df, cols).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    picks = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("mode"))
    return {r["column"]: r["mode"] for r in picks.collect()}


def fit_fills(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
              accuracy: int = 100_000) -> tuple[dict[str, float], dict[str, str]]:
    """(medians, modes) of ``fit_medians`` and ``fit_modes`` from two passes and no written table.

    The first pass brackets every median between two approximate quantiles
    (rank error 1/accuracy).  The second counts (column, value) for the
    categories and for numbers inside their bracket; all numbers below it are
    one value.  So one count table gives the exact medians and the modes, and
    what is ordered a column is 5/accuracy of its rows at most.  The counts
    tell whether a bracket holds its median; if not, it is widened.
    """
    numeric, categorical = list(dict.fromkeys(numeric)), list(dict.fromkeys(categorical))
    if not numeric and not categorical:
        return {}, {}
    x = {c: F.col(c).cast("double") for c in numeric}
    width, medians, modes = 1.5 / accuracy, {}, {}
    while True:
        open_cols = [c for c in numeric if c not in medians]
        brackets = df.agg(F.count(F.lit(1)), *[e for c in open_cols for e in (
            F.count(x[c]), F.percentile_approx(x[c], [max(0.0, 0.5 - width), min(1.0, 0.5 + width)], accuracy))]).first() if open_cols else []
        cells = [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("num"), F.col(c).cast("string").alias("text"))
                 for c in categorical if not modes]
        ranks = []
        for k, c in enumerate(open_cols):
            n, ends = brackets[1 + 2 * k], brackets[2 + 2 * k]
            if n:
                inside = F.when(x[c] < ends[0], float("-inf")).when(x[c] <= ends[1], x[c])
                cells.append(F.struct(F.lit(c).alias("column"), inside.alias("num"), F.lit(None).cast("string").alias("text")))
                ranks.append((c, (n + 1) // 2, n // 2 + 1))
        if not cells:
            return medians, modes
        counts = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*").where("num IS NOT NULL OR text IS NOT NULL")
        counts = counts.groupBy("column", "num", "text").agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum(F.when(F.col("num").isNotNull(), F.col("n"))).over(Window.partitionBy("column").orderBy(F.col("num").asc_nulls_last()))
        low, high = F.lit(None).cast("long"), F.lit(None).cast("long")
        for c, a, b in ranks:
            low, high = F.when(F.col("column") == c, a).otherwise(low), F.when(F.col("column") == c, b).otherwise(high)
        numbers = counts.where("num IS NOT NULL").withColumn("upto", upto).groupBy("column").agg(
            F.min(F.when(F.col("upto") >= low, F.col("num"))).alias("low"), F.min(F.when(F.col("upto") >= high, F.col("num"))).alias("high"),
            F.lit(None).cast("string").alias("mode"))
        texts = counts.where("text IS NOT NULL").groupBy("column").agg(
            F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
            F.min_by("text", F.struct((-F.col("n")).alias("k"), F.col("text").alias("v"))).alias("mode"))
        for r in numbers.unionByName(texts).collect():  # one row a column
            if r["mode"] is not None:
                modes[r["column"]] = r["mode"]
            elif r["low"] is not None and r["high"] is not None and (r["low"] > float("-inf") or width >= 0.5):
                even = 0.5 if r["low"] != r["high"] else 0.0
                medians[r["column"]] = r["low"] + even * (r["high"] - r["low"])
        if all(c in medians for c, _, _ in ranks):
            return medians, modes
        width = min(0.5, width * 100)


def fill_median(df: DataFrame, cols: Sequence[str], medians: Mapping[str, float] | None = None) -> DataFrame:
    """Numeric nulls to the column median (fitted unless given)."""
    medians = dict(medians) if medians is not None else fit_medians(df, cols)
    vals = {c: v for c, v in medians.items() if c in cols and c in df.columns and v is not None}
    return df.fillna(vals) if vals else df


def fill_mode(df: DataFrame, cols: Sequence[str], modes: Mapping[str, str] | None = None) -> DataFrame:
    """C4: categorical nulls to the column mode (fitted unless given)."""
    modes = dict(modes) if modes is not None else fit_modes(df, cols)
    exprs = {c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
             for c, v in modes.items() if c in cols and c in df.columns and v is not None}
    return df.withColumns(exprs) if exprs else df


def encode_binary(df: DataFrame, cols: str | Sequence[str], positive="Yes", negative="No") -> DataFrame:
    """Yes/No columns to 1/0 (others null)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.withColumns({c: X.encode_binary(c, positive, negative) for c in cols})


def decode_binary(df: DataFrame, col: str, out: str | None = None, positive="Yes", negative="No") -> DataFrame:
    """1 to Yes, else No."""
    return df.withColumn(out or col, X.decode_binary(col, positive, negative))


def recode(df: DataFrame, col: str, mapping: Mapping, out: str | None = None) -> DataFrame:
    """Replace values through a literal map; unmapped values pass through as text."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in (str(kv[0]), kv[1])])
    src = F.col(col).cast("string")
    return df.withColumn(out or col, F.coalesce(m[src], src))


def set_role(roles: Mapping[str, str], cols: Sequence[str], role: str = "categorical") -> dict[str, str]:
    """Mark columns with a role (e.g. an integer flag treated as category)."""
    new = dict(roles)
    new.update({c: role for c in cols})
    return new


def as_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C8 applied: categorical columns travel as text."""
    return df.withColumns({c: F.col(c).cast("string") for c in cols if c in df.columns})


def conform(df: DataFrame, cols: Sequence[str], types: Mapping[str, T.DataType | str] | None = None) -> DataFrame:
    """Project to a fixed column order; absent columns become typed nulls."""
    types = types or {}
    out = []
    for c in cols:
        if c in df.columns:
            out.append(F.col(c))
        else:
            out.append(F.lit(None).cast(types.get(c, "string")).alias(c))
    return df.select(*out)


def drop_if_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop named columns, ignore absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def filter_rows(df: DataFrame, predicate=None, dropna_subset: Sequence[str] | None = None) -> DataFrame:
    """C11: keep rows matching a predicate and/or with no nulls in a subset."""
    if dropna_subset:
        df = df.dropna(subset=list(dropna_subset))
    if predicate is not None:
        df = df.where(predicate)
    return df


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """C11: the rows whose ``col`` is null."""
    return df.where(F.col(col).isNull())


def add_ratio(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """Num / den with zero denominators replaced by one."""
    return df.withColumn(out, X.safe_ratio(num, den))


def bin_column(df: DataFrame, col: str, edges: Sequence[float], labels: Sequence[str] | None = None,
               out: str | None = None, right: bool = False) -> DataFrame:
    """Interval label per row; right-open by default, outside is null."""
    return df.withColumn(out or f"{col}_band", X.bin_expr(col, edges, labels, right))


def add_risk_band(df: DataFrame, p: str, out: str = "risk") -> DataFrame:
    """C14: probability to Low / Medium / High."""
    return df.withColumn(out, X.risk_band(p))


def add_threshold_label(df: DataFrame, p: str, t: float = 0.5, inclusive: bool = True,
                        out: str = "prediction") -> DataFrame:
    """Probability to class."""
    return df.withColumn(out, X.threshold_label(p, t, inclusive))


def round_cols(df: DataFrame, cols: Sequence[str], digits: int) -> DataFrame:
    """Round for presentation."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


def pseudonymise(df: DataFrame, col: str, salt: str, out: str | None = None) -> DataFrame:
    """C17: salted SHA-256 of an identifier."""
    return df.withColumn(out or col, X.pseudonymise(col, salt))


def fit_cleaning(df: DataFrame, numeric_text: Sequence[str], numeric: Sequence[str],
                 categorical: Sequence[str], fill: str = "zero") -> dict:
    """Fitted fill values of the cleaning step, for reuse at serving time: one for
    every listed column, whether or not it had nulls when fitted."""
    typed = to_numeric(df, numeric_text)
    if fill == "zero":
        typed = fill_constant(typed, list(numeric_text), 0.0)
    medians, modes = fit_fills(typed, numeric, categorical)
    return {"fill": fill, "numeric_text": list(numeric_text), "medians": medians, "modes": modes}


def apply_cleaning(df: DataFrame, params: Mapping) -> DataFrame:
    """Apply fitted cleaning: text to number, zero fill, median and mode fills."""
    out = to_numeric(df, params["numeric_text"])
    if params.get("fill", "zero") == "zero":
        out = fill_constant(out, list(params["numeric_text"]), 0.0)
    out = fill_median(out, list(params["medians"]), params["medians"])
    return fill_mode(out, list(params["modes"]), params["modes"])


def clean_table(df: DataFrame, numeric_text: Sequence[str], numeric: Sequence[str],
                categorical: Sequence[str], fill: str = "zero") -> DataFrame:
    """The cleaning step: text to number, zero (or median) fill, median fill
    for other numeric nulls, mode fill for categorical nulls (Q1, Q2)."""
    return apply_cleaning(df, fit_cleaning(df, numeric_text, numeric, categorical, fill))
