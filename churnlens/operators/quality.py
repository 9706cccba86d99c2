"""Schema and quality operators (family B)."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.constants import SUBSCRIBER_DOMAINS
from churnlens.functions.columns import blank_or_null
from churnlens.operators.ordered import exact_quantiles, prefix_sums
from churnlens.operators.reshape import melt
from churnlens.session import materialize

log = logging.getLogger(__name__)

def validate_schema(df: DataFrame, expected: Sequence[str], warn_nulls: bool = False) -> bool:
    """B1: raise ValueError listing missing columns; optional null warning."""
    missing = [c for c in expected if c not in df.columns]
    if warn_nulls:
        present = [c for c in expected if c in df.columns]
        any_null = F.lit(False)
        for c in present:
            any_null = any_null | F.col(c).isNull()
        if present and df.where(any_null).limit(1).count():
            log.warning("missing values detected")
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return True


def enforce_types(df: DataFrame, schema: T.StructType) -> DataFrame:
    """B2: cast every field with ``try_cast``; ``bad_field`` names the first
    field whose non-null input did not convert (null when the row is clean)."""
    cast, bad = [], None
    for f in schema.fields:
        src = F.col(f.name) if f.name in df.columns else F.lit(None)
        tgt = F.trim(src.cast("string")).try_cast(f.dataType) if not isinstance(f.dataType, T.StringType) \
            else src.cast("string")
        cast.append(tgt.alias(f.name))
        failed = src.isNotNull() & (F.trim(src.cast("string")) != "") & tgt.isNull()
        cond = F.when(failed, F.lit(f.name))
        bad = cond if bad is None else F.coalesce(bad, cond)
    return df.select(*cast, bad.alias("bad_field"))


def split_typed(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """B2: (rows that conform, rows that do not)."""
    typed = enforce_types(df, schema)
    return (typed.where(F.col("bad_field").isNull()).drop("bad_field"),
            typed.where(F.col("bad_field").isNotNull()))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None, total_label: str = "__all__") -> DataFrame:
    """Nulls per column plus a total row; one aggregate, then unpivot."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    wide = wide.withColumn(total_label, sum((F.col(c) for c in cols), F.lit(0)))
    return wide.unpivot([], [*cols, total_label], "column", "n_null")


def split_incomplete(df: DataFrame, cols: Sequence[str], out: str = "bad_field") -> DataFrame:
    """Name the first null-or-blank field of each row (null when complete)."""
    first = F.coalesce(*[F.when(blank_or_null(c), F.lit(c)) for c in cols])
    return df.withColumn(out, first)


def domain_violations(df: DataFrame, domains: Mapping[str, Sequence[str]] = SUBSCRIBER_DOMAINS) -> DataFrame:
    """(column, value, n) for non-null values outside the allowed lists.

    A left-anti join with the domain table; Spark broadcasts it when its size
    allows.
    """
    entries = [(c, str(v)) for c, vs in domains.items() for v in vs]
    spark = df.sparkSession
    dom = spark.createDataFrame(entries, "column string, value string")
    long = melt(df, list(domains)).where(F.col("value").isNotNull())
    bad = long.join(dom, on=["column", "value"], how="left_anti")
    return bad.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def _distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, n_distinct), nulls excluded; distinct pairs combined map-side."""
    long = melt(df, cols).where(F.col("value").isNotNull())
    return long.select("column", "value").distinct().groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"))


def classify_columns(df: DataFrame, cat_th: int = 10, car_th: int = 20) -> DataFrame:
    """Text → categorical; non-text with < cat_th distinct → categorical;
    text with > car_th distinct → cardinal; the rest numeric."""
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), isinstance(f.dataType, T.StringType)) for f in df.schema.fields],
        "column string, dtype string, is_text boolean")
    counts = _distinct_counts(df, df.columns)
    j = types.join(counts, "column", "left").fillna(0, subset=["n_distinct"])
    kind = (F.when(F.col("is_text") & (F.col("n_distinct") > car_th), F.lit("cardinal"))
            .when(F.col("is_text"), F.lit("categorical"))
            .when(F.col("n_distinct") < cat_th, F.lit("categorical"))
            .otherwise(F.lit("numeric")))
    return j.select("column", "dtype", F.col("n_distinct").cast("bigint").alias("n_distinct"), kind.alias("kind"))


def columns_by_type(df: DataFrame, kinds: Sequence[str]) -> list[str]:
    """Names of columns whose type is one of ``kinds`` ('numeric', 'string', ...)."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        tags = {t.simpleString()}
        if isinstance(t, T.NumericType):
            tags.add("numeric")
        if isinstance(t, T.StringType):
            tags.add("text")
        if any(k in tags for k in kinds):
            out.append(f.name)
    return out


def sorted_distinct(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, position, n_values): sorted category lists.

    Positions come from distributed prefix sums over distinct values, so a
    high-cardinality column is not sorted in one task.
    """
    long = melt(df, cols).where(F.col("value").isNotNull())
    dv = long.select("column", "value").distinct().withColumn("_one", F.lit(1))
    ps = prefix_sums(dv, ["value"], ["_one"], by=["column"], with_total=True)
    return ps.select("column", "value", (F.col("cum__one") - 1).cast("bigint").alias("position"),
                     F.col("tot__one").cast("bigint").alias("n_values"))


def profile_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, std (sample), min, quartiles, max, distinct per column.

    All eight come from one (column, value, count) table, combined map-side
    and written once.  A column without any value has count 0 and null
    statistics.
    """
    counts = materialize(melt(df, cols, as_type="double").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("_w")), "profile_counts")
    known = counts.where(F.col("value").isNotNull())
    w, v = F.col("_w"), F.col("value")
    base = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(v.isNotNull(), w)), F.lit(0)).cast("bigint").alias("count"),
        (F.sum(v * w) / F.sum(F.when(v.isNotNull(), w))).alias("mean"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.count(v).alias("n_distinct"))
    spread = known.join(F.broadcast(base.select("column", F.col("mean").alias("_m"))), "column").groupBy("column").agg(  # one row a column
        F.sum(w * (v - F.col("_m")) * (v - F.col("_m"))).alias("_ss"))
    qs = exact_quantiles(known, "value", [0.25, 0.5, 0.75], by=["column"], names=["q25", "q50", "q75"],
                         weight="_w").drop("n")
    out = base.join(F.broadcast(spread), "column", "left").join(F.broadcast(qs), "column", "left")
    std = F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1)))
    return out.select("column", "count", "mean", std.alias("std"), "min", "max", "q25", "q50", "q75", "n_distinct")


def profile_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, distinct, most frequent value (ties → smallest) and its frequency."""
    long = melt(df, cols).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"), F.count(F.lit(1)).alias("n_distinct"),
        F.min_by(F.struct("value", "n"), F.struct((-F.col("n")).alias("k"), F.col("value").alias("v"))).alias("t"),
    ).select("column", "count", "n_distinct", F.col("t.value").alias("top"), F.col("t.n").alias("freq"))


def require_rows(df: DataFrame, n: int) -> bool:
    """Gate — at least n rows (reads at most n rows)."""
    return df.limit(n).count() >= n


def groups_with_rows(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """B10 per group: groups with at least n rows, with their size."""
    return (df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") >= n))
