"""Union, upsert, top-k, sampling and run tables (family G)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.clean import conform
from churnlens.operators.quality import validate_schema


def combine_distinct(base: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """G1: align both to the contract, union, drop identical rows."""
    return conform(base, cols).unionByName(conform(new, cols)).distinct()


def upsert_log(log: DataFrame, feedback: DataFrame, key: str, seq: Sequence[str]) -> DataFrame:
    """Append feedback and keep the last row per key.

    "Last" is (source, then ``seq`` columns) descending: feedback beats the
    log, a later sequence beats an earlier one, and of rows alike in these the
    greatest in all columns stays.  Columns absent on one side are null.
    """
    a = log.withColumn("_src", F.lit(0))
    b = feedback.withColumn("_src", F.lit(1))
    u = a.unionByName(b, allowMissingColumns=True)
    return greatest_row(u, [key], ["_src", *seq]).drop("_src")


def greatest_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each ``keys`` that is greatest in ``order``, then in all its other columns (left to right).

    The pick is ``max`` of a struct — combined map-side — so a key holding a
    third of all rows is never gathered in one task.  Maps are compared by
    their sorted entries.
    """
    rest = [c for c in df.columns if c not in (*keys, *order)]
    plain = [F.array_sort(F.map_entries(c)).alias(f"_{c}") if isinstance(df.schema[c].dataType, T.MapType) else F.col(c) for c in rest]
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    picked = df.groupBy(*keys).agg(F.max_by(row, F.struct(*[F.col(c) for c in order], *plain)).alias("_r")) if len(df.columns) > len(keys) \
        else df.select(*keys).distinct()
    return picked.select(*[F.col(c) if c in keys else F.col(f"_r.`{c}`").alias(c) for c in df.columns])


def upsert_training(base: DataFrame, upload: DataFrame, key: str, expected: Sequence[str],
                    seq: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Validate the upload, upsert it, and report (rows, columns)."""
    validate_schema(upload, expected)
    merged = upsert_log(base, upload, key, seq)
    report = merged.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(merged.columns)))
    return merged, report


def _desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def top_recent(log: DataFrame, n: int, time_col: str, tiebreak: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Newest n rows (nulls last, Q17) with a fixed column list (top-k, no full sort)."""
    out = log.orderBy(_desc(time_col), _desc(tiebreak)).limit(n)
    return out.select(*cols) if cols else out


def last_n(log: DataFrame, n: int, time_col: str, tiebreak: str) -> DataFrame:
    """The last min(n, rows) rows in ascending time order."""
    newest = log.orderBy(_desc(time_col), _desc(tiebreak)).limit(n)
    return newest.orderBy(F.col(time_col).asc_nulls_first(), F.col(tiebreak).asc_nulls_first())


def sample_n(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """Seeded sample of n rows, stable under repartitioning."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), F.col(key)).limit(n)


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First n rows in a stated order."""
    return df.orderBy(*order).limit(n)


def best_run(runs: DataFrame, metric: str, tiebreak: str = "run_id") -> DataFrame:
    """The run with the highest metric (ties → smallest run id)."""
    m = F.col("metrics")[metric]
    return runs.orderBy(m.desc_nulls_last(), F.col(tiebreak)).limit(1)


def latest_in_stage(versions: DataFrame, stage: str, version: str = "version",
                    stage_col: str = "stage") -> DataFrame:
    """Greatest numeric version in ``stage``, else greatest overall."""
    vnum = F.regexp_extract(F.col(version).cast("string"), r"(\d+)", 1).try_cast("int")
    # of versions alike in number the greatest in all columns
    rest = [F.col(c) for c in versions.columns if not isinstance(versions.schema[c].dataType, T.MapType)]
    key = F.struct((F.col(stage_col) == stage).cast("int"), vnum, *rest)
    return versions.agg(F.max_by(F.struct(*[F.col(c) for c in versions.columns]), key).alias("_r")).select("_r.*")


def version_metrics(runs: DataFrame, names: Sequence[str], id_cols: Sequence[str] = ("version", "stage")) -> DataFrame:
    """Metrics map → one column per metric (explode + pivot on a fixed list)."""
    ex = runs.select(*id_cols, F.explode("metrics").alias("metric", "value"))
    return ex.groupBy(*id_cols).pivot("metric", list(names)).agg(F.first("value"))
