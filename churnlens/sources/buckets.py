"""Tables that are merged in part (A7, G2, G3): rows lie in folders by a hash of their key.

An update reads and rewrites only the buckets of its own keys (dynamic
partition overwrite); the files of all others stay as they are, so the cost of
an upsert grows with the buckets it touches and not with the table, and two
writers of different buckets do not disturb each other. Of two writers of one
bucket the later replaces the earlier one's, as with any overwrite.

A bucket is replaced when Spark commits the write: the merged rows are written
beside the table first, so a failed job leaves the old files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.operators.merge import upsert_log
from churnlens.session import materialize

BUCKET = "_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _describe(spark: SparkSession, path: str) -> tuple[str, int]:
    try:
        row = spark.read.parquet(f"{path}/about").first()
    except AnalysisException:
        raise FileNotFoundError(path) from None
    return row["key"], row["buckets"]


def _write(rows: DataFrame, path: str, per_bucket: int) -> None:
    """A bucket is one task's and one file's work, or ``per_bucket`` tasks' and files'."""
    part = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c != BUCKET]), F.lit(per_bucket)) if per_bucket > 1 else F.lit(0)
    (rows.repartition(BUCKET, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BUCKET).parquet(f"{path}/rows"))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = 64, files_per_bucket: int = 1) -> None:
    """Write a table anew, one folder a bucket of ``key`` (a null key has a bucket like any other)."""
    df.sparkSession.createDataFrame([(key, buckets)], "key string, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")
    rows = df.withColumn(BUCKET, _bucket(key, buckets))
    # buckets that the new table lacks must not survive from the old one
    rows.limit(0).drop(BUCKET).write.mode("overwrite").parquet(f"{path}/rows")
    _write(rows, path, files_per_bucket)


def read_bucketed(spark: SparkSession, path: str, keys_of: DataFrame | None = None) -> DataFrame:
    """The table; with ``keys_of`` only the buckets that hold its keys (partition pruning)."""
    key, buckets = _describe(spark, path)
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    if BUCKET not in rows.columns:
        return rows
    if keys_of is not None:
        rows = rows.where(F.col(BUCKET).isin(_touched(keys_of, key, buckets)))
    return rows.drop(BUCKET)


def _touched(df: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets of the keys of ``df`` (at most ``buckets`` numbers)."""
    return sorted(r[0] for r in df.select(_bucket(key, buckets)).distinct().collect())


def upsert_bucketed(updates: DataFrame, path: str, seq: Sequence[str], files_per_bucket: int = 1) -> list[int]:
    """Apply ``updates`` (G2: they beat the table, a later ``seq`` beats an earlier one); returns the rewritten buckets.

    Columns that the updates lack are null in their rows; columns that the
    table lacks are an error.
    """
    spark = updates.sparkSession
    key, buckets = _describe(spark, path)
    rows = spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows")
    table_columns = [c for c in rows.columns if c != BUCKET]
    extra = [c for c in updates.columns if c not in table_columns]
    if extra:
        raise ValueError(f"the table has no column {extra}")
    touched = _touched(updates, key, buckets)
    if not touched:
        return []
    old = rows.where(F.col(BUCKET).isin(touched)).drop(BUCKET) if BUCKET in rows.columns else rows
    merged = upsert_log(old, updates, key, seq).select(*table_columns)
    # files that are read cannot be overwritten by the same job
    merged = materialize(merged.withColumn(BUCKET, _bucket(key, buckets)), "merged_buckets")
    _write(merged, path, files_per_bucket)
    return touched
