"""Sources and sinks (family A).

Reads declare their schema (no inference); writes are plain DataFrame
writers.  Paths may be any Hadoop-compatible URI; existence checks go
through the session's Hadoop file system, not the local disk.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException


class EmptySourceError(ValueError):
    """The source exists but holds no data."""


class MalformedSourceError(ValueError):
    """The source holds records that do not parse under the declared schema."""


def _listing(spark: SparkSession, path: str) -> DataFrame | None:
    """Files under ``path`` (name and size only), or None when it does not exist.

    Uses the ``binaryFile`` source; only ``path`` and ``length`` are selected,
    so file contents are never read."""
    try:
        return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
                .select("path", "length"))
    except AnalysisException:
        return None


def path_size(spark: SparkSession, path: str) -> int | None:
    """Total bytes of the data files under ``path``; None when it does not exist."""
    files = _listing(spark, path)
    if files is None:
        return None
    return int(files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def _struct(spark: SparkSession, schema: T.StructType | str) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool, failfast: bool,
              multiline: bool) -> DataFrame:
    r = (spark.read.option("header", header).option("mode", "FAILFAST" if failfast else "PERMISSIVE")
         .option("multiLine", multiline).option("escape", '"'))
    if not header:
        return r.schema(schema).csv(path)
    names = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').csv(path).columns
    missing = [n for n in schema.names if n not in names]
    if missing:
        raise MalformedSourceError(f"{path}: no column {missing} in the header")
    # the file's order; every file's own header is checked against it
    as_stored = T.StructType([schema[n] if n in schema.names else T.StructField(n, T.StringType()) for n in names])
    return r.schema(as_stored).option("enforceSchema", False).csv(path).select(*schema.names)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv",
               header: bool = True, failfast: bool = True, validate: bool = False,
               multiline: bool = False) -> DataFrame:
    """A1: typed load; a missing path raises FileNotFoundError, an empty one
    EmptySourceError; with ``failfast`` a malformed record fails the job that
    reads it, and ``validate=True`` reads everything once now (a no-op sink)
    so that a malformed source raises MalformedSourceError here."""
    size = path_size(spark, path)
    if size is None:
        raise FileNotFoundError(path)
    if size == 0:
        raise EmptySourceError(path)
    if fmt == "csv":
        df = _read_csv(spark, path, _struct(spark, schema), header, failfast, multiline)
    else:
        df = spark.read.schema(schema).format(fmt).load(path)
    if validate:
        try:
            df.write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - the JVM error type varies by format
            raise MalformedSourceError(f"{path}: {str(e).splitlines()[0][:300]}") from e
    return df


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv",
                  header: bool = True) -> DataFrame:
    """A2: like ``read_table`` but a missing or zero-byte source gives an empty frame."""
    try:
        return read_table(spark, path, schema, fmt, header)
    except (FileNotFoundError, EmptySourceError):
        return spark.createDataFrame([], schema)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def parse_records(df: DataFrame, col: str, schema: T.StructType | str, keep: Sequence[str] | None = None) -> DataFrame:
    """A3: JSON text column → typed columns (``from_json``, works on streams)."""
    keep = list(keep) if keep is not None else [c for c in df.columns if c != col]
    parsed = F.from_json(F.col(col), schema)
    return df.select(*keep, parsed.alias("_rec")).select(*keep, "_rec.*")


def parse_csv_text(df: DataFrame, col: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """A4: CSV text held in a column (an upload) → typed rows.

    Every text is split by a CSV reader (quoted commas, quotes and line breaks
    are data) and its columns are taken by the names in its own header; a
    column absent there is null, as is a value that doesn't convert or an
    empty one.  Blank lines are skipped; null text gives no rows.
    """
    fields = _struct(df.sparkSession, schema)
    names = fields.names

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: _csv_rows(text, names, header))

    rows = df.select(F.explode(split(F.col(col).cast("string"))).alias("_r"))
    out = []
    for k, f in enumerate(fields.fields):
        value = F.when(F.col("_r")[k] != "", F.col("_r")[k])
        out.append((value if isinstance(f.dataType, T.StringType) else F.trim(value).try_cast(f.dataType)).alias(f.name))
    return rows.select(*out)


def _csv_rows(text: str | None, names: Sequence[str], header: bool) -> list[list[str | None]]:
    """The lines of a CSV text as values in the order of ``names``."""
    lines = [line for line in csv.reader(io.StringIO(text or "", newline="")) if any(v.strip() for v in line)]
    if header:
        place = {name.strip(): k for k, name in enumerate(lines[0])} if lines else {}
        lines = lines[1:]
    else:
        place = {name: k for k, name in enumerate(names)}
    return [[line[place[n]] if n in place and place[n] < len(line) else None for n in names] for line in lines]


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: Sequence[str] = (), header: bool = True) -> None:
    """A5: write a table (Parquet by default, CSV with header on request)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", header)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def with_log_columns(df: DataFrame, prediction: str, probability: str, stage: str, version: str,
                     latency: float | str, label_col: str = "Churn") -> DataFrame:
    """A6 columns: decoded label, probability, UTC time, stage, version, latency, date."""
    lat = F.col(latency) if isinstance(latency, str) else F.lit(float(latency))
    return (df.withColumn(label_col, F.when(F.col(prediction).cast("int") == 1, "Yes").otherwise("No"))
            .withColumn("probability", F.col(probability).cast("double"))
            .withColumn("timestamp", F.current_timestamp())
            .withColumn("model_stage", F.lit(stage)).withColumn("model_version", F.lit(version))
            .withColumn("latency", lat.cast("double"))
            .withColumn("date", F.to_date("timestamp")))


def append_inference_log(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Append scored rows in one batch, partitioned by date (not row by row)."""
    out = df.select(*columns, "date") if columns else df
    out.write.mode("append").partitionBy("date").parquet(path)


def _newest(spark: SparkSession, path: str) -> int:
    """The newest committed version of a table, 0 when there is none."""
    try:
        return spark.read.parquet(f"{path}/versions").agg(F.max("version")).first()[0]
    except AnalysisException:
        return 0


def read_current(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read the newest committed version of a table written by ``overwrite_after_merge``."""
    v = _newest(spark, path)
    if not v:
        raise FileNotFoundError(path)
    return spark.read.format(fmt).load(f"{path}/v{v}")


def overwrite_after_merge(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write the next version of a table and return its folder.

    Spark cannot overwrite the files it is reading, so each merge writes
    ``v<n+1>`` whole and then adds the number to the small ``versions`` table;
    a write that failed half-way was never added and is overwritten.
    """
    v = _newest(df.sparkSession, path) + 1
    target = f"{path}/v{v}"
    df.write.mode("overwrite").format(fmt).save(target)
    df.sparkSession.createDataFrame([(v,)], "version int").coalesce(1).write.mode("append").parquet(f"{path}/versions")
    return target


def save_params(spark: SparkSession, path: str, encoder: DataFrame | None = None,
                scaler: dict | None = None) -> None:
    """Persist encoder codes and scaler parameters as small Parquet tables."""
    if encoder is not None:
        encoder.write.mode("overwrite").parquet(f"{path}/encoder")
    if scaler is not None:
        rows = [(c, float(a) if a is not None else None, float(b) if b is not None else None)
                for c, (a, b) in scaler.items()]
        spark.createDataFrame(rows, "column string, a double, b double").write.mode("overwrite") \
            .parquet(f"{path}/scaler")


def load_params(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """Load what ``save_params`` wrote."""
    enc = spark.read.parquet(f"{path}/encoder")
    sc = {r["column"]: (r["a"], r["b"]) for r in spark.read.parquet(f"{path}/scaler").collect()}
    return enc, sc


def save_model(model, path: str) -> None:
    """Persist a fitted Spark ML pipeline (overwrites)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a pipeline written by ``save_model``."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_drift_report(report: DataFrame, path: str) -> None:
    """Drift result as JSON lines."""
    report.write.mode("overwrite").json(path)
