"""Metric aggregates over the request/prediction log, batch or streaming.

The aggregate functions (J2–J6, J8 counts) are written once and accept both a
batch and a streaming DataFrame.  The runners below drive a streaming query
to completion with an ``availableNow`` trigger and a ``foreachBatch`` sink.
Sources are file streams over tables as they lie; Spark splits each
micro-batch over tasks as it splits any scan.

Rows may arrive twice or late.  ``replay_safe`` lets each row through once
within the watermark's delay and drops rows behind it, so the state is that of
one delay, however long the stream; what it lets through reaches the sink
exactly once, because a batch is written to a folder of its own number.
Sink and checkpoint lie together under a path the caller gives (or a fresh
folder in the session's shared checkpoint folder, never a machine-local one),
so a restarted job resumes from its checkpoint and never overwrites what an
earlier run wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.constants import INTERNAL_ENDPOINTS, SCRAPE_INTERVAL
from churnlens.session import materialize as _materialize
from churnlens.session import scratch_path as _scratch_path

# --- fixed values: default latency histogram bucket edges (seconds) ---
DEFAULT_LATENCY_EDGES = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def _event_time(df: DataFrame, col: str) -> Column:
    """Event time as TIMESTAMP (parquet gives TIMESTAMP_NTZ; watermarks need TIMESTAMP)."""
    return F.col(col).cast("timestamp") if isinstance(df.schema[col].dataType, T.TimestampNTZType) else F.col(col)


def with_watermark(df: DataFrame, time_col: str, delay: str | None) -> DataFrame:
    """Streams: event time as TIMESTAMP with a watermark.  Batch: unchanged —
    windows over TIMESTAMP_NTZ are aligned on the naive epoch, independent of
    the session time zone."""
    if not df.isStreaming:
        return df
    out = df.withColumn(time_col, _event_time(df, time_col))
    return out.withWatermark(time_col, delay) if delay else out


def replay_safe(df: DataFrame, keys: Sequence[str], time_col: str, delay: str) -> DataFrame:
    """Each row (told by ``keys``) once.

    On a stream the keys are remembered until the watermark has passed a row's
    time by ``delay`` (``dropDuplicatesWithinWatermark``), and rows that come
    later than that, or without a time, are left out.  The rows are dealt by all of ``keys``, so a
    request or customer with a third of all rows is spread.
    """
    if not df.isStreaming:
        return df.dropDuplicates(list(keys))
    timed = with_watermark(df, time_col, delay)
    return timed.where(F.col(time_col).isNotNull()).dropDuplicatesWithinWatermark(list(keys))


def request_counts(df: DataFrame, time_col: str, endpoint: str, method: str | None = None,
                   every: str = SCRAPE_INTERVAL, slide: str | None = None,
                   exclude: Sequence[str] = INTERNAL_ENDPOINTS, watermark: str | None = None) -> DataFrame:
    """Requests per window, endpoint (and method); internal paths excluded."""
    d = with_watermark(df, time_col, watermark).where(~F.col(endpoint).isin(list(exclude)))
    win = F.window(time_col, every, slide) if slide else F.window(time_col, every)
    keys = [endpoint] + ([method] if method else [])
    g = d.groupBy(win.alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *keys, "n")


def latency_histogram(df: DataFrame, by: Sequence[str], latency: str,
                      edges: Sequence[float] = DEFAULT_LATENCY_EDGES) -> DataFrame:
    """Cumulative bucket counts (le = edge, +inf last) per label set.

    Each row is exploded to all edges with a 0/1 mark, so the result is one
    additive group-by (streaming-safe) in which empty buckets are there with 0."""
    bounds = F.array(*[F.lit(float(e)) for e in edges], F.lit(float("inf")))
    d = df.where(F.col(latency).isNotNull()).select(*by, F.col(latency).cast("double").alias("_l"))
    ex = d.select(*by, "_l", F.explode(bounds).alias("le"))
    return ex.groupBy(*by, "le").agg(F.count_if(F.col("_l") <= F.col("le")).alias("n"))


def latency_summary(df: DataFrame, by: Sequence[str], latency: str) -> DataFrame:
    """Histogram sum and count per label set."""
    return df.groupBy(*by).agg(F.sum(latency).alias("sum"), F.count(latency).alias("count"))


def error_counts(df: DataFrame, by: Sequence[str], is_error: Column) -> DataFrame:
    """Failures and totals per label set."""
    return df.groupBy(*by).agg(F.count_if(is_error).alias("n_errors"), F.count(F.lit(1)).alias("n"))


def request_rows(df: DataFrame, by: Sequence[str], request: str) -> DataFrame:
    """J5 state: predicted rows per label set and request — additive, on batch or stream."""
    return df.groupBy(*by, request).agg(F.count(F.lit(1)).alias("n"))


def prediction_totals(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """J5 from its state: requests (distinct, a null is none) and predicted rows per label set."""
    request = next(c for c in rows.columns if c not in (*by, "n"))
    return rows.groupBy(*by).agg(F.count(request).alias("n_requests"), F.sum("n").cast("bigint").alias("n_rows"))


def prediction_counts(df: DataFrame, by: Sequence[str], request: str) -> DataFrame:
    """Requests (distinct) and predicted rows per model/version/stage of a batch."""
    return prediction_totals(request_rows(df, by, request), by)


def stream_prediction_counts(stream: DataFrame, by: Sequence[str], request: str, row_keys: Sequence[str], time_col: str,
                             delay: str, out_path: str | None = None, name: str = "prediction_counts",
                             stats: dict | None = None) -> DataFrame:
    """J5 on a stream: the counts of ``prediction_counts`` over all rows so far, each row counted once.

    The only state is that of ``replay_safe``; a batch's rows per request are
    written, and a request that is spread over batches is put together when
    the written rows are read.
    """
    rows = replay_safe(stream, row_keys, time_col, delay)
    sink = run_append_stream(rows, name, out_path, lambda batch: request_rows(batch, by, request), stats)
    written = stream.sparkSession.read.option("basePath", sink).parquet(sink)
    return prediction_totals(written.groupBy(*by, request).agg(F.sum("n").alias("n")), by)


def latest_gauges(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Last value per label set, ``max_by`` over the ordering columns."""
    return df.groupBy(*keys).agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("value"))


def window_category_counts(df: DataFrame, time_col: str, cols: Sequence[str], every: str,
                           watermark: str | None = None) -> DataFrame:
    """J8 state: counts per (window, column, value) — additive, so the
    streaming state is one row per window × category."""
    d = with_watermark(df, time_col, watermark)
    long = d.select(F.window(time_col, every).start.cast("timestamp_ntz").alias("window_start"),
                    F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                        for c in cols])).alias("_cv"))
    return (long.where(F.col("_cv.value").isNotNull())
            .groupBy("window_start", F.col("_cv.column").alias("column"), F.col("_cv.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")))


def windowed_js(counts: DataFrame, ref: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Jensen–Shannon distance of each window's shares to the reference shares.

    Only categories seen in the window are joined to the reference shares;
    reference categories absent from a window each add p·ln 2 / 2, which is
    ln 2 / 2 × (1 − Σ p over the seen ones) — no window × category grid.
    """
    import math
    from churnlens.operators.reshape import melt
    rc = (melt(ref, cols).where(F.col("value").isNotNull()).groupBy("column", "value")
          .agg(F.count(F.lit(1)).alias("_a")))
    rt = rc.groupBy("column").agg(F.sum("_a").alias("_ta"))
    ref_sh = rc.join(F.broadcast(rt), "column").select("column", "value", (F.col("_a") / F.col("_ta")).alias("p"))
    ct = counts.groupBy("window_start", "column").agg(F.sum("n").alias("_tb"))
    cur_sh = counts.join(ct, ["window_start", "column"]).select(
        "window_start", "column", "value", (F.col("n") / F.col("_tb")).alias("q"))
    j = cur_sh.join(ref_sh, ["column", "value"], "left").fillna(0.0, subset=["p"])
    m = (F.col("p") + F.col("q")) / 2
    term = (F.when(F.col("p") > 0, F.col("p") * F.log(F.col("p") / m)).otherwise(0.0)
            + F.col("q") * F.log(F.col("q") / m))
    per = j.groupBy("window_start", "column").agg(F.sum(term).alias("_s"), F.sum("p").alias("_pseen"))
    has_ref = rt.select("column").withColumn("_ref", F.lit(1.0))
    per = per.join(F.broadcast(has_ref), "column", "left").fillna(0.0, subset=["_ref"])
    unseen = F.greatest(F.col("_ref") - F.col("_pseen"), F.lit(0.0)) * math.log(2.0)
    js = F.sqrt(F.greatest((F.col("_s") + unseen) / 2, F.lit(0.0)))
    return per.select("window_start", "column", js.alias("js"))


def fit_sketch(ref: DataFrame, cols: Sequence[str], bins: int = 64) -> DataFrame:
    """J8 reference of numeric columns, one row a column: ``column, lo, hi, sd, bins, points`` with
    ``points`` = (mean, share) of every bin that holds reference values.  Written once."""
    long = ref.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                          for c in cols])).alias("x")).select("x.*").where("value IS NOT NULL AND NOT isnan(value)")
    spread = long.groupBy("column").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.stddev_pop("value").alias("sd"))
    binned = long.join(F.broadcast(spread), "column")  # one row a column
    counts = binned.groupBy("column", "lo", "hi", "sd", sketch_bin(F.col("value"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))
    points = counts.groupBy("column", "lo", "hi", "sd").agg(
        F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("bin", "n", "s"))).alias("cells"))  # at most bins + 2
    return _materialize(points.select("column", "lo", "hi", "sd", F.lit(bins).alias("bins"), F.transform(
        "cells", lambda c: F.struct((c["s"] / c["n"]).alias("v"), (c["n"] / F.col("total")).alias("p"))).alias("points")), "drift_sketch")


def sketch_bin(value: Column, lo: Column, hi: Column, bins: int | Column) -> Column:
    """0 below ``lo``, 1 … bins in equal widths up to ``hi``, bins + 1 from there on."""
    bins = F.lit(bins) if isinstance(bins, int) else bins
    inside = F.floor((value - lo) * bins / (hi - lo)) + 1
    return F.when(value < lo, 0).when(value >= hi, bins + 1).otherwise(inside).cast("int")


def window_bin_sums(df: DataFrame, time_col: str, sketch: DataFrame, every: str, watermark: str | None = None) -> DataFrame:
    """J8 state of numeric columns: rows and sum per (window, column, bin) — additive, a row per window and bin."""
    cols = [r[0] for r in sketch.select("column").collect()]  # one row a column
    d = with_watermark(df, time_col, watermark)
    long = d.select(F.window(time_col, every).start.cast("timestamp_ntz").alias("window_start"),
                    F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                                        for c in cols])).alias("x")).select("window_start", "x.*")
    long = long.where("value IS NOT NULL AND NOT isnan(value)").join(F.broadcast(sketch.select("column", "lo", "hi", "bins")), "column")
    return long.groupBy("window_start", "column", sketch_bin(F.col("value"), F.col("lo"), F.col("hi"), F.col("bins")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("s"))


def windowed_wasserstein(sums: DataFrame, sketch: DataFrame) -> DataFrame:
    """Distance of each window's values to the reference (area between the distribution functions, over the
    reference deviation), each bin standing at the mean of its values; ``n`` rows of the window.

    Off by at most the width of a bin; exact where the values of a bin are equal.  A window and column are at most
    2 (bins + 2) points.
    """
    total = F.sum("n").over(Window.partitionBy("window_start", "column"))
    now = sums.select("window_start", "column", (F.col("s") / F.col("n")).alias("v"), F.lit(0.0).alias("p"),
                      (F.col("n") / total).alias("q"), "n")
    then = sums.select("window_start", "column").distinct().join(F.broadcast(sketch), "column").select(
        "window_start", "column", F.explode("points").alias("x")).select(
        "window_start", "column", "x.v", "x.p", F.lit(0.0).alias("q"), F.lit(0).cast("long").alias("n"))
    order = Window.partitionBy("window_start", "column").orderBy("v")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gap = F.sum(F.col("p") - F.col("q")).over(upto)
    area = now.unionByName(then).select("window_start", "column", "n", (F.abs(gap) * (F.lead("v").over(order) - F.col("v"))).alias("a"))
    out = area.groupBy("window_start", "column").agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("a"), F.sum("n").alias("n"))
    out = out.join(F.broadcast(sketch.select("column", "sd")), "column")
    return out.select("window_start", "column", "n", F.when(F.col("sd") > 0, F.col("a") / F.col("sd")).otherwise(F.col("a")).alias("wasserstein"))


# ---------------------------------------------------------------------------
# runners
# ---------------------------------------------------------------------------

def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return _scratch_path(spark, kind, name)


def file_stream(spark: SparkSession, path: str, schema: T.StructType,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """The Parquet files under ``path`` (a folder or a pattern), and those that are added, as a stream;
    ``max_files_per_trigger`` bounds a micro-batch."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def late_rows_dropped(query) -> int:
    """Rows the stateful operators dropped as later than the watermark,
    summed over the query's recorded progress.  Spark counts them after the
    map-side partial aggregate (one per late group and partition) and, with
    its multi-operator watermark, filters late input using the previous
    batch's watermark."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators:
            n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
            total += int(n or 0)
    return total


def _drain(query) -> None:
    """Wait until the available input is read; a failed query raises its error here."""
    query.awaitTermination()


def _paths(spark: SparkSession, name: str, out_path: str | None) -> tuple[str, str]:
    """(sink, checkpoint).  Both lie under ``out_path`` when the caller gives one: a later run into
    the same path goes on where the last ended, with batch ids of its own.  Without it both are
    fresh scratch folders."""
    base = out_path or scratch_path(spark, "streams", name)
    return f"{base}/batches", f"{base}/_checkpoint_{name}"


def _write_batch(sink: str):
    """A ``foreachBatch`` writer: one folder per batch, overwritten, so a replayed batch replaces itself."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")
    return write


def observed(query, name: str) -> dict:
    """Sums of the metrics observed under ``name`` over the query's recorded progress."""
    total: dict = {}
    for p in query.recentProgress:
        row = (p.observedMetrics or {}).get(name)
        for k, v in (row.asDict() if row is not None else {}).items():
            total[k] = total.get(k, 0) + (v or 0)
    return total


def run_append_stream(stream: DataFrame, name: str, out_path: str | None = None,
                      per_batch: Callable[[DataFrame], DataFrame] | None = None, stats: dict | None = None,
                      observe: str | None = None) -> str:
    """Write the stream's rows (``per_batch`` of each micro-batch) until the input is drained; returns the folder.

    ``stats`` receives ``late_rows_dropped``, ``state_rows`` (after the last
    batch) and the metrics observed under the name ``observe``.
    """
    sink, ckpt = _paths(stream.sparkSession, name, out_path)
    write = _write_batch(sink)
    q = (stream.writeStream.foreachBatch(lambda batch, batch_id: write(per_batch(batch) if per_batch else batch, batch_id))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _drain(q)
    if stats is not None:
        stats["late_rows_dropped"] = late_rows_dropped(q)
        if q.recentProgress:
            stats["state_rows"] = sum(op.numRowsTotal for op in q.recentProgress[-1].stateOperators)
        if observe:
            stats.update(observed(q, observe))
    return sink


def run_update_stream(agg: DataFrame, keys: Sequence[str], name: str, stats: dict | None = None,
                      out_path: str | None = None) -> DataFrame:
    """Run a streaming aggregate in update mode until the input is drained.

    Each micro-batch's updated rows are written with their batch id; the
    result is the latest row per key (``max_by`` on the batch id), which is
    what a key-value sink would hold.  ``stats`` receives
    ``late_rows_dropped`` (rows behind the watermark).  ``out_path`` makes
    sink and checkpoint lasting.
    """
    spark = agg.sparkSession
    sink, ckpt = _paths(spark, name, out_path)
    q = (agg.writeStream.outputMode("update").foreachBatch(_write_batch(sink))
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    _drain(q)
    if stats is not None:
        stats["late_rows_dropped"] = late_rows_dropped(q)
    out = spark.read.option("basePath", sink).parquet(sink).drop("batch")
    vals = [c for c in out.columns if c not in (*keys, "_batch")]
    last = out.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in vals]), F.col("_batch")).alias("_r"))
    return last.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])


def score_requests(requests: DataFrame, record: str, schema: T.StructType | str, params, model, stage: str, version: str,
                   id_cols: Sequence[str], means=None, latency: float | str = 0.0, threshold: float = 0.5) -> DataFrame:
    """Parse → prepare → score → explain → log columns, one plan for a batch or a stream.

    ``record`` is a JSON text with the raw columns of ``schema``; nothing else
    is looked up.  One output row a request: ``id_cols``, the raw columns, the
    log columns and ``bad``.  A record that is null or does not parse under
    the schema is bad: its raw columns, probability, label and attributions
    are null.
    """
    from churnlens.operators.ml import predict_log
    fields = schema if isinstance(schema, T.StructType) else requests.sparkSession.createDataFrame([], schema).schema
    wide = T.StructType([*fields.fields, T.StructField("_corrupt", T.StringType())])
    parsed = requests.select(*id_cols, F.from_json(F.col(record), wide, {"columnNameOfCorruptRecord": "_corrupt"}).alias("_r"))
    bad = F.col("_r").isNull() | F.col("_r._corrupt").isNotNull()
    raw = parsed.select(*id_cols, bad.alias("bad"), *[F.col(f"_r.`{n}`").alias(n) for n in fields.names])
    names = fields.names
    out = predict_log(raw, model, params, [*id_cols, "bad", *names], means, stage, version, latency, threshold)
    return out.withColumns({c: F.when(~F.col("bad"), F.col(c)) for c in ("Churn", "probability", "attributions") if c in out.columns})


def stream_score(stream: DataFrame, record: str, schema: T.StructType | str, params, model, stage: str, version: str,
                 id_cols: Sequence[str], time_col: str, delay: str, out_path: str, means=None, name: str = "stream_score",
                 stats: dict | None = None) -> str:
    """Score each arriving request once and append it to the log, batch by batch; returns the log's folder.

    The record carries the raw columns, so the plan needs the fitted
    parameters and the model only.  A request that arrives twice within
    ``delay`` is scored once; one that is later than that is left out and
    counted.  ``stats`` receives ``requests``, ``bad`` and
    ``late_rows_dropped``.  Runs into one ``out_path`` continue each other.
    """
    once = replay_safe(stream, [*id_cols], time_col, delay)
    scored = score_requests(once, record, schema, params, model, stage, version, id_cols, means)
    watched = scored.observe("requests", F.count(F.lit(1)).alias("requests"), F.count_if("bad").alias("bad"))
    return run_append_stream(watched, name, out_path, None, stats, "requests")


def stream_upsert(stream: DataFrame, out_path: str, key: str, seq: Sequence[str], time_col: str | None = None,
                  delay: str | None = None, name: str = "stream_upsert", stats: dict | None = None) -> str:
    """Feedback arriving over time; returns the folder of the feedback table.

    With ``time_col`` and ``delay`` a row that arrives again is not written
    again (``replay_safe``), and the table does not grow with replays.  Each
    micro-batch writes one row a (key, seq): the greatest in all its columns,
    so the result does not depend on the order within a batch.  ``merged``
    applies the G2 rule to a base table and all feedback so far; the greatest
    ``seq`` wins in whatever order rows came.
    """
    from churnlens.operators.merge import greatest_row
    keys = [key, *seq]
    rows = replay_safe(stream, keys, time_col, delay) if time_col and delay else stream
    rows = rows.drop(time_col) if time_col and time_col not in keys else rows
    return run_append_stream(rows, name, out_path, lambda batch: greatest_row(batch, keys, []), stats)


def merged(spark: SparkSession, base: DataFrame, feedback: str, key: str, seq: Sequence[str]) -> DataFrame:
    """``base`` with the feedback table applied (G2): the greatest ``seq`` of a key wins; of equal
    ones the later batch."""
    from churnlens.operators.merge import upsert_log

    rows = spark.read.option("basePath", feedback).parquet(feedback).drop("batch")
    return upsert_log(base, rows, key, [*seq, "_batch"]).select(*base.columns)
