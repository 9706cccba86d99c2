"""Ordered statistics without a single-task sort.

A running sum over a whole table (or over one huge group) is the classic way
to end up with one task holding everything.  Here every ordered statistic is
built from the same three steps:

1. the (already aggregated) input is range-partitioned on its ordering columns
   and written once, each row with its range number — the ranges are balanced
   even when a single group holds most rows, and text is ordered by its full
   value;
2. running sums inside each (group, range) with a window, so each task sees
   one range of one group;
3. range totals (groups × ranges rows) turned into offsets with a window over
   that small table, joined back (null group keys included).

The result is exact: ranges only decide *where* work runs, never the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize as materialize_table

_BUCKET = "_range"


def default_ranges(df: DataFrame) -> int:
    """One range per shuffle partition, at least 4."""
    return max(4, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equality join on ``keys`` in which null keys match; the right side's keys are dropped."""
    other = right.select(*[F.col(c).alias(f"_on_{c}") if c in keys else F.col(c) for c in right.columns])
    on = F.lit(True)
    for c in keys:
        on = on & left[c].eqNullSafe(other[f"_on_{c}"])
    return left.join(other, on, how).drop(*[f"_on_{c}" for c in keys])


def add_range(df: DataFrame, order_cols: Sequence[str], n_ranges: int | None = None, name: str = _BUCKET) -> DataFrame:
    """The rows, written with a range number that never decreases in the order of ``order_cols``.

    Spark's range partitioner picks the bounds from a sample of bounded size;
    rows equal in ``order_cols`` share a range.  The table is written because
    the bounds, being sampled, must not be picked twice.
    """
    n = n_ranges or default_ranges(df)
    ranged = df.repartitionByRange(n, *[F.col(c) for c in order_cols]).withColumn(name, F.spark_partition_id())
    return materialize_table(ranged, "prefix")


def prefix_sums(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                by: Sequence[str] = (), n_ranges: int | None = None,
                with_next: bool = False, with_total: bool = False) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` in ``order_cols`` order within ``by``.

    Adds ``cum_<c>`` for every summed column, optionally ``tot_<c>`` (group
    total) and ``next_<order_cols[0]>`` (the following row's key in the same
    group, null on the last row).  Rows should be unique on ``by`` +
    ``order_cols``; callers aggregate to distinct keys first.  A null in
    ``by`` is a group like any other.

    The range-partitioned input is written once in the shared checkpoint
    folder; running sums and range totals read that table, and a lost executor
    does not replay the upstream scan and aggregation.
    """
    by = list(by)
    order_cols = list(order_cols)
    ranged = add_range(df, order_cols, n_ranges)
    part = by + [_BUCKET]
    w_local = (Window.partitionBy(*part).orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = ranged
    for c in sum_cols:
        out = out.withColumn(f"_loc_{c}", F.sum(c).over(w_local))
    if with_next:
        w_row = Window.partitionBy(*part).orderBy(*order_cols)
        out = out.withColumn("_lead", F.lead(order_cols[0]).over(w_row))

    # per-range totals: groups x ranges rows, small by construction
    # (partial aggregation keeps the shuffle at ranges x partitions rows)
    aggs = [F.sum(c).alias(f"_rt_{c}") for c in sum_cols]
    if with_next:
        aggs.append(F.min(order_cols[0]).alias("_rmin"))
    totals = ranged.groupBy(*part).agg(*aggs)
    w_prev = (Window.partitionBy(*by).orderBy(_BUCKET)
              .rowsBetween(Window.unboundedPreceding, -1))
    w_all = Window.partitionBy(*by)
    cols = list(part)
    for c in sum_cols:
        cols.append(F.coalesce(F.sum(f"_rt_{c}").over(w_prev), F.lit(0)).alias(f"_off_{c}"))
        if with_total:
            cols.append(F.sum(f"_rt_{c}").over(w_all).alias(f"tot_{c}"))
    if with_next:
        cols.append(F.lead("_rmin").over(Window.partitionBy(*by).orderBy(_BUCKET)).alias("_next_range"))
    offsets = totals.select(*cols)

    out = null_safe_join(out, offsets, part)
    for c in sum_cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_loc_{c}") + F.col(f"_off_{c}"))
        out = out.drop(f"_loc_{c}", f"_off_{c}")
    if with_next:
        out = (out.withColumn(f"next_{order_cols[0]}", F.coalesce("_lead", "_next_range"))
               .drop("_lead", "_next_range"))
    return out.drop(_BUCKET)


def _interp_bounds(n: Column, p: float):
    h = (n - 1) * F.lit(p) + 1
    return h, F.floor(h), F.ceil(h)


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    by: Sequence[str] = (), names: Sequence[str] | None = None,
                    n_ranges: int | None = None, weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (numpy/pandas default).

    Works on distinct values with their counts, so memory never depends on a
    group's row count, and no group is sorted in one task.  Returns one row
    per group with ``n`` and one column per probability.  ``weight`` names a
    count column when the input is already (by…, value, count).
    """
    by = list(by)
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    if weight is None:
        dv = (df.where(F.col(value_col).isNotNull())
              .groupBy(*by, value_col).agg(F.count(F.lit(1)).alias("_c")))
    else:
        dv = df.where(F.col(value_col).isNotNull()).select(*by, value_col, F.col(weight).alias("_c"))
    ps = prefix_sums(dv, [value_col], ["_c"], by=by, n_ranges=n_ranges, with_total=True)
    n = F.col("tot__c")
    prev = F.col("cum__c") - F.col("_c")
    aggs = [F.max("tot__c").alias("n")]
    for p, name in zip(probs, names):
        _, lo, hi = _interp_bounds(n, p)
        aggs.append(F.max(F.when((prev < lo) & (F.col("cum__c") >= lo), F.col(value_col))).alias(f"_lo_{name}"))
        aggs.append(F.max(F.when((prev < hi) & (F.col("cum__c") >= hi), F.col(value_col))).alias(f"_hi_{name}"))
    res = ps.groupBy(*by).agg(*aggs)
    for p, name in zip(probs, names):
        h, lo, _ = _interp_bounds(F.col("n"), p)
        vlo, vhi = F.col(f"_lo_{name}").cast("double"), F.col(f"_hi_{name}").cast("double")
        res = res.withColumn(name, vlo + (h - lo) * (vhi - vlo)).drop(f"_lo_{name}", f"_hi_{name}")
    return res
