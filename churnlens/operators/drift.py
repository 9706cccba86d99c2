"""Drift between a reference and a current table.

Both sides are unioned in long form with a side flag and aggregated to
(column, value) counts once; every statistic is computed from those counts.
Ordered statistics (KS, Wasserstein) use the distributed prefix sums.

The per-column choice is a design choice stated in arguments: text, or numeric
with ≤ ``cat_max_distinct`` distinct reference values, is categorical;
``method`` picks distances (Wasserstein, Jensen–Shannon) or tests (KS,
chi-square) whatever the size of the reference.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.functions.special import chi2_sf_udf, ks_p_udf, normal_two_sided_udf
from churnlens.operators.merge import last_n
from churnlens.operators.ordered import prefix_sums
from churnlens.operators.reshape import melt
from churnlens.session import materialize


def _side_counts(ref: DataFrame, cur: DataFrame, cols: Sequence[str], as_type: str) -> DataFrame:
    a = melt(ref, cols, as_type=as_type).withColumn("_side", F.lit(0))
    b = melt(cur, cols, as_type=as_type).withColumn("_side", F.lit(1))
    u = a.unionByName(b).where(F.col("value").isNotNull())
    return u.groupBy("column", "value").agg(F.count_if(F.col("_side") == 0).alias("_a"),
                                            F.count_if(F.col("_side") == 1).alias("_b"))


def _ecdf(counts: DataFrame, with_next: bool = False) -> DataFrame:
    ps = prefix_sums(counts, ["value"], ["_a", "_b"], by=["column"], with_total=True, with_next=with_next)
    return (ps.withColumn("F", F.col("cum__a") / F.col("tot__a"))
            .withColumn("G", F.col("cum__b") / F.col("tot__b")))


def ks_two_sample(ref: DataFrame, cur: DataFrame, cols: Sequence[str], with_p: bool = True) -> DataFrame:
    """max |F_ref − F_cur| per numeric column (+ asymptotic p-value)."""
    return _ks(_side_counts(ref, cur, cols, "double"), with_p)


def _ks(counts: DataFrame, with_p: bool = True) -> DataFrame:
    out = _ecdf(counts).groupBy("column").agg(
        F.max(F.abs(F.col("F") - F.col("G"))).alias("statistic"),
        F.first("tot__a").alias("n_ref"), F.first("tot__b").alias("n_cur"))
    if with_p:
        out = out.withColumn("p_value", ks_p_udf("statistic", "n_ref", "n_cur"))
    return out


def wasserstein_norm(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """∫|F − G| dx divided by the reference population std."""
    return _wasserstein(_side_counts(ref, cur, cols, "double"))


def _wasserstein(counts: DataFrame) -> DataFrame:
    """Area and reference deviation from the same (column, value) counts."""
    e = _ecdf(counts, with_next=True)
    a, v = F.col("_a"), F.col("value")
    # the mean is one number a column; the squares are summed around it
    means = e.groupBy("column").agg((F.sum(a * v) / F.first("tot__a")).alias("_m"))
    j = e.join(F.broadcast(means), "column")  # one row per column
    out = j.groupBy("column").agg(
        F.sum(F.when(F.col("next_value").isNotNull(),
                     F.abs(F.col("F") - F.col("G")) * (F.col("next_value") - v)).otherwise(0.0)).alias("_w"),
        F.sqrt(F.sum(a * (v - F.col("_m")) * (v - F.col("_m"))) / F.first("tot__a")).alias("_sd"))
    score = F.when(F.col("_sd") > 0, F.col("_w") / F.col("_sd")).otherwise(F.col("_w"))
    return out.select("column", score.alias("statistic"))


def _shares(counts: DataFrame) -> DataFrame:
    tot = counts.groupBy("column").agg(
        F.sum("_a").cast("double").alias("_ta"), F.sum("_b").cast("double").alias("_tb"),
        F.count(F.lit(1)).alias("_k"), F.min("value").alias("_first"))
    # counts as doubles: their products must not overflow; tot has one row per column
    return counts.select("column", "value", F.col("_a").cast("double").alias("_a"),
                         F.col("_b").cast("double").alias("_b")).join(F.broadcast(tot), "column")


def js_distance(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Jensen–Shannon distance (natural log) between category shares."""
    return _js(_side_counts(ref, cur, cols, "string"))


def _js(counts: DataFrame) -> DataFrame:
    s = _shares(counts)
    p = F.col("_a") / F.col("_ta")
    q = F.col("_b") / F.col("_tb")
    m = (p + q) / 2
    term = (F.when(p > 0, p * F.log(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log(q / m)).otherwise(0.0))
    out = s.groupBy("column").agg(F.sum(term).alias("_js"))
    return out.select("column", F.sqrt(F.greatest(F.col("_js") / 2, F.lit(0.0))).alias("statistic"))


def category_shift(ref: DataFrame, cur: DataFrame, cols: Sequence[str], with_p: bool = True) -> DataFrame:
    """chi-square on the (side × category) table; two-proportion z on the
    smallest category when the column is binary."""
    return _category_shift(_side_counts(ref, cur, cols, "string"), with_p)


def _category_shift(counts: DataFrame, with_p: bool = True) -> DataFrame:
    s = _shares(counts)
    n = F.col("_ta") + F.col("_tb")
    ea = (F.col("_a") + F.col("_b")) * F.col("_ta") / n
    eb = (F.col("_a") + F.col("_b")) * F.col("_tb") / n
    cell = (F.col("_a") - ea) ** 2 / ea + (F.col("_b") - eb) ** 2 / eb
    p1 = F.col("_a") / F.col("_ta")
    p2 = F.col("_b") / F.col("_tb")
    pp = (F.col("_a") + F.col("_b")) / n
    z = (p1 - p2) / F.sqrt(pp * (1 - pp) * (1.0 / F.col("_ta") + 1.0 / F.col("_tb")))
    out = s.groupBy("column").agg(F.sum(cell).alias("chi2"), F.first("_k").alias("_k"),
                                  F.max(F.when(F.col("value") == F.col("_first"), z)).alias("z"))
    binary = F.col("_k") == 2
    out = out.select("column", F.when(binary, F.lit("z")).otherwise(F.lit("chi_square")).alias("test"),
                     F.when(binary, F.col("z")).otherwise(F.col("chi2")).alias("statistic"),
                     (F.col("_k") - 1).cast("bigint").alias("dof"))
    if with_p:
        out = out.withColumn("p_value", F.when(F.col("test") == "z", normal_two_sided_udf("statistic"))
                             .otherwise(chi2_sf_udf("statistic", "dof")))
    return out


def _all_counts(ref: DataFrame, cur: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One (column, value, number) table with the counts of both sides, written once:
    kinds and every statistic of the report come from it."""
    sides = []
    for side, df in ((0, ref), (1, cur)):
        numeric = {f.name for f in ref.schema.fields if isinstance(f.dataType, T.NumericType)}
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"),
                          (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number"))
                 for c in cols]
        sides.append(df.select(F.explode(F.array(*pairs)).alias("p")).select("p.*", F.lit(side).alias("_side")))
    u = sides[0].unionByName(sides[1]).where(F.col("text").isNotNull())
    return materialize(u.groupBy("column", "text", "number").agg(
        F.count_if(F.col("_side") == 0).alias("_a"), F.count_if(F.col("_side") == 1).alias("_b")), "drift_counts")


def drift_report(ref: DataFrame, cur: DataFrame, cols: Sequence[str], cat_max_distinct: int = 5,
                 method: str = "distance", alpha: float = 0.05, distance_threshold: float = 0.1) -> DataFrame:
    """one row per column: kind, method, statistic, score, threshold, drifted.

    ``method='distance'`` (default) measures Wasserstein / Jensen–Shannon
    distances, ``method='test'`` runs KS / chi-square (z) tests; ``score`` is
    the distance or the p-value.  The choice never depends on the size of the
    data.
    """
    if method not in ("distance", "test"):
        raise ValueError(f"method must be 'distance' or 'test', got {method!r}")
    counts = _all_counts(ref, cur, cols)
    seen = counts.where((F.col("_a") > 0) & F.col("number").isNotNull()).groupBy("column").agg(
        F.count_distinct("number").alias("n"))
    distinct = {r["column"]: r["n"] for r in seen.collect()}  # one row per numeric column
    nums = [c for c in cols if distinct.get(c, 0) > cat_max_distinct]
    cats = [c for c in cols if c not in nums]
    number = counts.where(F.col("column").isin(nums)).groupBy("column", F.col("number").alias("value")).agg(
        F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    text = counts.where(F.col("column").isin(cats)).select("column", F.col("text").alias("value"), "_a", "_b")
    test = method == "test"
    parts = []
    if nums:
        k = _ks(number) if test else _wasserstein(number)
        parts.append(k.select("column", F.lit("numeric").alias("kind"), F.lit("ks" if test else "wasserstein").alias("method"),
                              "statistic", F.col("p_value" if test else "statistic").alias("score")))
    if cats:
        c = _category_shift(text) if test else _js(text)
        parts.append(c.select("column", F.lit("categorical").alias("kind"),
                              (F.col("test") if test else F.lit("jensen_shannon")).alias("method"),
                              "statistic", F.col("p_value" if test else "statistic").alias("score")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    threshold = alpha if test else distance_threshold
    drifted = F.col("score") < threshold if test else F.col("score") >= threshold
    return out.withColumn("threshold", F.lit(threshold)).withColumn("drifted", drifted)


def drift_share(report: DataFrame) -> DataFrame:
    """F8: number of columns, drifted count and share."""
    return report.agg(F.count(F.lit(1)).alias("n_columns"),
                      F.count_if("drifted").alias("drift_count"),
                      F.avg(F.col("drifted").cast("double")).alias("drift_share"))


def drift_last_n(ref: DataFrame, log: DataFrame, cols: Sequence[str], n: int, time_col: str,
                 tiebreak: str, min_rows: int = 10, **kw) -> DataFrame:
    """drift of the latest ``n`` log rows against the reference (≥ 10 rows)."""
    cur = materialize(last_n(log, n, time_col, tiebreak), "drift_last_n")  # n rows
    got = cur.count()
    if got < min_rows:
        raise ValueError(f"not enough production rows for drift ({got} < {min_rows})")
    return drift_report(ref, cur, cols, **kw)


def cleaned_sides(ref: DataFrame, cur: DataFrame, numeric_text: Sequence[str], numeric: Sequence[str],
                  categorical: Sequence[str], fill: str = "zero") -> tuple[DataFrame, DataFrame]:
    """Both sides in contract order and cleaned alike, with fill values fitted on the reference."""
    from churnlens.operators.clean import apply_cleaning, conform, fit_cleaning
    cols = [*numeric, *categorical]
    ref, cur = conform(ref, cols), conform(cur, cols)
    params = fit_cleaning(ref, numeric_text, numeric, categorical, fill)
    return apply_cleaning(ref, params), apply_cleaning(cur, params)


def drift_check(ref: DataFrame, log: DataFrame, cols: Sequence[str], n: int, time_col: str, tiebreak: str,
                min_rows: int = 10, **kw) -> DataFrame:
    """F8–F10 as one row that always comes: status ('ok' or 'not_enough_rows'), rows, columns, drifted
    columns and their share (null unless ok)."""
    cur = materialize(last_n(log, n, time_col, tiebreak), "drift_last_n")
    rows = cur.count()
    if rows < min_rows:
        return ref.sparkSession.createDataFrame(
            [("not_enough_rows", rows, None, None, None)],
            "status string, n_rows bigint, n_columns bigint, drift_count bigint, drift_share double")
    share = drift_share(drift_report(ref, cur, cols, **kw))
    return share.select(F.lit("ok").alias("status"), F.lit(rows).cast("bigint").alias("n_rows"), "n_columns",
                        "drift_count", "drift_share")
