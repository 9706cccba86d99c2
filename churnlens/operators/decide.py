"""Decisions over the prediction log (family I)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens import constants as K
from churnlens.operators.metrics import stage_metrics


def version_number(c: str | Column) -> Column:
    """Numeric part of a version label ('v12' → 12)."""
    x = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(x.cast("string"), r"(\d+)", 1).try_cast("int")


def canary_decision(metrics: DataFrame, by: Sequence[str] = (), stage: str = "model_stage",
                    version: str = "model_version", min_samples: int = K.MIN_ROWS_CANARY,
                    min_improvement: float = K.CANARY_MIN_IMPROVEMENT,
                    latency_weight: float = K.CANARY_LATENCY_WEIGHT,
                    max_latency: float = K.CANARY_MAX_LATENCY_SEC) -> DataFrame:
    """One decision row (per ``by`` group) from stage metrics.

    Metrics are grouped by (stage, version); the newest version of each stage
    is compared (Q7).  score = F1 − 0.1·latency; promote when staging beats
    production by 0.01, its latency is ≤ 2 s and it has ≥ 30 samples.  A
    missing stage contributes zeros, as in the reference.
    """
    by = list(by)
    newest = metrics.groupBy(*by, stage).agg(
        F.max_by(F.struct("f1", "mean_latency", "num_samples", version), version_number(version)).alias("m"))

    def pick(s: str, field: str):
        return F.max(F.when(F.col(stage) == s, F.col(f"m.{field}")))

    one = newest.groupBy(*by).agg(
        F.coalesce(pick("Production", "f1"), F.lit(0.0)).alias("prod_f1"),
        F.coalesce(pick("Staging", "f1"), F.lit(0.0)).alias("stag_f1"),
        F.coalesce(pick("Production", "mean_latency"), F.lit(0.0)).alias("prod_latency"),
        F.coalesce(pick("Staging", "mean_latency"), F.lit(0.0)).alias("stag_latency"),
        F.coalesce(pick("Staging", "num_samples"), F.lit(0)).alias("stag_samples"),
        pick("Production", version).alias("prod_version"), pick("Staging", version).alias("stag_version"))
    one = (one.withColumn("prod_score", F.col("prod_f1") - latency_weight * F.col("prod_latency"))
           .withColumn("stag_score", F.col("stag_f1") - latency_weight * F.col("stag_latency")))
    promote = ((F.col("stag_score") > F.col("prod_score") + min_improvement)
               & (F.col("stag_latency") <= max_latency) & (F.col("stag_samples") >= min_samples))
    return (one.withColumn("promote", promote)
            .withColumn("better_model", F.when(promote, F.lit("Staging")).otherwise(F.lit("Production"))))


def decay_level(df: DataFrame, f1: str = "f1", threshold: float = K.DECAY_F1_THRESHOLD,
                out: str = "level") -> DataFrame:
    """< t retrain; < 1.05t critical; < 1.10t early; else healthy (no cap, Q11)."""
    x = F.col(f1)
    lvl = (F.when(x < threshold, "retrain").when(x < threshold * K.DECAY_CRITICAL_FACTOR, "critical")
           .when(x < threshold * K.DECAY_EARLY_FACTOR, "early").otherwise("healthy"))
    return df.withColumn(out, lvl)


def drift_level(df: DataFrame, share: str = "drift_share", threshold: float = K.DRIFT_SHARE_THRESHOLD,
                out: str = "level") -> DataFrame:
    """> t retrain; ≥ 0.8t critical; ≥ 0.6t early; else healthy."""
    x = F.col(share)
    lvl = (F.when(x > threshold, "retrain").when(x >= threshold * K.DRIFT_CRITICAL_FACTOR, "critical")
           .when(x >= threshold * K.DRIFT_EARLY_FACTOR, "early").otherwise("healthy"))
    return df.withColumn(out, lvl)


def route(df: DataFrame, key: str, weight: float, salt: str = "canary",
          has_staging: bool = True, out: str = "model_stage") -> DataFrame:
    """I4: send a repeatable ``weight`` fraction of keys to Staging (a null key stays in Production)."""
    if not has_staging:
        return df.withColumn(out, F.lit("Production"))
    # the first 32 bits of a digest, which any system can recompute
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{salt}")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 10000
    return df.withColumn(out, F.when(bucket < int(round(weight * 10000)), F.lit("Staging"))
                         .otherwise(F.lit("Production")))


def rollout_replay(log: DataFrame, time_col: str = "event_time", steps: Sequence[float] = K.CANARY_STEPS,
                   every: str = K.CANARY_STEP_WAIT, **metric_kw) -> DataFrame:
    """I5 (re-aimed): judge the canary per event-time window; the rollout
    continues while every window so far passed (running min).  Step weights
    follow the window order, the last weight repeats."""
    w = log.withColumn("_win", F.window(F.col(time_col), every).start)
    m = stage_metrics(w, extra_by=["_win"], **{"with_auc": False, **metric_kw})
    d = canary_decision(m, by=["_win"])
    # one row per window: the window over them is tiny (time span / width)
    order = Window.orderBy("_win")
    d = d.withColumn("step", F.row_number().over(order) - 1)
    weights = F.array(*[F.lit(float(s)) for s in steps])
    d = d.withColumn("weight", F.element_at(weights, F.least(F.col("step"), F.lit(len(steps) - 1)) + 1))
    d = d.withColumn("still_rolling",
                     F.min(F.col("promote").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    return d.select(F.col("_win").alias("window_start"), "step", "weight", "prod_score", "stag_score",
                    "promote", "still_rolling")


def retrain_action(levels: DataFrame, check: str = "check", level: str = "level") -> DataFrame:
    """Map (check, level) to the next action through a fixed decision table."""
    # fixed values: decision table of the monitoring flow
    table = [
        ("decay", "retrain", "combine_data"), ("decay", "critical", "send_warning_email"),
        ("decay", "early", "send_warning_email"), ("decay", "healthy", "no_model_decay"),
        ("drift", "retrain", "combine_data"), ("drift", "critical", "send_warning_email"),
        ("drift", "early", "send_warning_email"), ("drift", "healthy", "no_drift_detected"),
        ("canary", "promote", "Production"), ("canary", "keep", "Archived"),
    ]
    t = levels.sparkSession.createDataFrame(table, f"{check} string, {level} string, action string")
    return levels.join(F.broadcast(t), [check, level], "left")
