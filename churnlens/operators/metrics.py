"""Classification metrics over a scored table.

Confusion counts are one aggregate.  AUC is the Mann–Whitney statistic on
distinct scores (tie-aware): every score row contributes
pos · (negatives below + ½ · negatives equal); the "negatives below" running
sum comes from the distributed prefix sums, so no group is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.functions.columns import threshold_label
from churnlens.operators.ordered import null_safe_join, prefix_sums
from churnlens.session import materialize


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def confusion_aggs(y: str, yhat: str) -> list[Column]:
    yc, pc = F.col(y), F.col(yhat)
    return [F.count(F.lit(1)).alias("n"),
            F.count_if((yc == 1) & (pc == 1)).alias("tp"), F.count_if((yc == 0) & (pc == 1)).alias("fp"),
            F.count_if((yc == 1) & (pc == 0)).alias("fn"), F.count_if((yc == 0) & (pc == 0)).alias("tn")]


def metrics_from_counts(df: DataFrame) -> DataFrame:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    prec = _ratio(tp, tp + fp)
    rec = _ratio(tp, tp + fn)
    return (df.withColumn("accuracy", _ratio(tp + tn, tp + fp + fn + tn))
            .withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn)))


def binary_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """H9: accuracy, precision, recall, F1 (0 when undefined), per group."""
    return metrics_from_counts(df.groupBy(*by).agg(*confusion_aggs(y, yhat)))


def _auc_from_counts(per_score: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """AUC per group from (by…, score, _pos, _neg); products in double, so no count overflows."""
    by = list(by)
    ps = prefix_sums(per_score, [score], ["_neg"], by=by)
    pos, neg = F.col("_pos").cast("double"), F.col("_neg").cast("double")
    contrib = pos * (F.col("cum__neg").cast("double") - neg + 0.5 * neg)
    agg = ps.groupBy(*by).agg(F.sum(contrib).alias("_u"), F.sum(pos).alias("_p"), F.sum(neg).alias("_q"))
    auc = F.when((F.col("_p") > 0) & (F.col("_q") > 0), F.col("_u") / (F.col("_p") * F.col("_q")))
    return agg.select(*by, auc.alias("roc_auc"))


def roc_auc(df: DataFrame, y: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Tie-aware ROC AUC per group (a null key is a group); null when a group has one class."""
    per_score = (df.where(F.col(score).isNotNull() & F.col(y).isNotNull())
                 .groupBy(*by, score).agg(F.count_if(F.col(y) == 1).alias("_pos"),
                                          F.count_if(F.col(y) != 1).alias("_neg")))
    return _auc_from_counts(per_score, score, by)


def stage_metrics(log: DataFrame, label: str = "label", prob: str = "probability",
                  stage: str = "model_stage", version: str = "model_version", latency: str = "latency",
                  min_samples: int = 30, threshold: float = 0.5, inclusive: bool = False,
                  extra_by: Sequence[str] = (), with_auc: bool = True) -> DataFrame:
    """Per (stage, version): H9 + H10 + mean latency + sample count;
    groups under ``min_samples`` rows are skipped (the cut-off is ``> t`` as in
    the canary check unless ``inclusive``).

    The log is reduced once, map-side combined, to (group, score) counts;
    confusion counts, latency and AUC all come from that written table.
    ``with_auc=False`` leaves the AUC out for callers that don't judge by it.
    """
    by = [*extra_by, stage, version]
    y = F.col(label)
    per_score = materialize(
        log.where(y.isNotNull()).groupBy(*by, F.col(prob).alias("_score")).agg(
            F.count(F.lit(1)).alias("_all"), F.count_if(y == 1).alias("_pos"), F.count_if(y != 1).alias("_neg"),
            F.count_if(y == 0).alias("_zero"), F.sum(latency).alias("_lat"), F.count(latency).alias("_nlat")),
        "stage_scores")
    hit = threshold_label("_score", threshold, inclusive) == 1
    miss = threshold_label("_score", threshold, inclusive) == 0

    def total(c: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))

    counts = per_score.groupBy(*by).agg(
        F.sum("_all").alias("n"), total("_pos", hit).alias("tp"), total("_zero", hit).alias("fp"),
        total("_pos", miss).alias("fn"), total("_zero", miss).alias("tn"),
        (F.sum("_lat") / F.sum(F.when(F.col("_nlat") > 0, F.col("_nlat")))).alias("mean_latency"))
    m = metrics_from_counts(counts.where(F.col("n") >= min_samples))
    if with_auc:
        auc = _auc_from_counts(per_score.where(F.col("_score").isNotNull()).select(*by, "_score", "_pos", "_neg"),
                               "_score", by)
        m = null_safe_join(m, auc, by, "left")
    else:
        m = m.withColumn("roc_auc", F.lit(None).cast("double"))
    return m.select(*by, F.col("n").alias("num_samples"), "accuracy", "precision", "recall", "f1", "roc_auc",
                    "mean_latency")
