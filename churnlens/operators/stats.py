"""Significance tests (F1, F2).

The statistic is computed by distributed aggregates; the p-value is a pandas
UDF applied to the one-row-per-column result only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.functions.special import chi2_sf_udf, t_two_sided_udf
from churnlens.operators.reshape import melt


#: Classes of a target that are looked up; more can be passed by the caller.
MAX_CLASSES = 200


def chi_square(df: DataFrame, cats: Sequence[str], target: str, correction: bool = True,
               classes: Sequence | None = None, with_p: bool = True, alpha: float = 0.05) -> DataFrame:
    """Pearson chi-square of each column against the target.

    Cells are (value × class); the class list is small and pivoted into
    columns, so every cell — including empty ones — is present on its row and
    expected counts are per-row arithmetic.  Yates' continuity correction is
    applied to 1-dof tables (magnitude at most |O − E|).
    """
    base = df.where(F.col(target).isNotNull())
    if classes is None:
        # one column a class: refuse a target that is no class label before it reaches the driver
        found = base.select(target).distinct().limit(MAX_CLASSES + 1).collect()
        if len(found) > MAX_CLASSES:
            raise ValueError(f"{target} has more than {MAX_CLASSES} values; bin it or pass classes")
        classes = sorted(r[0] for r in found)
    classes = list(classes)
    long = melt(base, cats, ids=[target]).where(F.col("value").isNotNull())
    ks = [f"_k{i}" for i in range(len(classes))]
    wide = (long.groupBy("column", "value").pivot(target, classes).agg(F.count(F.lit(1)))
            .fillna(0))
    wide = wide.select("column", "value", *[F.col(f"`{c}`").alias(k) for c, k in zip(classes, ks)])
    wide = wide.withColumn("_row", sum((F.col(k) for k in ks), F.lit(0)))
    tot = wide.groupBy("column").agg(F.count(F.lit(1)).alias("_r"), F.sum("_row").alias("_n"),
                                     *[F.sum(k).alias(f"_t{k}") for k in ks])
    j = wide.join(F.broadcast(tot), "column")  # tot: one row per tested column
    k_present = sum((F.when(F.col(f"_t{k}") > 0, 1).otherwise(0) for k in ks), F.lit(0))
    plain, yates = F.lit(0.0), F.lit(0.0)
    for k in ks:
        e = F.col("_row").cast("double") * F.col(f"_t{k}") / F.col("_n")  # counts as doubles: no overflow
        o = F.col(k)
        d = e - o
        o_adj = o + F.least(F.lit(0.5), F.abs(d)) * F.signum(d)
        present = F.col(f"_t{k}") > 0
        plain = plain + F.when(present, (o - e) * (o - e) / e).otherwise(0.0)
        yates = yates + F.when(present, (o_adj - e) * (o_adj - e) / e).otherwise(0.0)
    per = j.select("column", "_r", k_present.alias("_kp"), plain.alias("_plain"), yates.alias("_yates"))
    res = per.groupBy("column").agg(F.first("_r").alias("_r"), F.first("_kp").alias("_kp"),
                                    F.sum("_plain").alias("_plain"), F.sum("_yates").alias("_yates"))
    dof = ((F.col("_r") - 1) * (F.col("_kp") - 1)).cast("bigint")
    stat = F.when((dof == 1) & F.lit(correction), F.col("_yates")).otherwise(F.col("_plain"))
    out = res.select("column", stat.alias("statistic"), dof.alias("dof"))
    if with_p:
        out = out.withColumn("p_value", chi2_sf_udf("statistic", "dof"))
        out = out.withColumn("significant", F.col("p_value") < alpha)
    return out


def t_test(df: DataFrame, nums: Sequence[str], target: str, pos="Yes", neg="No",
           with_p: bool = True, alpha: float = 0.05) -> DataFrame:
    """pooled two-sample t per numeric column (nulls omitted), with class means."""
    long = melt(df.where(F.col(target).isin(pos, neg)), nums, ids=[target], as_type="double") \
        .where(F.col("value").isNotNull())
    is1 = F.col(target) == pos
    g = long.groupBy("column").agg(
        F.count_if(is1).alias("n1"), F.count_if(~is1).alias("n2"),
        F.avg(F.when(is1, F.col("value"))).alias("mean_pos"), F.avg(F.when(~is1, F.col("value"))).alias("mean_neg"),
        F.var_samp(F.when(is1, F.col("value"))).alias("_v1"), F.var_samp(F.when(~is1, F.col("value"))).alias("_v2"))
    dof = F.col("n1") + F.col("n2") - 2
    sp2 = ((F.col("n1") - 1) * F.col("_v1") + (F.col("n2") - 1) * F.col("_v2")) / dof
    t = (F.col("mean_pos") - F.col("mean_neg")) / F.sqrt(sp2 * (1.0 / F.col("n1") + 1.0 / F.col("n2")))
    out = g.select("column", t.alias("statistic"), dof.cast("bigint").alias("dof"), "mean_pos", "mean_neg")
    if with_p:
        out = out.withColumn("p_value", t_two_sided_udf("statistic", "dof"))
        out = out.withColumn("significant", F.col("p_value") < alpha)
    return out
