"""Aggregation and exploration (family E).

Each family is one plan: categoricals are unpivoted once and counted in one
``groupBy`` (not one job per column), min/max come in as scalar subqueries
that Catalyst merges into one scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators.ordered import exact_quantiles, null_safe_join
from churnlens.operators.reshape import melt
from churnlens.session import materialize


def class_share(df: DataFrame, target: str) -> DataFrame:
    """Rows and percent per class (the window runs over #classes rows)."""
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()))


def crosstab_all(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Counts per (column, value, class) for all columns in one group-by."""
    long = melt(df, cols, ids=[target])
    return long.groupBy("column", "value", target).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, cols: Sequence[str], target: str, classes: Sequence) -> DataFrame:
    """E2 wide form: one count column per class (pivot on a fixed class list)."""
    long = melt(df, cols, ids=[target])
    return (long.groupBy("column", "value").pivot(target, list(classes))
            .agg(F.count(F.lit(1))).fillna(0))


def rate_by(df: DataFrame, key: str | Sequence[str], flag: str) -> DataFrame:
    """Mean of a 0/1 flag and row count per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(flag).alias("n_flag"),
                                 F.avg(flag).alias("rate"))


def means_by_class(df: DataFrame, nums: Sequence[str], target: str) -> DataFrame:
    """Class means side by side."""
    return df.groupBy(target).agg(*[F.avg(c).alias(f"mean_{c}") for c in nums])


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """E5: equal-width counts between min and max, last bin closed; empty
    bins are there with 0 (a constant column has bin 0 only).

    Min and max are scalar subqueries (merged into one scan by Catalyst),
    so the whole operator is a single lazy plan.
    """
    x = F.col(col).cast("double")
    lo = df.agg(F.min(x)).scalar()
    hi = df.agg(F.max(x)).scalar()
    width = (hi - lo) / F.lit(float(bins))
    idx = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / width), F.lit(bins - 1))).cast("int")
    counts = df.where(x.isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    every = every.where(lo.isNotNull() & ((hi > lo) | (F.col("bin") == 0)))
    return every.join(counts, "bin", "left").select(
        "bin", (lo + F.col("bin") * width).alias("lo"), (lo + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def density(df: DataFrame, col: str, by: str, grid: int = 200, bw: str = "scott", cut: float = 3.0,
            bins: int | None = None) -> DataFrame:
    """Gaussian kernel density per class, each class normalised alone.

    Bandwidth h = factor × sample std with Scott's factor n^(-1/5) or
    Silverman's (3n/4)^(-1/5).  The grid per class spans
    [min − cut·h, max + cut·h].  Work is distinct values × grid points
    (each distinct value carries its count), not rows × grid.  For a
    continuous column on a very large table, ``bins`` first snaps values to
    the centres of that many equal-width bins over [min, max] (a fine
    histogram), so the work is bins × grid; the error is bounded by half a
    bin width relative to the bandwidth.
    """
    x = F.col(col).cast("double")
    data = df.where(x.isNotNull() & F.col(by).isNotNull()).select(F.col(by), x.alias("_x"))
    stats = data.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"),
                                 F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    factor = (F.pow(F.col("_n"), F.lit(-0.2)) if bw == "scott"
              else F.pow(F.col("_n") * 0.75, F.lit(-0.2)))
    stats = (stats.withColumn("_h", factor * F.col("_sd"))
             .withColumn("_g0", F.col("_min") - cut * F.col("_h"))
             .withColumn("_step", (F.col("_max") - F.col("_min") + 2 * cut * F.col("_h")) / F.lit(grid - 1)))
    if bins:
        lo = data.agg(F.min("_x")).scalar()
        hi = data.agg(F.max("_x")).scalar()
        width = (hi - lo) / F.lit(float(bins))
        idx = F.least(F.floor((F.col("_x") - lo) / width), F.lit(bins - 1))
        snapped = F.when(hi == lo, F.col("_x")).otherwise(lo + (idx + 0.5) * width)
        dv = data.groupBy(by, snapped.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    else:
        dv = data.groupBy(by, "_x").agg(F.count(F.lit(1)).alias("_c"))
    j = dv.join(stats.where(F.col("_h") > 0), by)  # one row per class: small side
    pts = j.select(by, "_x", "_c", "_n", "_h", "_g0", "_step",
                   F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("_gi"))
    gx = F.col("_g0") + F.col("_gi") * F.col("_step")
    z = (gx - F.col("_x")) / F.col("_h")
    contrib = F.col("_c") * F.exp(-0.5 * z * z)
    out = pts.groupBy(by, "_gi").agg(F.first(gx).alias("x"), F.sum(contrib).alias("_s"),
                                   F.first("_n").alias("_n"), F.first("_h").alias("_h"))
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return out.select(by, F.col("_gi").alias("grid_index"), "x", (F.col("_s") / norm).alias("density"))


def density_binned(df: DataFrame, col: str, by: str, grid: int = 200, bw: str = "scott", cut: float = 3.0,
                   bins: int = 4096) -> DataFrame:
    """E6 for a continuous column: as ``density``, from ``bins`` or more linear bins and one convolution a class.

    A value is shared between the two bins it lies between, in proportion to
    its nearness, so the binned sums keep every class's mass and mean.  The
    bins are the grid refined, so each grid point is a bin.  The rows are read
    twice (spread, bins); a class is then one group of bins, convolved with the
    kernel by a fast Fourier transform: rows + bins log bins, whatever the
    number of distinct values.
    """
    x = F.col(col).cast("double")
    data = df.where(x.isNotNull() & F.col(by).isNotNull()).select(F.col(by), x.alias("_x"))
    fine = -(-bins // (grid - 1))  # bins a grid step
    last = fine * (grid - 1)
    stats = data.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.stddev_samp("_x").alias("_sd"), F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    factor = F.pow(F.col("_n"), F.lit(-0.2)) if bw == "scott" else F.pow(F.col("_n") * 0.75, F.lit(-0.2))
    stats = stats.withColumn("_h", factor * F.col("_sd")).where("_h > 0")
    stats = stats.withColumn("_g0", F.col("_min") - cut * F.col("_h")).withColumn(
        "_width", (F.col("_max") - F.col("_min") + 2 * cut * F.col("_h")) / F.lit(last))
    stats = materialize(stats.select(by, "_n", "_h", "_g0", "_width"), "density_classes")
    at = (F.col("_x") - F.col("_g0")) / F.col("_width")
    placed = data.join(F.broadcast(stats.select(by, "_g0", "_width")), by).withColumn("_at", at).withColumn("_b", F.floor("_at").cast("int"))
    part = F.col("_at") - F.col("_b")
    shares = placed.select(by, F.explode(F.array(F.struct(F.col("_b").alias("bin"), (1 - part).alias("w")),
                                                 F.struct((F.col("_b") + 1).alias("bin"), part.alias("w")))).alias("_s"))
    sums = shares.groupBy(by, F.col("_s.bin").alias("bin")).agg(F.sum("_s.w").alias("w"))
    cells = sums.join(F.broadcast(stats), by).select(by, "bin", "w", "_n", "_h", "_g0", "_width")

    def convolve(pdf: pd.DataFrame) -> pd.DataFrame:
        n, h, g0, width = (float(pdf[c].iloc[0]) for c in ("_n", "_h", "_g0", "_width"))
        mass = np.zeros(last + 2)
        np.add.at(mass, pdf["bin"].to_numpy(), pdf["w"].to_numpy())
        size = 1 << (2 * len(mass) - 1).bit_length()
        away = np.minimum(np.arange(size), size - np.arange(size)) * width / h
        sums = np.fft.irfft(np.fft.rfft(mass, size) * np.fft.rfft(np.exp(-0.5 * away * away)), size)[:last + 1:fine]
        points = np.arange(grid)
        return pd.DataFrame({by: pdf[by].iloc[0], "grid_index": points.astype(np.int32), "x": g0 + points * fine * width,
                             "density": np.maximum(sums, 0.0) / (n * h * math.sqrt(2 * math.pi))})

    by_type = data.schema[by].dataType.simpleString()
    return cells.groupBy(by).applyInPandas(convolve, f"`{by}` {by_type}, grid_index int, x double, density double")


def box_stats(df: DataFrame, x: str, y: str, hue: str, whisker: float = 1.5) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per (x, hue)."""
    # distinct values with counts (combined map-side), written once: quartiles
    # and whiskers both read it, and a hot group costs its distinct values,
    # not its rows
    dv = materialize(df.where(F.col(y).isNotNull())
                     .groupBy(x, hue, F.col(y).cast("double").alias(y)).agg(F.count(F.lit(1)).alias("_w")),
                     "box_values")
    qs = exact_quantiles(dv, y, [0.25, 0.5, 0.75], by=[x, hue], names=["q1", "median", "q3"], weight="_w")
    qs = materialize(qs, "box_quartiles")  # one row per group: read twice, small by its file size
    qs = (qs.withColumn("iqr", F.col("q3") - F.col("q1"))
          .withColumn("lo_fence", F.col("q1") - whisker * F.col("iqr"))
          .withColumn("hi_fence", F.col("q3") + whisker * F.col("iqr")))
    j = null_safe_join(dv, qs, [x, hue])  # qs has one row per group
    inside = (F.col(y) >= F.col("lo_fence")) & (F.col(y) <= F.col("hi_fence"))
    agg = j.groupBy(x, hue).agg(
        F.min(F.when(inside, F.col(y))).alias("whisker_lo"),
        F.max(F.when(inside, F.col(y))).alias("whisker_hi"),
        F.sum(F.when(~inside, F.col("_w")).otherwise(0)).alias("n_outliers"))
    return null_safe_join(qs, agg, [x, hue]).select(x, hue, "n", "q1", "median", "q3", "iqr",
                                         "whisker_lo", "whisker_hi", "n_outliers")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (col_a, col_b, corr), one aggregate."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
                    for a, b in pairs])
    long = wide.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    return long.select(F.split("pair", r"\|")[0].alias("col_a"), F.split("pair", r"\|")[1].alias("col_b"), "corr")


def count_distinct_all(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-null values per column (exact; distinct pairs combined map-side)."""
    cols = list(cols or df.columns)
    long = melt(df, cols).where(F.col("value").isNotNull())
    return long.select("column", "value").distinct().groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct"))


def approx_distinct_all(df: DataFrame, cols: Sequence[str] | None = None, rsd: float = 0.01) -> DataFrame:
    """E9 at scale: HyperLogLog++ estimates, one pass, no shuffle of values."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_distinct")
