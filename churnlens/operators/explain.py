"""Per-row attributions (H12) and their summary.

* Linear models: exact attributions phi_j = w_j · (x_j − mean_j) on the
  log-odds scale, base = w · mean + b — plain column arithmetic.
* Any model: sampled Shapley values (Štrumbelj & Kononenko 2014).  For each
  row, ``m`` samples per feature draw a background row and a random feature
  order (seeded hashes); the model scores the two hybrid rows with and
  without the feature, and the average difference is the attribution.  The
  background is usually a sample of 100 rows; the work is rows × features × m × 2 model rows.  Tree models are
  tabulated first (``trees.worth_grid``), so that a model row is one look-up.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.operators.merge import sample_n
from churnlens.operators.ordered import default_ranges, prefix_sums
from churnlens.operators.trees import Grid, TreeModel, forest_model, worth_grid
from churnlens.session import materialize


def _long(df: DataFrame, row_id: str, features: Sequence[str], phi_prefix: str) -> DataFrame:
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"{phi_prefix}{f}").alias("phi")) for f in features])
    return df.select(row_id, "base", F.explode(arr).alias("_a")).select(row_id, "_a.feature", "_a.phi", "base")


def explain_linear(df: DataFrame, row_id: str, features: Sequence[str], weights: Sequence[float],
                   intercept: float, background: DataFrame | None = None) -> DataFrame:
    """Exact attributions of a linear (logistic) model: (row_id, feature, phi, base)."""
    bg = background if background is not None else df
    means = bg.agg(*[F.avg(F.col(f).cast("double")).alias(f) for f in features]).first()
    base = float(intercept) + sum(float(w) * float(means[f]) for f, w in zip(features, weights))
    out = df.select(row_id, *[(F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(means[f]))))
                              .alias(f"_phi_{f}") for f, w in zip(features, weights)])
    return _long(out.withColumn("base", F.lit(base)), row_id, features, "_phi_")


def logistic_weights(model) -> tuple[list[float], float]:
    """Coefficients of the last stage of a fitted logistic pipeline."""
    lr = model.stages[-1] if hasattr(model, "stages") else model
    return [float(x) for x in lr.coefficients.toArray()], float(lr.intercept)


def explain_sampled(df: DataFrame, model, row_id: str, features: Sequence[str], background: DataFrame | None = None,
                    samples: int = 100, seed: int = 7) -> DataFrame:
    """Sampled Shapley values for any fitted pipeline: (row_id, feature, phi, base).

    Each input row is attributed by itself, also where ids repeat.  The
    default background is the input.
    """
    background = df if background is None else background
    n_bg = background.count()
    if n_bg == 0:
        raise ValueError("the background holds no row")
    d = len(features)
    grid = model_grid(model, features)
    bg = background.select(*[F.col(f).cast("double").alias(f"_z_{f}") for f in features])
    # deterministic index over the background: position in the order of its contents
    zs = bg.columns
    bg = prefix_sums(bg.groupBy(*zs).agg(F.count(F.lit(1)).alias("_n")), zs, ["_n"])
    bg = bg.select(*zs, F.explode(F.sequence(F.col("cum__n") - F.col("_n"), F.col("cum__n") - 1)).alias("_bi"))
    # a key for every row; written, so that it is the same wherever it is read
    x = materialize(df.select(row_id, *[F.col(f).cast("double").alias(f) for f in features])
                    .withColumn("_rk", F.monotonically_increasing_id()), "explain_rows")
    rows = x
    if grid is not None:
        # a draw carries the two cells that its rows lie in, not their values
        rows = x.select("_rk", _cell(grid, features).alias("_xc"))
        bg = materialize(bg.select("_bi", _cell(grid, zs).alias("_zc")), "explain_background")
    # one row per (row, feature j, sample s); the input rows are dealt out first, each makes d * samples draws
    draws = rows.repartition(default_ranges(x), "_rk").select("*", F.explode(F.sequence(F.lit(0), F.lit(d * samples - 1))).alias("_s"))
    draws = (draws.withColumn("_j", (F.col("_s") % d).cast("int"))
             .withColumn("_bi", F.pmod(F.xxhash64(F.col("_rk"), F.col("_s"), F.lit(seed)), F.lit(n_bg))))
    draws = draws.join(bg, "_bi")

    def key(i: int):
        return F.xxhash64(F.col("_rk"), F.col("_s"), F.lit(seed + 1), F.lit(i))

    key_j = F.element_at(F.array(*[key(i) for i in range(d)]), F.col("_j") + 1)
    names = F.array(*[F.lit(f) for f in features])
    if grid is not None:
        keyed = draws.select("_rk", "_xc", "_zc", "_j", key_j.alias("_kj"), *[key(i).alias(f"_k{i}") for i in range(d)])
        before = sum((F.when(F.col(f"_k{i}") < F.col("_kj"), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(d)), F.lit(0))
        parts = _grid_differences(keyed.select("_rk", "_j", "_xc", "_zc", before.alias("_before")), grid, d)
        phi = parts.groupBy("_rk", "_j").agg((F.sum("_d") / samples).alias("phi")).join(x.select("_rk", row_id), "_rk")
        base_val = _grid_mean(background, grid, features)
    else:
        plus, minus = {}, {}
        for i, f in enumerate(features):
            before = key(i) < key_j
            is_j = F.col("_j") == i
            plus[f] = F.when(before | is_j, F.col(f)).otherwise(F.col(f"_z_{f}"))
            minus[f] = F.when(before & ~is_j, F.col(f)).otherwise(F.col(f"_z_{f}"))
        both = (draws.select(row_id, "_rk", "_j", "_s", F.lit(1.0).alias("_sign"), *[plus[f].alias(f) for f in features])
                .unionByName(draws.select(row_id, "_rk", "_j", "_s", F.lit(-1.0).alias("_sign"),
                                          *[minus[f].alias(f) for f in features])))
        scored = model.transform(both).withColumn("_p", vector_to_array("probability")[1])
        phi = scored.groupBy("_rk", row_id, "_j").agg((F.sum(F.col("_sign") * F.col("_p")) / samples).alias("phi"))
        base_val = model.transform(background).select(F.avg(vector_to_array("probability")[1])).first()[0]
    return phi.select(row_id, F.element_at(names, F.col("_j") + 1).alias("feature"), "phi",
                      F.lit(float(base_val)).alias("base"))


@dataclass(frozen=True)
class _SharedGrid:
    """The table of a model on the executors; ``at`` are the places of its features among those explained."""
    grid: Grid
    worth: Broadcast
    at: tuple[int, ...]


def model_grid(model, features: Sequence[str]) -> _SharedGrid | None:
    """The probability that a tree model gives, by the places of its features; None for other models and for those
    whose table would be too large."""
    last = model
    if hasattr(model, "stages"):
        if len(model.stages) != 2 or not isinstance(model.stages[0], VectorAssembler):
            return None
        inputs, last = model.stages[0].getInputCols(), model.stages[-1]
        if model.stages[0].getHandleInvalid() != "keep":
            return None
        if isinstance(last, RandomForestClassificationModel) and last.numClasses == 2 or isinstance(last, GBTClassificationModel):
            try:
                last = forest_model(model, inputs)
            except ValueError:  # splits on sets of categories
                return None
    if not isinstance(last, TreeModel) or not set(last.features) <= set(features):
        return None
    grid = worth_grid(last, False)
    if grid is None:
        return None
    worth = SparkSession.getActiveSession().sparkContext.broadcast(grid.worth)
    light = Grid(grid.used, grid.cuts, np.zeros(0), False)  # the table travels once an executor
    return _SharedGrid(light, worth, tuple(list(features).index(last.features[f]) for f in grid.used))


def _cell(shared: _SharedGrid, columns: Sequence[str]) -> Column:
    """The cell of the table that a row lies in."""
    grid, at = shared.grid, list(shared.at)

    @F.pandas_udf(T.LongType())
    def cell(x: pd.DataFrame) -> pd.Series:
        values = x.to_numpy(float)[:, at]
        places = [np.searchsorted(c, values[:, k]) for k, c in enumerate(grid.cuts)]
        return pd.Series(np.stack(places, 1) @ grid.strides)

    return cell(F.struct(*[F.col(c).cast("double") for c in columns]))


def _grid_mean(df: DataFrame, shared: _SharedGrid, features: Sequence[str]) -> float:
    worth = shared.worth

    @F.pandas_udf(T.DoubleType())
    def value(cells: pd.Series) -> pd.Series:
        return pd.Series(worth.value[cells.to_numpy()])

    return df.select(value(_cell(shared, features)).alias("_p")).agg(F.avg("_p")).first()[0]


def _grid_differences(draws: DataFrame, shared: _SharedGrid, d: int) -> DataFrame:
    """``_rk, _j, _d``: worth with the feature less worth without it, summed over draws that lie together."""
    grid, worth, at = shared.grid, shared.worth, shared.at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rk, j, xc, zc, before = (np.asarray(c) for c in batch.columns)
            xs, zs = np.unravel_index(xc, grid.shape), np.unravel_index(zc, grid.shape)
            minus, step = zc.copy(), np.zeros(len(zc), np.int64)
            for k, (i, stride) in enumerate(zip(at, grid.strides)):
                gain = (xs[k] - zs[k]) * stride
                minus += gain * ((before >> i) & 1)
                step += gain * (j == i)
            diff = worth.value[minus + step] - worth.value[minus]
            rows, row = np.unique(rk, return_inverse=True)
            sums = np.bincount(row * d + j, weights=diff, minlength=len(rows) * d)
            yield pa.record_batch([pa.array(np.repeat(rows, d)), pa.array(np.tile(np.arange(d, dtype=np.int32), len(rows))),
                                   pa.array(sums)], names=["_rk", "_j", "_d"])

    return draws.mapInArrow(run, "_rk long, _j int, _d double")


def explain_summary(phi: DataFrame) -> DataFrame:
    """Mean and max of |phi| per feature."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"),
                                      F.max(F.abs("phi")).alias("max_abs_phi"))


def default_background(df: DataFrame, key: str, n: int = 100, seed: int = 42) -> DataFrame:
    """The fixed-size background sample."""
    return sample_n(df, n, seed, key)
