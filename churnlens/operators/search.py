"""Training as configured (H3-H5, H7, H8, L1): every kind of model searched over its grid, the best of each ranked.

The forest's grid goes through Spark's cross validation with stratified folds.
All points and folds of the boosted search grow in the same jobs, and all
points of the network's grid are trained in the same steps; their held-out
rows are scored in one pass.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.operators import boosting, network
from churnlens.operators.metrics import binary_metrics
from churnlens.operators.ml import (FOREST_DEFAULTS, MAX_TREE_DEPTH, assembler, class_weights, grid_search, smallest_leaf, stratified_folds,
                                    stratified_split, train_logistic)
from churnlens.operators.trees import TreeModel
from churnlens.session import materialize

# --- fixed values: grids of the reference configuration ---
FOREST_GRID = {"n_estimators": [200, 300, 500], "max_depth": [10, 15, None], "min_samples_split": [5, 10, 20]}
BOOSTED_GRID = {"lr": [0.01, 0.05, 0.1], "depth": [6, 7, 10], "trees": [200, 300, 400], "subsample": [0.8, 1.0], "colsample": [0.8, 1.0]}
NETWORK_GRID = network.GRID
BOOSTED_POINTS = 5
FOLDS = 3


def points(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def forest_search(df: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence] = FOREST_GRID, folds: int = FOLDS,
                  seed: int = FOREST_DEFAULTS["seed"], parallelism: int = 4, key: str | None = None) -> tuple[DataFrame, PipelineModel]:
    """(mean F1 of every point, the best point's forest on all rows), with balanced class weights.

    ``max_depth`` None is Spark's greatest depth; ``min_samples_split`` becomes
    the smallest leaf that ``smallest_leaf`` gives.
    """
    est = RandomForestClassifier(seed=seed, weightCol="weight")
    maps = [{est.numTrees: p["n_estimators"], est.maxDepth: min(p["max_depth"] or MAX_TREE_DEPTH, MAX_TREE_DEPTH),
             est.minInstancesPerNode: smallest_leaf(p["min_samples_split"])} for p in points(grid)]
    found = grid_search(class_weights(df, label), features, label, est, {}, folds, parallelism, seed, maps, key)
    rows = [(k, *(None if v is None else int(v) for v in p.values()), float(m)) for k, (p, m) in enumerate(zip(points(grid), found.avgMetrics))]
    scores = df.sparkSession.createDataFrame(rows, "setting int, " + "".join(f"{c} int, " for c in grid) + "mean_f1 double")
    return scores, PipelineModel(stages=[assembler(features), found.bestModel])


def booster_scores(df: DataFrame, models: Sequence[TreeModel], label: str, fold: str, held_out: Sequence[int]) -> DataFrame:
    """``setting, y, h``: class of every row of ``held_out[k]`` under model k, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y, f = np.asarray(batch.column(1)), np.asarray(batch.column(2))
            x = np.asarray(batch.column(0).flatten()).reshape(len(y), -1)
            for k, (m, out) in enumerate(zip(models, held_out)):
                mine = f == out
                yield pa.record_batch([pa.array(np.full(int(mine.sum()), k, np.int32)), pa.array(y[mine]),
                                       pa.array((m.raw(x[mine]) >= 0).astype(np.int32))], names=["setting", "y", "h"])

    value = [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in models[0].features]
    rows = df.where(F.col(label).isNotNull()).select(F.array(*value).alias("x"), F.col(label).cast("int").alias("y"), F.col(fold).cast("int").alias("f"))
    return rows.mapInArrow(run, "setting int, y int, h int")


def booster_search(df: DataFrame, features: Sequence[str], label: str, grid: Mapping[str, Sequence] = BOOSTED_GRID,
                   n_iter: int = BOOSTED_POINTS, folds: int = FOLDS, seed: int = 42, key: str | None = None) -> tuple[DataFrame, TreeModel]:
    """(mean F1 over the folds of ``n_iter`` seeded points of the grid, the best point's model on all rows)."""
    every = points(grid)
    chosen = [every[k] for k in sorted(random.Random(seed).sample(range(len(every)), min(n_iter, len(every))))]
    dealt = materialize(stratified_folds(df, label, folds, seed, key), "folds")
    settings = [{**p, "without": f} for p in chosen for f in range(folds)]
    models = boosting.train_boosters(dealt, features, label, settings, seed, fold="fold")
    scores = booster_scores(dealt, models, label, "fold", [s["without"] for s in settings])
    per_fold = binary_metrics(scores, "y", "h", ["setting"])
    mean = per_fold.groupBy(F.floor(F.col("setting") / folds).cast("int").alias("setting")).agg(F.avg("f1").alias("mean_f1"))
    table = df.sparkSession.createDataFrame([(k, *(float(v) for v in p.values())) for k, p in enumerate(chosen)],
                                            "setting int, " + ", ".join(f"{c} double" for c in grid))
    found = F.broadcast(table).join(mean, "setting", "left")  # one row a point
    found = materialize(found.withColumn("rank", F.row_number().over(Window.orderBy(F.desc_nulls_last("mean_f1"), "setting"))), "booster_search")
    best = chosen[found.where("rank = 1").first()["setting"]]
    return found, boosting.train_newton(df, features, label, best, seed)


def configured_trainers(forest: Mapping = FOREST_GRID, boosted: Mapping = BOOSTED_GRID, net: Mapping = NETWORK_GRID, n_iter: int = BOOSTED_POINTS,
                        folds: int = FOLDS, epochs: int | None = None, key: str | None = None) -> dict[str, Callable]:
    """Trainers for ``ml.train_and_rank`` that run the configured searches and hand back the best model of each kind.

    The network is chosen on a fifth of the training rows that it is not
    trained on.
    """
    def best_network(df: DataFrame, features: Sequence[str], label: str):
        parts = materialize(stratified_split(df.drop("split"), label, 0.2, seed=3, key=key), "network_parts")
        found, nets = network.network_search(parts.where("split = 'train'"), parts.where("split = 'test'"), features, label, net, epochs=epochs)
        return nets[found.where("rank = 1").first()["setting"]]

    return {"forest": lambda df, x, y: forest_search(df, x, y, forest, folds, key=key)[1],
            "boosted": lambda df, x, y: booster_search(df, x, y, boosted, n_iter, folds, key=key)[1],
            "network": best_network, "logistic": train_logistic}
