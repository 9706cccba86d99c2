"""Tree ensembles as node tables: scores and exact attributions.

An ensemble is a small table of nodes (its size is that of the model, not of
the data) which travels to the tasks with the function that reads it. Rows are
scored and explained block by block in numpy, so a task holds one block.

Attributions are the Shapley values of the game in which the features of a
coalition are known and a split on any other is passed in proportion to the
training weight of its children. A leaf pays its value times a product over
the features of its path: 1 or 0 (the row's value fits the path or not) where
the feature is known, the share ``z`` where it is not. For such a product the
Shapley value of feature i is

    value (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} (t o_j + (1 - t) z_j)

whose integrand is a polynomial of degree m - 1 for m features on the path, so
Gauss-Legendre with m / 2 points is exact. A row costs leaves x features x
m / 2 operations, whatever the number of coalitions, and no background rows.

A model sees a value only as its place among the thresholds of its feature, so
its worth for every place of every feature, known or not, is a table of the
model's size. Where the table is small enough (``CELLS``) it is made once, by
running sums over the corners of the leaves' boxes, and broadcast; a row then
costs 2^features look-ups, whatever the number of trees.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.session import scratch_path

#: Rows and leaves that are multiplied out together.
ROWS, LEAVES = 256, 128
#: Cells (8 bytes each) and features that a table of a model's worth has at most.
CELLS, KNOWN = 1 << 24, 12


@dataclass(frozen=True)
class Tree:
    """Nodes as arrays: ``feature`` is -1 in a leaf; a row goes left where its value is at most ``threshold``
    (a missing value goes right); ``cover`` is the training weight that reached the node."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            node = at[rows]
            at[rows] = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        return at

    def paths(self) -> list[tuple[float, dict[int, tuple[float, float, float]]]]:
        """(value, feature -> (above, up to, share)) of every leaf."""
        if not (self.cover > 0).all():
            raise ValueError("a node without training weight has no share")
        out, open_nodes = [], [(0, {})]
        while open_nodes:
            node, path = open_nodes.pop()
            f = int(self.feature[node])
            if f < 0:
                out.append((float(self.value[node]), path))
                continue
            low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
            cut = float(self.threshold[node])
            for child, a, b in ((self.left[node], low, min(high, cut)), (self.right[node], max(low, cut), high)):
                part = share * float(self.cover[child] / self.cover[node])
                open_nodes.append((int(child), {**path, f: (a, b, part)}))
        return out


@dataclass(frozen=True)
class TreeModel:
    """``intercept`` + the sum of the trees; ``logistic``: that sum is a log-odds, else a probability."""
    features: tuple[str, ...]
    trees: tuple[Tree, ...]
    intercept: float = 0.0
    logistic: bool = False

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for t in self.trees:
            total += t.value[t.leaves(x)]
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the ``probability`` vector, as a fitted Spark model does."""
        @F.pandas_udf(T.DoubleType())
        def p(columns: pd.DataFrame) -> pd.Series:
            raw = self.raw(columns.to_numpy(float))
            return pd.Series(1 / (1 + np.exp(-raw)) if self.logistic else raw)
        one = p(F.struct(*[F.col(f).cast("double").alias(f) for f in self.features]))
        scored = df.withColumn("_p1", one)
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p1"), F.col("_p1")))).drop("_p1")


def tree_from_nodes(nodes: pd.DataFrame) -> Tree:
    """A tree from rows ``id, feature, threshold, left, right, value, cover`` (root id 0; leaves have feature -1)."""
    nodes = nodes.sort_values("id")
    if nodes["id"].tolist() != list(range(len(nodes))):
        raise ValueError("node ids must run from 0")
    ints = [nodes[c].to_numpy(np.int64) for c in ("feature", "left", "right")]
    nums = [nodes[c].to_numpy(float) for c in ("threshold", "value", "cover")]
    return Tree(ints[0], nums[0], ints[1], ints[2], nums[1], nums[2])


def forest_nodes(model) -> DataFrame:
    """The nodes of a fitted forest or boosted model, read from what Spark saves: ``tree, id, feature, threshold,
    left, right, prediction, stats``. The model is written to the shared scratch folder once."""
    spark = SparkSession.getActiveSession()
    last = model.stages[-1] if hasattr(model, "stages") else model
    path = scratch_path(spark, "models", "trees")
    last.write().overwrite().save(path)
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["split"]["featureIndex"].alias("feature"),
        n["split"]["leftCategoriesOrThreshold"].alias("cut"), n["split"]["numCategories"].alias("categories"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["prediction"].alias("prediction"),
        n["impurityStats"].alias("stats"))


def forest_model(model, features: Sequence[str]) -> TreeModel:
    """A fitted Spark forest (mean class-1 share of the leaves) or boosted model (log-odds) as a ``TreeModel``.

    The nodes come to the driver, which already holds the fitted model.
    """
    last = model.stages[-1] if hasattr(model, "stages") else model
    boosted = hasattr(last, "treeWeights") and type(last).__name__.startswith("GBT")
    nodes = forest_nodes(model)
    total = F.aggregate("stats", F.lit(0.0), lambda a, b: a + b)
    # flat columns: a node is a few numbers on the driver
    nodes = nodes.select("tree", "id", "feature", F.get("cut", F.lit(0)).alias("cut"), "categories", "left", "right", "prediction",
                         F.get("stats", F.lit(0)).alias("first"), F.get("stats", F.lit(1)).alias("second"), total.alias("total"))
    nodes = nodes.toArrow().to_pandas().sort_values(["tree", "id"])
    if (nodes["categories"] > 0).any():
        raise ValueError("splits on category sets are not supported; encode categories as numbers")
    weights = list(last.treeWeights)
    if boosted:
        # Spark's boosted log-odds is twice the weighted sum of its trees
        value = nodes["prediction"].to_numpy() * 2 * np.array(weights)[nodes["tree"].to_numpy()]
        cover = nodes["first"].to_numpy()
    else:
        cover = nodes["total"].to_numpy()
        value = nodes["second"].to_numpy() / cover / len(weights)
    table = pd.DataFrame({"tree": nodes["tree"], "id": nodes["id"], "feature": np.where(nodes["left"] < 0, -1, nodes["feature"]),
                          "threshold": nodes["cut"], "left": nodes["left"], "right": nodes["right"], "value": value, "cover": cover})
    trees = tuple(tree_from_nodes(t) for _, t in table.groupby("tree"))
    return TreeModel(tuple(features), trees, 0.0, boosted)


@dataclass(frozen=True)
class _Leaves:
    """Leaves whose paths hold equally many features: arrays of (leaf, feature)."""
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray


def leaf_groups(model: TreeModel) -> tuple[float, list[_Leaves]]:
    """(expected value, leaves grouped by the length of their paths)."""
    base, found = model.intercept, {}
    for t in model.trees:
        for value, path in t.paths():
            base += value * float(np.prod([s for _, _, s in path.values()]))
            if path and value:
                found.setdefault(len(path), []).append((value, path))
    groups = []
    for m, leaves in sorted(found.items()):
        sides = np.array([[path[f] for f in path] for _, path in leaves])
        groups.append(_Leaves(np.array([list(path) for _, path in leaves]), sides[:, :, 0], sides[:, :, 1], sides[:, :, 2],
                              np.array([v for v, _ in leaves])))
    return base, groups


def attributions(x: np.ndarray, groups: Sequence[_Leaves]) -> np.ndarray:
    """Shapley values (row, feature) of the trees that the groups stand for."""
    out = np.zeros(x.shape)
    for g in groups:
        m = g.feature.shape[1]
        points, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
        t, w = ((points + 1) / 2)[:, None, None], (weights / 2)[:, None, None]
        for a in range(0, len(g.value), LEAVES):
            f, low, high, z, value = (v[a:a + LEAVES] for v in (g.feature, g.low, g.high, g.share, g.value))
            to = np.zeros((m, len(f), x.shape[1]))
            for j in range(m):
                to[j, np.arange(len(f)), f[:, j]] = 1
            for b in range(0, len(x), ROWS):
                rows = x[b:b + ROWS]
                fits, factors, product = [], [], w * value
                for j in range(m):
                    v = rows[:, f[:, j]]
                    # a missing value has gone right at every split
                    o = (~(v <= low[:, j]) & ((v <= high[:, j]) | np.isinf(high[:, j]))).astype(float)
                    factor = t * o + (1 - t) * z[:, j]
                    fits.append(o)
                    factors.append(factor)
                    product = product * factor
                for j in range(m):
                    out[b:b + ROWS] += ((product / factors[j]).sum(0) * (fits[j] - z[:, j])) @ to[j]
    return out


@dataclass(frozen=True)
class Grid:
    """The worth of a model for every place of the features that it splits on: ``used`` are their positions, ``cuts``
    their thresholds, ``worth`` the flat table. With ``partial`` the last place of each feature stands for "not known"."""
    used: tuple[int, ...]
    cuts: tuple[np.ndarray, ...]
    worth: np.ndarray
    partial: bool

    @property
    def shape(self) -> tuple[int, ...]:
        return tuple(len(c) + 1 + self.partial for c in self.cuts)

    @property
    def strides(self) -> np.ndarray:
        return np.array([math.prod(self.shape[k + 1:]) for k in range(len(self.cuts))], np.int64)

    def places(self, x: np.ndarray) -> np.ndarray:
        """(row, used feature): thresholds below the value; a missing value lies above all."""
        return np.stack([np.searchsorted(c, x[:, f]) for f, c in zip(self.used, self.cuts)], axis=1)


def worth_grid(model: TreeModel, partial: bool) -> Grid | None:
    """The table of a model, or None where it would have more than ``CELLS`` cells."""
    inner = [(t.feature[t.feature >= 0], t.threshold[t.feature >= 0]) for t in model.trees]
    feature, threshold = (np.concatenate(c) for c in zip(*inner)) if inner else (np.zeros(0, int), np.zeros(0))
    used = tuple(int(f) for f in np.unique(feature))
    cuts = tuple(np.unique(threshold[feature == f]) for f in used)
    cells = math.prod(len(c) + 1 + partial for c in cuts)
    if not used or len(used) > KNOWN or cells > CELLS:
        return None
    grid = Grid(used, cuts, np.zeros(cells), partial)
    for t in model.trees:
        found = {}
        for value, path in t.paths():
            if value:
                found.setdefault(tuple(sorted(path)), []).append((value, [path[f] for f in sorted(path)]))
        for path, leaves in found.items():
            for a in range(0, len(leaves), LEAVES):
                _mark(grid, path, leaves[a:a + LEAVES])
    table = grid.worth.reshape(grid.shape)
    for k, c in enumerate(cuts):
        side = np.moveaxis(table, k, 0)
        for place in range(1, len(c) + 1):
            side[place] += side[place - 1]
    grid.worth[:] += model.intercept
    if model.logistic and not partial:
        grid.worth[:] = 1 / (1 + np.exp(-grid.worth))
    return grid


def _mark(grid: Grid, path: tuple[int, ...], leaves: Sequence) -> None:
    """Adds the corners of the leaves' boxes: running sums along all features make boxes of them."""
    at, weight = np.zeros((len(leaves), 1), np.int64), np.array([[v] for v, _ in leaves])
    for f, c, stride in zip(grid.used, grid.cuts, grid.strides):
        if f in path:
            low, high, share = np.array([sides[path.index(f)] for _, sides in leaves]).T
            open_end = np.isinf(high)
            start = np.searchsorted(c, low, "right")
            # no value fits a path whose bounds exclude each other: its box is empty
            place = [start, np.where(open_end, 0, np.maximum(start, np.searchsorted(c, high, "right")))]
            part = [np.ones(len(leaves)), np.where(open_end, 0.0, -1.0)]
        else:
            place, part, share = [np.zeros(len(leaves), np.int64)], [np.ones(len(leaves))], np.ones(len(leaves))
        if grid.partial:
            place.append(np.full(len(leaves), len(c) + 1))
            part.append(share)
        at = (at[:, :, None] + (np.stack(place, 1) * stride)[:, None, :]).reshape(len(leaves), -1)
        weight = (weight[:, :, None] * np.stack(part, 1)[:, None, :]).reshape(len(leaves), -1)
    np.add.at(grid.worth, at.ravel(), weight.ravel())


def coalition_weights(k: int) -> np.ndarray:
    """(coalition, feature): what the worth of a coalition (bits) counts for a feature."""
    sets = np.arange(1 << k)
    size = np.array([int(s).bit_count() for s in sets])
    out = np.zeros((1 << k, k))
    share = [math.factorial(s) * math.factorial(k - 1 - s) / math.factorial(k) for s in range(k)]
    for i in range(k):
        known = (sets >> i) & 1 == 1
        out[known, i] = [share[s - 1] for s in size[known]]
        out[~known, i] = [-share[s] for s in size[~known]]
    return out


def grid_attributions(x: np.ndarray, grid: Grid, worth: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shapley values (row, feature) from the table of a model."""
    out, unknown = np.zeros(x.shape), (np.array(grid.shape) - 1) * grid.strides
    known = grid.places(x) * grid.strides - unknown
    for a in range(0, len(x), ROWS):
        at = np.full((len(known[a:a + ROWS]), 1), unknown.sum())
        for k in range(len(grid.used)):
            at = np.concatenate([at, at + known[a:a + ROWS, k:k + 1]], axis=1)
        out[a:a + ROWS, list(grid.used)] = worth[at] @ weights
    return out


def attribution_column(model: TreeModel) -> Column:
    """The attributions of a row in the order of the model's features, as an array column."""
    grid = worth_grid(model, True)
    if grid is None:
        groups = leaf_groups(model)[1]

        def explained(x: np.ndarray) -> np.ndarray:
            return attributions(x, groups)
    else:
        worth, weights = SparkSession.getActiveSession().sparkContext.broadcast(grid.worth), coalition_weights(len(grid.used))
        grid = Grid(grid.used, grid.cuts, np.zeros(0), True)  # the table travels once an executor

        def explained(x: np.ndarray) -> np.ndarray:
            return grid_attributions(x, grid, worth.value, weights)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def phi(columns: pd.DataFrame) -> pd.Series:
        return pd.Series(list(explained(columns.to_numpy(float))))

    return phi(F.struct(*[F.col(f).cast("double").alias(f) for f in model.features]))


def expected_value(model: TreeModel) -> float:
    """The worth of a model of which no feature is known."""
    base = model.intercept
    for t in model.trees:
        base += sum(value * float(np.prod([s for _, _, s in path.values()])) for value, path in t.paths())
    return base


def explain_trees(df: DataFrame, model: TreeModel, row_id: str) -> DataFrame:
    """Exact attributions of every row: (row_id, feature, phi, base); base + the sum of phi is the model's raw
    value. Each input row is explained by itself, also where ids repeat."""
    rows = df.select(F.col(row_id), attribution_column(model).alias("_phi"))
    return rows.select(row_id, F.posexplode("_phi").alias("_k", "phi")).select(
        row_id, F.element_at(F.lit(list(model.features)), F.col("_k") + 1).alias("feature"), "phi",
        F.lit(float(expected_value(model))).alias("base"))
