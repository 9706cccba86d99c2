"""Second-order gradient boosting (H4): logistic loss, histogram splits, Newton leaves, column sampling per tree.

The rows are written once with each value replaced by its quantile bin. A
level of a tree is one job: a task finds the node of each of its rows, adds
the gradient and Hessian of the loss to the histogram of (node, feature, bin),
and sends one histogram a node and feature; these are added up by (node,
feature), where the best cut of the feature is found, so the driver receives
one row a node and feature. The totals of a cut's two sides are the children's
totals, so the last level needs no job of its own.

The log-odds of a row are carried in the written table and brought up to date
every ``KEEP`` trees; a task adds the few trees since. All models of a search
grow in the same jobs, each at its own level.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.operators.trees import Tree, TreeModel
from churnlens.session import materialize

# --- fixed values: settings of the reference configuration, then the usual defaults of second-order boosting ---
DEFAULTS = {"lr": 0.1, "depth": 6, "trees": 200, "subsample": 1.0, "colsample": 1.0, "l2": 1.0, "gamma": 0.0, "min_weight": 1.0}
#: Trees after which the rows are written anew with their log-odds.
KEEP = 10


def fit_bins(df: DataFrame, features: Sequence[str], bins: int = 256, accuracy: int = 10_000) -> list[np.ndarray]:
    """Cut points of every feature: its approximate quantiles, each once (one aggregate for all features)."""
    probs = [k / bins for k in range(1, bins)]
    row = df.agg(*[F.percentile_approx(F.col(f).cast("double"), probs, accuracy).alias(f"q{k}") for k, f in enumerate(features)]).first()
    return [np.unique(np.array([v for v in row[k] or [] if v == v], float)) for k in range(len(features))]


class _Growing:
    """A tree under construction: nodes by level, thresholds as bins."""

    def __init__(self, columns: np.ndarray, number: int):
        self.columns, self.number = columns, number
        self.feature, self.cut, self.left, self.right, self.g, self.h = [-1], [0], [-1], [-1], [None], [None]
        self.open = [0]
        self.depth = 0

    def split(self, node: int, feature: int, cut: int, sides: Sequence[float]) -> None:
        self.feature[node], self.cut[node] = feature, cut
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for g, h in (sides[:2], sides[2:]):
            for column, v in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.g, g), (self.h, h)):
                column.append(v)

    def tree(self, lr: float, l2: float) -> Tree:
        g, h = (np.array([0.0 if v is None else v for v in x]) for x in (self.g, self.h))
        return Tree(np.array(self.feature), np.array(self.cut, float), np.array(self.left), np.array(self.right), -lr * g / (h + l2), h)


def _chosen(key: np.ndarray, number: int, seed: int, share: float) -> np.ndarray:
    """Rows of a tree's sample: a seeded hash of the row and the tree's number."""
    if share >= 1:
        return np.ones(len(key), bool)
    x = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 1_000_003 + number) % (1 << 64))
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(31)).astype(float) / 2.0 ** 64 < share


def best_cut(hist: np.ndarray, l2: float, gamma: float, min_weight: float) -> tuple[float, int, float, float, float, float]:
    """(gain, cut, left g, left h, right g, right h) of the best cut of a histogram (bins x 2); the last bin holds
    missing values and stays right. Gain is -inf where no cut leaves ``min_weight`` on both sides."""
    total = hist.sum(0)
    left = np.cumsum(hist, 0)[:-1]
    right = total - left
    ok = (left[:, 1] >= min_weight) & (right[:, 1] >= min_weight)
    if not ok.any():
        return -np.inf, 0, 0.0, 0.0, *total
    score = left[:, 0] ** 2 / (left[:, 1] + l2) + right[:, 0] ** 2 / (right[:, 1] + l2) - total[0] ** 2 / (total[1] + l2)
    gain = np.where(ok, score / 2 - gamma, -np.inf)
    at = int(np.argmax(gain))
    return float(gain[at]), at, float(left[at, 0]), float(left[at, 1]), float(right[at, 0]), float(right[at, 1])


def _binned(df: DataFrame, features: Sequence[str], label: str, cuts: Sequence[np.ndarray], models: int, keep: Sequence[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False), float) for k in range(len(cuts))]
            b = np.stack([np.where(np.isnan(v), len(c) + 1, np.searchsorted(c, v)) for v, c in zip(x, cuts)], 1).astype(np.int32)
            n = batch.num_rows
            yield pa.record_batch([
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(cuts)), pa.array(b.ravel())),
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * models), pa.array(np.zeros(n * models))),
                *[batch.column(len(cuts) + k) for k in range(2 + len(keep))]], names=["x", "m", "y", "key", *keep])

    rows = df.where(F.col(label).isNotNull()).select(
        *[F.col(f).cast("double").alias(f"_x{k}") for k, f in enumerate(features)], F.col(label).cast("double").alias("y"),
        F.monotonically_increasing_id().alias("key"), *[F.col(c).cast("int").alias(c) for c in keep])
    schema = "x array<int>, m array<double>, y double, key long" + "".join(f", {c} int" for c in keep)
    return materialize(rows.mapInArrow(run, schema), "boosting_rows")


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    n = batch.num_rows
    return (np.asarray(batch.column(0).flatten()).reshape(n, -1), np.asarray(batch.column(1).flatten()).reshape(n, -1),
            np.asarray(batch.column(2)), np.asarray(batch.column(3)))


def train_boosters(df: DataFrame, features: Sequence[str], label: str, settings: Sequence[Mapping], seed: int = 42,
                   bins: int = 256, fold: str | None = None) -> list[TreeModel]:
    """One model for each of the settings (``DEFAULTS``), grown by the same jobs.

    ``fold`` names an integer column: a model whose settings have ``without``
    is trained on the rows of the other folds.
    """
    settings = [{**DEFAULTS, **s} for s in settings]
    d, rng = len(features), np.random.default_rng(seed)
    cuts = fit_bins(df, features, bins)
    wide = max(len(c) for c in cuts) + 2
    rows = _binned(df, features, label, cuts, len(settings), [fold] if fold else [])
    done: list[list[Tree]] = [[] for _ in settings]
    written = [0] * len(settings)

    def sprout(k: int) -> _Growing | None:
        if len(done[k]) >= settings[k]["trees"]:
            return None
        some = max(1, round(settings[k]["colsample"] * d))
        return _Growing(np.sort(rng.choice(d, some, replace=False)), len(done[k]))

    growing = [sprout(k) for k in range(len(settings))]
    while any(growing):
        state = [(k, g, done[k][written[k]:], settings[k]) for k, g in enumerate(growing) if g]

        def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, margins, y, key = _arrays(batch)
                for k, g, since, s in state:
                    use = _chosen(key, g.number, seed, s["subsample"])
                    if "without" in s:
                        use &= np.asarray(batch.column(4)) != s["without"]
                    xs, margin = x[use], margins[use, k]
                    for t in since:
                        margin = margin + t.value[t.leaves(xs)]
                    p = 1 / (1 + np.exp(-margin))
                    node = g.tree(1.0, 1.0).leaves(xs)
                    place = np.full(len(g.feature), -1)
                    place[g.open] = np.arange(len(g.open))
                    at = place[node]
                    inside = at >= 0
                    xs, at, grad, hess = xs[inside], at[inside], (p - y[use])[inside], (p * (1 - p))[inside]
                    size = len(g.open) * wide
                    for f in g.columns:
                        index = at * wide + xs[:, f]
                        both = np.stack([np.bincount(index, grad, size), np.bincount(index, hess, size)], 1).reshape(len(g.open), wide, 2)
                        sums[k, int(f)] = sums[k, int(f)] + both if (k, int(f)) in sums else both
            found = [(k, g.open[a], f, h[a].tobytes()) for k, g, _, _ in state for (m, f), h in sums.items() if m == k for a in range(len(g.open))]
            if found:
                model, node, feature, hist = zip(*found)
                yield pa.record_batch([pa.array(model, pa.int32()), pa.array(node, pa.int32()), pa.array(feature, pa.int32()),
                                       pa.array(hist, pa.binary())], names=["model", "node", "feature", "hist"])

        by_model = {k: s for k, _, _, s in state}

        def cut(keys, table):
            k, node, feature = (v.as_py() for v in keys)
            # the feature's own bins, then its missing values
            hist = sum(np.frombuffer(b.as_py()) for b in table["hist"]).reshape(wide, 2)[:len(cuts[feature]) + 2]
            s = by_model[k]
            gain, at, *sides = best_cut(hist, s["l2"], s["gamma"], s["min_weight"])
            return pa.table({"model": pa.array([k], pa.int32()), "node": pa.array([node], pa.int32()), "feature": pa.array([feature], pa.int32()),
                             "gain": [gain], "cut": pa.array([at], pa.int32()), "gl": [sides[0]], "hl": [sides[1]], "gr": [sides[2]], "hr": [sides[3]]})

        parts = rows.mapInArrow(histograms, "model int, node int, feature int, hist binary")
        found = parts.groupBy("model", "node", "feature").applyInArrow(
            cut, "model int, node int, feature int, gain double, cut int, gl double, hl double, gr double, hr double").collect()
        best = {}
        for r in sorted(found, key=lambda r: (r["model"], r["node"], -r["gain"], r["feature"])):
            best.setdefault((r["model"], r["node"]), r)
        for k, g, _, s in state:
            level, g.open = g.open, []
            for node in level:
                r = best.get((k, node))
                if r is None:
                    continue
                if g.g[node] is None:
                    g.g[node], g.h[node] = r["gl"] + r["gr"], r["hl"] + r["hr"]
                if r["gain"] > 0:
                    g.split(node, r["feature"], r["cut"], (r["gl"], r["hl"], r["gr"], r["hr"]))
                    g.open += [g.left[node], g.right[node]]
            g.depth += 1
            if not g.open or g.depth >= s["depth"]:
                done[k].append(g.tree(s["lr"], s["l2"]))
                growing[k] = sprout(k)
        if max(len(t) - w for t, w in zip(done, written)) >= KEEP and any(growing):
            rows = _carried(rows, [t[w:] for t, w in zip(done, written)], [fold] if fold else [])
            written = [len(t) for t in done]
    return [TreeModel(tuple(features), tuple(_real(t, cuts) for t in trees), 0.0, True) for trees in done]


def _carried(rows: DataFrame, trees: Sequence[Sequence[Tree]], keep: Sequence[str]) -> DataFrame:
    """The rows with the trees added to their log-odds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, m, _, _ = _arrays(batch)
                m = m + np.stack([sum((t.value[t.leaves(x)] for t in new), np.zeros(len(x))) for new in trees], 1)
                ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * m.shape[1])
                yield pa.record_batch([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(m.ravel())),
                                       *[batch.column(k) for k in range(2, batch.num_columns)]], names=batch.schema.names)
    return materialize(rows.mapInArrow(run, rows.schema), "boosting_rows")


def _real(t: Tree, cuts: Sequence[np.ndarray]) -> Tree:
    """Bins as values of the features."""
    value = np.array([cuts[f][int(c)] if f >= 0 and int(c) < len(cuts[f]) else np.inf for f, c in zip(t.feature, t.threshold)])
    return Tree(t.feature, value, t.left, t.right, t.value, np.where(t.cover > 0, t.cover, 1e-300))


def train_newton(df: DataFrame, features: Sequence[str], label: str, cfg: Mapping | None = None, seed: int = 42) -> TreeModel:
    """H4: one boosted model."""
    return train_boosters(df, features, label, [cfg or {}], seed)[0]
