"""Split, balance, train, tune and score (family H).

Training and scoring are Spark ML estimators and transformers; the only
Python in the data path is the per-cell neighbour search of the minority
oversampler, which runs as an Arrow-batched ``applyInPandas`` on cells of a
bounded size; the new rows themselves are column expressions.
"""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.functions.columns import decode_binary, risk_band, threshold_label
from churnlens.operators.fitted import prepare_serving
from churnlens.operators.ordered import null_safe_join, prefix_sums
from churnlens.operators.quality import validate_schema
from churnlens.session import materialize

# --- fixed values: default model settings of the reference configuration ---
FOREST_DEFAULTS = {"numTrees": 200, "maxDepth": 10, "seed": 42}
BOOSTED_DEFAULTS = {"stepSize": 0.1, "maxDepth": 6, "maxIter": 200, "seed": 42}
MLP_DEFAULTS = {"hidden": 128, "stepSize": 0.001, "maxIter": 20, "blockSize": 512, "seed": 42}
MAX_TREE_DEPTH = 30
#: Most parts that one level of the neighbour search cuts a cell into.
FAN = 4
#: Neighbours that the search keeps on the way, as a multiple of those asked for.
POOL = 2
#: Training rows from which they are dealt evenly over the cores; fewer stay in the parts in which they are read.
DEAL_FROM = 50_000


def stratified_split(df: DataFrame, label: str, test_frac: float = 0.2, seed: int = 2,
                     key: str | None = None) -> DataFrame:
    """H1: add ``split`` ('train'/'test') with the same class mix in both parts.

    Rows are ordered by a seeded hash within each class; the first
    round(frac · n_class) rows go to test.  Only (class, hash, tie) travels:
    distributed prefix sums find the cut-off of each class (rows without a
    label are a class of their own), and a projection compares every row with
    it.  ``key`` breaks ties of the hash; without it rows alike in all columns
    go to the same side.
    """
    cols = df.columns
    h = F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    tie = F.xxhash64(F.col(key), F.lit(seed)) if key else F.xxhash64(*[F.col(c) for c in cols], F.lit(seed + 1))
    place = F.struct(h.alias("h"), tie.alias("t"))
    narrow = df.select(F.col(label), h.alias("_h"), tie.alias("_t")).groupBy(label, "_h", "_t").agg(
        F.count(F.lit(1)).alias("_one"))
    ps = prefix_sums(narrow, ["_h", "_t"], ["_one"], by=[label], with_total=True)
    n_test = F.least(F.round(F.col("tot__one") * test_frac), F.col("tot__one"))
    cuts = ps.where(F.col("cum__one") <= n_test).groupBy(label).agg(
        F.max(F.struct(F.col("_h").alias("h"), F.col("_t").alias("t"))).alias("_cut"))
    out = null_safe_join(df, F.broadcast(cuts), [label], "left")  # one row per class
    side = F.when(F.col("_cut").isNotNull() & (place <= F.col("_cut")), "test").otherwise("train")
    return out.withColumn("split", side).select(*cols, "split")


def stratified_folds(df: DataFrame, label: str, folds: int = 3, seed: int = 2, key: str | None = None) -> DataFrame:
    """H7: add ``fold`` (0 … folds − 1) with each class spread evenly: its share in every fold is exact to one row.

    As in ``stratified_split``: rows are ranked by a seeded hash within their
    class by distributed prefix sums, which give the ``folds − 1`` cut-offs of
    each class; a projection compares every row with them.
    """
    cols = df.columns
    h = F.xxhash64(*[F.col(c) for c in cols], F.lit(seed))
    tie = F.xxhash64(F.col(key), F.lit(seed)) if key else F.xxhash64(*[F.col(c) for c in cols], F.lit(seed + 1))
    place = F.struct(h.alias("h"), tie.alias("t"))
    narrow = df.select(F.col(label), h.alias("_h"), tie.alias("_t")).groupBy(label, "_h", "_t").agg(F.count(F.lit(1)).alias("_one"))
    ps = prefix_sums(narrow, ["_h", "_t"], ["_one"], by=[label], with_total=True)
    fold = F.floor((F.col("cum__one") - 1) * folds / F.col("tot__one"))
    ends = ps.groupBy(label, fold.alias("_f")).agg(F.max(F.struct(F.col("_h").alias("h"), F.col("_t").alias("t"))).alias("_end"))
    cuts = ends.groupBy(label).agg(F.collect_list(F.when(F.col("_f") < folds - 1, F.struct("_f", "_end"))).alias("_cuts"))  # folds − 1 a class
    out = null_safe_join(df, F.broadcast(cuts), [label], "left")
    beyond = F.filter("_cuts", lambda c: place > c["_end"])
    return out.select(*cols, F.coalesce(F.array_max(F.transform(beyond, lambda c: c["_f"])) + 1, F.lit(0)).cast("int").alias("fold"))


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weights n / (k · n_class) from one count of the classes (k rows on the driver)."""
    counts = [(r[0], r[1]) for r in df.groupBy(label).count().collect() if r[0] is not None]
    total, weight = sum(n for _, n in counts), F.lit(None).cast("double")
    for value, n in counts:
        weight = F.when(F.col(label) == F.lit(value), F.lit(total / (len(counts) * n))).otherwise(weight)
    return df.where(F.col(label).isNotNull()).withColumn(out, weight)


def _nearest_in_cell(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The k nearest rows of each row within one cell of bounded size."""
        x = np.stack(pdf["x"].to_numpy())
        ids = pdf["id"].to_numpy()
        kk = min(k, len(x) - 1)
        if kk <= 0:
            return pd.DataFrame({"id": ids[:0], "other": ids[:0], "d": np.zeros(0)})
        sq = (x * x).sum(1)
        d2 = sq[:, None] + sq[None, :] - 2.0 * x @ x.T
        np.fill_diagonal(d2, np.inf)
        near = np.argpartition(d2, kk - 1, axis=1)[:, :kk]
        return pd.DataFrame({"id": np.repeat(ids, kk), "other": ids[near].ravel(),
                             "d": np.maximum(np.take_along_axis(d2, near, 1), 0.0).ravel()})
    return run


def _nearest_of(pairs: DataFrame, k: int, salts: int = 0) -> DataFrame:
    """The k nearest ``other`` of each ``id``; with ``salts`` a point that very many name is cut down in parts first."""
    def cut(df: DataFrame, *keys: str) -> DataFrame:
        lists = df.groupBy("id", *keys).agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "other"))), 1, k).alias("_n"))
        return lists.select("id", F.explode("_n").alias("_n")).select("id", "_n.other", "_n.d")
    if salts:
        pairs = cut(pairs.withColumn("_salt", F.pmod(F.xxhash64("other"), F.lit(salts))), "_salt")
    return cut(pairs)


def refine_neighbours(points: DataFrame, graph: DataFrame, k: int, rounds: int) -> DataFrame:
    """Neighbour-of-neighbour refinement of a neighbour graph (Dong et al. 2011).

    In every round a point is compared with the neighbours of its neighbours,
    where a neighbour is one of its k nearest or one of the k nearest that
    name it: at most 4 k² candidates a point, whatever the number of points.
    """
    d = points.select(F.size("x")).head()[0]
    for _ in range(rounds):
        named = _nearest_of(graph.select(F.col("other").alias("id"), F.col("id").alias("other"), "d"), k, salts=64)
        near = graph.select("id", "other").unionByName(named.select("id", "other")).distinct()
        lists = near.groupBy("id").agg(F.collect_list("other").alias("_more"))  # at most 2 k
        pairs = near.join(lists.withColumnRenamed("id", "other"), "other").select("id", F.explode("_more").alias("other"))
        pairs = pairs.where("id <> other").distinct()
        far = pairs.join(points.select("id", F.col("x").alias("_a")), "id").join(points.select(F.col("id").alias("other"), F.col("x").alias("_b")), "other")
        square = F.lit(0.0)
        for i in range(d):
            square = square + (F.col("_a")[i] - F.col("_b")[i]) * (F.col("_a")[i] - F.col("_b")[i])
        both = graph.unionByName(far.select("id", "other", square.alias("d"))).groupBy("id", "other").agg(F.min("d").alias("d"))
        graph = materialize(_nearest_of(both, k), "neighbour_graph")
    return graph


def nearest_neighbours(points: DataFrame, k: int = 5, projections: int = 6, cell_size: int = 2048,
                       seed: int = 42, rounds: int = 2) -> DataFrame:
    """(id, other, d): about the k nearest of every point (``id``, ``x`` array of double).

    The neighbours found in cells of bounded size (below) are refined by
    ``rounds`` of neighbour-of-neighbour search over ``POOL`` times as many
    neighbours, which makes up for those that many dimensions put into other
    cells.

    Up to ``cell_size`` points the result is exact.  Beyond it the points are
    cut into cells once for each of ``projections`` trees, and the k best of
    all cells that hold a point are kept.  A tree turns the points into axes of
    its own; then each cell of more than ``cell_size`` points is cut at ranks
    of the axis along which it is widest, into up to ``FAN`` parts, until none
    is larger, so that a cell is compact in all directions whatever the number
    of points.  The trees' cuts are shifted against each other.  All cells of
    all trees are cut by one distributed prefix sum a level.  A cell bounds a
    task's memory whatever the number of equal points.
    """
    points = materialize(points.select("id", "x"), "points")
    most = points.count()
    small = most <= cell_size  # one cell holds all points: the result is exact
    if small:
        rows = points.select(F.lit(0).alias("_tree"), F.lit(0).cast("long").alias("_cell"), "id", "x")
    else:
        d = points.select(F.size("x")).first()[0]
        rng = np.random.default_rng(seed)
        turns = [np.linalg.qr(rng.normal(size=(d, d)))[0].tolist() for _ in range(projections)]
        along = F.transform("_turn", lambda u: F.aggregate(F.zip_with("x", u, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v))
        rows = points.select("id", "x", F.posexplode(F.lit(turns)).alias("_tree", "_turn")).select(
            "_tree", F.lit(0).cast("long").alias("_cell"), "id", along.alias("x"))
        rows = materialize(rows, "turned_points")
    while most > cell_size:
        spread = F.array(*[F.var_pop(F.col("x")[i]) for i in range(d)])
        widest = rows.groupBy("_tree", "_cell").agg(F.count(F.lit(1)).alias("_n"), spread.alias("_v")).select(
            "_tree", "_cell", "_n", F.coalesce(F.array_position("_v", F.array_max("_v")), F.lit(1)).cast("int").alias("_axis"))
        aimed = rows.join(widest, ["_tree", "_cell"]).withColumn("_p", F.element_at("x", F.col("_axis"))).withColumn("_one", F.lit(1))
        # one order over all cells: a group per cell would make as many range totals as rows
        ranked = materialize(prefix_sums(aimed, ["_tree", "_cell", "_p", "id"], ["_one"]), "ranked_points")
        starts = ranked.groupBy("_tree", "_cell").agg(F.min("cum__one").alias("_start"))
        parts = F.least(F.lit(FAN), F.ceil(F.col("_n") / cell_size))
        width = F.ceil(F.col("_n") / parts)
        shift = F.when(parts > 1, F.floor(width * F.col("_tree") / projections)).otherwise(0)
        part = F.floor((F.col("cum__one") - F.col("_start") + shift) / width)
        rows = materialize(ranked.join(starts, ["_tree", "_cell"]).select(
            "_tree", (F.col("_cell") * (FAN + 1) + part).cast("long").alias("_cell"), "id", "x"), "cut_points")
        most = max(cell_size, -(-most // FAN))
    kept = k if small else POOL * k
    found = rows.groupBy("_tree", "_cell").applyInPandas(
        _nearest_in_cell(kept), "id long, other long, d double")
    best = _nearest_of(found.groupBy("id", "other").agg(F.min("d").alias("d")), kept)  # of at most projections * kept
    if small:
        return best
    return _nearest_of(refine_neighbours(points, materialize(best, "neighbour_graph"), kept, rounds), k)


def oversample_minority(df: DataFrame, label: str, features: Sequence[str], k: int = 5, seed: int = 42,
                        cell_size: int = 2048, key: str | None = None, projections: int = 6,
                        per_task: int = 10_000, with_pairs: bool = False) -> DataFrame:
    """H2: balance the smallest class by interpolating between neighbours (Chawla et al. 2002).

    Neighbours come from all minority rows (``nearest_neighbours``).  Each
    row makes its share of the (majority − minority) new rows, in pieces of at
    most ``per_task`` rows that are dealt over the tasks, so one row that must
    make billions is no single task's work.  A new row is the row plus a
    seeded share of the way to one of its k neighbours; a minority of one row
    is repeated.  ``with_pairs`` adds ``source_id`` and ``neighbour_id`` (null
    for original rows).
    """
    counts = {r[0]: r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    orig = df.select(*[F.col(f).cast("double").alias(f) for f in features], label,
                     F.lit(None).cast("long").alias("source_id"), F.lit(None).cast("long").alias("neighbour_id"))
    shown = [*features, label, *(["source_id", "neighbour_id"] if with_pairs else [])]
    minority = min(counts, key=lambda c: (counts[c], str(c))) if len(counts) > 1 else None
    if minority is None or counts[minority] == max(counts.values()):
        return orig.select(*shown)
    n_new = max(counts.values()) - counts[minority]
    base, extra = divmod(n_new, counts[minority])
    mins = df.where(F.col(label) == minority).select(F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
                                                     F.col(key).alias("_key") if key else F.lit(0).alias("_key"))
    # numbered in the order of their values, so the numbers repeat with the data
    mins = mins.groupBy("x", "_key").agg(F.count(F.lit(1)).alias("_n"))
    mins = prefix_sums(mins, ["x", "_key"], ["_n"]).select(
        "x", F.explode(F.sequence(F.col("cum__n") - F.col("_n"), F.col("cum__n") - 1)).alias("id"))
    mins = materialize(mins, "minority_rows")
    near = nearest_neighbours(mins, k, projections, cell_size, seed)
    near = near.join(mins.select(F.col("id").alias("other"), F.col("x").alias("z")), "other").groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("d", "other", "z"))).alias("near"))
    need = F.lit(base) + F.when(F.col("id") < extra, 1).otherwise(0)
    work = mins.join(near, "id", "left").withColumn("_need", need).where("_need > 0")
    work = work.withColumn("_from", F.explode(F.sequence(F.lit(0), F.col("_need") - 1, F.lit(per_task))))
    work = work.repartition("id", "_from")
    work = work.withColumn("_s", F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_from") + per_task, F.col("_need").cast("long")) - 1)))
    pick = F.element_at("near", (F.pmod(F.xxhash64("id", "_s", F.lit(seed)), F.size("near")) + 1).cast("int"))
    gap = F.pmod(F.xxhash64("id", "_s", F.lit(seed + 1)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    work = work.withColumn("_pick", F.when(F.size("near") > 0, pick)).withColumn("_gap", gap)
    made = F.coalesce(F.zip_with("x", F.col("_pick.z"), lambda a, z: a + F.col("_gap") * (z - a)), F.col("x"))
    synth = work.select(made.alias("x"), F.col("id").alias("source_id"), F.col("_pick.other").alias("neighbour_id"))
    synth = synth.select(*[F.col("x")[i].alias(f) for i, f in enumerate(features)],
                         F.lit(minority).cast(df.schema[label].dataType).alias(label), "source_id", "neighbour_id")
    return orig.unionByName(synth).select(*shown)


class LinearScorer:
    """A logistic model with given weights; ``transform`` adds its ``probability`` vector."""

    def __init__(self, features: Sequence[str], weights: Sequence[float], intercept: float):
        self.features, self.weights, self.intercept = list(features), list(weights), float(intercept)

    def transform(self, df: DataFrame) -> DataFrame:
        margin = F.lit(self.intercept)
        for f, w in zip(self.features, self.weights):
            margin = margin + F.lit(float(w)) * F.col(f).cast("double")
        p = 1 / (1 + F.exp(-margin))
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def dealt_evenly(df: DataFrame, name: str = "training_rows") -> DataFrame:
    """The rows, written in one equal part a core where there are ``DEAL_FROM`` or more.

    Every pass of a fit lasts as long as its largest part, and the files of a
    written table differ much in size.  More parts than cores would cost a
    forest: each part sends the statistics of every open node of every tree.
    """
    if df.count() < DEAL_FROM:
        return df
    return materialize(df.repartition(df.sparkSession.sparkContext.defaultParallelism), name)


def train_and_rank(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                   trainers: Mapping, first_version: bool = True) -> DataFrame:
    """Train every model, score the test part and rank by F1 (then by name): one row per model with its
    five metrics; the best goes to Production as the first version, to Staging afterwards.

    The models do not depend on each other and are fitted at the same time, so the many short jobs of one
    (boosting: a job a tree level) run beside the long ones of another.
    """
    from churnlens.operators.metrics import binary_metrics, roc_auc
    train = dealt_evenly(train)
    with ThreadPoolExecutor(max(1, len(trainers))) as pool:
        fits = {name: pool.submit(inheritable_thread_target(train.sparkSession)(fit), train, features, label) for name, fit in trainers.items()}
        models = {name: f.result() for name, f in fits.items()}
    parts = None
    for name, model in models.items():
        s = score(test, model).select(F.lit(name).alias("model"), label, "probability_1", "predicted")
        parts = s if parts is None else parts.unionByName(s)
    scores = materialize(parts, "model_scores")
    m = binary_metrics(scores, label, "predicted", ["model"]).join(
        roc_auc(scores, label, "probability_1", ["model"]), "model", "left")
    rank = F.row_number().over(Window.orderBy(F.desc("f1"), "model"))  # one row per model
    stage = F.when(F.col("rank") == 1, F.lit("Production" if first_version else "Staging"))
    return m.withColumn("rank", rank).withColumn("stage", stage)


def assembler(features: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="keep")


def smallest_leaf(min_samples_split: int) -> int:
    """A node is split from ``min_samples_split`` rows on; Spark bounds the children instead: half of it, rounded up,
    so no smaller node is split (a split that leaves less than half on one side is given up too)."""
    return max(1, -(-int(min_samples_split) // 2))


def train_forest(df: DataFrame, features: Sequence[str], label: str, cfg: Mapping | None = None,
                 balanced: bool = True) -> PipelineModel:
    """H3: random forest with balanced class weights.

    The node that each row has reached in each tree is kept between levels (four bytes a row and tree, which may go
    to disk), instead of walking every tree from its root at each level; the trees are the same.
    """
    cfg = {**FOREST_DEFAULTS, **(cfg or {})}
    depth = MAX_TREE_DEPTH if cfg.get("maxDepth") is None else min(int(cfg["maxDepth"]), MAX_TREE_DEPTH)
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=int(cfg["numTrees"]),
                                maxDepth=depth, seed=int(cfg["seed"]), cacheNodeIds=True,
                                minInstancesPerNode=int(cfg.get("minInstancesPerNode", smallest_leaf(cfg.get("minSamplesSplit", 2)))))
    data = df
    if balanced:
        data = class_weights(df, label)
        rf.setWeightCol("weight")
    return Pipeline(stages=[assembler(features), rf]).fit(data)


def train_boosted(df: DataFrame, features: Sequence[str], label: str, cfg: Mapping | None = None) -> PipelineModel:
    """H4: gradient-boosted trees."""
    cfg = {**BOOSTED_DEFAULTS, **(cfg or {})}
    gbt = GBTClassifier(labelCol=label, featuresCol="features", stepSize=float(cfg["stepSize"]),
                        maxDepth=int(cfg["maxDepth"]), maxIter=int(cfg["maxIter"]), seed=int(cfg["seed"]),
                        subsamplingRate=float(cfg.get("subsamplingRate", 1.0)),
                        featureSubsetStrategy=str(cfg.get("featureSubsetStrategy", "all")))
    return Pipeline(stages=[assembler(features), gbt]).fit(df)


def train_mlp(df: DataFrame, features: Sequence[str], label: str, cfg: Mapping | None = None) -> PipelineModel:
    """H5: one hidden layer network (sigmoid hidden layer, L-BFGS/GD per Spark ML)."""
    cfg = {**MLP_DEFAULTS, **(cfg or {})}
    mlp = MultilayerPerceptronClassifier(labelCol=label, featuresCol="features",
                                         layers=[len(features), int(cfg["hidden"]), 2],
                                         stepSize=float(cfg["stepSize"]), maxIter=int(cfg["maxIter"]),
                                         blockSize=int(cfg["blockSize"]), seed=int(cfg["seed"]),
                                         solver=str(cfg.get("solver", "l-bfgs")))
    return Pipeline(stages=[assembler(features), mlp]).fit(df)


def train_logistic(df: DataFrame, features: Sequence[str], label: str, cfg: Mapping | None = None) -> PipelineModel:
    """H6: logistic regression."""
    cfg = dict(cfg or {})
    lr = LogisticRegression(labelCol=label, featuresCol="features", maxIter=int(cfg.get("maxIter", 100)),
                            regParam=float(cfg.get("regParam", 0.0)))
    return Pipeline(stages=[assembler(features), lr]).fit(df)


def f1_evaluator(label: str) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def _grid(est, grid: Mapping[str, Sequence]) -> list:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


def grid_search(df: DataFrame, features: Sequence[str], label: str, est, grid: Mapping[str, Sequence],
                folds: int = 3, parallelism: int = 4, seed: int = 42, maps: list | None = None, key: str | None = None):
    """H7: exhaustive search, k folds with the class mix of the whole, F1 of class 1; returns the CrossValidatorModel."""
    est.setLabelCol(label).setFeaturesCol("features")
    maps = maps if maps is not None else _grid(est, grid)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=f1_evaluator(label),
                        numFolds=folds, parallelism=parallelism, seed=seed, foldCol="fold")
    dealt = materialize(stratified_folds(df, label, folds, seed, key), "folds")
    return cv.fit(assembler(features).transform(dealt))


def random_search(df: DataFrame, features: Sequence[str], label: str, est, grid: Mapping[str, Sequence],
                  n_iter: int = 5, folds: int = 3, seed: int = 42, parallelism: int = 4):
    """H8: a seeded subset of n_iter grid points through H7."""
    maps = _grid(est, grid)
    pick = random.Random(seed).sample(range(len(maps)), min(n_iter, len(maps)))
    return grid_search(df, features, label, est, grid, folds, parallelism, seed, [maps[i] for i in sorted(pick)])


def score(df: DataFrame, model, threshold: float = 0.5, inclusive: bool = True,
          prob_col: str = "probability_1", pred_col: str = "predicted") -> DataFrame:
    """Label + probability of class 1 for any fitted pipeline or model."""
    scored = model.transform(df)
    out = scored.withColumn(prob_col, vector_to_array("probability")[1])
    out = out.withColumn(pred_col, threshold_label(prob_col, threshold, inclusive))
    drop = [c for c in ("features", "rawPrediction", "probability", "prediction") if c in out.columns]
    return out.drop(*drop)


def predict_table(raw: DataFrame, model, params: Mapping, keep: Sequence[str], features: Sequence[str],
                  id_col: str, event_time: str | None = None, threshold: float = 0.5) -> DataFrame:
    """Raw columns + decoded label + probability + risk band (+ latency
    from an event-time column when given).  One projection: every input row
    gives one output row, whatever its id (``id_col`` is kept for callers)."""
    row = raw.select("*", F.struct(*[F.col(c) for c in keep]).alias("_kept"))
    scored = score(prepare_serving(row, params), model, threshold)
    out = scored.select("_kept.*", "probability_1", "predicted")
    out = (out.withColumn("Churn", decode_binary("predicted")).withColumn("risk", risk_band("probability_1"))
           .drop("predicted").withColumnRenamed("probability_1", "probability"))
    if event_time:
        out = out.withColumn("latency", (F.unix_micros(F.current_timestamp())
                                         - F.unix_micros(F.col(event_time).cast("timestamp"))) / 1e6)
    return out


def row_attributions(model, means: Mapping[str, float] | None = None) -> Column | None:
    """H12 as a column of the prepared features (feature → attribution): exact for linear and tree models, null for others."""
    from churnlens.operators.trees import TreeModel, attribution_column
    if isinstance(model, TreeModel):
        return F.map_from_arrays(F.lit(list(model.features)), attribution_column(model))
    if isinstance(model, LinearScorer) and means is not None:
        return F.map_from_arrays(
            F.lit(list(model.features)),
            F.array(*[F.lit(float(w)) * (F.col(f).cast("double") - F.lit(float(means[f])))
                      for f, w in zip(model.features, model.weights)]))
    return None


def predict_log(raw: DataFrame, model, params: Mapping, keep: Sequence[str], means: Mapping[str, float] | None,
                stage: str, version: str, latency: float | str = 0.0, threshold: float = 0.5) -> DataFrame:
    """H14 + H12 + A6 in one projection: the kept raw columns, ``attributions`` (feature → attribution; linear and
    tree models) and the log columns (label, probability, time, stage, version, latency, date), ready for
    ``append_inference_log``.  One output row per input row, on a batch or a stream, for any model with ``transform``."""
    from churnlens.sources.io import with_log_columns
    row = raw.select("*", F.struct(*[F.col(c) for c in keep]).alias("_kept"))
    prepared = prepare_serving(row, params)
    phi = row_attributions(model, means)
    if phi is not None:
        prepared = prepared.withColumn("_phi", phi)
    scored = score(prepared, model, threshold)
    out = scored.select("_kept.*", *([F.col("_phi").alias("attributions")] if phi is not None else []), "probability_1", "predicted")
    return with_log_columns(out, "predicted", "probability_1", stage, version, latency).drop("predicted", "probability_1")


def decay_check(log_features: DataFrame, model, label: str, threshold: float = 0.5,
                expected: Sequence[str] = ()) -> DataFrame:
    """Check that the ``expected`` columns are there, score labelled rows and report the five metrics.

    A labelled row that lacks one of the expected features (an unknown
    customer) is not scored; ``unscored`` counts these.
    """
    from churnlens.operators.metrics import binary_metrics, roc_auc
    whole = F.lit(True)
    if expected:
        validate_schema(log_features, expected)
        for c in expected:
            whole = whole & F.col(c).isNotNull()
    # joined once; only whole rows reach the model, which takes no missing feature
    labelled = materialize(log_features.where(F.col(label).isNotNull()).withColumn("_whole", whole), "decay_rows")
    # scored once: both metrics read the written (label, probability, class) columns
    scored = score(labelled.where("_whole").drop("_whole"), model, threshold).select(label, "probability_1", "predicted")
    scored = materialize(scored, "decay_scores")
    m = _one_row_join(binary_metrics(scored, label, "predicted"), roc_auc(scored, label, "probability_1"))
    return _one_row_join(m, labelled.agg(F.count_if(~F.col("_whole")).alias("unscored")))


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two single-row aggregates on a constant key."""
    return a.withColumn("_k", F.lit(1)).join(b.withColumn("_k", F.lit(1)), "_k").drop("_k")
