"""Split, oversampling, training and explanation on the small test tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.plans import catalog


@pytest.fixture(scope="module")
def ml(spark):
    t, params = catalog.ml_table(spark, "/root/testdata/sf0.001")
    return t.cache(), params


def test_stratified_split_class_totals(ml):
    t, _ = ml
    got = {(r.churn, r.split): r.n for r in t.groupBy("churn", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    for cls in (0, 1):
        n = got.get((cls, "test"), 0) + got.get((cls, "train"), 0)
        assert got.get((cls, "test"), 0) == round(0.2 * n)


def test_oversample_balances_and_stays_in_hull(ml):
    from churnlens.operators.ml import oversample_minority
    t, _ = ml
    train = t.where(F.col("split") == "train")
    bal = oversample_minority(train, "churn", catalog.ML_FEATURES, k=5, seed=1, cell_size=64, key="customer_id")
    counts = {r.churn: r["count"] for r in bal.groupBy("churn").count().collect()}
    assert len(set(counts.values())) == 1
    minority = min(counts, key=lambda c: train.where(F.col("churn") == c).count())
    src = np.array(train.where(F.col("churn") == minority).select(*catalog.ML_FEATURES).collect(), dtype=float)
    syn = np.array(bal.where(F.col("churn") == minority).select(*catalog.ML_FEATURES).collect(), dtype=float)
    lo, hi = src.min(0) - 1e-9, src.max(0) + 1e-9
    assert ((syn >= lo) & (syn <= hi)).all()


def test_models_score_probabilities(ml):
    from churnlens.operators.ml import score, train_forest, train_logistic
    t, _ = ml
    train, test = t.where(F.col("split") == "train"), t.where(F.col("split") == "test")
    for model in (train_logistic(train, catalog.ML_FEATURES, "churn"),
                  train_forest(train, catalog.ML_FEATURES, "churn", {"numTrees": 10, "maxDepth": 4})):
        s = score(test, model).collect()
        assert len(s) == test.count()
        assert all(0.0 <= r.probability_1 <= 1.0 and r.predicted in (0, 1) for r in s)


def test_linear_attributions_are_additive(ml):
    from churnlens.operators.explain import explain_linear, logistic_weights
    from churnlens.operators.ml import train_logistic
    t, _ = ml
    train = t.where(F.col("split") == "train")
    model = train_logistic(train, catalog.ML_FEATURES, "churn")
    w, b = logistic_weights(model)
    phi = explain_linear(train, "customer_id", catalog.ML_FEATURES, w, b)
    sums = {r.customer_id: r.s for r in phi.groupBy("customer_id").agg((F.sum("phi") + F.first("base")).alias("s"))
            .collect()}
    for r in train.limit(20).collect():
        margin = b + sum(wi * float(r[f]) for wi, f in zip(w, catalog.ML_FEATURES))
        assert sums[r.customer_id] == pytest.approx(margin, abs=1e-9)


def test_grid_search_returns_metrics(ml):
    from pyspark.ml.classification import LogisticRegression
    from churnlens.operators.ml import grid_search
    t, _ = ml
    cvm = grid_search(t.where(F.col("split") == "train"), catalog.ML_FEATURES, "churn", LogisticRegression(),
                      {"regParam": [0.0, 0.1]}, folds=2, parallelism=2)
    assert len(cvm.avgMetrics) == 2


def test_model_save_load_round_trip(ml, tmpdir_path):
    from churnlens.operators.ml import score, train_logistic
    from churnlens.sources.io import load_model, save_model
    t, _ = ml
    train = t.where(F.col("split") == "train")
    model = train_logistic(train, catalog.ML_FEATURES, "churn")
    save_model(model, tmpdir_path + "/model")
    back = load_model(tmpdir_path + "/model")
    a = sorted((r.customer_id, round(r.probability_1, 12)) for r in score(train, model).collect())
    b = sorted((r.customer_id, round(r.probability_1, 12)) for r in score(train, back).collect())
    assert a == b


def test_neighbours_against_brute_force(spark):
    from churnlens.operators.ml import nearest_neighbours
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.3, (1000, 4)) for c in rng.normal(0, 3, (5, 4))])
    points = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, x array<double>")
    got = {}
    for r in nearest_neighbours(points, k=5, cell_size=512, projections=6).collect():
        got.setdefault(r.id, set()).add(r.other)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    near = np.argpartition(d, 4, axis=1)[:, :5]
    assert len(got) == len(x) and all(len(v) == 5 for v in got.values())
    assert np.mean([len(got[i] & set(near[i])) / 5 for i in range(len(x))]) >= 0.9


@pytest.mark.parametrize("n,dimensions", [(20_000, 5), (60_000, 5), (20_000, 13), (60_000, 13)])
def test_neighbours_of_many_points_by_default(spark, n, dimensions):
    from churnlens.operators.ml import nearest_neighbours
    x = np.random.default_rng(4).normal(size=(n, dimensions))
    points = spark.createDataFrame(pd.DataFrame({"id": np.arange(n), "x": x.tolist()}))
    asked = np.arange(0, n, n // 500)
    got = {}
    for r in nearest_neighbours(points).where(F.col("id") % (n // 500) == 0).collect():
        got.setdefault(r.id, set()).add(r.other)
    d = ((x[asked][:, None, :] - x[None, :, :]) ** 2).sum(2)
    d[np.arange(len(asked)), asked] = np.inf
    near = np.argpartition(d, 4, axis=1)[:, :5]
    assert set(got) == set(asked) and all(len(v) == 5 for v in got.values())
    recall = np.mean([len(got[i] & set(row)) / 5 for i, row in zip(asked, near)])
    print("recall", n, dimensions, recall)
    assert recall >= 0.95


def test_oversampling_far_out_of_balance(spark):
    from churnlens.operators.ml import oversample_minority
    rows = [(float(i % 97), float(i % 89), 0) for i in range(30_000)] + [(1.0, 2.0, 1), (3.0, 4.0, 1), (3.0, 4.0, 1)]
    df = spark.createDataFrame([*rows, (0.0, 0.0, None)], "a double, b double, y int")
    out = oversample_minority(df, "y", ["a", "b"], per_task=500, with_pairs=True)
    got = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert got == {0: 30_000, 1: 30_000, None: 1}
    made = out.where("source_id IS NOT NULL")
    assert made.where("neighbour_id IS NULL OR a < 1 OR a > 3 OR abs(b - a - 1) > 1e-9").count() == 0
    assert made.select("source_id").distinct().count() == 3
    one = spark.createDataFrame([(1.0, 0), (2.0, 0), (5.0, 1)], "a double, y int")
    assert [r.a for r in oversample_minority(one, "y", ["a"]).where("y = 1").collect()] == [5.0, 5.0]


def test_repeated_ids_are_explained_row_by_row(ml):
    from churnlens.operators.explain import explain_sampled
    from churnlens.operators.ml import LinearScorer
    t, _ = ml
    two = t.limit(3)
    model = LinearScorer(catalog.ML_FEATURES, [0.3] * len(catalog.ML_FEATURES), 0.0)
    phi = explain_sampled(two.unionByName(two), model, "customer_id", catalog.ML_FEATURES, samples=3)
    assert phi.count() == 6 * len(catalog.ML_FEATURES)


def test_explain_query_takes_all_rows_samples_and_trees(spark, ml, monkeypatch):
    from churnlens.operators import explain
    from churnlens.operators.ml import FOREST_DEFAULTS
    real, seen = explain.explain_sampled, {}

    def watched(df, model, *args, samples=100, **more):
        seen.update(samples=samples, trees=model.stages[-1].getNumTrees)
        return real(df, model, *args, samples=2, **more)

    monkeypatch.setattr(explain, "explain_sampled", watched)
    t, _ = ml
    got = catalog.QUERIES["explain_sampled"](spark, "/root/testdata/sf0.001")
    pairs = {(r.customer_id, r.feature) for r in got.collect()}
    assert pairs == {(r.customer_id, f) for r in t.select("customer_id").collect() for f in catalog.ML_FEATURES}
    assert seen == {"samples": 100, "trees": FOREST_DEFAULTS["numTrees"]}


def test_ranking_of_models(ml):
    from churnlens.operators.ml import LinearScorer, train_and_rank
    t, _ = ml
    fits = {"up": lambda *_: LinearScorer(["tenure"], [5.0], -2.0), "down": lambda *_: LinearScorer(["tenure"], [-5.0], 2.0)}
    got = train_and_rank(t, t, catalog.ML_FEATURES, "churn", fits).orderBy("rank").collect()
    assert [r.rank for r in got] == [1, 2] and got[0].f1 >= got[1].f1
    assert got[0].stage == "Production" and got[1].stage is None
    assert abs(got[0].roc_auc + got[1].roc_auc - 1) < 1e-9


def test_predict_explain_and_log_in_one_projection(spark, ml, tmpdir_path):
    from churnlens.operators.ml import LinearScorer, predict_log
    from churnlens.sources.io import append_inference_log
    _, params = ml
    raw = catalog.raw_subscribers(spark, "/root/testdata/sf0.001")
    model = LinearScorer(catalog.ML_FEATURES, [0.5] * len(catalog.ML_FEATURES), -1.0)
    means = {f: 0.25 for f in catalog.ML_FEATURES}
    out = predict_log(raw, model, params, [c for c in raw.columns if c != "churn"], means, "Production", "v1")
    append_inference_log(out, tmpdir_path + "/log")
    back = spark.read.parquet(tmpdir_path + "/log")
    assert back.count() == raw.count()
    for r in back.limit(20).collect():
        margin = -1.0 + sum(r.attributions.values()) + 0.5 * 0.25 * len(catalog.ML_FEATURES)
        assert r.probability == pytest.approx(1 / (1 + np.exp(-margin)), abs=1e-9)
        assert r.Churn == ("Yes" if r.probability >= 0.5 else "No")



def test_decay_check_counts_rows_of_unknown_customers(spark):
    from churnlens.operators.ml import LinearScorer, decay_check
    log = spark.createDataFrame([(1, 0.5), (0, -0.5), (1, None), (0, None), (None, 0.1), (1, -1.0)], "label int, a double")
    got = decay_check(log, LinearScorer(["a"], [1.0], 0.0), "label", expected=["a", "label"]).first()
    assert (got["n"], got["tp"], got["fp"], got["fn"], got["tn"], got["unscored"]) == (3, 1, 0, 1, 1, 2)
    assert got["roc_auc"] == 0.5
    none = decay_check(log.where("a IS NULL"), LinearScorer(["a"], [1.0], 0.0), "label", expected=["a", "label"]).first()
    assert (none["n"], none["unscored"]) == (0, 2)


def test_grid_search_keeps_the_nodes_of_rows(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier
    from churnlens.operators import ml
    seen = {}
    df = spark.range(2000).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 5).cast("double").alias("c"))
    df = df.withColumn("y", (F.col("a") + F.col("b") * F.col("c") / 4 > 0.8).cast("int")).cache()

    class Found:
        avgMetrics = [0.5]

    def watched(train, features, label, est, grid, folds):
        seen["kept"] = est.getCacheNodeIds()
        return Found

    monkeypatch.setattr(catalog, "_train_test", lambda *_: (df, df, None))
    monkeypatch.setattr(ml, "grid_search", watched)
    assert catalog.QUERIES["forest_grid_search"](spark, "").count() == 1 and seen["kept"]
    rows = ml.assembler(["a", "b", "c"]).transform(df).cache()
    fits = [RandomForestClassifier(seed=42, labelCol="y", numTrees=4, maxDepth=6, cacheNodeIds=k).fit(rows) for k in (True, False)]
    trees = [fit.toDebugString.split("\n", 1)[1] for fit in fits]
    assert trees[0] == trees[1] and fits[0].totalNumNodes > 100


def test_models_are_fitted_at_the_same_time_on_rows_dealt_evenly(spark, monkeypatch):
    from threading import Barrier
    from churnlens.operators import ml
    rows = [(i, float(i % 7), int(i % 3 == 0)) for i in range(1000)]
    uneven = spark.range(0, 960, 1, 1).unionByName(spark.range(960, 1000, 1, 2)).selectExpr(
        "CAST(id AS int) i", "CAST(id % 7 AS double) a", "CAST(id % 3 = 0 AS int) y")
    together, seen = Barrier(2, timeout=60), {}

    def fit(name):
        def run(df, x, y):
            together.wait()  # one fit after the other would never meet here
            seen[name] = (sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), sorted(map(tuple, df.collect())))
            return ml.LinearScorer(x, [1.0], -3.0)
        return run

    def ranked():
        return ml.train_and_rank(uneven, uneven, ["a"], "y", {"one": fit("one"), "two": fit("two")}).count()

    assert ranked() == 2
    assert seen["one"] == seen["two"] == ([20, 20, 960], rows)  # few rows stay as they are read
    monkeypatch.setattr(ml, "DEAL_FROM", 1000)
    assert ranked() == 2
    sizes, found = seen["one"]
    assert found == rows and len(sizes) == spark.sparkContext.defaultParallelism and sizes[-1] - sizes[0] <= 2


def test_forest_keeps_the_nodes_of_rows_and_its_trees(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from churnlens.operators.ml import assembler, class_weights, train_forest
    df = spark.range(2000).select(F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 5).cast("double").alias("c"))
    df = df.withColumn("y", (F.col("a") + F.col("b") * F.col("c") / 4 > 0.8).cast("int")).cache()
    got = train_forest(df, ["a", "b", "c"], "y", {"numTrees": 5, "maxDepth": 6}).stages[-1]
    assert got.getCacheNodeIds()
    walked = RandomForestClassifier(labelCol="y", featuresCol="features", weightCol="weight", numTrees=5, maxDepth=6, seed=42, cacheNodeIds=False)
    plain = Pipeline(stages=[assembler(["a", "b", "c"]), walked]).fit(class_weights(df, "y")).stages[-1]
    assert got.toDebugString.split("\n")[1:] == plain.toDebugString.split("\n")[1:]
