"""Tree attributions, second-order boosting and the network against brute force."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churnlens.operators import boosting, network
from churnlens.operators.trees import TreeModel, attributions, explain_trees, forest_model, leaf_groups, tree_from_nodes
from churnlens.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def ml(spark):
    t, _ = catalog.ml_table(spark, SF)
    return t.cache()


def random_tree(rng, features, depth):
    rows = []

    def grow(level, cover):
        node = len(rows)
        rows.append(None)
        if level == depth or cover < 2 or rng.random() < 0.15:
            rows[node] = (node, -1, 0.0, -1, -1, float(rng.normal()), cover)
        else:
            part = int(rng.integers(1, cover))
            f, cut = int(rng.integers(features)), float(rng.normal())
            left = grow(level + 1, part)
            right = grow(level + 1, cover - part)
            rows[node] = (node, f, cut, left, right, 0.0, cover)
        return node

    grow(0, 1000)
    return tree_from_nodes(pd.DataFrame(rows, columns=["id", "feature", "threshold", "left", "right", "value", "cover"]))


def coalition_value(tree, x, known, node=0):
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        return coalition_value(tree, x, known, left if x[f] <= tree.threshold[node] else right)
    return sum(tree.cover[c] / tree.cover[node] * coalition_value(tree, x, known, c) for c in (left, right))


def exhaustive(trees, x):
    d, phi = len(x), np.zeros(len(x))
    worth = {s: sum(coalition_value(t, x, s) for t in trees) for k in range(d + 1) for s in map(frozenset, itertools.combinations(range(d), k))}
    for i in range(d):
        for s, v in worth.items():
            if i not in s:
                phi[i] += math.factorial(len(s)) * math.factorial(d - 1 - len(s)) / math.factorial(d) * (worth[s | {i}] - v)
    return phi, worth[frozenset()]


@pytest.mark.parametrize("features,depth", [(4, 3), (4, 9), (6, 12), (1, 4)])
def test_attributions_equal_all_coalitions(features, depth):
    rng = np.random.default_rng(features * depth)
    trees = tuple(random_tree(rng, features, depth) for _ in range(3))
    model = TreeModel(tuple(f"f{k}" for k in range(features)), trees)
    x = rng.normal(size=(12, features))
    x[0, 0] = np.nan
    base, groups = leaf_groups(model)
    got = attributions(x, groups)
    for row, phi in zip(x, got):
        want, mean = exhaustive(trees, row)
        assert np.allclose(phi, want, atol=1e-12) and mean == pytest.approx(base)
    assert np.allclose(base + got.sum(1), model.raw(x))


def test_forest_and_boosted_nodes_score_as_spark_does(spark, ml):
    from churnlens.operators.ml import score, train_boosted, train_forest
    features = catalog.ML_FEATURES
    for fitted in (train_forest(ml, features, "churn", {"numTrees": 7, "maxDepth": 5}),
                   train_boosted(ml, features, "churn", {"maxIter": 5, "maxDepth": 3})):
        model = forest_model(fitted, features)
        want = {r.customer_id: r.probability_1 for r in score(ml, fitted).collect()}
        got = {r.customer_id: r.probability_1 for r in score(ml, model).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)
        phi = explain_trees(ml.unionByName(ml.limit(5)), model, "customer_id")
        assert phi.count() == (ml.count() + 5) * len(features)
        sums = phi.groupBy("customer_id").agg((F.sum("phi") / (F.count("phi") / len(features)) + F.first("base")).alias("raw"))
        for r in sums.collect():
            p = 1 / (1 + math.exp(-r.raw)) if model.logistic else r.raw
            assert p == pytest.approx(want[r.customer_id], abs=1e-9)


def test_a_trained_forest_predicts_explains_and_logs(spark, ml):
    from churnlens.operators.fitted import prepare_training
    from churnlens.operators.ml import predict_log, train_forest
    raw = catalog.raw_subscribers(spark, SF)
    feats, params = prepare_training(raw, catalog.ML_SPEC)
    model = forest_model(train_forest(feats, catalog.ML_FEATURES, "churn", {"numTrees": 5, "maxDepth": 4}), catalog.ML_FEATURES)
    out = predict_log(raw.drop("churn"), model, params, ["customer_id"], None, "Production", "v3").collect()
    assert len(out) == raw.count()
    base = leaf_groups(model)[0]
    for r in out:
        assert set(r.attributions) == set(catalog.ML_FEATURES)
        assert r.probability == pytest.approx(base + sum(r.attributions.values()), abs=1e-9)
        assert r.Churn == ("Yes" if r.probability >= 0.5 else "No")


# --- boosting -------------------------------------------------------------------------------------------------------

def brute_boost(x, y, s, rounds):
    """Second-order boosting by trying every cut of every feature."""
    margin, trees = np.zeros(len(y)), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(rows, depth):
            G, H = g[rows].sum(), h[rows].sum()
            best = (0.0,)
            if depth < s["depth"]:
                for f in range(x.shape[1]):
                    for cut in np.unique(x[rows, f]):
                        left = rows[x[rows, f] <= cut]
                        right = rows[x[rows, f] > cut]
                        if len(right) and min(h[left].sum(), h[right].sum()) >= s["min_weight"]:
                            gain = 0.5 * (g[left].sum() ** 2 / (h[left].sum() + s["l2"]) + g[right].sum() ** 2 / (h[right].sum() + s["l2"]) - G * G / (H + s["l2"]))
                            if gain > best[0] + 1e-12:
                                best = (gain, left, right)
            if best[0] <= 0:
                margin[rows] += -s["lr"] * G / (H + s["l2"])
                return
            grow(best[1], depth + 1)
            grow(best[2], depth + 1)

        grow(np.arange(len(y)), 0)
        trees.append(margin.copy())
    return margin


def test_boosting_equals_brute_force(spark):
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(200, 3)), 1)
    y = (x[:, 0] + x[:, 1] ** 2 + rng.normal(size=200) * 0.3 > 0.5).astype(int)
    df = spark.createDataFrame([(i, *map(float, r), int(v)) for i, (r, v) in enumerate(zip(x, y))], "i int, a double, b double, c double, y int").repartition(3)
    s = {**boosting.DEFAULTS, "depth": 3, "trees": 12, "lr": 0.3}
    model = boosting.train_newton(df, ["a", "b", "c"], "y", s)
    assert len(model.trees) == 12
    want = brute_boost(x, y, s, 12)
    assert np.allclose(model.raw(x), want, atol=1e-9)
    base, groups = leaf_groups(model)
    assert np.allclose(base + attributions(x, groups).sum(1), model.raw(x))


def test_boosting_samples_columns_and_rows_and_skips_missing(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = (x.sum(1) > 0).astype(int)
    rows = [(*[None if rng.random() < 0.05 else float(v) for v in r], int(v)) for r, v in zip(x, y)] + [(0.0,) * 5 + (None,)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double, y int")
    some, all_rows = boosting.train_boosters(df, list("abcde"), "y", [{"trees": 12, "depth": 2, "colsample": 0.4, "subsample": 0.7}, {"trees": 5, "depth": 3}])
    for t in some.trees:
        assert len(set(t.feature[t.feature >= 0])) <= 2
    assert len({f for t in some.trees for f in t.feature if f >= 0}) == 5
    assert len(all_rows.trees) == 5 and any(len(set(t.feature[t.feature >= 0])) > 2 for t in all_rows.trees)
    assert ((all_rows.raw(x) > 0) == y).mean() > 0.8
    again, _ = boosting.train_boosters(df, list("abcde"), "y", [{"trees": 12, "depth": 2, "colsample": 0.4, "subsample": 0.7}, {"trees": 5, "depth": 3}])
    assert np.allclose(again.raw(x), some.raw(x))


def test_folds_of_a_search_leave_their_rows_out(spark):
    df = spark.createDataFrame([(float(i % 10), int(i % 10 >= 5) if i < 100 else int(i % 10 < 5), int(i >= 100)) for i in range(200)], "a double, y int, fold int")
    one, other = boosting.train_boosters(df, ["a"], "y", [{"trees": 5, "depth": 1, "without": 1}, {"trees": 5, "depth": 1, "without": 0}], fold="fold")
    assert one.raw(np.array([[9.0]]))[0] > 0 > other.raw(np.array([[9.0]]))[0]


# --- network --------------------------------------------------------------------------------------------------------

def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    x, y, flat = rng.normal(size=(20, 3)), rng.integers(0, 2, 20).astype(float), network.initial(3, 5, 1)
    _, g = network.loss_and_gradient(flat, x, y, 5)
    for k in range(len(flat)):
        step = np.zeros(len(flat))
        step[k] = 1e-6
        slope = (network.loss_and_gradient(flat + step, x, y, 5)[0] - network.loss_and_gradient(flat - step, x, y, 5)[0]) / 2e-6
        assert slope == pytest.approx(g[k], abs=1e-5)


def test_training_steps_equal_plain_adam(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(90, 2))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, y)], "a double, b double, y int").repartition(4)
    nets = network.train_networks(df, ["a", "b"], "y", [{"hidden": 6, "lr": 0.05, "batch": 1000}, {"hidden": 3, "lr": 0.01, "batch": 1000}], epochs=8)
    flat, adam = network.initial(2, 6, 42), network.Adam(len(network.initial(2, 6, 42)), 0.05)
    for _ in range(8):
        flat = adam.step(flat, network.loss_and_gradient(flat, x, y.astype(float), 6)[1] / len(x))
    assert np.allclose(nets[0].flat, flat, atol=1e-10) and len(nets[1].flat) == 2 * 3 + 3 + 3 + 1
    scored = nets[0].transform(df).collect()
    assert all(r.probability[1] == pytest.approx(1 / (1 + math.exp(-network.logits(flat, np.array([[r.a, r.b]]), 6)[0])), abs=1e-9) for r in scored)


def test_larger_batches_add_up_blocks(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(200, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a > b)) for a, b in x], "a double, b double, y int")
    counted = []
    real = network.Adam.step
    network.Adam.step = lambda self, flat, g: counted.append(self.lr) or real(self, flat, g)
    try:
        network.train_networks(df, ["a", "b"], "y", [{"hidden": 2, "lr": 0.1, "batch": 50}, {"hidden": 2, "lr": 0.2, "batch": 100}], epochs=2)
    finally:
        network.Adam.step = real
    assert counted.count(0.1) == 8 and counted.count(0.2) == 4


def test_a_step_has_the_configured_batch_at_any_number_of_rows(spark, monkeypatch):
    x = np.random.default_rng(3).normal(size=(301, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a > b)) for a, b in x], "a double, b double, y int")
    counted, real = [], network.Adam.step
    monkeypatch.setattr(network.Adam, "step", lambda self, flat, g: counted.append(self.lr) or real(self, flat, g))
    network.train_networks(df, ["a", "b"], "y", [{"hidden": 2, "lr": 0.1, "batch": 2}, {"hidden": 2, "lr": 0.2, "batch": 4}], epochs=2)
    assert 2 * 76 >= counted.count(0.2) > 2 * 70 and 2 * 151 >= counted.count(0.1) > 2 * 100


def test_network_goes_through_all_shares(spark, monkeypatch):
    """Blocks of about 8 rows in shares of 5 blocks, on the executors, against plain Adam over the blocks in the order they are met."""
    x = np.random.default_rng(4).normal(size=(203, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a > b)) for a, b in x], "a double, b double, y int").repartition(3).cache()
    settings = [{"hidden": 5, "lr": 0.05, "batch": 8}, {"hidden": 3, "lr": 0.02, "batch": 24}]
    monkeypatch.setattr(network, "SHARE", 40)
    found = network.train_networks(df, ["a", "b"], "y", settings, 1, 3)
    shares = network.deal_shares(df, ["a", "b"], "y", 26, 5, 1).glom().collect()
    assert [{b // 5 for b, _, _ in s} for s in shares] == [{k} for k in range(6)]
    blocks = {b: (np.frombuffer(x).reshape(-1, 2), np.frombuffer(y)) for s in shares for b, x, y in s}
    assert sorted(tuple(r) for xs, _ in blocks.values() for r in xs) == sorted(map(tuple, x))
    for k, (setting, net) in enumerate(zip(settings, found)):
        plain, per = network.Learner(2, setting, 26, 8, 1), (1, 3)[k]
        flat, adam, orders = plain.flat, plain.adam, set()
        for epoch in range(3):
            order = [5 * s + int(b) for s in plain.route(6, epoch) for b in network.block_order(5 if s < 5 else 1, int(s), epoch, 1)]
            assert sorted(order) == list(range(26))
            orders.add(tuple(order))
            for a in range(0, 26, per):
                some = [blocks[b] for b in order[a:a + per] if b in blocks]
                if some:
                    xs, ys = (np.concatenate(v) for v in zip(*some))
                    flat = adam.step(flat, network.loss_and_gradient(flat, xs, ys, setting["hidden"])[1] / len(ys))
        assert len(orders) == 3 and np.allclose(net.flat, flat, atol=1e-10)
    df.unpersist()


def test_where_the_steps_run_does_not_change_them(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(120, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a > b) if a > -2 else None) for a, b in x], "a double, b double, y int").cache()
    settings = [{"hidden": 4, "lr": 0.05, "batch": 16}, {"hidden": 4, "lr": 0.05, "batch": 48}]
    here = network.train_networks(df, ["a", "b"], "y", settings, epochs=2)
    monkeypatch.setattr(network, "WORK", 0)
    assert all(np.allclose(a.flat, b.flat, atol=1e-10) for a, b in zip(here, network.train_networks(df, ["a", "b"], "y", settings, epochs=2)))
    df.unpersist()


def test_batches_larger_than_a_share_are_jobs(spark, monkeypatch):
    x = np.random.default_rng(8).normal(size=(90, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a > b)) for a, b in x], "a double, b double, y int").cache()
    settings = [{"hidden": 3, "lr": 0.02, "batch": 60}, {"hidden": 4, "lr": 0.05, "batch": 30}]
    want = network.train_networks(df, ["a", "b"], "y", settings, epochs=2)
    monkeypatch.setattr(network, "SHARE", 29)
    monkeypatch.setattr(network, "WORK", 100)
    got = network.train_networks(df, ["a", "b"], "y", settings, epochs=2)
    assert all(np.allclose(a.flat, b.flat, atol=1e-10) for a, b in zip(got, want))
    df.unpersist()


def test_search_ranks_every_setting(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a * b > 0)) for a, b in x], "a double, b double, y int")
    out, nets = network.network_search(df.limit(200), df, ["a", "b"], "y", {"hidden": [8, 16], "lr": [0.05, 0.0], "batch": [64]}, epochs=15)
    rows = out.orderBy("rank").collect()
    assert len(rows) == 4 == len(nets) and [r.rank for r in rows] == [1, 2, 3, 4]
    assert rows[0].lr == 0.05 and rows[0].f1 > 0.8 and all(a.f1 >= b.f1 for a, b in zip(rows, rows[1:]))
    assert len(network.network_grid()) == 27


def test_search_keeps_batches_apart_at_any_number_of_rows(spark, monkeypatch):
    x = np.random.default_rng(11).normal(size=(400, 2))
    df = spark.createDataFrame([(float(a), float(b), int(a * b > 0)) for a, b in x], "a double, b double, y int")
    counted, real = [], network.Adam.step
    monkeypatch.setattr(network.Adam, "step", lambda self, flat, g: counted.append(self.lr) or real(self, flat, g))
    out, nets = network.network_search(df, df, ["a", "b"], "y", {"hidden": [3], "lr": [0.01], "batch": [4, 8, 16]}, epochs=2)
    assert 2 * (100 + 50 + 25) >= len(counted) > 2 * (90 + 45 + 23) and out.count() == 3
    assert all(not np.allclose(a.flat, b.flat, atol=1e-6) for a, b in itertools.combinations(nets, 2))


# --- folds ----------------------------------------------------------------------------------------------------------

def test_folds_hold_each_class_evenly(spark):
    from churnlens.operators.ml import stratified_folds
    rows = [(i, 0 if i % 10 else 1) for i in range(997)] + [(5000 + i, None) for i in range(7)]
    df = spark.createDataFrame(rows, "i int, y int").repartition(5)
    got = stratified_folds(df, "y", 4, key="i")
    counts = {}
    for r in got.groupBy("y", "fold").count().collect():
        counts.setdefault(r.y, {})[r.fold] = r["count"]
    for y, per in counts.items():
        assert sorted(per) == [0, 1, 2, 3] and max(per.values()) - min(per.values()) <= 1 and sum(per.values()) == sum(b == y for _, b in rows)
    def by_id(folds):
        return {r.i: r.fold for r in folds.collect()}
    assert by_id(got) == by_id(stratified_folds(df.repartition(2), "y", 4, key="i"))


# --- searches -------------------------------------------------------------------------------------------------------

def test_configured_training_searches_and_ranks(spark, ml):
    from churnlens.operators.ml import train_and_rank
    from churnlens.operators.search import BOOSTED_GRID, FOREST_GRID, configured_trainers, points
    assert len(points(FOREST_GRID)) == 27 and len(points(BOOSTED_GRID)) == 108
    train, test = ml.where("split = 'train'"), ml.where("split = 'test'")
    trainers = configured_trainers({"n_estimators": [3], "max_depth": [2, None], "min_samples_split": [5]},
                                   {"lr": [0.1, 0.3], "depth": [2], "trees": [3], "subsample": [0.8], "colsample": [0.8]},
                                   {"hidden": [4], "lr": [0.01, 0.05], "batch": [64]}, n_iter=2, folds=2, epochs=2, key="customer_id")
    rows = train_and_rank(train, test, catalog.ML_FEATURES, "churn", trainers).orderBy("rank").collect()
    assert {r.model for r in rows} == {"forest", "boosted", "network", "logistic"} and [r["rank"] for r in rows] == [1, 2, 3, 4]


def test_boosted_search_scores_held_out_folds(spark):
    from churnlens.operators.search import booster_search
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 2))
    df = spark.createDataFrame([(i, float(a), float(b), int(a > 0.2)) for i, (a, b) in enumerate(x)], "i int, a double, b double, y int")
    found, best = booster_search(df, ["a", "b"], "y", {"lr": [0.0, 0.5], "depth": [2], "trees": [8], "colsample": [1.0]}, n_iter=2, key="i")
    rows = found.orderBy("rank").collect()
    assert rows[0].lr == 0.5 and rows[0].mean_f1 > 0.95 > rows[1].mean_f1
    assert ((best.raw(x) >= 0) == (x[:, 0] > 0.2)).mean() > 0.97
    assert found.count() == 2 and booster_search(df, ["a", "b"], "y", {"lr": [0.5], "depth": [1], "trees": [2]}, key="i")[0].count() == 1


def test_table_of_a_model_gives_the_same_attributions():
    from churnlens.operators.trees import coalition_weights, grid_attributions, worth_grid
    rng = np.random.default_rng(5)
    model = TreeModel(tuple("abcd"), tuple(random_tree(rng, 4, 6) for _ in range(8)), 0.25)
    cuts = np.concatenate([t.threshold[t.feature >= 0] for t in model.trees])
    x = np.concatenate([rng.normal(size=(40, 4)), rng.choice(cuts, size=(20, 4))])
    x[rng.random(x.shape) < 0.1] = np.nan
    grid = worth_grid(model, True)
    assert np.allclose(grid_attributions(x, grid, grid.worth, coalition_weights(4)), attributions(x, leaf_groups(model)[1]))
    whole = worth_grid(model, False)
    assert np.allclose(whole.worth[grid.places(x) @ whole.strides], model.raw(x))


def test_attributions_do_not_go_through_all_leaves(spark, monkeypatch):
    from churnlens.operators import trees
    model = TreeModel(("a", "b"), tuple(random_tree(np.random.default_rng(k), 2, 4) for k in range(3)))
    df = spark.range(50).select("id", (F.randn(1)).alias("a"), (F.randn(2)).alias("b")).cache()
    monkeypatch.setattr(trees, "CELLS", 1)
    slow = {(r.id, r.feature): r.phi for r in explain_trees(df, model, "id").collect()}
    monkeypatch.setattr(trees, "CELLS", 1 << 24)
    monkeypatch.setattr(trees, "leaf_groups", None)
    fast = {(r.id, r.feature): r.phi for r in explain_trees(df, model, "id").collect()}
    assert fast == pytest.approx(slow) and len(fast) == 100


def test_sampled_attributions_of_a_forest_are_looked_up(spark, monkeypatch):
    from churnlens.operators import explain
    from churnlens.operators.ml import train_forest
    df = spark.range(200).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), (F.col("id") % 3).cast("double").alias("c"))
    df = df.withColumn("y", (F.col("a") + F.col("c") > 1.2).cast("int")).cache()
    model = train_forest(df, ["b", "a", "c"], "y", {"numTrees": 4, "maxDepth": 4})
    few = df.orderBy("id").limit(12).cache()
    background = df.where("id % 20 = 7")
    got = {(r.id, r.feature): (r.phi, r.base) for r in explain.explain_sampled(few, model, "id", ["a", "b", "c"], background, 5).collect()}
    monkeypatch.setattr(explain, "model_grid", lambda *_: None)
    want = {(r.id, r.feature): (r.phi, r.base) for r in explain.explain_sampled(few, model, "id", ["a", "b", "c"], background, 5).collect()}
    assert len(got) == 36 and got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_blocks_stay_dealt_and_a_step_is_one_stage(spark):
    df = spark.range(600).select(F.col("id").cast("double").alias("a"), F.when(F.col("id") < 590, F.col("id") % 2).cast("int").alias("y"))
    dealt = network.deal_blocks(df, ["a"], "y", 3, 2, 1)
    assert dealt.getNumPartitions() == 6
    found = [[v for x, _ in part for v in np.frombuffer(x)] for part in dealt.glom().collect()]
    assert sorted(v for part in found for v in part) == list(range(590)) and all(found)
    spark.sparkContext.setJobGroup("steps", "")
    n, (g,) = network._gradients(dealt, 1, 2, [(4, network.initial(1, 4, 1))])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("steps")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n == len(found[2]) + len(found[3]) and g.shape == (13,) and len(jobs) == 1
    rows = {v: v % 2 for v in found[2] + found[3]}
    want = network.loss_and_gradient(network.initial(1, 4, 1), np.array(list(rows))[:, None], np.array(list(rows.values())), 4)[1]
    assert np.allclose(g, want)
    dealt.unpersist()
