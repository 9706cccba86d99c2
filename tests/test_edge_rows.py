"""Edge rows listed in FIXTURES.md and the behaviour decisions (Q-items)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from churnlens.functions import columns as X
from churnlens.operators import clean as C
from churnlens.operators import decide as I
from churnlens.operators import fitted as D
from churnlens.operators import merge as G
from churnlens.operators.metrics import roc_auc, stage_metrics


def test_blank_and_bad_text_to_null(spark):
    df = spark.createDataFrame([(" ",), ("abc",), ("12.5",), (None,), (" 7 ",)], "t string")
    got = [r[0] for r in df.select(X.to_numeric("t")).collect()]
    assert got == [None, None, 12.5, None, 7.0]


def test_median_fill_option(spark):
    df = spark.createDataFrame([("1",), ("3",), (" ",), ("10",)], "t string")
    zero = C.clean_table(df, ["t"], ["t"], [], fill="zero")
    med = C.clean_table(df, ["t"], ["t"], [], fill="median")
    assert sorted(r.t for r in zero.collect()) == [0.0, 1.0, 3.0, 10.0]
    assert sorted(r.t for r in med.collect()) == [1.0, 3.0, 3.0, 10.0]


def test_mode_fill_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    out = C.fill_mode(df, ["c"])
    assert sorted(r.c for r in out.collect()) == ["a", "a", "a", "b", "b"]


def test_unseen_category_encodes_to_minus_one_and_text_match(spark):
    train = spark.createDataFrame([(0, "x"), (1, "y")], "flag int, cat string")
    enc = D.fit_label_encoder(C.as_categorical(train, ["flag"]), ["flag", "cat"])
    serve = spark.createDataFrame([(1, "z"), (0, "x")], "flag int, cat string")
    out = D.apply_label_encoder(serve, enc, ["flag", "cat"]).orderBy("flag").collect()
    # Q3: an integer flag is compared as text on both sides, so it is found
    assert [(r.flag, r.cat) for r in out] == [(0, 0), (1, -1)]


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    out = D.apply_affine(df, D.fit_minmax(df, ["x"]))
    assert [r.x for r in out.collect()] == [0.0, 0.0]
    out2 = D.apply_affine(df, D.fit_standard(df, ["x"]))
    assert [r.x for r in out2.collect()] == [0.0, 0.0]


def test_zero_tenure_ratio_uses_one(spark):
    df = spark.createDataFrame([(30.0, 0), (30.0, 3)], "total double, tenure int")
    out = C.add_ratio(df, "total", "tenure", "r")
    assert [r.r for r in out.collect()] == [30.0, 10.0]


def test_bins_right_open_and_outside_null(spark):
    df = spark.createDataFrame([(0,), (11,), (12,), (72,), (73,), (-1,)], "t int")
    out = C.bin_column(df, "t", [0, 12, 48, 73], ["a", "b", "c"], out="band")
    assert [r.band for r in out.collect()] == ["a", "a", "b", "c", None, None]


def test_threshold_inclusive_switch(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (0.51,)], "p double")
    inc = [r[0] for r in df.select(X.threshold_label("p", 0.5, True)).collect()]
    exc = [r[0] for r in df.select(X.threshold_label("p", 0.5, False)).collect()]
    assert inc == [1, 0, 1] and exc == [0, 0, 1]


def test_risk_band(spark):
    df = spark.createDataFrame([(0.1,), (0.33,), (0.65,), (0.66,), (None,)], "p double")
    assert [r[0] for r in df.select(X.risk_band("p")).collect()] == ["Low", "Medium", "Medium", "High", None]


def test_one_class_group_auc_is_null(spark):
    df = spark.createDataFrame([("g", 1, 0.2), ("g", 1, 0.9), ("h", 0, 0.1), ("h", 1, 0.8)],
                               "g string, y int, p double")
    got = {r.g: r.roc_auc for r in roc_auc(df, "y", "p", by=["g"]).collect()}
    assert got["g"] is None and got["h"] == 1.0


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    # pairs (pos, neg): (0.5,0.5)=0.5, (0.5,0.1)=1, (0.9,0.5)=1, (0.9,0.1)=1 -> 3.5/4
    assert roc_auc(df, "y", "p").first().roc_auc == 0.875


def test_small_groups_skipped(spark):
    rows = [("Production", "v1", 1, 0.9, 0.1)] * 31 + [("Staging", "v3", 1, 0.9, 0.1)] * 5
    df = spark.createDataFrame(rows, "model_stage string, model_version string, label int, probability double, "
                                     "latency double")
    got = {r.model_stage for r in stage_metrics(df).collect()}
    assert got == {"Production"}


def test_canary_uses_newest_version_per_stage(spark):
    rows = [("Production", "v1", 0.5, 0.1, 100), ("Production", "v2", 0.6, 0.1, 100),
            ("Staging", "v3", 0.9, 0.2, 100)]
    m = spark.createDataFrame(rows, "model_stage string, model_version string, f1 double, mean_latency double, "
                                    "num_samples long")
    d = I.canary_decision(m).first()
    assert d.prod_version == "v2" and d.stag_version == "v3"
    assert d.promote is True and d.better_model == "Staging"


def test_canary_missing_stage_counts_as_zero(spark):
    m = spark.createDataFrame([("Production", "v1", 0.7, 0.1, 100)],
                              "model_stage string, model_version string, f1 double, mean_latency double, "
                              "num_samples long")
    d = I.canary_decision(m).first()
    assert d.stag_f1 == 0.0 and d.promote is False


def test_decay_levels_no_cap(spark):
    df = spark.createDataFrame([(0.79,), (0.83,), (0.87,), (0.95,)], "f1 double")
    assert [r.level for r in I.decay_level(df).collect()] == ["retrain", "critical", "early", "healthy"]


def test_drift_levels(spark):
    df = spark.createDataFrame([(0.6,), (0.45,), (0.3,), (0.1,)], "drift_share double")
    assert [r.level for r in I.drift_level(df).collect()] == ["retrain", "critical", "early", "healthy"]


def test_duplicate_rows_removed(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert G.combine_distinct(a, b, ["k", "v", "absent"]).count() == 2


def test_upsert_keeps_last_and_fills_absent(spark):
    log = spark.createDataFrame([("c1", 1, "No", 0.2), ("c1", 2, "No", 0.3), ("c2", 1, "Yes", 0.9)],
                                "customerID string, seq int, Churn string, probability double")
    fb = spark.createDataFrame([("c1", 0, "Yes")], "customerID string, seq int, Churn string")
    out = {r.customerID: r for r in G.upsert_log(log, fb, "customerID", ["seq"]).collect()}
    assert out["c1"].Churn == "Yes" and out["c1"].probability is None
    assert out["c2"].Churn == "Yes" and len(out) == 2


def test_upsert_idempotent(spark):
    log = spark.createDataFrame([("c1", 1, "No"), ("c2", 1, "Yes")], "k string, seq int, v string")
    fb = spark.createDataFrame([("c1", 2, "Yes")], "k string, seq int, v string")
    once = G.upsert_log(log, fb, "k", ["seq"])
    twice = G.upsert_log(once, fb, "k", ["seq"])
    assert sorted(once.collect()) == sorted(twice.select(*once.columns).collect())


def test_null_timestamps_sort_last(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, None), (2, t), (3, t + dt.timedelta(1))], "id int, ts timestamp")
    assert [r.id for r in G.top_recent(df, 3, "ts", "id").collect()] == [3, 2, 1]


def test_latest_in_stage_and_fallback(spark):
    v = spark.createDataFrame([("v1", "Production"), ("v10", "Production"), ("v11", "Staging")],
                              "version string, stage string")
    assert G.latest_in_stage(v, "Production").first().version == "v10"
    assert G.latest_in_stage(v, "Archived").first().version == "v11"


def test_route_share_repeatable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = I.route(df, "k", 0.25).where(F.col("model_stage") == "Staging").count()
    b = I.route(df, "k", 0.25).where(F.col("model_stage") == "Staging").count()
    assert a == b and abs(a / 20000 - 0.25) < 0.02
    assert I.route(df, "k", 0.25, has_staging=False).where(F.col("model_stage") == "Staging").count() == 0


def test_encode_decode_identity(spark):
    df = spark.createDataFrame([("Yes",), ("No",)], "c string")
    back = C.decode_binary(C.encode_binary(df, "c"), "c")
    assert [r.c for r in back.collect()] == ["Yes", "No"]


@pytest.mark.parametrize("method", ["distance", "test"])
def test_drift_kinds_exact_at_the_limit(spark, method):
    from churnlens.operators.drift import drift_report
    rows = [(float(i % 5), float(i % 6), float(i), str(i % 2), None) for i in range(600)]
    df = spark.createDataFrame(rows, "five double, six double, many double, txt string, none double")
    got = {r.column: r for r in drift_report(df, df, ["five", "six", "many", "txt", "none"], method=method).collect()}
    assert {c: r.kind for c, r in got.items()} == {"five": "categorical", "six": "numeric", "many": "numeric",
                                                   "txt": "categorical"}
    assert not any(r.drifted for r in got.values())
    assert got["six"].method == ("wasserstein" if method == "distance" else "ks")


def test_density_prebinned_close_to_exact(spark):
    import numpy as np
    from churnlens.operators.explore import density
    rng = np.random.default_rng(5)
    rows = [("a", float(x)) for x in rng.normal(0, 1, 2000)] + [("b", float(x)) for x in rng.normal(3, 0.5, 800)]
    df = spark.createDataFrame(rows, "g string, x double")
    exact = {(r.g, r.grid_index): r.density for r in density(df, "x", "g", grid=50).collect()}
    approx = {(r.g, r.grid_index): r.density for r in density(df, "x", "g", grid=50, bins=2000).collect()}
    assert exact.keys() == approx.keys()
    assert max(abs(exact[k] - approx[k]) for k in exact) < 1e-3


def test_cluster_conf_sizes_partitions():
    from churnlens.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert cluster_conf(10 * 1024 ** 2, 8)["spark.sql.shuffle.partitions"] == "16"


def test_null_groups_are_groups(spark):
    from churnlens.operators.explore import box_stats
    from churnlens.operators.metrics import roc_auc, stage_metrics
    from churnlens.operators.ml import stratified_split
    rows = [(i, i % 2, (i * 7 % 11) / 11, None if i % 10 == 0 else "p", "v") for i in range(100)]
    df = spark.createDataFrame(rows, "id int, y int, p double, model_stage string, model_version string")
    assert {r.model_stage for r in roc_auc(df, "y", "p", ["model_stage"]).collect()} == {None, "p"}
    assert {r.model_stage: r.n for r in box_stats(df, "model_stage", "p", "model_version").collect()} == {None: 10, "p": 90}
    log = df.withColumns({"label": df.y, "probability": df.p, "latency": df.p})
    got = {r.model_stage: r for r in stage_metrics(log, min_samples=5).collect()}
    assert {k: v.num_samples for k, v in got.items()} == {None: 10, "p": 90} and got["p"].roc_auc is not None
    split = stratified_split(df, "model_stage", 0.2, key="id")
    assert split.count() == 100
    assert split.where("split = 'test'").count() == 20 and split.where("model_stage IS NULL AND split = 'test'").count() == 2


def test_profile_keeps_columns_without_values(spark):
    from churnlens.operators.quality import profile_numeric, validate_schema
    df = spark.createDataFrame([(1, None), (2, None), (None, None)], "a int, b double")
    got = {r.column: r for r in profile_numeric(df, ["a", "b"]).collect()}
    assert got["b"]["count"] == 0 and got["b"]["mean"] is None and got["b"]["n_distinct"] == 0
    assert got["a"]["count"] == 2 and got["a"]["q50"] == 1.5 and abs(got["a"]["std"] - 0.5 ** 0.5) < 1e-12
    assert validate_schema(df, ["b"], warn_nulls=True)


def test_histogram_has_all_bins(spark):
    from churnlens.operators.explore import histogram
    df = spark.createDataFrame([(0.0,), (10.0,), (9.9,)], "x double")
    assert [r.n for r in histogram(df, "x", 5).orderBy("bin").collect()] == [1, 0, 0, 0, 2]
    assert [r.n for r in histogram(df.where("x > 9.95"), "x", 5).collect()] == [1]
    assert histogram(df.limit(0), "x", 5).count() == 0


def test_numbers_with_java_suffixes_are_text(spark):
    from churnlens.functions import to_numeric
    df = spark.createDataFrame([("1d",), ("2F",), (" 3.5 ",), ("1e3",), ("inf",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(to_numeric("t")).collect()]
    assert got == [None, None, 3.5, 1000.0, float("inf"), None, None]


def test_long_common_prefixes_spread_over_ranges(spark):
    from churnlens.operators.ordered import add_range
    df = spark.range(4000).selectExpr("concat('https://www.example.com/page/', lpad(id, 8, '0')) AS u")
    sizes = [r["count"] for r in add_range(df, ["u"], 16).groupBy("_range").count().collect()]
    assert len(sizes) >= 12 and max(sizes) < 1000


def test_last_n_ascending(spark):
    from churnlens.operators.merge import last_n
    df = spark.createDataFrame([(i, i * 7 % 10) for i in range(10)], "id int, t int")
    assert [r.t for r in last_n(df, 4, "t", "id").collect()] == [6, 7, 8, 9]


def test_predict_table_one_row_per_row(spark):
    from churnlens.plans import catalog
    from churnlens.operators.ml import predict_table, train_logistic
    t, params = catalog.ml_table(spark, "/root/testdata/sf0.001")
    model = train_logistic(t.where("split = 'train'"), catalog.ML_FEATURES, "churn")
    raw = catalog.raw_subscribers(spark, "/root/testdata/sf0.001")
    twice = raw.unionByName(raw).withColumns({"segment": F.when(F.col("tenure") > 3, F.col("segment")),
                                              "monthly_charges": F.when(F.col("tenure") > 3, F.col("monthly_charges"))})
    out = predict_table(twice, model, params, keep=raw.columns, features=catalog.ML_FEATURES, id_col="customer_id")
    assert out.count() == twice.count() and out.where("probability IS NULL").count() == 0
    feats = catalog_serving(twice, params)
    assert feats.where("monthly_charges IS NULL OR segment < 0").count() == 0


def catalog_serving(raw, params):
    from churnlens.operators.fitted import prepare_serving
    return prepare_serving(raw, params)


def test_counts_of_ten_billion_do_not_overflow(spark):
    from churnlens.operators.drift import _category_shift
    from churnlens.operators.metrics import _auc_from_counts
    big = 10 ** 10
    counts = spark.createDataFrame([("c", "a", big, 2 * big), ("c", "b", 2 * big, big), ("c", "d", big, big)],
                                   "column string, value string, _a long, _b long")
    row = _category_shift(counts).first()
    assert row.test == "chi_square" and row.p_value == 0.0
    scores = spark.createDataFrame([(0.1, big, 3 * big), (0.9, 3 * big, big)], "s double, _pos long, _neg long")
    assert abs(_auc_from_counts(scores, "s", []).first().roc_auc - 0.75) < 1e-12


def test_drift_check_gives_a_row_in_any_case(spark):
    from churnlens.operators.drift import cleaned_sides, drift_check
    ref = spark.createDataFrame([(i, str(i % 3), float(i % 7)) for i in range(60)], "t int, c string, x double")
    ok = drift_check(ref, ref, ["c", "x"], 50, "t", "t").first()
    assert (ok.status, ok.n_rows, ok.n_columns, ok.drift_count) == ("ok", 50, 2, 0)
    few = drift_check(ref, ref.limit(4), ["c", "x"], 50, "t", "t").first()
    assert (few.status, few.n_rows, few.drift_share) == ("not_enough_rows", 4, None)
    a, b = cleaned_sides(ref, spark.createDataFrame([(None, None)], "x double, c string"), [], ["x"], ["c"])
    assert a.columns == b.columns == ["x", "c"] and b.first().x == 3.0 and b.first().c == "0"


def test_a_version_counts_once_it_is_committed(spark, tmpdir_path):
    from churnlens.sources import io as A
    path = tmpdir_path + "/t"
    with pytest.raises(FileNotFoundError):
        A.read_current(spark, path)
    A.overwrite_after_merge(spark.range(3), path)
    spark.range(9).write.parquet(path + "/v2")  # a write that was never committed
    assert A.read_current(spark, path).count() == 3
    A.overwrite_after_merge(spark.range(5), path)
    assert A.read_current(spark, path).count() == 5

