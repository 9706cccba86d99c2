"""Sources, sinks and stream = batch."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.sources import io as A


def test_read_table_errors(spark, tmpdir_path):
    with pytest.raises(FileNotFoundError):
        A.read_table(spark, os.path.join(tmpdir_path, "missing.csv"), "a int")
    empty = os.path.join(tmpdir_path, "empty.csv")
    open(empty, "w").close()
    with pytest.raises(A.EmptySourceError):
        A.read_table(spark, empty, "a int")
    assert A.read_or_empty(spark, empty, "a int").count() == 0
    assert A.read_or_empty(spark, os.path.join(tmpdir_path, "nope.csv"), "a int").count() == 0


def test_read_table_csv_failfast(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "t.csv")
    with open(p, "w") as f:
        f.write("a,b\n1,x\n2,y\n")
    df = A.read_table(spark, p, "a int, b string")
    assert df.count() == 2
    bad = os.path.join(tmpdir_path, "bad.csv")
    with open(bad, "w") as f:
        f.write("a,b\n1,x\nnot_a_number,y\n")
    with pytest.raises(Exception):
        A.read_table(spark, bad, "a int, b string").collect()
    with pytest.raises(A.MalformedSourceError):
        A.read_table(spark, bad, "a int, b string", validate=True)
    assert A.read_table(spark, p, "a int, b string", validate=True).count() == 2


def test_parse_csv_text_and_records(spark):
    up = spark.createDataFrame([("a,b\n1,x\n2,y\n",)], "body string")
    out = A.parse_csv_text(up, "body", "a int, b string")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x"), (2, "y")]
    js = spark.createDataFrame([(1, '{"k": 5, "s": "q"}')], "id int, body string")
    rec = A.parse_records(js, "body", "k int, s string").first()
    assert (rec.id, rec.k, rec.s) == (1, 5, "q")


def test_versioned_overwrite(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "tbl")
    A.overwrite_after_merge(spark.range(3), path)
    cur = A.read_current(spark, path)
    A.overwrite_after_merge(cur.union(spark.range(10, 12)), path)
    assert A.read_current(spark, path).count() == 5


def test_params_round_trip(spark, tmpdir_path):
    enc = spark.createDataFrame([("c", "a", 0), ("c", "b", 1)], "column string, value string, code int")
    A.save_params(spark, tmpdir_path, enc, {"x": (1.0, 2.0)})
    e2, s2 = A.load_params(spark, tmpdir_path)
    assert e2.count() == 2 and s2 == {"x": (1.0, 2.0)}


def test_append_inference_log(spark, tmpdir_path):
    df = spark.createDataFrame([("c1", 1, 0.8)], "customerID string, pred int, p double")
    logged = A.with_log_columns(df, "pred", "p", "Production", "v1", 0.01)
    A.append_inference_log(logged, tmpdir_path + "/log")
    A.append_inference_log(logged, tmpdir_path + "/log")
    back = spark.read.parquet(tmpdir_path + "/log")
    assert back.count() == 2 and back.first().Churn == "Yes"


def land(df, path, order, n=2):
    """The rows as files one after another in the order of a column (nulls first)."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    parts = df.withColumn("_p", F.ntile(n).over(Window.orderBy(F.col(order).asc_nulls_first()))).cache()
    for k in range(1, n + 1):
        parts.where(F.col("_p") == k).drop("_p").coalesce(1).write.mode("append").parquet(path)
    return path


def test_stream_equals_batch_multi_batch(spark):
    from churnlens.plans import fixtures as FX
    from churnlens.streaming import streams as J
    log = FX.prediction_log(spark, "/root/testdata/sf0.001")
    batch = J.request_counts(log, "event_time", "endpoint")
    path = land(log, J.scratch_path(spark, "landing", "t"), "event_time", 3)
    s = J.file_stream(spark, path, log.schema, max_files_per_trigger=1)
    got = J.run_update_stream(J.request_counts(s, "event_time", "endpoint", watermark="10 minutes"),
                              ["window_start", "endpoint"], "t")
    assert sorted(got.collect()) == sorted(batch.collect())


def test_stream_upsert_equals_batch_over_two_runs(spark):
    from churnlens.operators.merge import upsert_log
    from churnlens.streaming import streams as J
    schema = "k int, seq int, v string"
    base = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], schema)
    first = spark.createDataFrame([(1, 9, "c"), (3, 1, "d"), (1, 3, "e"), (4, None, "x")], schema)
    second = spark.createDataFrame([(1, 5, "late and older"), (2, 2, "f"), (None, 1, "no key")], schema)
    landing, table = J.scratch_path(spark, "landing", "fb"), J.scratch_path(spark, "tables", "fb")
    for part in (first, second):  # the second run goes on in the same folder
        land(part, landing, "seq")
        feedback = J.stream_upsert(J.file_stream(spark, landing, first.schema, 1), table, "k", ["seq"])
    got = sorted(map(str, map(tuple, J.merged(spark, base, feedback, "k", ["seq"]).collect())))
    both = first.unionByName(second)
    want = sorted(map(str, map(tuple, upsert_log(base, both, "k", ["seq"]).select("k", "seq", "v").collect())))
    assert got == want and len(got) == 5


LOG = "request_id long, customer string, event_time timestamp_ntz, stage string"


def at(minutes):
    import datetime as dt
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def stream_of(spark, parts, schema, name):
    """A stream that reads one part a micro-batch."""
    from churnlens.streaming import streams as J
    path = J.scratch_path(spark, "landing", name)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    return J.file_stream(spark, path, spark.createDataFrame([], schema).schema, 1)


def test_replayed_and_late_rows_leave_counts_unchanged(spark):
    from churnlens.streaming import streams as J
    rows = [(i // 2, f"c{i % 2}", at(i), "P" if i % 3 else "S") for i in range(40)]
    late = [(900 + i, "x", at(-600), "P") for i in range(5)]
    # a request is spread over two batches, whole batches come twice, and a late file comes after the watermark has moved
    parts = [rows[:19], rows[:19], rows[19:], rows[15:], rows[35:] + late, late]
    stats = {}
    got = J.stream_prediction_counts(stream_of(spark, parts, LOG, "replay"), ["stage"], "request_id", ["request_id", "customer"],
                                     "event_time", "30 minutes", stats=stats)
    want = J.prediction_counts(spark.createDataFrame(rows, LOG), ["stage"], "request_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert stats["late_rows_dropped"] >= 5


def test_state_of_replay_safe_streams_is_that_of_one_delay(spark):
    from churnlens.streaming import streams as J
    parts = [[(1000 * b + i, "c", at(60 * b + i % 60), "P") for i in range(200)] for b in range(8)]
    stats = {}
    got = J.stream_prediction_counts(stream_of(spark, parts, LOG, "bounded"), ["stage"], "request_id", ["request_id"], "event_time",
                                     "10 minutes", stats=stats)
    assert [(r.n_requests, r.n_rows) for r in got.collect()] == [(1600, 1600)]
    assert stats["state_rows"] <= 400  # not the 1,600 rows so far


def test_rows_without_a_time_are_no_crash(spark):
    from churnlens.streaming import streams as J
    parts = [[(1, "c", None, "P"), (2, "c", at(1), "P")], [(2, "c", at(1), "P"), (3, "c", at(2), "P")]]
    got = J.stream_prediction_counts(stream_of(spark, parts, LOG, "timeless"), ["stage"], "request_id", ["request_id"], "event_time", "5 minutes")
    assert [(r.n_requests, r.n_rows) for r in got.collect()] == [(2, 2)]


def test_replayed_feedback_is_written_once(spark):
    from churnlens.streaming import streams as J
    schema = "k int, seq int, v string, t timestamp_ntz"
    rows = [(1, 5, "late answer", at(1)), (2, 1, "b", at(2)), (1, 7, "last", at(3)), (1, 7, "last", at(3)), (3, 1, "d", at(4))]
    old = [(1, 6, "older", at(-900))]
    base = spark.createDataFrame([(1, 1, "a"), (9, 1, "z")], "k int, seq int, v string")
    stats, out = {}, J.scratch_path(spark, "tables", "replayed")
    sink = J.stream_upsert(stream_of(spark, [rows, rows[:3], rows[3:], old], schema, "fb2"), out, "k", ["seq"], "t", "20 minutes", stats=stats)
    assert spark.read.parquet(sink).count() == 4 and stats["late_rows_dropped"] == 1
    got = sorted(map(tuple, J.merged(spark, base, sink, "k", ["seq"]).collect()))
    assert got == [(1, 7, "last"), (2, 1, "b"), (3, 1, "d"), (9, 1, "z")]


def test_rows_alike_in_key_and_sequence_have_one_winner(spark):
    from churnlens.operators.merge import greatest_row, upsert_log
    rows = [(1, 1, "x", {"a": 1}), (1, 1, "y", {"a": 2}), (1, 1, "y", {"a": 3}), (2, None, None, None)]
    df = spark.createDataFrame(rows, "k int, seq int, v string, m map<string,int>")
    for n in (1, 3, 4):
        got = sorted(map(str, (r.asDict() for r in greatest_row(df.repartition(n), ["k"], ["seq"]).collect())))
        assert got == sorted(map(str, [{"k": 1, "seq": 1, "v": "y", "m": {"a": 3}}, {"k": 2, "seq": None, "v": None, "m": None}]))
        log = upsert_log(df.drop("m").repartition(n), df.drop("m").limit(0), "k", ["seq"])
        assert {r.k: r.v for r in log.collect()} == {1: "y", 2: None}


def test_arriving_records_are_scored_once_and_bad_ones_counted(spark):
    import json

    from churnlens.operators.ml import LinearScorer
    from churnlens.plans import catalog
    from churnlens.streaming import streams as J
    sf = "/root/testdata/sf0.001"
    raw = catalog.raw_subscribers(spark, sf).drop("churn")
    _, params = catalog._served(spark, sf)
    model = LinearScorer(catalog.ML_FEATURES, [0.4] * len(catalog.ML_FEATURES), -0.5)
    means = dict.fromkeys(catalog.ML_FEATURES, 0.1)
    records = [json.dumps({k: v for k, v in r.asDict().items() if v is not None}) for r in raw.limit(12).collect()]
    asked = [(i, at(i), text) for i, text in enumerate(records)]
    broken = [(50, at(13), "{not json"), (51, at(13), None), (52, at(14), '{"tenure": "soon"}')]
    late = [(60, at(-5000), records[0])]
    stats, out = {}, J.scratch_path(spark, "sinks", "sc")
    schema = "request_id long, event_time timestamp_ntz, record string"
    s = stream_of(spark, [asked[:6], asked[:6] + broken, asked[6:], asked[4:], late], schema, "sc")
    sink = J.stream_score(s, "record", raw.schema, params, model, "Production", "v1", ["request_id"], "event_time", "1 hour", out, means, stats=stats)
    got = {r.request_id: r for r in spark.read.parquet(sink).collect()}
    assert len(got) == spark.read.parquet(sink).count() == 15 and 60 not in got
    assert (stats["requests"], stats["bad"]) == (15, 3) and stats["late_rows_dropped"] >= 1
    assert all(got[i].bad and got[i].probability is None and got[i].Churn is None for i in (50, 51, 52))
    batch = J.score_requests(spark.createDataFrame(asked, schema), "record", raw.schema, params, model, "Production", "v1", ["request_id"], means)
    for r in batch.collect():
        assert got[r.request_id].probability == pytest.approx(r.probability, abs=1e-12)
        margin = -0.5 + sum(r.attributions.values()) + 0.4 * 0.1 * len(catalog.ML_FEATURES)
        assert r.probability == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_scoring_goes_on_in_a_second_run_and_keeps_unknown_customers(spark):
    from churnlens.operators.ml import LinearScorer
    from churnlens.plans import catalog
    from churnlens.streaming import streams as J
    raw = catalog.raw_subscribers(spark, "/root/testdata/sf0.001").drop("churn")
    _, params = catalog._served(spark, "/root/testdata/sf0.001")
    model = LinearScorer(catalog.ML_FEATURES, [0.4] * len(catalog.ML_FEATURES), -0.5)
    landing, out = J.scratch_path(spark, "landing", "two"), J.scratch_path(spark, "sinks", "two")
    known = raw.limit(1).select(F.to_json(F.struct("*")).alias("j")).first().j
    schema = "r int, asked string, t timestamp_ntz, record string"
    for rows in ([(10, "a", at(1), known), (11, "nobody", at(1), None)], [(12, "a", at(2), known), (13, None, at(3), None)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        s = J.file_stream(spark, landing, spark.createDataFrame([], schema).schema)
        sink = J.stream_score(s, "record", raw.schema, params, model, "Production", "v1", ["r", "asked"], "t", "1 hour", out)
    got = {r.r: r for r in spark.read.parquet(sink).collect()}
    assert set(got) == {10, 11, 12, 13} and got[11].asked == "nobody"
    assert got[11].probability is None and got[13].probability is None and got[10].probability == got[12].probability is not None


def area_between(a, b):
    """Area between two empirical distribution functions."""
    points = np.unique(np.concatenate([a, b]))
    f, g = (np.searchsorted(np.sort(v), points, side="right") / len(v) for v in (a, b))
    return float((np.abs(f - g)[:-1] * np.diff(points)).sum())


def test_windowed_numbers_against_direct_areas(spark):
    from churnlens.streaming import streams as J
    rng = np.random.default_rng(1)
    ref = rng.integers(0, 30, 400).astype(float)  # a bin a value: exact
    now = [(at(60 * 24 * (i % 3)), float(rng.integers(-5, 40) if i % 3 else 29)) for i in range(300)] + [(at(0), None), (at(0), float("nan"))]
    sketch = J.fit_sketch(spark.createDataFrame([(float(v),) for v in ref], "x double"), ["x"], bins=29)
    schema = "t timestamp_ntz, x double"
    batch = J.windowed_wasserstein(J.window_bin_sums(spark.createDataFrame(now, schema), "t", sketch, "1 day"), sketch)
    s = stream_of(spark, [now[:150], now[150:]], schema, "num")
    sums = J.run_update_stream(J.window_bin_sums(s, "t", sketch, "1 day", watermark="5 days"), ["window_start", "column", "bin"], "num")
    streamed = J.windowed_wasserstein(sums, sketch)
    assert sorted(map(str, batch.collect())) == sorted(map(str, streamed.collect()))
    got = {r.window_start: r for r in batch.collect()}
    for day in range(3):
        mine = np.array([v for t, v in now if t == at(60 * 24 * day) and v is not None and v == v])
        r = got[at(60 * 24 * day)]
        assert r.n == len(mine)
        # values beyond the reference stand at the mean of their side
        low, high = mine[mine < ref.min()], mine[mine >= ref.max()]
        inside = np.where(mine < ref.min(), low.mean() if len(low) else 0, np.where(mine >= ref.max(), high.mean() if len(high) else 0, mine))
        assert r.wasserstein == pytest.approx(area_between(inside, ref) / ref.std(), abs=1e-9)


def test_a_saved_pipeline_scores_raw_rows_in_a_new_session(spark, tmpdir_path):
    from pyspark.ml.classification import LogisticRegression

    from churnlens.operators.fitted import prepare_training
    from churnlens.operators.ml import assembler, train_logistic
    from churnlens.operators.pipeline import churn_pipeline, load_pipeline
    from churnlens.plans import catalog
    sf = "/root/testdata/sf0.001"
    raw = catalog.raw_subscribers(spark, sf)
    stages = [assembler(catalog.ML_FEATURES), LogisticRegression(labelCol="churn", featuresCol="features", maxIter=50)]
    fitted = churn_pipeline(catalog.ML_SPEC, stages).fit(raw)
    A.save_model(fitted, tmpdir_path + "/whole")
    back = load_pipeline(spark.newSession(), tmpdir_path + "/whole")

    def scores(model, rows):
        return {r.customer_id: round(r.p, 12) for r in model.transform(rows).select(
            "customer_id", _p1().alias("p")).collect()}
    want = scores(fitted, raw)
    assert scores(back, raw) == want and scores(back, raw.drop("churn")) == want and len(want) == raw.count()
    feats, _ = prepare_training(raw, catalog.ML_SPEC)
    model = train_logistic(feats, catalog.ML_FEATURES, "churn", {"maxIter": 50})
    apart = {r.customer_id: r.p for r in model.transform(feats).select("customer_id", _p1().alias("p")).collect()}
    assert all(apart[k] == pytest.approx(want[k], abs=1e-6) for k in want)


def _p1():
    from pyspark.ml.functions import vector_to_array
    return vector_to_array("probability")[1]


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_an_upsert_rewrites_its_own_buckets_only(spark, tmpdir_path):
    from churnlens.sources import buckets as B
    path = tmpdir_path + "/t"
    with pytest.raises(FileNotFoundError):
        B.read_bucketed(spark, path)
    schema = "k int, seq int, v string"
    B.write_bucketed(spark.createDataFrame([(i, 1, "old") for i in range(200)] + [(None, 1, "none")], schema), path, "k", 16)
    before = files_of(path)
    new = spark.createDataFrame([(3, 2, "new"), (3, 3, "newer"), (1000, 1, "added"), (None, 2, "nothing")], schema)
    touched = B.upsert_bucketed(new, path, ["seq"])
    assert 1 <= len(touched) <= 3
    after = files_of(path)
    for f in before:
        bucket = int(f.split("_bucket=")[1].split("/")[0]) if "_bucket=" in f else None
        assert (f in after) == (bucket not in touched)
    got = {r.k: r.v for r in B.read_bucketed(spark, path).collect()}
    assert len(got) == 202 and got[3] == "newer" and got[1000] == "added" and got[None] == "nothing" and got[4] == "old"
    assert {r.k for r in B.read_bucketed(spark, path, new).collect()} >= {3, 1000, None}
    assert B.upsert_bucketed(new.limit(0), path, ["seq"]) == []
    with pytest.raises(ValueError):
        B.upsert_bucketed(spark.createDataFrame([(1, 1, 1)], "k int, seq int, other int"), path, ["seq"])


def test_two_writers_of_different_buckets_both_survive(spark, tmpdir_path):
    from concurrent.futures import ThreadPoolExecutor

    from churnlens.sources import buckets as B
    path, schema = tmpdir_path + "/t", "k int, seq int, v string"
    B.write_bucketed(spark.createDataFrame([(i, 1, "old") for i in range(100)], schema), path, "k", 8)
    by_bucket = {}
    for r in spark.range(100).selectExpr("cast(id as int) k").select("k", B._bucket("k", 8).alias("b")).collect():
        by_bucket.setdefault(r.b, []).append(r.k)
    (a, mine), (b, yours) = list(by_bucket.items())[:2]
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda x: B.upsert_bucketed(spark.createDataFrame([(k, 2, x[1]) for k in x[0]], schema), path, ["seq"]),
                             [(mine, "a"), (yours, "b")]))
    assert done == [[a], [b]]
    got = {r.k: r.v for r in B.read_bucketed(spark, path).collect()}
    assert len(got) == 100 and all(got[k] == "a" for k in mine) and all(got[k] == "b" for k in yours)


def test_csv_by_header_name(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "swapped.csv")
    with open(p, "w") as f:
        f.write('b,extra,a\n"x, ""q""",0,1\ny,0,2\n')
    assert sorted(map(tuple, A.read_table(spark, p, "a int, b string").collect())) == [(1, 'x, "q"'), (2, "y")]
    with pytest.raises(A.MalformedSourceError):
        A.read_table(spark, p, "a int, c string")
    q = os.path.join(tmpdir_path, "breaks.csv")
    with open(q, "w") as f:
        f.write('b,a\n"two\nlines",3\n')
    assert [tuple(r) for r in A.read_table(spark, q, "a int, b string", multiline=True).collect()] == [(3, "two\nlines")]
    up = spark.createDataFrame([('b,a\n"two\nlines, ""q""",3\n\n,x\n',), (None,), ("a\n7\n",)], "body string")
    got = sorted(map(str, map(tuple, A.parse_csv_text(up, "body", "a int, b string").collect())))
    assert got == sorted(map(str, [(3, 'two\nlines, "q"'), (None, None), (7, None)]))


def test_write_table_and_drift_report(spark, tmpdir_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    A.write_table(df, tmpdir_path + "/pq", partition_by=["k"])
    assert spark.read.parquet(tmpdir_path + "/pq").count() == 2
    A.write_table(df, tmpdir_path + "/csv", fmt="csv")
    assert A.read_table(spark, tmpdir_path + "/csv", "k string, v int").count() == 2
    rep = spark.createDataFrame([("x", "wasserstein", 0.2, True)], "column string, method string, score double, "
                                                                    "drifted boolean")
    A.write_drift_report(rep, tmpdir_path + "/json")
    assert spark.read.json(tmpdir_path + "/json").first().drifted is True


def test_late_rows_are_dropped_and_counted(spark):
    import datetime as dt
    from churnlens.streaming import streams as J
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    on_time = [(i, t0 + dt.timedelta(seconds=30 * i), "view") for i in range(20)]
    late = [(100 + i, t0 - dt.timedelta(hours=1, seconds=i), "view") for i in range(4)]
    schema = "request_id long, event_time timestamp_ntz, endpoint string"
    path = J.scratch_path(spark, "landing", "late")
    # Spark filters late rows with the watermark of the previous batch, so the
    # late file comes third: two on-time files, then rows an hour behind
    for part in (on_time[:10], on_time[10:], late):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    s = J.file_stream(spark, path, spark.createDataFrame([], schema).schema, max_files_per_trigger=1)
    stats = {}
    got = J.run_update_stream(J.request_counts(s, "event_time", "endpoint", watermark="1 minute"),
                              ["window_start", "endpoint"], "late", stats=stats)
    assert sum(r.n for r in got.collect()) == len(on_time)
    # Spark counts dropped rows after the map-side partial aggregate: one per
    # late 10-second window here (09:00:00 and 08:59:50)
    assert stats["late_rows_dropped"] == 2
