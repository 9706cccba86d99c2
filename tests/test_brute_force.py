"""Operators against brute-force Python on small random fixtures."""

import math
import random

import numpy as np
import pytest

from churnlens.operators import drift as Fd
from churnlens.operators.merge import upsert_log
from churnlens.operators.stats import chi_square


def _chi2_brute(table, correction=True):
    rows = [r for r in table if sum(r) > 0]
    cols = [j for j in range(len(rows[0])) if sum(r[j] for r in rows) > 0]
    obs = np.array([[r[j] for j in cols] for r in rows], dtype=float)
    n = obs.sum()
    exp = np.outer(obs.sum(1), obs.sum(0)) / n
    dof = (obs.shape[0] - 1) * (obs.shape[1] - 1)
    if dof == 1 and correction:
        d = exp - obs
        obs = obs + np.minimum(0.5, np.abs(d)) * np.sign(d)
    return float(((obs - exp) ** 2 / exp).sum()), dof


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_chi_square_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice("ab"), rnd.choice("xyz" if seed != 2 else "xy"), rnd.choice(["Yes", "No"]))
            for _ in range(300)]
    df = spark.createDataFrame(rows, "c1 string, c2 string, churn string")
    got = {r.column: r for r in chi_square(df, ["c1", "c2"], "churn", with_p=False).collect()}
    for i, col in enumerate(["c1", "c2"]):
        vals = sorted({r[i] for r in rows})
        table = [[sum(1 for r in rows if r[i] == v and r[2] == k) for k in ("No", "Yes")] for v in vals]
        stat, dof = _chi2_brute(table)
        assert got[col].dof == dof
        assert got[col].statistic == pytest.approx(stat, rel=1e-9)


@pytest.mark.parametrize("seed", [4, 5])
def test_ks_wasserstein_js_match_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    a = np.round(rng.normal(0, 1, 400), 1)
    b = np.round(rng.normal(0.3, 1.2, 300), 1)
    ref = spark.createDataFrame([(float(x), str(int(abs(x) * 2) % 4)) for x in a], "x double, c string")
    cur = spark.createDataFrame([(float(x), str(int(abs(x) * 2) % 4)) for x in b], "x double, c string")
    grid = np.unique(np.concatenate([a, b]))
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    ks = Fd.ks_two_sample(ref, cur, ["x"], with_p=False).first().statistic
    assert ks == pytest.approx(np.max(np.abs(fa - fb)), abs=1e-12)
    w = np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)) / np.std(a)
    assert Fd.wasserstein_norm(ref, cur, ["x"]).first().statistic == pytest.approx(w, rel=1e-9)
    ca = [str(int(abs(x) * 2) % 4) for x in a]
    cb = [str(int(abs(x) * 2) % 4) for x in b]
    cats = sorted(set(ca) | set(cb))
    p = np.array([ca.count(c) / len(ca) for c in cats])
    q = np.array([cb.count(c) / len(cb) for c in cats])
    m = (p + q) / 2
    kl = lambda u: sum(ui * math.log(ui / mi) for ui, mi in zip(u, m) if ui > 0)
    js = math.sqrt((kl(p) + kl(q)) / 2)
    assert Fd.js_distance(ref, cur, ["c"]).first().statistic == pytest.approx(js, rel=1e-9)


def test_upsert_matches_python_rule(spark):
    rnd = random.Random(9)
    log = [(f"c{rnd.randrange(20)}", i, rnd.choice(["a", "b"])) for i in range(120)]
    fb = [(f"c{rnd.randrange(25)}", rnd.randrange(200), "fb") for _ in range(30)]
    want = {}
    for k, s, v in sorted(log, key=lambda r: r[1]):
        want[k] = (s, v)
    fb_best = {}
    for k, s, v in fb:
        if k not in fb_best or s > fb_best[k][0]:
            fb_best[k] = (s, v)
    want.update(fb_best)
    got = upsert_log(spark.createDataFrame(log, "k string, s int, v string"),
                     spark.createDataFrame(fb, "k string, s int, v string"), "k", ["s"]).collect()
    assert {r.k: (r.s, r.v) for r in got} == want


def test_box_density_ttest_histogram_match_numpy(spark):
    from churnlens.operators.explore import box_stats, density, histogram
    from churnlens.operators.stats import t_test
    rng = np.random.default_rng(11)
    ys = np.round(np.concatenate([rng.normal(50, 10, 300), [150.0, -40.0, 160.0]]), 2)
    cls = ["Yes" if i % 3 == 0 else "No" for i in range(len(ys))]
    df = spark.createDataFrame([("g", c, float(y)) for c, y in zip(cls, ys)], "x string, churn string, y double")
    box = {r.churn: r for r in box_stats(df, "x", "y", "churn").collect()}
    for c in ("Yes", "No"):
        v = np.array([y for y, k in zip(ys, cls) if k == c])
        q1, q3 = np.percentile(v, 25), np.percentile(v, 75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= lo) & (v <= hi)]
        r = box[c]
        assert (r.q1, r.median, r.q3) == pytest.approx((q1, np.median(v), q3))
        assert (r.whisker_lo, r.whisker_hi, r.n_outliers) == (inside.min(), inside.max(), int(len(v) - len(inside)))
    # Gaussian KDE, Scott's bandwidth, grid over [min - 3h, max + 3h]
    kde = {(r.churn, r.grid_index): r for r in density(df, "y", "churn", grid=20).collect()}
    v = np.array([y for y, k in zip(ys, cls) if k == "Yes"])
    h = v.std(ddof=1) * len(v) ** -0.2
    g = np.linspace(v.min() - 3 * h, v.max() + 3 * h, 20)
    want = np.exp(-0.5 * ((g[:, None] - v[None, :]) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
    assert [kde[("Yes", i)].density for i in range(20)] == pytest.approx(list(want), rel=1e-9)
    # pooled two-sample t
    t = t_test(df, ["y"], "churn", with_p=False).first()
    a = np.array([y for y, k in zip(ys, cls) if k == "Yes"])
    b = np.array([y for y, k in zip(ys, cls) if k == "No"])
    sp2 = ((len(a) - 1) * a.var(ddof=1) + (len(b) - 1) * b.var(ddof=1)) / (len(a) + len(b) - 2)
    assert t.statistic == pytest.approx((a.mean() - b.mean()) / math.sqrt(sp2 * (1 / len(a) + 1 / len(b))), rel=1e-9)
    # equal-width histogram, last bin closed
    counts, edges = np.histogram(ys, bins=30)
    got = {r.bin: r for r in histogram(df, "y", 30).collect()}
    assert [got[i].n if i in got else 0 for i in range(30)] == list(counts)
    assert got[0].lo == pytest.approx(edges[0]) and got[29].hi == pytest.approx(edges[-1])


def test_sliding_request_counts_and_cumulative_buckets(spark):
    import datetime as dt
    from churnlens.streaming.streams import latency_histogram, request_counts
    t0 = dt.datetime(2024, 1, 1)
    rnd = random.Random(3)
    rows = [(i, t0 + dt.timedelta(seconds=rnd.randrange(600)), rnd.choice(["view", "/metrics"]), rnd.random())
            for i in range(400)]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, endpoint string, latency double")
    got = {(r.window_start, r.endpoint): r.n
           for r in request_counts(df, "ts", "endpoint", every="60 seconds", slide="20 seconds").collect()}
    want = {}
    for _, ts, ep, _ in rows:
        if ep == "/metrics":
            continue
        sec = int((ts - t0).total_seconds())
        for start in range((sec // 20) * 20 - 40, sec + 1, 20):
            if start <= sec < start + 60:
                key = (t0 + dt.timedelta(seconds=start), ep)
                want[key] = want.get(key, 0) + 1
    assert got == want
    h = sorted((r.le, r.n) for r in latency_histogram(df, ["endpoint"], "latency", [0.1, 0.5, 0.9]).collect()
               if r.endpoint == "view")
    ns = [n for _, n in h]
    assert ns == sorted(ns) and h[-1][0] == float("inf")
    assert h[-1][1] == sum(1 for r in rows if r[2] == "view")
    assert h[0][1] == sum(1 for r in rows if r[2] == "view" and r[3] <= 0.1)
