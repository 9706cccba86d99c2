"""Distributed prefix sums and exact quantiles against numpy, with a hot key
holding a third of the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.operators.ordered import exact_quantiles, prefix_sums


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 3000
    grp = np.where(np.arange(n) < n // 3, "hot", rng.choice(["a", "b", "c"], n))
    val = np.where(grp == "hot", 7.0, np.round(rng.normal(50, 20, n), 1))
    val[::11] = np.round(rng.normal(0, 5, len(val[::11])), 1)
    rows = [(str(g), float(v)) for g, v in zip(grp, val)]
    return spark.createDataFrame(rows, "g string, x double"), rows


def test_exact_quantiles_match_numpy(skewed):
    df, rows = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "x", probs, by=["g"], n_ranges=7).collect()}
    for g in {r[0] for r in rows}:
        xs = np.array([v for gg, v in rows if gg == g])
        for p in probs:
            name = f"q{int(round(p * 100)):02d}"
            assert got[g][name] == pytest.approx(np.percentile(xs, p * 100), abs=1e-9)
        assert got[g].n == len(xs)


def test_global_quantile(skewed):
    df, rows = skewed
    xs = np.array([v for _, v in rows])
    r = exact_quantiles(df, "x", [0.5], names=["median"], n_ranges=5).first()
    assert r.median == pytest.approx(np.median(xs))


def test_prefix_sums_match_cumsum(skewed):
    df, rows = skewed
    counts = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("c"))
    ps = prefix_sums(counts, ["x"], ["c"], by=["g"], with_total=True, with_next=True, n_ranges=6).collect()
    by = {}
    for r in ps:
        by.setdefault(r.g, []).append(r)
    for g, rs in by.items():
        rs.sort(key=lambda r: r.x)
        cum = np.cumsum([r.c for r in rs])
        assert [r.cum_c for r in rs] == list(cum)
        assert all(r.tot_c == cum[-1] for r in rs)
        assert [r.next_x for r in rs] == [r.x for r in rs[1:]] + [None]


def test_prefix_sums_string_order(spark):
    words = ["b", "a", "ba", "", "zz", "Z", "éa", "ab"]
    df = spark.createDataFrame([(w, 1) for w in words], "w string, one int")
    ps = prefix_sums(df, ["w"], ["one"], n_ranges=3).collect()
    order = sorted(words, key=lambda s: s.encode("utf-8"))
    assert {r.w: r.cum_one for r in ps} == {w: i + 1 for i, w in enumerate(order)}
