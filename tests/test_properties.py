"""Property tests: the ordered-statistics core equals brute force for any
data, any number of value ranges, with or without a dominant value."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlens.operators.metrics import roc_auc
from churnlens.operators.ordered import exact_quantiles, prefix_sums

values = st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.integers(-5, 5)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=values, n_ranges=st.integers(1, 6), hot=st.booleans())
def test_quantiles_equal_numpy(spark, rows, n_ranges, hot):
    if hot:
        rows = rows + [("g1", 3)] * (len(rows) // 2 + 1)
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, x double")
    probs = [0.0, 0.3, 0.5, 0.75, 1.0]
    got = {r.g: r for r in exact_quantiles(df, "x", probs, by=["g"], n_ranges=n_ranges).collect()}
    for g in {g for g, _ in rows}:
        xs = np.array([v for gg, v in rows if gg == g], dtype=float)
        for p in probs:
            assert got[g][f"q{int(round(p * 100)):02d}"] == pytest.approx(np.percentile(xs, p * 100))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=values, n_ranges=st.integers(1, 5))
def test_running_sums_equal_cumsum(spark, rows, n_ranges):
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, x double")
    c = df.groupBy("g", "x").agg(F.count(F.lit(1)).alias("c"))
    ps = prefix_sums(c, ["x"], ["c"], by=["g"], n_ranges=n_ranges).collect()
    for g in {r.g for r in ps}:
        rs = sorted((r for r in ps if r.g == g), key=lambda r: r.x)
        assert [r.cum_c for r in rs] == list(np.cumsum([r.c for r in rs]))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.integers(0, 1), st.integers(0, 4)), min_size=2, max_size=40))
def test_auc_equals_pair_count(spark, rows):
    df = spark.createDataFrame([(y, s / 4.0) for y, s in rows], "y int, p double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    got = roc_auc(df, "y", "p").first().roc_auc
    if not pos or not neg:
        assert got is None
    else:
        wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
        assert got == pytest.approx(wins / (len(pos) * len(neg)))
