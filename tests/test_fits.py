"""Fitted fills and binned densities against the direct computations."""

import numpy as np
import pytest


@pytest.mark.parametrize("n", [1, 2, 3, 10, 501, 4000])
def test_fills_from_one_count_table(spark, n):
    from churnlens.operators.clean import fit_fills, fit_medians, fit_modes
    rng = np.random.default_rng(n)
    rows = [(float(rng.normal()) if rng.random() < 0.9 else None, int(rng.integers(0, 5)), 7.5, None if rng.random() < 0.3 else "ab"[rng.integers(2)],
             None, float(rng.choice([-np.inf, np.inf, 0.0]))) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d string, e string, f double").repartition(3)
    numeric, text = ["a", "b", "c", "f"], ["d", "e"]
    for accuracy in (100_000, 50):  # the second brackets are wide
        medians, modes = fit_fills(df, numeric, text, accuracy)
        want = fit_medians(df, numeric)
        assert medians.keys() == want.keys()
        for c in want:
            assert medians[c] == want[c] or (np.isnan(want[c]) or np.isinf(medians[c])) and c == "f"
        assert modes == fit_modes(df, text)
    assert fit_fills(df.limit(0), numeric, text) == ({}, {})
    assert fit_fills(df, [], []) == ({}, {})


def test_density_by_convolution_equals_the_direct_sum(spark):
    from churnlens.operators.explore import density, density_binned
    rng = np.random.default_rng(0)
    rows = [(float(v), "x") for v in rng.normal(3, 2, 700)] + [(float(v), "y") for v in rng.exponential(5, 300)] + [(1.0, "one"), (2.0, None), (None, "x")]
    df = spark.createDataFrame(rows, "v double, c string").repartition(4)
    for bw in ("scott", "silverman"):
        want = {(r.c, r.grid_index): (r.x, r.density) for r in density(df, "v", "c", bw=bw).collect()}
        got = {(r.c, r.grid_index): (r.x, r.density) for r in density_binned(df, "v", "c", bw=bw).collect()}
        assert got.keys() == want.keys() and len(got) == 400
        assert all(got[k][0] == pytest.approx(want[k][0], abs=1e-9) and got[k][1] == pytest.approx(want[k][1], abs=1e-6) for k in want)


def test_columns_by_type(spark):
    from churnlens.operators.quality import columns_by_type
    df = spark.createDataFrame([], "a int, b double, c string, d decimal(9,2), e timestamp, f array<int>")
    assert columns_by_type(df, ["numeric"]) == ["a", "b", "d"]
    assert columns_by_type(df, ["text"]) == columns_by_type(df, ["string"]) == ["c"]
    assert columns_by_type(df, ["timestamp", "numeric"]) == ["a", "b", "d", "e"] and columns_by_type(df, []) == []


def test_chi_square_refuses_a_target_that_is_no_class(spark):
    from churnlens.operators.stats import MAX_CLASSES, chi_square
    df = spark.range(MAX_CLASSES + 1).selectExpr("cast(id as string) y", "'a' c")
    with pytest.raises(ValueError):
        chi_square(df, ["c"], "y")
    assert chi_square(df.limit(MAX_CLASSES), ["c"], "y").count() == 1


def test_profile_of_an_empty_column(spark):
    from churnlens.operators.quality import profile_numeric
    df = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {r.column: r for r in profile_numeric(df, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"].q50, got["b"]["count"], got["b"].q50) == (2, 2.0, 2.0, 0, None)
