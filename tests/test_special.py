"""Hand-worked p-values (scipy is not available)."""

import math

import pytest

from churnlens.functions import special as S


def test_chi2_tail():
    assert S.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert S.chi2_sf(10.0, 3) == pytest.approx(0.018566135463043, rel=1e-9)
    # dof 2: closed form exp(-x/2)
    assert S.chi2_sf(4.0, 2) == pytest.approx(math.exp(-2.0), rel=1e-12)


def test_t_two_sided():
    # t with 1 dof is Cauchy: p = 1 - 2/pi * atan(|t|)
    assert S.t_two_sided(1.0, 1) == pytest.approx(0.5, rel=1e-10)
    assert S.t_two_sided(2.0, 10) == pytest.approx(0.0733880347707404, rel=1e-8)
    # t with 2 dof: p = 1 - |t| / sqrt(2 + t^2)
    assert S.t_two_sided(1.5, 2) == pytest.approx(1 - 1.5 / math.sqrt(2 + 2.25), rel=1e-10)


def test_normal_two_sided():
    assert S.normal_two_sided(1.959963984540054) == pytest.approx(0.05, rel=1e-9)


def test_ks_asymptotic_bounds():
    assert S.ks_two_sample_p(0.0, 100, 100) == 1.0
    assert 0.0 <= S.ks_two_sample_p(0.5, 100, 100) < 1e-4
    assert S.ks_two_sample_p(0.1, 100, 100) > 0.5


def test_large_parameters_converge():
    import math

    from churnlens.functions.special import chi2_sf, gamma_q, t_two_sided
    for a, x, want in ((5e4, 5e4, 0.499405), (5e5, 4.998e5, 0.611215), (5e6, 5e6, 0.499941)):
        assert abs(gamma_q(a, x) - want) < 2e-4
    for dof in (10**5, 10**6, 10**7):
        z = 1.5
        normal = math.erfc(z / math.sqrt(2))
        assert abs(t_two_sided(z, dof) - normal) < 1e-5
        assert abs(chi2_sf(dof + z * math.sqrt(2 * dof), dof) - normal / 2) < 1e-2
    assert gamma_q(3.0, float("inf")) == 0.0 and math.isnan(gamma_q(3.0, float("nan")))

