"""Tail probabilities against closed forms, exact integer sums and limits at very many degrees of freedom."""

import math
from fractions import Fraction
from math import comb

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortry.functions import tails


@given(st.integers(1, 150), st.floats(1e-6, 800))
@settings(max_examples=200, deadline=None)
def test_chi_square_with_even_degrees(half, x):
    """The upper tail is a Poisson sum."""
    want = math.fsum(math.exp(-x / 2 + k * math.log(x / 2) - math.lgamma(k + 1)) for k in range(half))
    assert tails.chi2_upper(x, 2 * half) == pytest.approx(want, rel=1e-10, abs=1e-13)


@given(st.floats(1e-9, 1400))
@settings(max_examples=200, deadline=None)
def test_chi_square_with_one_degree(x):
    assert tails.chi2_upper(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)


@given(st.floats(1e-6, 1e6), st.floats(0.5, 1e13))
@settings(max_examples=200, deadline=None)
def test_f_with_two_degrees_above(x, df2):
    assert tails.f_upper(x, 2, df2) == pytest.approx(math.exp(-df2 / 2 * math.log1p(2 * x / df2)), rel=1e-9, abs=1e-300)


@given(st.integers(1, 40), st.integers(1, 40), st.floats(0.001, 0.999))
@settings(max_examples=200, deadline=None)
def test_beta_with_whole_parameters(a, b, x):
    """A binomial sum."""
    n = a + b - 1
    want = math.fsum(comb(n, k) * x**k * (1 - x) ** (n - k) for k in range(a, n + 1))
    assert tails.beta_lower(a, b, x) == pytest.approx(want, rel=1e-9, abs=1e-13)


def test_very_many_degrees_of_freedom():
    # A ratio of many degrees below tends to a chi-square.
    assert tails.f_upper(1, 9, 1e12) == pytest.approx(tails.chi2_upper(9, 9), abs=1e-11)
    assert tails.chi2_upper(9, 9) == pytest.approx(0.4372741889138668, abs=1e-12)
    assert tails.t_two_sided(1.959963984540054, 1e12) == pytest.approx(0.05, abs=1e-11)
    # Temme's expansion at the mean: 1/2 - 1/(3 sqrt(2 pi a)) and its next term.
    for df in (1e8, 1e10, 1e12):
        a = df / 2
        assert tails.chi2_upper(df, df) == pytest.approx(0.5 - (1 / 3 + 1 / (540 * a)) / math.sqrt(2 * math.pi * a), abs=1e-12)
    assert tails.f_upper(1.0, 1e12, 1e12) == pytest.approx(0.5, abs=1e-12)


def exact_fisher(a, b, c, d):
    row, col, n = a + b, a + c, a + b + c + d
    weights = {k: comb(col, k) * comb(n - col, row - k) for k in range(max(0, row + col - n), min(row, col) + 1)}
    return float(Fraction(sum(w for w in weights.values() if w * 10**9 <= weights[a] * (10**9 + 1)), comb(n, row)))


@given(*[st.integers(0, 60)] * 4)
@settings(max_examples=300, deadline=None)
def test_fisher_is_the_exact_sum(a, b, c, d):
    if min(a + b, c + d, a + c, b + d) == 0:
        assert tails.fisher_two_sided(a, b, c, d) == 1.0
    else:
        assert tails.fisher_two_sided(a, b, c, d) == pytest.approx(exact_fisher(a, b, c, d), rel=1e-9)


def test_fisher_far_out_and_on_large_tables():
    far = tails.fisher_two_sided(45, 955, 955, 10**8 - 1955)
    assert far == pytest.approx(exact_fisher(45, 955, 955, 10**8 - 1955), rel=1e-9) and 1e-148 < far < 1e-146
    # Normal limit with the continuity correction.
    n = 4 * 10**10
    sd = math.sqrt(n) / 4
    off = round(2 * sd)
    want = math.erfc((off - 0.5) / sd / math.sqrt(2))
    assert tails.fisher_two_sided(n // 4 + off, n // 4 - off, n // 4 - off, n // 4 + off) == pytest.approx(want, rel=1e-4)
    assert tails.fisher_two_sided(0, 10**9, 10**9, 0) == 0.0
