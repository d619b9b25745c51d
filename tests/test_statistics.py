"""The evaluators against other methods and known answers."""

import random
from math import exp, lgamma, log, sqrt

import numpy as np
import pytest

from trialmetrics.functions import means, proportions, ranks, resampling
from trialmetrics.functions.special import incomplete_beta
from trialmetrics.sources.tables import numeric_sample


def sample_of(spark, a, b, partitions=3):
    rows = [(i, int(i >= len(a)), float(v)) for i, v in enumerate([*a, *b])]
    return spark.createDataFrame(rows, "user_id long, variation_id int, user_aov double").repartition(partitions)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(7)
    return [rng.gauss(10, 3) for _ in range(120)], [rng.gauss(10.8, 4) for _ in range(90)]


COUNTS = [(3, 10, 5, 11), (0, 4, 0, 7), (500, 1000, 530, 1010), (10, 10, 9, 10), (0, 1, 1, 1), (0, 0, 0, 0),
          (135, 135, 134, 134), (0, 500, 1, 400)]


@pytest.mark.parametrize("counts", COUNTS)
def test_win_probability_equals_the_finite_sum(counts):
    xc, nc, xe, ne = counts
    a, b, c, d = xc + 1, nc - xc + 1, xe + 1, ne - xe + 1

    def log_beta(p, q):
        return lgamma(p) + lgamma(q) - lgamma(p + q)

    exact = sum(exp(log_beta(a + i, b + d) - log(d + i) - log_beta(1 + i, d) - log_beta(a, b)) for i in range(c))
    assert proportions.win_probability(*counts) == pytest.approx(exact, abs=1e-10)


@pytest.mark.parametrize("counts", [*COUNTS, (120.4, 1000, 131.7, 990)])
def test_comparison_agrees_with_draws(counts):
    xc, nc, xe, ne = counts
    n, rng = 100_000, np.random.default_rng(3)
    c, e = rng.beta(xc + 1, nc - xc + 1, n), rng.beta(xe + 1, ne - xe + 1, n)
    low, high, win = proportions.compare_beta(*counts)
    tolerance = 4 / (2 * sqrt(n))
    assert win == pytest.approx((e > c).mean(), abs=tolerance)
    for quantile, level in ((low, 0.025), (high, 0.975)):
        assert (e - c <= quantile).mean() == pytest.approx(level, abs=tolerance)


def test_comparison_of_large_counts():
    low, high, win = proportions.compare_beta(26_000_000, 52_000_000, 26_010_000, 52_000_000)
    spread = sqrt(2 * 0.25 / 52e6)
    assert win == pytest.approx(means.normal_cdf(1e4 / 52e6 / spread), abs=1e-6)
    assert (high - low) / 2 == pytest.approx(1.95996 * spread, rel=1e-3)


def test_relative_uplift_is_zero_without_control(spark):
    df = spark.createDataFrame([(0.0, 0.3), (0.2, 0.3)], "c double, e double")
    assert [r[0] for r in df.select(proportions.relative_uplift("e", "c")).collect()] == [0.0, 0.5]


def test_assumed_normal_win(spark):
    df = spark.createDataFrame([(10.0, 10.0), (10.0, 12.0), (0.0, 0.0), (0.0, 1.0)], "c double, e double")
    wins = [r[0] for r in df.select(means.assumed_normal_win("c", "e")).collect()]
    rng = np.random.default_rng(5)
    drawn = (rng.normal(12, 2.4, 200_000) > rng.normal(10, 2, 200_000)).mean()
    assert wins[0] == pytest.approx(0.5) and wins[1] == pytest.approx(drawn, abs=0.005)
    assert wins[2] == 0.0 and wins[3] == pytest.approx(means.normal_cdf(5))


@pytest.mark.parametrize("t, df, p", [(2.228138852, 10, 0.05), (1.0, 1, 0.5), (0.0, 5, 1.0), (12.7062047364, 1, 0.05),
                                      (1.959963985, 1e7, 0.05)])
def test_student_p_values(t, df, p):
    assert means.student_p(t, df) == pytest.approx(p, abs=1e-6)


def test_incomplete_beta_at_the_ends():
    assert incomplete_beta(2.0, 3.0, np.array([0.0, 0.5, 1.0])) == pytest.approx([0, 0.6875, 1])


def test_mean_tests(spark, groups):
    a, b = map(np.array, groups)
    row = means.mean_tests(sample_of(spark, a, b)).first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    assert row.t_stat == pytest.approx((a.mean() - b.mean()) / sqrt(va + vb))
    assert row.z_stat == pytest.approx(-row.t_stat)
    assert row.t_df == pytest.approx((va + vb) ** 2 / (va**2 / (len(a) - 1) + vb**2 / (len(b) - 1)))
    assert row.z_p == pytest.approx(2 * (1 - means.normal_cdf(abs(row.z_stat))))
    assert 0 < row.z_p < row.t_p < 1


def test_posterior_difference(spark, groups):
    a, b = map(np.array, groups)
    row = means.posterior_difference(sample_of(spark, a, b)).first()
    rng = np.random.default_rng(0)
    drawn = rng.normal(b.mean(), b.std(ddof=1) / sqrt(len(b)), 200_000) - rng.normal(a.mean(), a.std(ddof=1) / sqrt(len(a)), 200_000)
    assert row.uplift_mean == pytest.approx(b.mean() - a.mean())
    assert (row.ci_low, row.ci_high) == pytest.approx(np.percentile(drawn, [2.5, 97.5]), abs=0.01)
    assert row.bayes_prob == pytest.approx((drawn > 0).mean(), abs=0.005)


def test_regression_is_the_difference_of_means(spark, groups):
    a, b = map(np.array, groups)
    rows = {r.term: r for r in means.linear_regression(sample_of(spark, a, b)).collect()}
    x, y = np.r_[np.zeros(len(a)), np.ones(len(b))], np.r_[a, b]
    design = np.c_[x, np.ones_like(x)]
    solution, residual, *_ = np.linalg.lstsq(design, y, rcond=None)
    errors = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * residual[0] / (len(y) - 2))
    for i, term in enumerate(("variation_id", "intercept")):
        assert rows[term].coefficient == pytest.approx(solution[i]) and rows[term].std_error == pytest.approx(errors[i])
        assert rows[term].p_value == pytest.approx(means.student_p(solution[i] / errors[i], len(y) - 2))
    assert rows["intercept"].r2 == pytest.approx(1 - residual[0] / ((y - y.mean()) ** 2).sum())


@pytest.mark.parametrize("buckets", [2, 7, 256])
def test_rank_test_counts_pairs(spark, buckets):
    rng = random.Random(11)
    a, b = [rng.randint(0, 30) for _ in range(150)], [rng.randint(2, 33) for _ in range(130)]
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    ties = sum(t**3 - t for t in np.unique([*a, *b], return_counts=True)[1])
    n = len(a) + len(b)
    spread = sqrt(len(a) * len(b) / 12 * (n + 1 - ties / (n * (n - 1))))
    z = (max(u, len(a) * len(b) - u) - len(a) * len(b) / 2 - 0.5) / spread
    row = ranks.rank_test(sample_of(spark, a, b), buckets=buckets).first()
    assert row.u_stat == u and row.z_stat == pytest.approx(z)
    assert row.u_p == pytest.approx(2 * (1 - means.normal_cdf(z)))


def test_rank_test_of_equal_groups(spark):
    row = ranks.rank_test(sample_of(spark, [1, 2, 3], [1, 2, 3])).first()
    assert row.u_stat == 4.5 and row.u_p == 1.0


def test_draws_are_poisson():
    draws = resampling.poisson_draws(np.arange(400), 500, seed=1)
    assert draws.mean() == pytest.approx(1, abs=0.01) and draws.var() == pytest.approx(1, abs=0.02)
    assert (draws == 0).mean() == pytest.approx(exp(-1), abs=0.005)
    correlation = np.corrcoef(draws)
    assert np.abs(correlation[~np.eye(400, dtype=bool)]).max() < 0.3


def test_bootstrap_does_not_depend_on_partitions(spark, groups):
    rows = [resampling.bootstrap_mean_difference(sample_of(spark, *groups, partitions=n), resamples=400).first() for n in (1, 5)]
    assert tuple(rows[0]) == pytest.approx(tuple(rows[1]), abs=1e-9)


def test_bootstrap_agrees_with_resampling(spark, groups):
    a, b = map(np.array, groups)
    row = resampling.bootstrap_mean_difference(sample_of(spark, a, b), resamples=4000).first()
    rng = np.random.default_rng(0)
    drawn = rng.choice(b, (4000, len(b))).mean(axis=1) - rng.choice(a, (4000, len(a))).mean(axis=1)
    assert (row.ci_low, row.ci_high) == pytest.approx(np.percentile(drawn, [2.5, 97.5]), abs=0.1)
    assert row.boot_prob == pytest.approx((drawn > 0).mean(), abs=0.03)


def test_numbers_from_text(spark):
    raw = spark.createDataFrame([("0", "1.5"), ("1", "x"), ("y", "2"), ("1", None), ("1", "nan")], "variation_id string, user_aov string")
    rows = sorted(map(tuple, numeric_sample(raw).collect()), key=str)
    assert rows == [(0, 1.5), (None, 2.0)]


# Exported results: revenue, orders and value of one experiment; shown, clicked and rate of another.
ORDER_VALUES = [(387.2063000202179, 52, 7.45), (671.2684980630875, 55, 12.2), (523.8590971231461, 68, 7.7),
                (1218.8705105781555, 77, 15.83), (429.702095746994, 49, 8.77), (614.8989992141724, 47, 13.08)]
CLICK_RATES = [(39542072, 2220742, 0.0562), (47356383, 2745469, 0.058), (48977329, 2659286, 0.0543), (0, 0, None)]


def test_published_ratios(spark):
    from trialmetrics.functions.ratios import ratio

    values = spark.createDataFrame(ORDER_VALUES, "revenue double, orders long, aov double")
    assert values.filter(ratio("revenue", "orders", 2) != values.aov).count() == 0
    rates = spark.createDataFrame(CLICK_RATES, "shown long, clicked long, rate double")
    assert rates.filter(~ratio("clicked", "shown", 4).eqNullSafe(rates.rate)).count() == 0
