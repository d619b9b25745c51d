"""Comparison of proportions: interval, Beta posteriors and relative uplift."""

from __future__ import annotations

from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trialmetrics.functions.ratios import ratio
from trialmetrics.functions.special import incomplete_beta

Z95 = 1.96
GRID = 2000
NODES, WEIGHTS = np.polynomial.legendre.leggauss(400)
# Standard deviations kept on each side. Next to 0 or 1 a posterior falls off only exponentially.
REACH, GRID_REACH = 40, 12


def wald_interval(df: DataFrame, successes: str, trials: str, rate: str = "rate") -> DataFrame:
    """T1. Add the rate and its normal-approximation interval, clipped to [0, 1]."""
    p = F.col(rate)
    margin = Z95 * F.sqrt(p * (1 - p) / F.col(trials))
    return df.withColumn(rate, ratio(successes, trials)).withColumns({
        "ci_lower": F.greatest(F.lit(0.0), p - margin), "ci_upper": F.least(F.lit(1.0), p + margin)})


def posterior_mean(successes: str, trials: str) -> Column:
    """Mean of Beta(1 + successes, 1 + failures)."""
    return (F.col(successes) + 1) / (F.col(trials) + 2)


def relative_uplift(treatment: Column | str, control: Column | str, digits: int = 6) -> Column:
    """T4. Relative change, 0 if the control is 0."""
    e, c = (F.col(x) if isinstance(x, str) else x for x in (treatment, control))
    return F.when(c > 0, F.round(F.try_divide(e - c, c), digits)).otherwise(F.lit(0.0))


def beta_comparison(df: DataFrame, control_successes: str, control_trials: str,
                    successes: str, trials: str, prefix: str = "") -> DataFrame:
    """T2. Add uplift, uplift_ci_lower, uplift_ci_upper and chance_to_win.

    Both sides have a Beta(1 + successes, 1 + failures) posterior. The posterior means
    are exact; the probability that the treatment is better and the 2.5% and 97.5%
    quantiles of the difference, relative to the control's mean, come from integrating the
    two densities numerically, so the same counts always give the same answer. ``df`` is an
    aggregate; rows are compared independently on the executors.
    """
    columns = [F.col(c).cast("double") for c in (control_successes, control_trials, successes, trials)]
    mean_c, mean_e = posterior_mean(control_successes, control_trials), posterior_mean(successes, trials)
    return (
        df.withColumn("_cmp", _compare(*columns))
        .withColumns({
            f"{prefix}uplift": (mean_e - mean_c) / mean_c,
            f"{prefix}uplift_ci_lower": F.col("_cmp.low") / mean_c,
            f"{prefix}uplift_ci_upper": F.col("_cmp.high") / mean_c,
            f"{prefix}chance_to_win": F.col("_cmp.win"),
        }).drop("_cmp")
    )


@F.pandas_udf(T.StructType([T.StructField(name, T.DoubleType()) for name in ("low", "high", "win")]))
def _compare(xc: pd.Series, nc: pd.Series, xe: pd.Series, ne: pd.Series) -> pd.DataFrame:
    rows = [compare_beta(*row) for row in zip(xc, nc, xe, ne)]
    return pd.DataFrame(rows, columns=["low", "high", "win"])


def compare_beta(xc: float, nc: float, xe: float, ne: float) -> tuple[float, float, float]:
    """Quantiles of (treatment - control) at 2.5% and 97.5%, and P(treatment > control)."""
    if np.isnan([xc, nc, xe, ne]).any():
        return np.nan, np.nan, np.nan
    low, high = difference_quantiles(xc, nc, xe, ne)
    return low, high, win_probability(xc, nc, xe, ne)


def win_probability(xc: float, nc: float, xe: float, ne: float) -> float:
    """The treatment's upper tail averaged over the control's posterior (Gauss-Legendre)."""
    low, high = _support(xc, nc, REACH)
    at = low + (high - low) * (NODES + 1) / 2
    mass = WEIGHTS * _density(at, xc, nc)
    upper = 1 - incomplete_beta(xe + 1, ne - xe + 1, at)
    return float(np.clip(mass @ upper / mass.sum(), 0, 1))


def difference_quantiles(xc: float, nc: float, xe: float, ne: float,
                         levels: tuple[float, float] = (0.025, 0.975)) -> list[float]:
    """Quantiles of treatment minus control, from both posteriors on a grid."""
    c, c_mass = _on_grid(xc, nc)
    e, e_mass = _on_grid(xe, ne)
    half = (e[1] - e[0]) / 2
    edges, cdf = np.append(e[0] - half, e + half), np.append(0.0, np.cumsum(e_mass))

    def quantile(level: float) -> float:
        low, high = -1.0, 1.0
        for _ in range(45):
            middle = (low + high) / 2
            at_most = c_mass @ np.interp(c + middle, edges, cdf)
            low, high = (middle, high) if at_most < level else (low, middle)
        return (low + high) / 2

    return [quantile(level) for level in levels]


def _support(x: float, n: float, reach: float) -> tuple[float, float]:
    """The part of [0, 1] that holds the posterior but for a negligible rest."""
    a, b = x + 1.0, n - x + 1.0
    mean, sd = a / (a + b), np.sqrt(a * b / (a + b + 1)) / (a + b)
    return max(0.0, mean - reach * sd), min(1.0, mean + reach * sd)


def _density(at: np.ndarray, x: float, n: float) -> np.ndarray:
    a, b = x + 1.0, n - x + 1.0
    return np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + (a - 1) * np.log(at) + (b - 1) * np.log1p(-at))


def _on_grid(x: float, n: float) -> tuple[np.ndarray, np.ndarray]:
    edges = np.linspace(*_support(x, n, GRID_REACH), GRID + 1)
    middle = (edges[1:] + edges[:-1]) / 2
    mass = _density(middle, x, n)
    return middle, mass / mass.sum()
