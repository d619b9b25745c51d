"""Comparison of means."""

from __future__ import annotations

from math import erfc, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trialmetrics.functions.special import incomplete_beta

# Fixed value: the standard deviation a mean is assumed to have, as a share of it.
ASSUMED_SD = 1 / 5
Z_975 = 1.959963984540054


def normal_cdf(z: float) -> float:
    return 0.5 * erfc(-z / sqrt(2))


@F.pandas_udf(T.DoubleType())
def _cdf(z: pd.Series) -> pd.Series:
    return z.map(normal_cdf, na_action="ignore").astype("float64")


@F.pandas_udf(T.DoubleType())
def _two_sided_normal(z: pd.Series) -> pd.Series:
    return z.abs().map(lambda v: erfc(v / sqrt(2)), na_action="ignore").astype("float64")


@F.pandas_udf(T.DoubleType())
def _two_sided_t(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([student_p(*pair) for pair in zip(t, df)], dtype="float64")


def assumed_normal_win(control: str, treatment: str, sd_control: Column | None = None,
                       sd_treatment: Column | None = None) -> Column:
    """T3. P(treatment > control) for two normal means.

    Their standard deviations are a fixed share of the means unless estimates are given.
    """
    c, e = F.col(control).cast("double"), F.col(treatment).cast("double")
    sc = ASSUMED_SD * c if sd_control is None else sd_control
    se = ASSUMED_SD * e if sd_treatment is None else sd_treatment
    spread = F.sqrt(sc * sc + se * se)
    # With no spread at all the draws are equal and neither side wins.
    return F.when(spread == 0, (e > c).cast("double")).otherwise(_cdf(F.try_divide(e - c, spread)))


def student_p(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    if pd.isna(t) or pd.isna(df):
        return float("nan")
    return float(incomplete_beta(df / 2, 0.5, np.array([df / (df + t * t)]))[0])


def number(value: str) -> Column:
    """A value of a sample, NULL if it is not a number, so that aggregates leave it out."""
    return F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))


def group_moments(sample: DataFrame, value: str = "user_aov", group: str = "variation_id") -> DataFrame:
    """T12. Size, mean and sample variance per variation."""
    mine = number(value)
    return sample.groupBy(group).agg(
        F.count(mine).alias("n"), F.avg(mine).alias("mean"), F.var_samp(mine).alias("variance"))


def _two_groups(sample: DataFrame, value: str, group: str, control: int, treatment: int) -> DataFrame:
    """One row: n, mean and variance of control (a) and treatment (b). One pass, no join."""
    parts = []
    for side, key in (("a", control), ("b", treatment)):
        mine = F.when(F.col(group) == key, number(value))
        parts += [F.count(mine).alias(f"n_{side}"), F.avg(mine).alias(f"mean_{side}"),
                  F.var_samp(mine).alias(f"var_{side}")]
    return sample.agg(*parts)


def _squared_error(side: str) -> Column:
    return F.try_divide(F.col(f"var_{side}"), F.col(f"n_{side}"))


def mean_tests(sample: DataFrame, value: str = "user_aov", group: str = "variation_id",
               control: int = 0, treatment: int = 1, p_values: bool = True) -> DataFrame:
    """T8. Welch's t (control minus treatment) and the z-test (treatment minus control)."""
    a, b = _squared_error("a"), _squared_error("b")
    error = F.sqrt(a + b)
    difference = F.col("mean_b") - F.col("mean_a")
    freedom = F.try_divide((a + b) * (a + b), F.try_divide(a * a, F.col("n_a") - 1) + F.try_divide(b * b, F.col("n_b") - 1))
    stats = _two_groups(sample, value, group, control, treatment).select(
        "n_a", "n_b", "mean_a", "mean_b", difference.alias("mean_diff"), error.alias("se"),
        F.try_divide(-difference, error).alias("t_stat"), freedom.alias("t_df"),
        F.try_divide(difference, error).alias("z_stat"))
    if not p_values:
        return stats
    return stats.withColumns({"t_p": _two_sided_t("t_stat", "t_df"), "z_p": _two_sided_normal("z_stat")})


def posterior_difference(sample: DataFrame, value: str = "user_aov", group: str = "variation_id",
                         control: int = 0, treatment: int = 1, probability: bool = True) -> DataFrame:
    """T9. Normal posterior of treatment minus control: mean, 95% interval, P(treatment > control)."""
    difference = F.col("mean_b") - F.col("mean_a")
    spread = F.sqrt(_squared_error("a") + _squared_error("b"))
    stats = _two_groups(sample, value, group, control, treatment).select(
        difference.alias("uplift_mean"), (difference - Z_975 * spread).alias("ci_low"),
        (difference + Z_975 * spread).alias("ci_high"), F.try_divide(difference, spread).alias("_z"))
    if probability:
        stats = stats.withColumn("bayes_prob", _cdf("_z"))
    return stats.drop("_z")


def linear_regression(sample: DataFrame, value: str = "user_aov", group: str = "variation_id",
                      p_values: bool = True) -> DataFrame:
    """T7. Least squares of the value on the variation and an intercept; one row per coefficient."""
    y, x = number(value), number(group)
    fit = sample.agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"),
        F.regr_avgx(y, x).alias("avgx"))
    residual = F.try_divide(F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx"), F.col("n") - 2)
    slope_error = F.sqrt(F.try_divide(residual, F.col("sxx")))
    intercept_error = F.sqrt(residual * (1 / F.col("n") + F.try_divide(F.col("avgx") * F.col("avgx"), F.col("sxx"))))
    rows = fit.select("n", "r2", F.inline(F.array(
        F.struct(F.lit(group).alias("term"), F.col("slope").alias("coefficient"), slope_error.alias("std_error")),
        F.struct(F.lit("intercept").alias("term"), F.col("intercept").alias("coefficient"), intercept_error.alias("std_error")))))
    rows = rows.withColumn("t_stat", F.try_divide("coefficient", "std_error"))
    if p_values:
        rows = rows.withColumn("p_value", _two_sided_t("t_stat", (F.col("n") - 2).cast("double")))
    return rows
