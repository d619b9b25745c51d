"""T10. Bootstrap of a difference of means, over any number of rows."""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from trialmetrics.functions.means import number

# Rows at a time, so that a block of draws stays in a core's cache.
_BLOCK = 8


def _limits() -> np.ndarray:
    """A hash at or above the k-th limit stands for more than k draws of a Poisson(1) variable, for as many
    k as a hash of 64 bits can tell apart."""
    limits, k = [], 0
    while (tail := sum(exp(-1) / factorial(j) for j in range(k + 30, k, -1)) * 2**64) >= 1:
        limits.append(2**64 - int(tail))
        k += 1
    return np.array(limits, np.uint64)


_LIMITS = _limits()


def bootstrap_mean_difference(sample: DataFrame, value: str = "user_aov", group: str = "variation_id",
                              key: str = "user_id", control: int = 0, treatment: int = 1,
                              resamples: int = 10_000, seed: int = 0) -> DataFrame:
    """One row: mean difference (treatment minus control), 95% interval, P(treatment > control).

    Each row is drawn a Poisson(1) number of times in each resample, decided by a hash of
    its ``key``, the resample and ``seed``: the result does not depend on how rows are
    partitioned, and a task that is run again draws the same. Values that are no number are
    left out, and a row without a key is an error: all of them would be drawn together.
    The work is rows x resamples. A task emits only its weighted sums: rows are first dealt to
    as many tasks as the session has shuffle partitions, or fewer, so that what is shuffled grows
    with those and the resamples, not with the splits of the input.
    """
    spark = sample.sparkSession
    no_key = F.raise_error(F.lit(f"a row of the sample has no {key}")).cast("string")
    rows = sample.filter(F.col(group).isin(control, treatment) & number(value).isNotNull()).select(
        F.md5(F.coalesce(F.col(key).cast("string"), no_key).cast("binary")).alias("row"),
        (F.col(group) == treatment).alias("treated"), number(value).alias("value"))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "row")

    def weighted_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((4, resamples))
        for batch in batches:
            values, treated = (batch[c].to_numpy() for c in ("value", "treated"))
            keys = np.array([int(digits[:16], 16) for digits in batch["row"]], np.uint64)
            weights = np.stack([~treated, ~treated * values, treated, treated * values]).astype("float64")
            for start in range(0, len(batch), _BLOCK):
                block = slice(start, start + _BLOCK)
                sums += weights[:, block] @ poisson_draws(keys[block], resamples, seed)
        yield pd.DataFrame({"resample": np.arange(resamples), **dict(zip(("n_a", "sum_a", "n_b", "sum_b"), sums))})

    partial = rows.mapInPandas(weighted_sums, "resample int, n_a double, sum_a double, n_b double, sum_b double")
    totals = partial.groupBy("resample").agg(*[F.sum(c).alias(c) for c in ("n_a", "sum_a", "n_b", "sum_b")])
    difference = F.try_divide("sum_b", "n_b") - F.try_divide("sum_a", "n_a")
    return totals.select(difference.alias("difference")).agg(
        F.avg("difference").alias("mean_diff"), F.percentile("difference", 0.025).alias("ci_low"),
        F.percentile("difference", 0.975).alias("ci_high"),
        F.avg((F.col("difference") > 0).cast("double")).alias("boot_prob"))


def poisson_draws(rows: np.ndarray, resamples: int, seed: int) -> np.ndarray:
    """Poisson(1) counts, one row per input row and one column per resample."""
    base = _mixed(rows.astype(np.uint64) + np.uint64(seed))
    step = _mixed(np.arange(1, resamples + 1, dtype=np.uint64))
    mixed = _mixed(base[:, None] ^ step[None, :])
    draws, above = np.zeros(mixed.shape), np.empty(mixed.shape, dtype=bool)
    for limit in _LIMITS:
        if not np.greater_equal(mixed, limit, out=above).any():
            break
        draws += above
    return draws


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 (published constants)."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x
