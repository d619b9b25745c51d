"""Days on which a user was active, as bits.

Retention asks, for many (user, day) pairs, whether the user was active exactly N days
later. With one bit per day of the window the activity table is shuffled once, by user,
as a few integers per user and map task (BIT_OR is combined on the map side and needs no
DISTINCT first), and the question becomes a bit test instead of a self-join per N.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.operators.windows import Days, EachDays
from trialmetrics.sources.tables import Tables

_BITS = 64


def active_bits(active: DataFrame, days: Days) -> DataFrame:
    """One row per user: ``bits``, an array of integers with a bit for each active day."""
    offset = F.datediff("active_date", F.lit(days.first))
    rows = (
        active.filter(days.contain("active_date") & (F.col("keep_alive_flag") == 1) & has_id(active))
        .select("user_id", offset.alias("offset"))
    )
    words = [
        F.expr(f"bit_or(CASE WHEN offset BETWEEN {low} AND {low + _BITS - 1} THEN shiftleft(1L, offset - {low}) END)")
        for low in range(0, max(1, len(days)), _BITS)
    ]
    names = [f"word{i}" for i in range(len(words))]
    return rows.groupBy("user_id").agg(*[word.alias(name) for word, name in zip(words, names)]).select(
        "user_id", F.array(*names).alias("bits"))


def observed_bits(t: Tables, days: Days | EachDays) -> tuple[DataFrame, date]:
    """Bits of the days and the day of the first bit. From the kept history if there is one; then bits around
    ``days`` are set too."""
    if t.history is not None:
        return t.history.active_bits(days)
    return active_bits(t["active"], days), days.first


def is_active(offset: str, bits: str = "bits") -> str:
    """SQL for: is the bit set that lies ``offset`` days after the window's first day?"""
    word = f"get({bits}, CAST(floor(({offset}) / {_BITS}) AS INT))"
    return f"coalesce(getbit({word}, pmod({offset}, {_BITS})) = 1, false)"


def has_id(df: DataFrame) -> Column:
    known = F.col("user_id").isNotNull()
    return known & (F.col("user_id") != "") if dict(df.dtypes)["user_id"] == "string" else known
