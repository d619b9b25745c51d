"""What runs need of all earlier days, kept from run to run instead of read again.

Three tables per user: the days of activity as bits, the first and latest assignments of each experiment, and the
country. Each is made with aggregates that can be merged (BIT_OR, MIN, MAX and distinct sets), so a run adds one
partial table of the new rows only, and readers merge the partials. Rows that come late, or twice, are added like any
others. :meth:`History.compact` replaces the partials by one table, in one step.
"""

from __future__ import annotations

from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trialmetrics.operators import activity, assignment
from trialmetrics.operators.windows import Days
from trialmetrics.publish import snapshots

WORD = 64
EPOCH = date(1970, 1, 1)
#: Assignment policies over all days and the column that answers them.
ORDERS = {policy: assignment.POLICIES[policy][1] for policy in ("user_first", "user_latest_day", "user_first_day")}


class Kept:
    """A table of mergeable aggregates by ``keys``, in partials."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], merges: dict[str, Column], order: str):
        self.spark, self.root, self.keys, self.merges, self.order = spark, root, keys, merges, order

    def add(self, partials: DataFrame) -> None:
        """``partials`` has one row per key. Files are sorted, so that readers skip most of them."""
        folders = list(snapshots.written(partials.sortWithinPartitions(self.order), self.root, spread=True).values())
        snapshots.commit(self.spark, self.root, partials.schema, lambda parts: {**parts, uuid4().hex: folders})

    def partials(self) -> DataFrame:
        return snapshots.read(self.spark, self.root)

    def merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*[merge.alias(name) for name, merge in self.merges.items()])

    def compact(self) -> None:
        before = snapshots.current(self.spark, self.root)["parts"]
        rows = self.merged(snapshots.read(self.spark, self.root, before.__contains__))
        folders = list(snapshots.written(rows.sortWithinPartitions(self.order), self.root, spread=True).values())

        def change(parts: snapshots.Parts) -> snapshots.Parts:
            return {**{part: held for part, held in parts.items() if part not in before}, uuid4().hex: folders}

        snapshots.commit(self.spark, self.root, rows.schema, change)


class History:
    """Activity, assignments and countries of all rows that were added, in folders under ``root``."""

    policies = frozenset(ORDERS)

    def __init__(self, spark: SparkSession, root: str):
        self.activity = Kept(spark, f"{root}/activity", ["user_id", "word"], {"bits": F.expr("bit_or(bits)")}, "word")
        merges = {policy: F.min(policy) for policy in ORDERS}
        merges["variations"] = F.array_distinct(F.flatten(F.collect_list("variations")))
        self.assignments = Kept(spark, f"{root}/assignments", ["experiment_id", "user_id"], merges, "experiment_id")
        self.countries = Kept(spark, f"{root}/countries", ["user_id"], {"country": F.max("country")}, "user_id")

    def add(self, active: DataFrame | None = None, assignments: DataFrame | None = None, app_events: DataFrame | None = None) -> None:
        """Add new rows of these tables."""
        if active is not None:
            self.activity.add(_activity_words(active))
        if assignments is not None:
            self.assignments.add(_assigned(assignments))
        if app_events is not None:
            self.countries.add(home_countries(app_events))

    def compact(self) -> None:
        for kept in (self.activity, self.assignments, self.countries):
            kept.compact()

    def active_bits(self, days: Days) -> tuple[DataFrame, date]:
        """As :func:`activity.active_bits`, and the day of the first bit. Days around ``days`` may have bits too."""
        first, last = ((day - EPOCH).days // WORD for day in (days.first, max(days.first, days.last)))
        rows = self.activity.partials().filter(F.col("word").between(first, last))
        words = {f"word{word}": F.expr(f"bit_or(CASE WHEN word = {word} THEN bits END)") for word in range(first, last + 1)}
        bits = rows.groupBy("user_id").agg(*[word.alias(name) for name, word in words.items()])
        return bits.select("user_id", F.array(*words).alias("bits")), EPOCH + timedelta(days=first * WORD)

    def users(self, names: list[str]) -> DataFrame:
        """One row per experiment and user: a struct for each policy, and ``variations``."""
        return self.assignments.merged(self.assignments.partials().filter(F.col("experiment_id").isin(names)))

    def home(self) -> DataFrame:
        return self.countries.merged(self.countries.partials())


def _activity_words(active: DataFrame) -> DataFrame:
    rows = active.filter((F.col("keep_alive_flag") == 1) & activity.has_id(active) & F.col("active_date").isNotNull())
    day = F.unix_date("active_date")
    rows = rows.select("user_id", F.floor(day / WORD).cast("int").alias("word"), F.pmod(day, F.lit(WORD)).cast("int").alias("bit"))
    return rows.groupBy("user_id", "word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits"))


def _assigned(rows: DataFrame) -> DataFrame:
    rows = rows.filter(F.col("user_id").isNotNull() & F.col("experiment_id").isNotNull())
    firsts = [F.min(assignment.order_struct(order)).alias(policy) for policy, order in ORDERS.items()]
    return rows.groupBy("experiment_id", "user_id").agg(*firsts, F.collect_set(F.struct("variation_id")).alias("variations"))


def home_countries(app_events: DataFrame) -> DataFrame:
    """The greatest country of each user's events. It is parsed before the shuffle, so that a user's events reach
    it as one value a task."""
    return app_events.filter(activity.has_id(app_events)).groupBy("user_id").agg(
        F.max(F.get_json_object("geo", "$.country")).alias("country"))
