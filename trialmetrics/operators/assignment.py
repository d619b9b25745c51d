"""Which variation a user belongs to.

The rows kept are those that ROW_NUMBER() = 1 would keep, but written as MIN over a
struct: it is combined on the map side, so that a user who holds a large share of the
assignment rows still reaches the shuffle as one row per map task. Spark plans it as a
sort-based aggregate, so a task sorts its own rows first. Ties always end on
``timestamp_assigned, variation_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.operators.windows import Days, EachDays, moment
from trialmetrics.sources.tables import Tables

# policy -> (grain, order); an order column that sorts descending is given negated
POLICIES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "user_first": (("user_id",), ("timestamp_assigned",)),
    "user_latest_day": (("user_id",), ("event_date IS NULL AS undated", "-unix_date(event_date) AS age", "timestamp_assigned")),
    "user_first_day": (("user_id",), ("event_date", "timestamp_assigned")),
    "daily_first": (("user_id", "event_date"), ("timestamp_assigned",)),
    "daily_lowest": (("user_id", "event_date"), ()),
    "any": (("user_id", "variation_id"), ()),
    "any_daily": (("user_id", "event_date", "variation_id"), ()),
}


def assignments(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """Assignment rows of one experiment, users without an id left out; of several, with tag and phase."""
    rows = t["assignment"].filter(F.col("user_id").isNotNull())
    if isinstance(exp, Experiments):
        return rows.filter(F.col("experiment_id").isin(exp.names)).join(exp.phases(t.spark), "experiment_id")
    return rows.filter(F.col("experiment_id") == exp.name)


def first_by(*order: str) -> Column:
    """Aggregate: the variation of the row that sorts first, NULL before all others."""
    if not order:
        return F.when(F.count("*") == F.count("variation_id"), F.min("variation_id"))
    return F.min(order_struct(order)).getField("variation_id")


def order_struct(order: tuple[str, ...]) -> Column:
    return F.struct(*map(F.expr, order), F.col("variation_id"))


def resolve(t: Tables, exp: Experiment | Experiments, policy: str, days: Days | EachDays | None = None,
            between: tuple | None = None) -> DataFrame:
    """One row per grain of ``policy`` with its ``variation_id``, and per tag of several experiments.

    ``days`` limits event_date and ``between`` limits timestamp_assigned, both inclusive
    and before rows are chosen.
    """
    def build() -> DataFrame:
        if t.history is not None and days is None and between is None and (policy == "any" or policy in t.history.policies):
            return _from_history(t, exp, policy)
        rows = assignments(t, exp)
        if days is not None:
            rows = days.narrowed(rows.filter(days.contain("event_date")))
        if between is not None:
            rows = rows.filter(F.col("timestamp_assigned").between(*map(moment, between)))
        grain, order = POLICIES[policy]
        if "variation_id" in grain:
            return rows.select(*exp.keys, *grain).distinct()
        return rows.groupBy(*exp.keys, *grain).agg(first_by(*order).alias("variation_id"))

    of = ["together"] if exp.keys else [exp.tag, exp.name]  # several share the tables of a run of their own
    parts = [*of, policy, days and days.name,
             between and "_".join(f"{b:%Y%m%d%H%M%S}" for b in between)]
    key = "assignment/" + "/".join(str(part) for part in parts if part)
    return t.shared(key, build)


def kept_users(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """Users of the kept history, of several experiments with tag and phase."""
    if isinstance(exp, Experiments):
        return t.history.users(exp.names).join(exp.phases(t.spark), "experiment_id")
    return t.history.users([exp.name])


def _from_history(t: Tables, exp: Experiment | Experiments, policy: str) -> DataFrame:
    users = kept_users(t, exp)
    if policy == "any":
        return users.select(*exp.keys, "user_id", F.inline("variations"))
    return users.select(*exp.keys, "user_id", F.col(f"{policy}.variation_id"))


def variations(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """Every variation seen in the raw assignment rows."""
    if t.history is not None:
        return _from_history(t, exp, "any").select(*exp.keys, "variation_id").distinct()
    return assignments(t, exp).select(*exp.keys, "variation_id").distinct()


def with_sums(users: DataFrame, facts: DataFrame, days: Days | EachDays, exp: Experiment | Experiments, sums: dict[str, Column],
              day: str = "event_date") -> DataFrame:
    """Users with sums over their facts of the phase, NULL if they have none. For several experiments ``facts`` are
    user-days, and each user's own days count."""
    of = [value.alias(name) for name, value in sums.items()]
    if not exp.keys:
        return users.join(facts.groupBy("user_id").agg(*of), "user_id", "left")
    bounded = days.bounded(users, "_first", "_last")
    own = [bounded["user_id"] == facts["user_id"], facts[day].between(bounded["_first"], bounded["_last"])]
    return bounded.join(facts, own, "left").drop(facts["user_id"]).groupBy(*users.columns).agg(*of)


def labelled(flag: Column) -> Column:
    """``flag`` where the variation is known. A NULL variation still forms a group of its
    own, but equality on the variation attaches no events to it."""
    return flag & F.col("variation_id").isNotNull()


def labelled_value(value: Column | str) -> Column:
    """``value`` where the variation is known, otherwise NULL."""
    return F.when(F.col("variation_id").isNotNull(), F.col(value) if isinstance(value, str) else value)
