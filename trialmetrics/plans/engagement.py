"""How often users do something per day: events, users, events per user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.ratios import ratio_or_zero
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.events import USER_DAY, day_spine
from trialmetrics.operators.windows import Days, EachDays
from trialmetrics.sources.tables import Tables


def _intensity(events: DataFrame, users: DataFrame, days: Days | EachDays, label: str) -> DataFrame:
    """Distinct events and users per day and variation, and tag if the users have one.

    ``users`` is resolved to one row per user, or per user and day; the join uses the
    columns it has. COUNT(DISTINCT) per user and day is planned on (user, day, id), so
    that the events of one user are spread over many tasks before they are counted.
    """
    per_user = (
        events.filter(days.contain("event_date") & F.col("user_id").isNotNull())
        .groupBy(*USER_DAY).agg(F.count_distinct("event_id").alias("events"))
    )
    keys = [key for key in USER_DAY if key in users.columns]
    rows = per_user.join(users, keys)
    if keys != USER_DAY:
        rows = days.narrowed(rows)
    by = [key for key in Experiments.keys if key in users.columns]
    sums = rows.groupBy(*by, "event_date", F.col("variation_id").alias("variation")).agg(
        F.sum("events").alias(f"total_{label}"), F.count("*").alias(f"unique_{label}_users"))
    return sums.withColumn(f"{label}_ratio", ratio_or_zero(f"total_{label}", f"unique_{label}_users", 4))


def _chats(t: Tables, method: str) -> DataFrame:
    return t["chat"].filter(F.col("method") == method)


def continues(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E1. Continued answers."""
    days = windows.inner(exp)
    return _intensity(_chats(t, "continue"), assignment.resolve(t, exp, "daily_first", days), days, "continue")


def conversation_resets(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E2. Conversation resets. The inner days already lie inside the phase's times."""
    days = windows.inner(exp)
    return _intensity(t["reset"], assignment.resolve(t, exp, "daily_first", days), days, "conversation_reset")


def edits(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E3. Edited messages."""
    days = windows.inner(exp)
    return _intensity(_chats(t, "edit"), assignment.resolve(t, exp, "daily_first", days), days, "edit")


def follows(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E4. Bots followed, by the variation of the user's latest day."""
    days = windows.inner_if_long(exp)
    return _intensity(t["follow"], assignment.resolve(t, exp, "user_latest_day"), days, "follow")


def new_conversations(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E5. Conversations with a message. A user counts in every variation seen that day.

    A conversation may be shared, so it is counted per group and not summed over users.
    """
    days = windows.inner(exp)
    rows = (t["chat"].filter(days.contain("event_date") & F.col("user_id").isNotNull())
            .select(*USER_DAY, "conversation_id").distinct())
    sums = (
        rows.join(assignment.resolve(t, exp, "any_daily", days), USER_DAY)
        .groupBy(*exp.keys, "event_date", F.col("variation_id").alias("variation"))
        .agg(F.count_distinct("conversation_id").alias("total_new_conversation"),
             F.count_distinct("user_id").alias("unique_new_conversation_users"))
    )
    return sums.withColumn(
        "new_conversation_ratio", ratio_or_zero("total_new_conversation", "unique_new_conversation_users", 4))


def regenerations(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E6. Regenerated answers; every day and variation has a row, with zeros if idle."""
    days = windows.inner(exp)
    found = _intensity(_chats(t, "regenerate"), assignment.resolve(t, exp, "user_latest_day"), days, "regen")
    groups = assignment.variations(t, exp).withColumnRenamed("variation_id", "variation")
    full = day_spine(groups, days).join(found, [*exp.keys, "event_date", "variation"], "left")
    return full.select(*exp.keys, "event_date", "variation", *[
        F.coalesce(name, F.lit(0).cast(kind)).alias(name) for name, kind in
        (("total_regen", "bigint"), ("unique_regen_users", "bigint"), ("regen_ratio", "double"))])


def edits_of_phase(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """E7. Edits of the whole phase by ingest time; a user counts once per day and variation seen."""
    days = windows.ingest_days(exp)
    moment: Column = F.col("ingest_timestamp")
    day = F.to_date(moment)
    rows = _chats(t, "edit").filter(
        (moment >= windows.moment_of(days.first)) & (moment < windows.moment_of(days.widened(after=1).last))
        & windows.before_last_second(moment) & F.col("user_id").isNotNull())
    users = assignment.resolve(t, exp, "any").filter("variation_id IS NOT NULL")
    per_day = rows.groupBy("user_id", day.alias("day")).agg(F.count_distinct("event_id").alias("events"))
    added = {"events": F.sum("events"), "days": F.count("events")}
    per_user = assignment.with_sums(users, per_day, days, exp, added, "day").filter("days > 0")
    sums = per_user.groupBy(*exp.keys, F.col("variation_id").alias("variation")).agg(
        F.sum("events").alias("total_edit"), F.sum("days").alias("unique_edit_users"))
    return sums.withColumn("edit_ratio", ratio_or_zero("total_edit", "unique_edit_users", 4))
