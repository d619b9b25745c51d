"""The funnel from cards shown over bots viewed to chats, overall and for new users.

A user is new on the day of the first visit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.experiment import Experiment, Experiments
from trialmetrics.functions.ratios import half_up, money, money_of, ratio, ratio_or_zero, total, total_of
from trialmetrics.operators import assignment, windows
from trialmetrics.operators.events import (
    USER_DAY, counted_by_entity, day_spine, distinct_ids, flagged_new, of, stacked)
from trialmetrics.operators.windows import Days, EachDays
from trialmetrics.sources.tables import Tables

GROUP = ["event_date", "variation"]
EXPLORE = "source = 'tag:Explore'"
NEW = "is_new"


def _on(events: DataFrame, days: Days | EachDays, *conditions: Column | str) -> DataFrame:
    rows = events.filter(days.contain("event_date") & F.col("user_id").isNotNull())
    for condition in conditions:
        rows = rows.filter(condition)
    return rows


def _with_variation(rows: DataFrame, t: Tables, exp: Experiment | Experiments, policy: str, days: Days | EachDays) -> DataFrame:
    """Rows of a day with the user's variation of that day and whether the user is new."""
    users = assignment.resolve(t, exp, policy, days).withColumnRenamed("variation_id", "variation")
    return flagged_new(rows.join(users, USER_DAY), t["first_visit"], days)


def _same_group(groups: DataFrame, sums: DataFrame, exp: Experiment | Experiments) -> list[Column]:
    """Rows of the same day, NULL being a variation like any other."""
    equal = [sums[name] == groups[name] for name in [*exp.keys, "event_date"]]
    return [*equal, sums["variation"].eqNullSafe(groups["variation"])]


def click_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C1. Clicks of users who were shown cards that day, per card shown.

    Every variation ever assigned has a row per day: cards NULL and clicks 0 if idle. Of the
    assignments of other days only the variations are read.
    """
    days = windows.inner(exp)
    facts = distinct_ids(shown=_on(t["show_card"], days), clicked=_on(t["bot_view"], days)).filter("shown > 0")
    sums = _with_variation(facts, t, exp, "daily_first", days).groupBy(*exp.keys, *GROUP).agg(
        F.sum("shown").alias("showed_events"), F.sum("clicked").alias("clicked_events"),
        total_of(NEW, "shown").alias("new_showed_events"), total_of(NEW, "clicked").alias("new_clicked_events"))

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint")).alias(name)

    groups = day_spine(assignment.variations(t, exp), days).withColumnRenamed("variation_id", "variation")
    full = groups.join(sums, _same_group(groups, sums, exp), "left")
    return full.select(
        *[groups[name] for name in [*exp.keys, *GROUP]], "showed_events", count("clicked_events"),
        ratio("clicked_events", "showed_events", 4).alias("click_ratio"),
        count("new_showed_events"), count("new_clicked_events"),
        ratio("new_clicked_events", "new_showed_events", 4).alias("new_user_click_ratio"))


def start_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C2. Bots viewed and then chatted with by the same user that day, by bot and by user."""
    days = windows.inner(exp)
    pairs = stacked(
        view=_on(t["bot_view"], days).select(*USER_DAY, "bot_id"),
        chat=_on(t["chat"], days, "prompt_id IS NOT NULL").select(*USER_DAY, F.col("prompt_id").alias("bot_id")),
    ).groupBy(*USER_DAY, "bot_id").agg(F.max(of("view")).alias("viewed"), F.max(of("chat")).alias("chatted"))
    rows = _with_variation(pairs.filter("viewed").drop("viewed"), t, exp, "daily_lowest", days)
    n = counted_by_entity(rows, [*exp.keys, *GROUP], {"bots": "bot_id", "users": "user_id"},
                          started=F.col("chatted"), new=F.col(NEW), new_started=F.col("chatted") & F.col(NEW))
    return n.select(
        *exp.keys, *GROUP, F.col("bots").alias("clicked_bots"), F.col("bots_started").alias("chat_bots"),
        ratio_or_zero("bots_started", "bots", 4).alias("chat_start_rate"),
        F.col("bots_new").alias("new_clicked_bots"), F.col("bots_new_started").alias("new_chat_bots"),
        ratio_or_zero("bots_new_started", "bots_new", 4).alias("new_chat_start_rate"),
        F.col("users").alias("clicked_users"), F.col("users_started").alias("started_users"),
        ratio_or_zero("users_started", "users", 4).alias("user_chat_start_rate"),
        ratio_or_zero("users_new_started", "users_new", 4).alias("new_user_chat_start_rate"))


def _depth(t: Tables, exp: Experiment | Experiments, condition: str, explore: bool) -> DataFrame:
    """Chat rounds per bot, per user and per user and bot."""
    days = windows.inner(exp)
    per_bot = (
        _on(t["chat"], days, condition).groupBy(*USER_DAY, "prompt_id")
        .agg(F.count_distinct("event_id").alias("ids"), F.count("*").alias("rows"), F.count("event_id").alias("events"))
    )
    rows = _with_variation(per_bot, t, exp, "daily_lowest", days)
    new_rounds = "ids" if explore else "rows"
    # Each (user, bot) row stands for the user and for the bot; rounds are summed over the users only.
    entity = F.inline(F.array(
        F.struct(F.lit(True).alias("is_user"), F.col("user_id").cast("string").alias("id")),
        F.struct(F.lit(False).alias("is_user"), F.col("prompt_id").cast("string").alias("id"))))
    per_id = rows.select(*exp.keys, *GROUP, "is_new", "ids", "events", F.when(F.col(NEW), F.col(new_rounds)).alias("new_rounds"), entity)
    per_id = per_id.groupBy(*exp.keys, *GROUP, "is_user", "id").agg(
        F.max("is_new").alias("is_new"), *[F.sum(name).alias(name) for name in ("ids", "events", "new_rounds")])
    user = F.col("is_user")
    n = per_id.groupBy(*exp.keys, *GROUP).agg(
        *[F.coalesce(F.sum(F.when(user, F.col(name))), F.lit(0)).alias(name) for name in ("ids", "events", "new_rounds")],
        total(user).alias("users"), total(user & F.col(NEW)).alias("new_users"), total(~user & F.col("id").isNotNull()).alias("bots"))
    depth, new_depth = F.col("ids"), F.col("new_rounds")
    return n.select(
        *exp.keys, *GROUP, F.col("events" if explore else "ids").alias("total_chat_rounds"),
        F.col("users").alias("unique_users"), F.col("bots").alias("chat_bots"),
        ratio(depth, "bots", 2).alias("chat_depth_bot"), ratio(depth, "users", 2).alias("chat_depth_user"),
        ratio(depth, F.col("users") * F.col("bots"), 4).alias("chat_depth_per_user_per_bot"),
        ratio(new_depth, "bots", 2).alias("chat_depth_bot_new"),
        ratio(new_depth, "new_users", 2).alias("chat_depth_user_new"),
        ratio(new_depth, F.col("bots") * F.col("new_users"), 4).alias("chat_depth_per_user_per_bot_new"))


def chat_depth(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C3. All chats but generated ones; a NULL method is left out too."""
    return _depth(t, exp, "method != 'generate'", explore=False)


def explore_chat_depth(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C9. Chats that came from the Explore tab."""
    return _depth(t, exp, EXPLORE, explore=True)


def _bots_per_user(t: Tables, exp: Experiment | Experiments, events: str, bot: str) -> DataFrame:
    days = windows.inner(exp)
    per_user = _on(t[events], days).groupBy(*USER_DAY).agg(F.count_distinct(bot).alias("bots"))
    sums = (
        _with_variation(per_user, t, exp, "daily_first", days)
        .groupBy(*exp.keys, "event_date", F.col("variation").alias("variation_id"))
        .agg(F.sum("bots").alias("total_click"), F.count("*").alias("total_user"),
             total_of(NEW, "bots").alias("new_user_total_click"), total(NEW).alias("new_user_total_user"))
    )
    return sums.select(
        *exp.keys, "event_date", "variation_id", "total_click", "total_user",
        ratio("total_click", "total_user", 4).alias("avg_bot_clicked"), "new_user_total_click", "new_user_total_user",
        ratio("new_user_total_click", "new_user_total_user", 4).alias("new_user_avg_bot_clicked"))


def bots_viewed_per_user(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C4. Distinct bots a user views in a day."""
    return _bots_per_user(t, exp, "bot_view", "bot_id")


def bots_chatted_per_user(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C5. Distinct bots a user chats with in a day."""
    return _bots_per_user(t, exp, "chat", "prompt_id")


def time_spent(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C6. Minutes in sessions, rounded per user and day."""
    days = windows.without_first(exp)
    day = F.to_date("event_date")
    per_user = (
        t["session"].filter(days.contain(day) & F.col("user_id").isNotNull())
        .groupBy("user_id", day.alias("event_date"))
        .agg(half_up(F.sum("duration") / 1000 / 60, 2).alias("minutes"))
    )
    sums = _with_variation(per_user, t, exp, "daily_first", days).groupBy(*exp.keys, *GROUP).agg(
        money("minutes").alias("total_time_minutes"), F.count("*").alias("unique_users"),
        money_of(NEW, "minutes").alias("new_user_total_time_minutes"), total(NEW).alias("new_user_count"))
    return sums.select(
        *exp.keys, *GROUP, "total_time_minutes", "unique_users",
        ratio("total_time_minutes", "unique_users", 2).alias("avg_time_spent_minutes"),
        "new_user_total_time_minutes", "new_user_count",
        ratio("new_user_total_time_minutes", "new_user_count", 2).alias("new_user_avg_time_spent_minutes"))


def _explore_counts(t: Tables, exp: Experiment | Experiments, days: Days | EachDays) -> DataFrame:
    """Explore cards shown and clicks for every day and variation, beside all users ever assigned.

    The number of users does not depend on the day, so it is joined to the days' sums
    instead of carrying every user through every day.
    """
    shown = (F.col("current_page") == "home") & (F.col("tab_name") == "Explore")
    facts = distinct_ids(shows=_on(t["show_card"], days, shown), clicks=_on(t["bot_view"], days, EXPLORE))
    visits = (t["first_visit"].select("user_id", F.to_date("first_visit_date").alias("event_date"))
              .filter(days.contain("event_date")))
    per_day = stacked(facts=facts, new=visits).groupBy(*USER_DAY).agg(
        F.coalesce(F.sum("shows"), F.lit(0)).alias("shows"), F.coalesce(F.sum("clicks"), F.lit(0)).alias("clicks"),
        F.max(of("new")).alias("is_new"))
    users = assignment.resolve(t, exp, "user_first_day").withColumnRenamed("variation_id", "variation")
    sums = days.narrowed(per_day.join(users, "user_id")).groupBy(*exp.keys, *GROUP).agg(
        F.sum("shows").alias("shows"), F.sum("clicks").alias("clicks"), total(NEW).alias("new_users"),
        total_of(NEW, "shows").alias("new_shows"), total_of(NEW, "clicks").alias("new_clicks"))
    spine = day_spine(users.groupBy(*exp.keys, "variation").agg(F.count("*").alias("users")), days)
    full = spine.join(sums, _same_group(spine, sums, exp), "left")
    return full.select(*[spine[name] for name in [*exp.keys, *GROUP]], "users", *[
        F.coalesce(name, F.lit(0).cast("bigint")).alias(name)
        for name in ("shows", "clicks", "new_users", "new_shows", "new_clicks")])


def explore_click_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C7. Explore cards shown per assigned user and clicks per card."""
    n = _explore_counts(t, exp, windows.explore(exp))
    return n.select(
        *exp.keys, *GROUP, F.col("users").alias("show_users"), ratio("shows", "users", 4).alias("avg_shows_per_user"),
        ratio("clicks", "shows", 4).alias("click_rate"), F.col("new_users").alias("new_user_show_users"),
        ratio("new_shows", "new_users", 4).alias("avg_shows_per_new_user"),
        ratio("new_clicks", "new_shows", 4).alias("click_rate_new_user"))


def recall_impressions(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C10. Explore cards shown, clicks, their rate and cards per assigned user, for every day."""
    n = _explore_counts(t, exp, windows.whole(exp))
    return n.select(
        *exp.keys, "event_date", F.col("variation").alias("variation_id"), F.col("shows").alias("total_shows"),
        F.col("clicks").alias("total_clicks"), ratio("clicks", "shows", 4).alias("click_through_rate"),
        ratio("shows", "users", 4).alias("avg_shows_per_user"))


def explore_start_rate(t: Tables, exp: Experiment | Experiments) -> DataFrame:
    """C8. Of the users who viewed a bot from the Explore tab, those who chatted from it that day."""
    days = windows.inner(exp)
    flags = stacked(**{name: _on(t[name], days, EXPLORE).select(*USER_DAY) for name in ("bot_view", "chat")})
    flags = flags.groupBy(*USER_DAY).agg(F.max(of("bot_view")).alias("viewed"), F.max(of("chat")).alias("chatted"))
    n = _with_variation(flags.filter("viewed"), t, exp, "daily_lowest", days).groupBy(*exp.keys, *GROUP).agg(
        F.count("*").alias("clicked_users"), total("chatted").alias("chat_users"),
        total(NEW).alias("new_clicked_users"), total(F.col(NEW) & F.col("chatted")).alias("new_chat_users"))
    return n.select(
        *exp.keys, *GROUP, "clicked_users", "chat_users", ratio_or_zero("chat_users", "clicked_users", 4).alias("chat_start_rate"),
        "new_clicked_users", "new_chat_users",
        ratio_or_zero("new_chat_users", "new_clicked_users", 4).alias("new_chat_start_rate"))
