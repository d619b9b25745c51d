"""Per-user-day facts and reports over days that may be empty.

Every event stream is reduced to one row per (user, day) before it meets the assignment.
The reduction is combined on the map side, so a single user with a third of all events
costs a join no more than any other user, and the join moves user-days, not events.

An event id names one event of one user; ids seen twice are deliveries of the same event
and count once. The number of distinct ids of a group of users is therefore the sum over
its users. Ids that users can share (bots, conversations) are never summed this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.operators.windows import Days

USER_DAY = ["user_id", "event_date"]


def stacked(**streams: DataFrame) -> DataFrame:
    """Union of streams with different columns; column ``stream`` says which."""
    parts = [df.withColumn("stream", F.lit(name)) for name, df in streams.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows


def of(stream: str) -> Column:
    return F.col("stream") == stream


def distinct_ids(by: list[str] = USER_DAY, **streams: DataFrame) -> DataFrame:
    """Distinct ``event_id`` of each stream per user and day, 0 where it has none.

    One shuffle on the ids themselves, which spreads a heavy user over all tasks, and a
    second one of partial counts.
    """
    rows = stacked(**{name: df.select(*by, "event_id") for name, df in streams.items()})
    counts = [F.count(F.when(of(name), F.col("event_id"))).alias(name) for name in streams]
    return rows.distinct().groupBy(*by).agg(*counts)


def new_user_days(first_visit: DataFrame, days: Days) -> DataFrame:
    """(user, day) of users whose first visit falls on that day."""
    day = F.to_date("first_visit_date")
    return (first_visit.filter(days.contain(day)).select("user_id", day.alias("event_date"))
            .distinct().withColumn("is_new", F.lit(True)))


def flagged_new(rows: DataFrame, first_visit: DataFrame, days: Days) -> DataFrame:
    """Add ``is_new``: the user's first visit is on the row's day."""
    marked = rows.join(new_user_days(first_visit, days), USER_DAY, "left")
    return marked.withColumn("is_new", F.coalesce("is_new", F.lit(False)))


def day_spine(groups: DataFrame, days: Days, day: str = "event_date") -> DataFrame:
    """Each row of ``groups`` (a handful of variations) once for every day."""
    return days.spread(groups, day)


def on_every_day(sums: DataFrame, group: str, days: Days, day: str = "event_date") -> DataFrame:
    """Each group of ``sums`` on every day, with NULLs where it has no row that day.

    Groups that occur on other days only are kept too. ``sums`` is a finished aggregate: a
    group has one row per day, so its rows fit one array, and it is computed only once.
    """
    values = [c for c in sums.columns if c not in (group, day)]
    found = F.map_from_entries(F.collect_list(F.when(
        days.contain(day), F.struct(day, F.struct(*values)))))
    return sums.groupBy(group).agg(found.alias("_found")).select(
        group, "_found", F.explode(days.column()).alias(day)).select(
        day, group, *[F.col("_found")[F.col(day)][name].alias(name) for name in values])


def counted_by_entity(rows: DataFrame, by: list[str], entities: dict[str, str], **flags: Column) -> DataFrame:
    """Distinct values of several id columns per group, each also under some conditions.

    Returns ``<entity>`` and ``<entity>_<flag>`` counts. Several COUNT(DISTINCT) in one
    query would replicate each row once per expression; here a row is replicated once per
    id column, and the conditions ride along as flags that are merged per id first.
    """
    variants = F.array(*[
        F.struct(F.lit(name).alias("entity"), F.col(column).cast("string").alias("id"))
        for name, column in entities.items()
    ])
    long = rows.select(*by, *[flag.alias(name) for name, flag in flags.items()],
                       F.inline(variants)).filter(F.col("id").isNotNull())
    per_id = long.groupBy(*by, "entity", "id").agg(*[F.max(name).alias(name) for name in flags])
    counts = []
    for name in entities:
        mine = F.col("entity") == name
        counts.append(F.count(F.when(mine, 1)).alias(name))
        counts += [F.count(F.when(mine & F.col(flag), 1)).alias(f"{name}_{flag}") for flag in flags]
    return per_id.groupBy(*by).agg(*counts)
