"""Which days of a phase a job reports on."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import wraps

from pyspark.sql import Column, DataFrame, Window, functions as F

from trialmetrics.experiment import Experiment, Experiments, small_table


@dataclass(frozen=True)
class Days:
    """An inclusive range of days; empty if ``first`` is after ``last``."""

    first: date
    last: date

    def contain(self, day: Column | str) -> Column:
        """A plain range predicate, so it prunes day partitions and Parquet row groups."""
        return (F.col(day) if isinstance(day, str) else day).between(F.lit(self.first), F.lit(self.last))

    def column(self) -> Column:
        """All the days as an array, empty for an empty range."""
        if self.first > self.last:
            return F.array().cast("array<date>")
        return F.sequence(F.lit(self.first), F.lit(self.last))

    def widened(self, before: int = 0, after: int = 0) -> Days:
        return Days(self.first - timedelta(days=before), self.last + timedelta(days=after))

    def __len__(self) -> int:
        return max(0, (self.last - self.first).days + 1)

    @property
    def name(self) -> str:
        return f"{self.first}_{self.last}"

    def bounded(self, rows: DataFrame, first: str, last: str) -> DataFrame:
        """``rows`` with the first and the last day as columns."""
        return rows.withColumns({first: F.lit(self.first), last: F.lit(self.last)})

    def narrowed(self, rows: DataFrame, day: str = "event_date") -> DataFrame:
        """Rows made of days that :meth:`contain` let pass: of one experiment these are its own."""
        return rows

    def spread(self, rows: DataFrame, day: str) -> DataFrame:
        """Each row once for every day."""
        return rows.withColumn(day, F.explode(self.column()))


class EachDays:
    """The days of several experiments by tag. Sources are read for all of them at once, from the first day
    of any to the last of any; rows that carry a tag are narrowed to its own days."""

    def __init__(self, days: Mapping[str, Days]):
        self.days = dict(days)
        known = [d for d in self.days.values() if len(d)]
        self.outer = Days(min(d.first for d in known), max(d.last for d in known)) if known else next(iter(self.days.values()))

    @property
    def first(self) -> date:
        return self.outer.first

    @property
    def last(self) -> date:
        return self.outer.last

    @property
    def name(self) -> str:
        return hashlib.sha256(repr(sorted(self.days.items())).encode()).hexdigest()[:16]

    def __len__(self) -> int:
        return len(self.outer)

    def contain(self, day: Column | str) -> Column:
        return self.outer.contain(day)

    def widened(self, before: int = 0, after: int = 0) -> EachDays:
        return EachDays({tag: days.widened(before, after) for tag, days in self.days.items()})

    def bounded(self, rows: DataFrame, first: str, last: str) -> DataFrame:
        bounds = small_table(rows.sparkSession, f"tag string, {first} date, {last} date",
                             [(tag, days.first, days.last) for tag, days in self.days.items()])
        return rows.join(bounds, "tag")

    def narrowed(self, rows: DataFrame, day: str = "event_date") -> DataFrame:
        return self.bounded(rows, "_first", "_last").filter(F.col(day).between(F.col("_first"), F.col("_last"))).drop("_first", "_last")

    def spread(self, rows: DataFrame, day: str) -> DataFrame:
        bounded = self.bounded(rows, "_first", "_last").filter("_first <= _last")
        return bounded.withColumn(day, F.explode(F.sequence("_first", "_last"))).drop("_first", "_last")


def of_each(policy: Callable[..., Days]) -> Callable[..., Days | EachDays]:
    """A policy that takes several experiments too."""
    @wraps(policy)
    def days(exp: Experiment | Experiments, *args, **options) -> Days | EachDays:
        if isinstance(exp, Experiments):
            return EachDays({e.tag: policy(e, *args, **options) for e in exp})
        return policy(exp, *args, **options)
    return days


def phase_times(exp: Experiment | Experiments, midnights: bool = False) -> tuple[Column, Column]:
    """Start and end of the phase, or the midnights that begin their days; of several experiments, columns of
    their assignments."""
    if isinstance(exp, Experiments):
        times = F.col("phase_start"), F.col("phase_end")
        return tuple(F.date_trunc("day", time).cast("timestamp_ntz") for time in times) if midnights else times
    return (moment_of(exp.first_day), moment_of(exp.last_day)) if midnights else (moment(exp.phase_start), moment(exp.phase_end))


def moment(at: datetime) -> Column:
    """A time without zone, whatever the zones of the driver and the session are."""
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def moment_of(day: date) -> Column:
    """Midnight at the start of ``day``."""
    return moment(datetime.combine(day, datetime.min.time()))


@of_each
def whole(exp: Experiment) -> Days:
    """First to last day of the phase."""
    return Days(exp.first_day, exp.last_day)


@of_each
def without_first(exp: Experiment) -> Days:
    return whole(exp).widened(before=-1)


@of_each
def inner(exp: Experiment) -> Days:
    """Neither the first nor the last day, which are seldom whole."""
    return whole(exp).widened(before=-1, after=-1)


@of_each
def without_last(exp: Experiment) -> Days:
    return whole(exp).widened(after=-1)


@of_each
def explore(exp: Experiment) -> Days:
    """The first day and the last two left out."""
    return whole(exp).widened(before=-1, after=-2)


@of_each
def inner_if_long(exp: Experiment) -> Days:
    """Inner days if the phase lasts two times 24 hours or more, otherwise the whole of it."""
    return inner(exp) if (exp.phase_end - exp.phase_start).days > 1 else whole(exp)


@of_each
def between_times(exp: Experiment, strict: bool = False) -> Days:
    """The phase where days are compared with its start and end *times*.

    A day counts as its midnight if ``strict``, so that the first day drops out when the
    phase starts later than midnight; otherwise the bounds are taken as days.
    """
    midnight = exp.phase_start == datetime.combine(exp.first_day, datetime.min.time())
    return whole(exp) if midnight or not strict else without_first(exp)


@of_each
def ingest_days(exp: Experiment) -> Days:
    """Days reached by stepping 24 hours from the phase start up to the phase end."""
    return Days(exp.first_day, exp.day((exp.phase_end - exp.phase_start).days))


def before_last_second(moment: Column | str) -> Column:
    """True up to 23:59:59 exclusive: the last second of each day is left out."""
    end = F.to_date(moment).cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return F.col(moment) < end if isinstance(moment, str) else moment < end


def trimmed(report: DataFrame, day: str = "dt", per: str = "day") -> DataFrame:
    """Drop the first and the last observed date if there are more than two.

    ``report`` is an aggregate with a bounded number of dates (the days of a phase).
    """
    series = Window.partitionBy(per)
    kept = (
        (F.size(F.collect_set(day).over(series)) <= 2)
        | (F.col(day) != F.min(day).over(series)) & (F.col(day) != F.max(day).over(series))
    )
    return report.withColumn("_kept", kept).filter("_kept").drop("_kept")


def matured(report: DataFrame, latest: Column, day: str = "dt", after: str = "day") -> DataFrame:
    """Keep dates that have been observed for at least ``after`` days."""
    return report.filter(F.col(day) <= F.date_sub(latest, F.col(after)))
