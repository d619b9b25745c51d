"""The experiment record that every metric job is run for, and many of them that are reported together."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Experiment:
    name: str
    tag: str
    phase_start: datetime
    phase_end: datetime
    variations: int = 2
    control: int = 0

    @property
    def first_day(self) -> date:
        return self.phase_start.date()

    @property
    def last_day(self) -> date:
        return self.phase_end.date()

    @property
    def span_days(self) -> int:
        """Calendar days between the first and the last day of the phase."""
        return (self.last_day - self.first_day).days

    @property
    def keys(self) -> list[str]:
        """Columns that tell the experiments of a report apart: none, there is one."""
        return []

    def day(self, offset: int) -> date:
        return self.first_day + timedelta(days=offset)


class Experiments:
    """Experiments with different tags that a job reports in one pass, with a column ``tag``.

    Events are read and reduced to user-days once for all of them. Their phases are a small table, joined
    to what carries a tag: assignments, and facts once they have met those.
    """

    keys = ["tag"]

    def __init__(self, members: Iterable[Experiment]):
        self.members = tuple(members)
        if not self.members or len({e.tag for e in self.members}) < len(self.members):
            raise ValueError("experiments reported together need one tag each")

    def __iter__(self) -> Iterator[Experiment]:
        return iter(self.members)

    @property
    def names(self) -> list[str]:
        return sorted({e.name for e in self})

    @property
    def span_days(self) -> int:
        """Of the longest phase."""
        return max(e.span_days for e in self)

    def phases(self, spark: SparkSession) -> DataFrame:
        """tag, experiment_id, phase_start, phase_end, span_days."""
        return small_table(spark, "tag string, experiment_id string, phase_start timestamp_ntz, phase_end timestamp_ntz, span_days int", [
            (e.tag, e.name, e.phase_start.isoformat(" "), e.phase_end.isoformat(" "), e.span_days) for e in self])


def small_table(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A table of literals. Spark knows its size, and so whether to broadcast it."""
    fields = [field.split() for field in schema.split(", ")]
    values = {f"v{i}_{j}": value if isinstance(value, (int, str)) else value.isoformat() for i, row in enumerate(rows) for j, value in enumerate(row)}
    lines = ", ".join("(" + ", ".join(f"CAST(:v{i}_{j} AS {kind})" for j, (_, kind) in enumerate(fields)) + ")" for i in range(len(rows)))
    return spark.sql(f"SELECT * FROM VALUES {lines} AS t({', '.join(name for name, _ in fields)})", args=values)
