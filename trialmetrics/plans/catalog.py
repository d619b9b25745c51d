"""The table of experiments made from experiment documents."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from trialmetrics.experiment import Experiment
from trialmetrics.operators.windows import moment
from trialmetrics.publish import snapshots

# An experiment is reported from its second whole day on and for at most 90 days.
MIN_AGE_DAYS = 2
MAX_DURATION_DAYS = 90
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}Z$"


def parsed_time(text: Column) -> Column:
    """M2. A document's time to the second, NULL if it is not one."""
    return F.when(text.rlike(TIME_SHAPE), F.substring(text, 1, 19)).try_cast("timestamp_ntz")


def by_tag(documents: DataFrame) -> DataFrame:
    """M1. One row per document and tag, with the start of the last phase.

    Tags are known without surrounding blanks from here on; a document has each of them once.
    """
    start = parsed_time(F.try_element_at("phases", F.lit(-1))["dateStarted"])
    trimmed = F.array_distinct(F.transform("tags", lambda tag: F.trim(tag)))
    return documents.withColumn("started", start).withColumn("tag", F.explode(trimmed))


def latest_by_tag(documents: DataFrame) -> DataFrame:
    """M3. Per tag the document whose last phase started latest, unknown starts last.

    Among equal starts the first in input order. Documents are combined on the map side, so a tag that
    most documents carry is no hot spot. What is judged of a document later is judged of the winners only.
    """
    rows = by_tag(documents)
    known = F.col("started").isNotNull()
    order = F.struct((~known).alias("unknown"), F.when(known, -F.unix_seconds(F.col("started").cast("timestamp"))).alias("recency"), "position")
    rest = [c for c in rows.columns if c != "tag"]
    return rows.groupBy("tag").agg(F.min_by(F.struct(*rest), order).alias("best")).select("tag", "best.*")


def eligible(latest: DataFrame, as_of: datetime) -> DataFrame:
    """M4. Drop documents without a start, younger than two days or longer than 90 days.

    A phase without an end lasts until ``as_of``. An end that is no time is an error.
    """
    text = F.try_element_at("phases", F.lit(-1))["dateEnded"]
    now = moment(as_of.replace(microsecond=0))
    end = F.when(F.coalesce(text, F.lit("")) == "", now).otherwise(
        F.coalesce(parsed_time(text), F.raise_error(F.concat(F.lit("not a phase end: "), text)).cast("timestamp_ntz")))
    rows = latest.filter(F.col("started").isNotNull()).withColumn("ended", end)
    return rows.filter((_whole_days("started", now) >= MIN_AGE_DAYS)
                       & (_whole_days("started", F.col("ended")) <= MAX_DURATION_DAYS))


def _whole_days(start: str, end: Column) -> Column:
    """Times 24 hours, rounded down; neither has fractions of a second."""
    return F.floor(F.timestamp_diff("SECOND", F.col(start), end) / 86_400)


def described(rows: DataFrame) -> DataFrame:
    """M5. The columns of the experiment table, one row per tag."""
    joined = F.regexp_replace(F.regexp_replace(F.array_join("tags", ","), ",", "_"), " ", "")
    return rows.select(
        "tag", F.col("name").alias("experiment_name"), joined.alias("tags"),
        F.col("started").alias("phase_start_time"), F.col("ended").alias("phase_end_time"),
        F.coalesce(F.size("variations"), F.lit(0)).alias("number_of_variations"),
        F.get("variations", F.lit(0))["key"].alias("control_group_key"))


def experiment_table(documents: DataFrame, as_of: datetime, overrides: DataFrame | None = None,
                     as_published: bool = False) -> DataFrame:
    """M1 to M7. One row per tag; ``overrides`` are rows added by hand, which lose to documents.

    ``as_published`` keeps one row per experiment name and joined tags, without ``tag``.
    """
    table = described(eligible(latest_by_tag(documents), as_of)).withColumn("source", F.lit(0))
    if overrides is not None:
        table = table.unionByName(overrides.withColumn("source", F.lit(1)))
    return first_of_each(table, ["experiment_name", "tags"] if as_published else ["experiment_name", "tag"])


def first_of_each(table: DataFrame, keys: list[str]) -> DataFrame:
    """M7. One row per key, documents before overrides."""
    rest = [c for c in table.columns if c not in (*keys, "source")]
    order = ["source", *(["tag"] if "tag" in rest else []), "phase_start_time"]
    best = table.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("best"))
    kept = [c for c in table.columns if c != "source" and not ("tag" in rest and c == "tag")]
    return best.select(*keys, "best.*").select(*kept)


def tags(table: DataFrame) -> DataFrame:
    """M9. All tags."""
    return table.select("tag").distinct()


def lookup(table: DataFrame, tag: str) -> DataFrame:
    """M10. The experiment of a tag, the one started last if there are several."""
    return (table.filter(F.col("tag") == tag.strip(" "))
            .orderBy(F.col("phase_start_time").desc(), "experiment_name").limit(1))


def experiment_for(table: DataFrame, tag: str) -> Experiment:
    """M10 as the record the jobs take; raises LookupError if the tag is unknown."""
    row = lookup(table, tag).first()
    if row is None:
        raise LookupError(f"no experiment has the tag {tag!r}")
    return _record(row)


def _record(row: Row) -> Experiment:
    return Experiment(row.experiment_name, row.tag, row.phase_start_time, row.phase_end_time, row.number_of_variations)


def store(table: DataFrame, path: str) -> DataFrame:
    """M8. Replace the stored experiment table in one step and return it as stored."""
    snapshots.replace(table, path)
    return stored(table.sparkSession, path)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The experiment table as last stored."""
    return snapshots.read(spark, path)


def in_force(table: DataFrame) -> DataFrame:
    """M10 for all tags. The experiment of each tag, the one started last if there are several."""
    recent = F.struct((-F.unix_micros(F.col("phase_start_time").cast("timestamp"))).alias("age"), "experiment_name")
    rest = F.struct(*[c for c in table.columns if c != "tag"])
    best = table.filter("tag IS NOT NULL").groupBy("tag").agg(F.min_by(rest, recent).alias("best"))
    return best.select("tag", "best.*").select(*table.columns)


def experiments(table: DataFrame) -> list[Experiment]:
    """The experiment of each tag of a stored table, in the order of the tags: the list a run works through."""
    return [_record(row) for row in in_force(table).orderBy("tag").toLocalIterator()]
