"""Writing reports and reading them back."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trialmetrics.publish import snapshots

TAG = re.compile(r"^[A-Za-z0-9_]+$")

# The headings reports are shown with.
RETENTION_HEADINGS = {
    "control_users": "对照组人数",
    "control_rate": "对照组留存率",
    "exp_users": "实验组人数",
    "exp_rate": "实验组留存率",
    "d1_rate": "d1留存率",
    "d3_rate": "d3留存率",
    "d7_rate": "d7留存率",
    "d15_rate": "d15留存率",
    "coverage_ratio": "覆盖占比",
}
EDIT_HEADINGS = {
    "event_date": "日期",
    "variation": "实验分组",
    "total_edit": "编辑事件数",
    "unique_edit_users": "活跃编辑用户数",
    "edit_ratio": "人均编辑次数",
}


def checked_tag(tag: str) -> str:
    if not TAG.match(tag):
        raise ValueError(f"a tag has letters, digits and underscores only: {tag!r}")
    return tag


def publish(report: DataFrame, root: str, metric: str, tag: str) -> str:
    """Replace the rows of ``tag`` in the table of ``metric`` in one step and return its folder.

    An empty report empties the tag, writing twice leaves one copy, and a failed write leaves the old rows. A
    report has a few rows per day; it is written as one file.
    """
    folder = f"{root}/{checked_tag(metric)}"
    found = list(snapshots.written(report.withColumn("tag", F.lit(checked_tag(tag))), folder).values())
    _commit(report, folder, {tag: found})
    return folder


def publish_tags(report: DataFrame, root: str, metric: str, tags: Iterable[str]) -> str:
    """As :func:`publish` for many tags in one write and one step; ``report`` has a column ``tag``. Tags
    without rows are emptied."""
    folder, tags = f"{root}/{checked_tag(metric)}", [checked_tag(tag) for tag in tags]
    rows = report.select(*[c for c in report.columns if c != "tag"], "tag")
    found = snapshots.written(rows, folder, by="tag")
    _commit(report, folder, {tag: [found[tag]] if tag in found else [] for tag in tags})
    return folder


def publish_days(report: DataFrame, root: str, metric: str, tag: str, day: str = "event_date",
                 days: Iterable[date] | None = None) -> str:
    """Replace rows of ``tag`` day by day in one step: those of ``days``, or of all days if none are given.

    The files of other days stay as they are. ``report`` need hold no other days; rows of them are left out, and days
    without rows are emptied. A tag that was published whole is published whole by days before one is replaced.
    """
    folder, tag = f"{root}/{checked_tag(metric)}", checked_tag(tag)
    wanted = None if days is None else sorted(set(days))
    rows = report if wanted is None else report.filter(F.col(day).isin(wanted))
    found = snapshots.written(rows.withColumn("tag", F.lit(tag)), folder, by=day)

    def change(parts: snapshots.Parts) -> snapshots.Parts:
        if wanted is None:
            kept = {part: folders for part, folders in parts.items() if not _of(part, tag)}
            return {**kept, f"{tag}/": [], **{f"{tag}/{value}": [place] for value, place in found.items()}}
        if tag in parts:
            raise ValueError(f"{tag} is not published by days in {folder}")
        gone = {f"{tag}/{value}" for value in wanted}
        kept = {part: folders for part, folders in parts.items() if part not in gone}
        return {**kept, f"{tag}/": [], **{f"{tag}/{value}": [place] for value, place in found.items()}}

    snapshots.commit(report.sparkSession, folder, rows.withColumn("tag", F.lit(tag)).schema, change)
    return folder


def _of(part: str, tag: str) -> bool:
    return part.split("/")[0] == tag


def _commit(report: DataFrame, folder: str, found: snapshots.Parts) -> None:
    schema = T.StructType([*[f for f in report.schema if f.name != "tag"], T.StructField("tag", T.StringType())])

    def change(parts: snapshots.Parts) -> snapshots.Parts:
        return {**{part: folders for part, folders in parts.items() if part.split("/")[0] not in found}, **found}

    snapshots.commit(report.sparkSession, folder, schema, change)


def publish_table(report: DataFrame, table: str, tag: str, day: str | None = None, days: Iterable[date] = ()) -> None:
    """As :func:`publish` for a catalog table, which is made if it does not exist. With ``day`` the table is
    partitioned by it too, and only the days of ``report``, and ``days``, are replaced."""
    if day is not None:
        return _publish_table_days(report, table, checked_tag(tag), day, days)
    spark, tag = report.sparkSession, checked_tag(tag)
    if not spark.catalog.tableExists(table):
        empty = report.limit(0).withColumn("tag", F.lit(tag))
        empty.write.partitionBy("tag").format("parquet").saveAsTable(table)
    names = ", ".join(f"`{name}`" for name in report.columns)
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (tag = '{tag}') ({names}) "
              f"SELECT {names} FROM {{report}}", report=report.repartition(1))


def _publish_table_days(report: DataFrame, table: str, tag: str, day: str, days: Iterable[date]) -> None:
    spark = report.sparkSession
    rows = report.select(*[c for c in report.columns if c != day], F.lit(tag).alias("tag"), day).repartition(day)
    if not spark.catalog.tableExists(table):
        rows.limit(0).write.partitionBy("tag", day).format("parquet").saveAsTable(table)
    for value in days:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (tag = '{tag}', {day} = DATE '{value}')")
    rows.select(*spark.table(table).columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)


def published(spark: SparkSession, root: str, metric: str, tag: str | None = None) -> DataFrame:
    """The rows of a metric, of all tags (with column ``tag``) or of one."""
    folder = f"{root}/{checked_tag(metric)}"
    if tag is None:
        return snapshots.read(spark, folder)
    return snapshots.read(spark, folder, lambda part: _of(part, checked_tag(tag))).drop("tag")


def typed(report: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types."""
    return report.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in schema])


def preview(report: DataFrame, *order: str) -> DataFrame:
    """For reading: sorted, with 0 for missing numbers."""
    return report.na.fill(0).orderBy(*order)


def with_headings(report: DataFrame, headings: dict[str, str]) -> DataFrame:
    return report.withColumnsRenamed(headings)


def export_csv(report: DataFrame, path: str, one_file: bool = False) -> None:
    """Write as CSV with a header line in each file; ``one_file`` is for reports of a few rows."""
    report = report.repartition(1) if one_file else report
    report.write.mode("overwrite").csv(path, header=True)
