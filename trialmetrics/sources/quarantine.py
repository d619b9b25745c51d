"""Bad records set apart.

Sources fail on what they cannot read. Where a few bad records are no reason to stop, they go to a side table with
their file and the reason, and the rest is read. How many may be bad is stated beforehand; beyond that it is an error, and the
side table tells why.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trialmetrics.publish import snapshots

BAD = T.StructType([T.StructField(name, T.StringType()) for name in ("file", "reason", "record")])


class TooManyBadRecords(ValueError):
    pass


@dataclass(frozen=True)
class Quarantine:
    """Side tables under ``root``, one for each source; ``at_most`` so many records of a source may be bad."""

    root: str
    at_most: int

    def put(self, source: str, bad: DataFrame) -> None:
        """Replace the side table of a source with ``bad`` (file, reason, record)."""
        folder, spark = f"{self.root}/{source}", bad.sparkSession
        found = list(snapshots.written(bad, folder, spread=True).values())
        snapshots.commit(spark, folder, BAD, lambda parts: {"": found})
        n = self.bad(spark, source).count()
        if n > self.at_most:
            raise TooManyBadRecords(f"{n} records of {source} are bad, {self.at_most} may be; they are in {folder}")

    def bad(self, spark: SparkSession, source: str) -> DataFrame:
        return snapshots.read(spark, f"{self.root}/{source}")


def parted(rows: DataFrame, reason: Column, record: Column, source: str, quarantine: Quarantine) -> DataFrame:
    """The rows without a reason to be set apart; the others go to the side table, which reads the source once more."""
    file = rows.metadataColumn("_metadata")["file_path"]
    bad = rows.select(file.alias("file"), reason.alias("reason"), record.alias("record")).filter("reason <> ''")
    quarantine.put(source, bad)
    return rows.filter(reason == "")


def not_fitting(casts: dict[str, tuple[Column, T.DataType]]) -> Column:
    """What is wrong with a row, '' if nothing is: the columns whose value does not fit its type."""
    wrong = [F.when(value.isNotNull() & value.try_cast(kind).isNull(), F.concat(
        F.lit(f"{name} is no {kind.simpleString()}: "), value.cast("string"))) for name, (value, kind) in casts.items()]
    return F.concat_ws("; ", *wrong) if wrong else F.lit("")
