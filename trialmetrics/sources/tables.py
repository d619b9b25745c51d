"""Where the input tables come from."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Mapping
from threading import Lock
from typing import TYPE_CHECKING
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from trialmetrics.session import remove_folder, shared_folder, staged
from trialmetrics.sources.quarantine import Quarantine, not_fitting, parted
from trialmetrics.sources.schemas import SCHEMAS

if TYPE_CHECKING:
    from trialmetrics.operators.history import History

#: Formats whose files hold the types of their columns.
TYPED_FORMATS = {"parquet", "orc", "avro", "delta", "iceberg"}


class Tables:
    """Input tables by name, opened when first asked for.

    ``share_assignments`` makes :func:`trialmetrics.operators.assignment.resolve` write
    each resolved assignment once to the shared folder, for runs of many metrics. Every
    instance has a folder of its own, so runs do not disturb each other; :meth:`release` removes it.
    Reports of one instance may be computed from several threads.

    With ``history``, what reports need of all days comes from there (:class:`trialmetrics.operators.history.History`).
    """

    def __init__(self, spark: SparkSession, opener: Callable[[str], DataFrame],
                 share_assignments: bool = False, history: History | None = None):
        self.spark = spark
        self.history = history
        self._opener = opener
        self._open: dict[str, DataFrame] = {}
        self._shared: dict[str, DataFrame] = {}
        self.share_assignments = share_assignments
        self._run = uuid4().hex
        self._lock, self._locks = Lock(), defaultdict(Lock)

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._open:
                self._open[name] = self._opener(name)
            return self._open[name]

    def shared(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if not self.share_assignments:
            return build()
        with self._lock:
            lock = self._locks[key]
        with lock:
            if key not in self._shared:
                self._shared[key] = staged(build(), f"run-{self._run}/{key}")
            return self._shared[key]

    def sharing(self) -> Tables:
        """The same tables with assignments shared, in a folder of their own."""
        return Tables(self.spark, self.__getitem__, share_assignments=True, history=self.history)

    def with_history(self, history: History) -> Tables:
        """The same tables with a kept history, which has to be up to date with them."""
        return Tables(self.spark, self.__getitem__, history=history)

    def release(self) -> None:
        """Remove what was shared. DataFrames built on it can no longer be computed."""
        self._shared.clear()
        remove_folder(self.spark, f"{shared_folder(self.spark)}/run-{self._run}")

    @classmethod
    def of(cls, frames: Mapping[str, DataFrame], **options) -> Tables:
        """Tables already at hand as DataFrames."""
        spark = next(iter(frames.values())).sparkSession
        return cls(spark, frames.__getitem__, **options)

    @classmethod
    def in_folder(cls, spark: SparkSession, root: str, file_format: str = "parquet",
                  names: Mapping[str, str] | None = None, quarantine: Quarantine | None = None, **options) -> Tables:
        """One day-partitioned folder per table under ``root``.

        Files that know their types are read with them and then conformed; others (CSV, JSON)
        are read under the declared schema, and a cell that does not fit is an error. With ``quarantine`` its
        record is set apart instead, when the table is opened.
        """
        def opener(name: str) -> DataFrame:
            path = f"{root}/{(names or {}).get(name, name)}"
            reader, schema = spark.read.format(file_format), SCHEMAS[name]
            if file_format not in TYPED_FORMATS:
                if quarantine is not None:
                    return fitting(reader.options(header=True).schema(as_text(schema)).option(
                        "columnNameOfCorruptRecord", CORRUPT).load(path), schema, name, quarantine)
                reader = reader.schema(schema).options(header=True, mode="FAILFAST")
            elif quarantine is not None:
                return fitting(reader.load(path), schema, name, quarantine)
            return conformed(reader.load(path), schema)
        return cls(spark, opener, **options)

    @classmethod
    def in_catalog(cls, spark: SparkSession, names: Mapping[str, str], **options) -> Tables:
        """Catalog tables; ``names`` maps our table names to theirs."""
        def opener(name: str) -> DataFrame:
            return conformed(spark.table(names[name]), SCHEMAS[name])
        return cls(spark, opener, **options)


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema``, mending types that differ between warehouses.

    A variation such as 'null' becomes NULL, a notification type 4 becomes '4', a day
    held as text or as a time becomes a date. Ids keep the type they have. Any other
    value that does not fit its type is an error, as is a column that is missing.
    """
    actual = {name.lower(): name for name in df.columns}
    if missing := [name for name in schema.names if name.lower() not in actual]:
        raise ValueError(f"columns {missing} are missing; there are {df.columns}")

    def column(field: T.StructField) -> Column:
        # Names are matched without regard to case, as Spark does.
        have, want = df.schema[actual[field.name.lower()]].dataType, field.dataType
        value = F.col(field.name)
        if have == want or field.name.endswith("_id") and field.name != "variation_id":
            return value.alias(field.name)
        if isinstance(want, T.DateType):
            return _strict(value, want).alias(field.name)
        return (value.try_cast(want) if field.name == "variation_id" else _strict(value, want)).alias(field.name)

    return df.select(*map(column, schema))


#: Holds the text of a line that cannot be taken apart.
CORRUPT = "_corrupt_line"


def as_text(schema: T.StructType) -> T.StructType:
    """All columns as text, so that a cell that does not fit is seen, and the line if it has not as many."""
    return T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema], T.StructField(CORRUPT, T.StringType())])


def fitting(rows: DataFrame, schema: T.StructType, source: str, quarantine: Quarantine) -> DataFrame:
    """As :func:`conformed`, but records that do not fit are set apart. Ids keep the type they have."""
    actual = {name.lower() for name in rows.columns}
    if missing := [name for name in schema.names if name.lower() not in actual]:
        raise ValueError(f"columns {missing} are missing; there are {rows.columns}")
    casts = {f.name: (F.col(f.name), f.dataType) for f in schema if not f.name.endswith("_id") and rows.schema[f.name].dataType != f.dataType}
    reason, record = not_fitting(casts), F.to_json(F.struct(*[c for c in rows.columns if c != CORRUPT]))
    if CORRUPT in rows.columns:
        broken = F.col(CORRUPT).isNotNull()
        reason = F.when(broken, "not a line of the table").otherwise(reason)
        record = F.when(broken, F.col(CORRUPT)).otherwise(record)
    good = parted(rows, reason, record, source, quarantine)
    return conformed(good.drop(CORRUPT), schema)


def _strict(value: Column, want: T.DataType) -> Column:
    """A cast that raises on what does not fit, whether or not the session is in ANSI mode."""
    cast = value.try_cast(want)
    text = F.concat(F.lit(f"not a {want.simpleString()}: "), value.cast("string"))
    return F.when(value.isNotNull() & cast.isNull(), F.raise_error(text).cast(want)).otherwise(cast)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV export with a header line, read under a declared schema; a cell that does not fit is an error."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def numeric_sample(df: DataFrame, value: str = "user_aov", group: str = "variation_id") -> DataFrame:
    """Coerce value and group to numbers and drop rows whose value is not one."""
    return (
        df.select(F.col(group).try_cast("int").alias(group), F.col(value).try_cast("double").alias(value))
        .filter(F.col(value).isNotNull() & ~F.isnan(value))
    )
