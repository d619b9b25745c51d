"""What the operators share: stored intermediate tables, row keys, slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.session import shared_folder

WHITE = " \t\n\x0b\x0c\r"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes to bytes: A-Z to lower case, all else unchanged.
LOWER = bytes.maketrans(LETTERS.encode(), LETTERS.lower().encode())


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have in any spelling."""
    taken = {name.lower() for name in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def new_folder(df: DataFrame, name: str) -> str:
    """A folder of this run alone, in the folder that all executors share."""
    spark = df.sparkSession
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: later jobs see the same rows whichever executors are lost."""
    path = new_folder(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """A long per row that tells equal rows apart. The same in every job over the same files, however these are split
    and packed into tasks: the rows of the files before it by name, and its place in its own. What is not a scan of
    Parquet files is written once with its numbers."""
    try:
        place = df.metadataColumn("_metadata")
        path, index = place["file_path"], place["row_index"]
        files = df.select(path.alias("path"), index.alias("i"))
        files.schema
    except AnalysisException:
        return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    starts, at = [], 0
    for file in sorted(files.groupBy("path").agg(F.max("i").alias("last"), F.count("*").alias("rows")).collect()):
        if file["rows"] > file["last"] + 1:
            raise ValueError(f"{file['path']} is read more than once")
        starts.append((file["path"], at))
        at += file["last"] + 1
    of, start, held = (fresh(df, stem + name) for stem in ("file_of_", "start_of_", "path_of_"))
    known = df.sparkSession.createDataFrame(starts, f"{held} string, {start} long")
    placed = df.withColumns({of: path, name: index})
    return placed.join(F.broadcast(known), placed[of] == known[held], "left").withColumn(
        name, F.col(start) + F.col(name)).drop(of, start, held)


def without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def id_remainder(key: Column, modulus: int) -> Column:
    """CRC-32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a slice holds about ``limit`` bytes of ``column``, or one row."""
    for batch in batches:
        values = batch.column(column)
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < len(sizes):
            yield batch.slice(start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    return [text or "" for text in batch.column(column).to_pylist()]


def bytes_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """Texts in UTF-8, null as the empty text."""
    return [text or b"" for text in batch.column(column).cast(pa.binary()).to_pylist()]
