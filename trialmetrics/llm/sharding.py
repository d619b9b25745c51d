"""Contiguous shards of nearly equal bytes from global prefix sums."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from trialmetrics.llm.common import fresh, numbered, stored

OVERHEAD = 8  # bytes a row takes besides its text


def byte_shards(
    df: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", partitions: int | None = None,
) -> DataFrame:
    """One row per row of ``df``: key, size, text_crc32, law, shard, slot and grown_shard.

    Rows are sorted by key (null last), size and checksum. Each partition sums its sizes, the sums of the
    partitions before it are added, and the row whose middle byte lies in the n-th of ``shards`` equal parts of all
    bytes goes to shard n. So shards are contiguous and each differs from its share by less than its largest
    rows; a row larger than a share has a shard to itself and leaves others short. Null texts have no bytes; repeated
    rows take neighbouring slots; other columns are not looked at; an empty table gives an empty
    result. Only ids and sizes are shuffled. Rows that a third of the table shares are cut by a row number.
    """
    parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    name = fresh(df, "row")
    light = numbered(df, name).select(
        F.col(key).alias("key"), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"), F.col(name).alias("row"))
    order = [F.asc_nulls_last("key"), "size", "crc", "row"]
    ordered = light.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row")
    schema = T.StructType(list(ordered.schema) + [
        T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()), T.StructField("before", T.LongType())])
    sums = stored(ordered.mapInArrow(_running, schema), "prefix-sums")

    # One row a partition, then one row a shard: both broadcasts are bounded by those numbers.
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    totals = sums.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    bases = totals.select(
        "part", F.coalesce(F.sum("bytes").over(in_order), F.lit(0)).alias("base"),
        F.coalesce(F.sum("rows").over(in_order), F.lit(0)).alias("base_rows"), F.sum("bytes").over(everything).alias("total"))
    placed = sums.join(F.broadcast(bases), "part").select(
        "key", "size", "crc", (F.col("base_rows") + F.col("nth")).alias("nth"),
        F.expr(f"cast(((base + before) * 2 + size) * {shards} div (total * 2) as int)").alias("shard"))
    firsts = placed.groupBy("shard").agg(F.min("nth").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("nth") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row number and bytes before each row, within a sorted partition."""
    part, rows, held = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        sizes = batch.column("size").to_numpy()
        until = held + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(sizes), part, np.int32)), pa.array(rows + np.arange(len(sizes))),
             pa.array(until - sizes)], [*batch.schema.names, "part", "nth", "before"])
        if len(sizes):
            rows, held = rows + len(sizes), int(until[-1])
