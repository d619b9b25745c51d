"""Exact duplicates by a content sort.

Rows are range-partitioned at sampled splitters of their normalised content, sorted externally, so that
equal contents are adjacent, and compared in full with their neighbours. A splitter holds the first
characters and the digest of a content instead of the content itself, so what the driver samples stays small.
The sort goes on after the content with the row's rank in its group: a group of any size is cut by splitters
like everything else, and a group over several partitions is joined at their edges, two rows a partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from trialmetrics.llm.common import WHITE, stored, without

HEAD = 32  # characters of a content in a splitter


def normalised(text: Column) -> Column:
    return without(F.coalesce(text, F.lit("")), WHITE)


def exact_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", carry: Iterable[str] = (), partitions: int | None = None,
) -> DataFrame:
    """One row per row of ``df``: key, keep_id, group_size, kept, text_sha256 and the columns in ``carry``
    as carry_0, carry_1, ...

    Texts are equal if they are the same without white space; null counts as empty, and all empty texts
    are one group. The longest original text stays, of those the smallest key (null keys last, then the
    carried columns). Of repeated rows exactly one is kept. Other columns of ``df`` are not looked at, and
    an empty table gives an empty result.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    carried = [f"carry_{i}" for i, _ in enumerate(carry)]
    rows = df.select(
        F.col(key).alias("key"), *[F.col(c).alias(n) for c, n in zip(carry, carried)],
        F.length(F.coalesce(text, F.lit(""))).alias("length"), normalised(F.col(text)).alias("content"),
    ).withColumn("digest", F.sha2("content", 256))
    rank = [F.desc("length"), F.asc_nulls_last("key"), *[F.asc_nulls_last(c) for c in carried]]
    head = F.substring("content", 1, HEAD)
    ordered = rows.repartitionByRange(parts, head, "digest", *rank).sortWithinPartitions(head, "digest", "content", *rank)

    schema = T.StructType([f for f in rows.drop("length", "content").schema] + [
        T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()),
        T.StructField("first", T.BooleanType()), T.StructField("size", T.LongType()),
        T.StructField("keep", rows.schema["key"].dataType), T.StructField("edge", T.StringType())])
    runs = stored(ordered.drop("length").mapInArrow(_runs, schema), "content-sort")

    # At most two rows a partition from here on, so the broadcast is bounded by the number of partitions.
    in_order = Window.orderBy("part", "run")
    edges = (
        runs.filter("edge is not null").select("part", "run", "size", "keep", "edge")
        .withColumn("goes_on", F.coalesce((F.lag("edge").over(in_order) == F.col("edge"))
                                          & (F.lag("part").over(in_order) < F.col("part")), F.lit(False)))
        .withColumn("chain", F.sum((~F.col("goes_on")).cast("long")).over(in_order)))
    chain = Window.partitionBy("chain")
    joined = edges.select(
        "part", "run", "goes_on", F.sum("size").over(chain).alias("chain_size"),
        F.first("keep").over(chain.orderBy("part", "run")).alias("chain_keep"))
    at_edge = F.col("chain_size").isNotNull()
    return runs.join(F.broadcast(joined), ["part", "run"], "left").select(
        F.col("key").alias(key),
        F.when(at_edge, F.col("chain_keep")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("chain_size", "size").alias("group_size"),
        (F.col("first") & ~F.coalesce("goes_on", F.lit(False))).alias("kept"),
        F.col("digest").alias("text_sha256"), *carried)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours in a sorted partition. Contents leave with the first row of the first and
    of the last run only. Of the open run, keys and digests are held, never contents."""
    part, held, run = TaskContext.get().partitionId(), [], 0
    opening = before = None

    def closed(rows: pa.Table, starts: np.ndarray, last: str | None = None) -> Iterator[pa.RecordBatch]:
        nonlocal run
        size = len(rows)
        sizes = np.diff(np.append(starts, size))
        of = np.repeat(np.arange(len(starts)), sizes)
        first = np.zeros(size, bool)
        first[starts] = True
        edge = [None] * size
        if run == 0:
            edge[0] = opening
        elif last is not None:
            edge[0] = last
        out = rows.append_column("part", pa.array(np.full(size, part, np.int32)))
        for name, column in (("run", pa.array(run + of)), ("first", pa.array(first)), ("size", pa.array(sizes[of])),
                             ("keep", rows["key"].take(pa.array(starts[of]))), ("edge", pa.array(edge, pa.string()))):
            out = out.append_column(name, column)
        run += len(starts)
        yield from out.combine_chunks().to_batches()

    held_starts: list[np.ndarray] = []
    for batch in batches:
        if not len(batch):
            continue
        content = batch.column("content")
        new = np.ones(len(batch), bool)
        new[1:] = ~pc.equal(content.slice(1), content.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
        if before is None:
            opening = content[0].as_py()
        else:
            new[0] = content[0].as_py() != before
        before = content[len(batch) - 1].as_py()
        rows = pa.Table.from_batches([batch]).drop_columns("content")
        starts = np.flatnonzero(new)
        if len(starts) and (held or starts[-1]):
            upto, offset = starts[-1], sum(map(len, held))
            done = held + ([rows.slice(0, upto)] if upto else [])
            marks = np.concatenate([*held_starts, starts[:-1] + offset]).astype(np.int64)
            yield from closed(pa.concat_tables(done), marks)
            held, held_starts = [rows.slice(upto)], [np.zeros(1, np.int64)]
        else:
            held.append(rows)
            held_starts.append(starts if len(held) == 1 else np.empty(0, np.int64))
    if held:
        yield from closed(pa.concat_tables(held), np.concatenate(held_starts).astype(np.int64), before)
