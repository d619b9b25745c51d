"""Near-duplicate embeddings by random-hyperplane sign hashing, exact cosines and connected components.

The signs of a vector on random hyperplanes give it a code in each of several tables; two vectors at an angle of theta
differ in a bit with probability theta / pi. The bits of a code follow from the size of the largest label, so that a
bucket holds about one unrelated vector at any size, and the number of tables from the wanted recall.

Copies fall together first. Vectors in buckets of few members are paired by their ids, pairs whose sketches of 64 signs are too
far apart fall away, and the others are verified with both vectors at hand. Vectors in a bucket of many members are
dealt into blocks, and a task multiplies the matrices of two blocks; it returns sums and a tree for each
cluster, no pairs. A pair that meets in several tables counts in the first one only, which both sides tell from their codes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from trialmetrics.llm.common import stored
from trialmetrics.llm.simhash import components

SEED = 42
SKETCH = 64
LOST = 1e-9  # chance that the sketches of a pair at the threshold are further apart than allowed


_made: dict[tuple[int, int], np.ndarray] = {}


def _planes(dimensions: int, n: int) -> np.ndarray:
    """Normals of the hyperplanes, one per column: the same wherever they are made, and no other ones if there are more."""
    if (dimensions, n) not in _made:
        _made[dimensions, n] = np.random.default_rng([SEED, dimensions]).standard_normal((n, dimensions)).T
    return _made[dimensions, n]


def plan(vectors: int, least: float, recall: float) -> tuple[int, int]:
    """Bits of a code and number of tables for so many vectors in one label."""
    bits = max(8, math.ceil(math.log2(max(2, vectors))))
    together = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - together))


def _sketch_bound(least: float) -> int:
    p = math.acos(least) / math.pi
    tail, d = 1.0, -1
    while tail >= LOST and d < SKETCH:
        d += 1
        tail -= math.comb(SKETCH, d) * p ** d * (1 - p) ** (SKETCH - d)
    return d


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their unit vectors in double precision) by dimension; rows without a direction are left out."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten()  # null lists have no values here
    values = np.asarray(pa.compute.fill_null(flat.cast(pa.float64()), math.nan).to_numpy(zero_copy_only=False))
    starts = np.cumsum(sizes) - sizes
    for dimensions in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dimensions)
        x = values[starts[rows, None] + np.arange(dimensions)]
        top = np.abs(x).max(1)  # NaN if there is one
        good = np.isfinite(top) & (top > 0)
        rows, x = rows[good], x[good] / top[good, None]
        yield rows, x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A 128-bit digest of label and direction; null if the row can't be linked. Vectors of one direction are copies."""
    for batch in batches:
        labels, digests = batch.column("label").to_pylist(), [None] * batch.num_rows
        for rows, x in _matrices(batch.column("vector")):
            x = x + 0.0  # no negative zeros
            for row, vector in zip(rows.tolist(), x):
                if labels[row] is not None:
                    digests[row] = xxhash.xxh3_128_digest(vector.tobytes() + labels[row].encode())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, "digest"])


def _coded(bits: int, tables: int):
    powers = 1 << np.arange(bits, dtype=np.int64)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, sketches = np.zeros((batch.num_rows, tables), np.int32), np.zeros(batch.num_rows, np.int64)
            for rows, x in _matrices(batch.column("vector")):
                signs = x @ _planes(x.shape[1], max(SKETCH, bits * tables)) > 0
                codes[rows] = signs[:, :bits * tables].reshape(-1, tables, bits) @ powers
                sketches[rows] = np.packbits(signs[:, :SKETCH], axis=1).view(np.int64)[:, 0]
            offsets = pa.array(np.arange(0, codes.size + 1, tables, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sketches), pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))],
                [*batch.schema.names, "sketch", "codes"])

    return coded


def _codes_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _verified(least: float):
    """Pairs with their cosine at ``least`` or above; ``first`` says whether no bucket of an earlier table holds both."""
    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosine = np.full(batch.num_rows, -1.0)
            other = {dimensions.shape[1]: (rows, dimensions) for rows, dimensions in _matrices(batch.column("vector_b"))}
            for rows, x in _matrices(batch.column("vector_a")):
                there, y = other.get(x.shape[1], (rows[:0], x[:0]))
                both, i, j = np.intersect1d(rows, there, assume_unique=True, return_indices=True)
                cosine[both] = np.einsum("ij,ij->i", x[i], y[j])
            linked = np.flatnonzero(cosine >= least)
            found = batch.take(pa.array(linked))
            same = _codes_of(found.column("codes_a")) == _codes_of(found.column("codes_b")) if len(linked) else np.zeros((0, 1), bool)
            first = same.argmax(1) == found.column("seen").to_numpy()
            yield pa.RecordBatch.from_arrays([*(found.column(c) for c in ("a", "b", "weight_a", "weight_b")), pa.array(first)],
                                             ["a", "b", "weight_a", "weight_b", "first"])

    return verified


def _block_pair(least: float):
    """Of the vectors of two blocks, or one with itself: how many each is linked with that no earlier table has, and a
    member of its cluster. Memory is the square of a block."""
    def compared(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group, (first, second) = group.combine_chunks(), (key[0].as_py()[c] for c in ("i", "j"))
        ids, weights = group.column("id").to_numpy(), group.column("weight").to_numpy().astype(np.float64)
        labels, sides = np.asarray(group.column("label").to_pylist()), group.column("block").to_numpy()
        table, codes = group.column("t")[0].as_py(), _codes_of(group.column("codes").combine_chunks())
        out: list[np.ndarray] = []
        for rows, x in _matrices(group.column("vector").combine_chunks()):
            for label in np.unique(labels[rows]):
                mine = labels[rows] == label
                at, y = rows[mine], x[mine]
                left, right = at[sides[at] == first], at[sides[at] == second]
                place = np.zeros(len(ids), np.int64)
                place[at] = np.arange(len(at))
                linked = y[place[left]] @ y[place[right]].T >= least
                linked &= ids[left][:, None] != ids[right][None, :]
                counted = linked.copy()
                for earlier in range(table):
                    counted &= codes[left, earlier][:, None] != codes[right, earlier][None, :]
                n = np.zeros(len(at))
                n[place[left]] += counted @ weights[right]
                if first != second:
                    n[place[right]] += weights[left] @ counted
                root = _clusters(linked, place[left], place[right], len(at))
                some = (n > 0) | (root != np.arange(len(at)))
                out.append(np.stack([ids[at], n.astype(np.int64), ids[at][root]], 1)[some])
        rows = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        return pa.table({"id": rows[:, 0], "n": rows[:, 1], "root": rows[:, 2]})

    return compared


def _clusters(linked: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The smallest place that each place reaches by links."""
    root = np.arange(n)
    while True:
        after = root.copy()
        np.minimum.at(after, left, np.where(linked, root[right][None, :], n).min(1, initial=n))
        np.minimum.at(after, right, np.where(linked, root[left][:, None], n).min(0, initial=n))
        if (after == root).all():
            return root
        root = after


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93,
    recall: float = 0.999, max_paired: int = 64, block: int = 512,
) -> DataFrame:
    """One row per row of ``df``: key, n_links (other rows linked directly), component_id (smallest key reachable) and
    kept (the key is the component's).

    Rows of equal labels that are not null are linked if their cosine is ``least`` or more. A pair exactly there is found
    with probability ``recall``, closer pairs almost always; pairs below are never linked. Vectors that are null, empty or zero,
    or that hold nulls or non-finite numbers, link with nothing, nor do vectors of different dimensions. Equal vectors link,
    so repeated rows count each other. A null key is never the smallest unless all of its component are null; rows that
    share the smallest key are all kept. Other columns are not looked at; an empty table gives an empty result.
    ``max_paired`` and ``block`` only decide how a bucket is searched. Direct links of near copies that all differ are the square of
    their number, which is what counting them costs; the blocks spread it over tasks.
    """
    rows = df.select(F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    marked = rows.mapInArrow(_digests, T.StructType([*rows.schema]).add("digest", "binary"))
    distinct = marked.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.count("*").alias("weight"), F.min("key").alias("key"), F.any_value("label").alias("label"),
        F.any_value("vector").alias("vector"))
    numbered = stored(distinct.withColumn("id", F.monotonically_increasing_id()), "vectors")
    largest = numbered.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, tables = plan(largest, least, recall)
    kept = numbered.select("id", "digest", "key", "weight", "label", "vector")
    vectors = stored(kept.mapInArrow(_coded(bits, tables), T.StructType([*kept.schema]).add("sketch", "long").add(
        "codes", T.ArrayType(T.IntegerType()))), "coded-vectors")

    filed = vectors.select("id", "sketch", F.size("vector").alias("dimensions"), "label", F.posexplode("codes").alias("t", "code")) \
        .select("id", "sketch", F.col("t").cast("short").alias("t"), F.xxhash64("label", "dimensions", "t", "code").alias("bucket"))
    sizes = filed.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    filed = stored(filed.join(sizes, "bucket"), "buckets")

    small = filed.filter(F.col("members") <= max_paired)
    a, b = small.alias("a"), small.alias("b")
    apart = F.bit_count(F.col("a.sketch").bitwiseXOR(F.col("b.sketch")))
    pairs = a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.t") == F.col("b.t")) & (F.col("a.id") < F.col("b.id"))
                   & (apart <= _sketch_bound(least))).groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")) \
        .agg(F.min("a.t").alias("seen"))

    def side(name: str) -> DataFrame:
        return vectors.select(F.col("id").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("weight", "label", "vector", "codes")])

    both = pairs.join(side("a"), "a").join(side("b"), "b").filter("label_a = label_b").select(
        "a", "b", "weight_a", "weight_b", "seen", "vector_a", "vector_b", "codes_a", "codes_b")
    paired = stored(both.mapInArrow(_verified(least), "a long, b long, weight_a long, weight_b long, first boolean"), "links")

    large = filed.filter(F.col("members") > max_paired).select(
        "id", "bucket", "t", F.ceil(F.col("members") / block).cast("int").alias("blocks"))
    large = large.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.col("blocks")).cast("int"))
    dealt = large.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "t", "block", F.struct("bucket", "t", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).alias("group"))
    blocks = dealt.join(vectors.select("id", "weight", "label", "vector", "codes"), "id")
    counted = stored(blocks.groupBy("group").applyInArrow(_block_pair(least), "id long, n long, root long"), "counts")

    first = paired.filter("first")
    links = first.select(F.col("a").alias("id"), F.col("weight_b").alias("n")).union(
        first.select(F.col("b").alias("id"), F.col("weight_a").alias("n"))).union(counted.select("id", "n"))
    links = links.groupBy("id").agg(F.sum("n").alias("n"))
    found = components(paired.select("a", "b").union(counted.filter("id <> root").select(F.col("root").alias("a"), F.col("id").alias("b"))))
    named = vectors.select("id", "digest", "key", "weight").join(found.withColumnRenamed("node", "id"), "id", "left").join(links, "id", "left") \
        .withColumn("root", F.coalesce("root", "id"))
    least_key = named.groupBy("root").agg(F.min("key").alias("component"))
    by_digest = named.join(least_key, "root").select(
        "digest", "component", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"))
    # A digest may belong to a third of all rows: the join splits such a partition (AQE).
    component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component"))
    return marked.select("key", "digest").join(by_digest, "digest", "left").select(
        F.col("key").alias(key), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(F.col("key")).alias("kept"))
