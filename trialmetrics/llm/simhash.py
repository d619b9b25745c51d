"""SimHash near-duplicates through tables of distances to pivots.

A fingerprint has 64 bits in six blocks. Two fingerprints at most two bits apart agree in four whole blocks at
least, so each is filed under its 15 choices of four blocks. Under a file, pairs whose distances to any of the
reference fingerprints (pivots) differ by more than two are discarded by the triangle inequality, and the
survivors are verified bit by bit. A file with many different fingerprints is never paired up: its
members are linked through the fingerprints one bit away, which two of them share exactly if they are at
most two bits apart. Copies fall together before any of this: only distinct fingerprints are compared.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trialmetrics.llm.common import LOWER, bytes_of, slices, stored

SEED = 42
PIECE = 1 << 20  # bytes of a text whose words are held together
_WHITE = re.compile(rb"[ \t-\r]")
BLOCKS = ((0, 11), (11, 11), (22, 11), (33, 11), (44, 10), (54, 10))  # first bit and bits of each
#: Reference fingerprints, from a rule: digests of their numbers.
PIVOTS = [xxhash.xxh64_intdigest(str(i).encode(), seed=SEED) - (1 << 63) for i in range(8)]


def fingerprint(text: bytes, shingle: int) -> int:
    """Bits set in over half of the shingles' hashes. A long text goes by in pieces cut at white space."""
    ones, n, words, at = np.zeros(64, np.int64), 0, [], 0
    while at < len(text):
        stop = at + PIECE
        if stop < len(text):
            found = _WHITE.search(text, stop)
            stop = found.start() if found else len(text)
        words += text[at:stop].translate(LOWER).split()
        at = stop
        if len(words) >= shingle or at >= len(text) and words and not n:
            hashes = _hashes(words, shingle)
            ones += _ones(hashes)
            n += len(hashes)
            words = words[len(words) - shingle + 1:] if shingle > 1 else []
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def _hashes(words: list[bytes], shingle: int) -> np.ndarray:
    """XXH64 of each shingle, or of all words if they are fewer."""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - shingle + 1)
    starts = [0, *ends[:n - 1].tolist()]
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    of = xxhash.xxh64_intdigest
    return np.fromiter((of(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits, counted in pieces of bounded size."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64) if len(bits) < 256 else _columns(bits)
    return total


def _columns(bits: np.ndarray) -> np.ndarray:
    """Sums of columns of 0 and 1: 255 rows fit in a byte, which halves the work of adding wider numbers."""
    whole = len(bits) // 255 * 255
    part = np.add.reduce(bits[:whole].reshape(-1, 255, 64), axis=1, dtype=np.uint8)
    return part.sum(0, dtype=np.int64) + bits[whole:].sum(0, dtype=np.int64)


def fingerprints(df: DataFrame, key: str, text: str, carry: Iterable[str], shingle: int) -> DataFrame:
    rows = df.select(F.col(key).alias("key"), *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)],
                     F.col(text).cast("string").alias("text"))
    kept = [c for c in rows.columns if c != "text"]
    schema = T.StructType([rows.schema[c] for c in kept]).add("fp", "long")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = np.array([fingerprint(text, shingle) for text in bytes_of(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found.view(np.int64))],
                                             [f.name for f in schema])

    return rows.mapInArrow(hashed, schema)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def close_pairs(distinct: DataFrame, bits: int, max_paired: int) -> DataFrame:
    """Links (a, b) between different fingerprints at most ``bits`` (0 to 2) apart: all of them from files
    of up to ``max_paired`` members, and enough to connect the members of larger files."""
    if not 0 <= bits <= 2:
        raise ValueError("files under four of six blocks are exact up to 2 bits")
    masks = []
    for choice in combinations(BLOCKS, 4):
        mask = sum(((1 << n) - 1) << at for at, n in choice)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    table = distinct.select("fp", F.struct(*[_distance(F.col("fp"), F.lit(p)).cast("tinyint").alias(f"d{i}")
                                             for i, p in enumerate(PIVOTS)]).alias("distances"))
    filed = table.withColumn("file", F.explode(F.array(*[
        F.struct(F.lit(i).cast("tinyint").alias("choice"), F.col("fp").bitwiseAND(F.lit(mask)).alias("value"))
        for i, mask in enumerate(masks)])))
    sizes = filed.groupBy("file").agg(F.count("*").alias("members")).filter("members > 1")
    filed = stored(filed.join(sizes, "file"), "simhash-files")

    small = filed.filter(F.col("members") <= max_paired)
    a, b = small.alias("a"), small.alias("b")
    near = F.lit(True)
    for i in range(len(PIVOTS)):
        near &= F.abs(F.col(f"a.distances.d{i}") - F.col(f"b.distances.d{i}")) <= bits
    pairs = a.join(b, (F.col("a.file") == F.col("b.file")) & (F.col("a.fp") < F.col("b.fp")) & near
                   & (_distance(F.col("a.fp"), F.col("b.fp")) <= bits)) \
        .select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    # For 2 bits two members share a neighbour; for 1 bit one is the other's neighbour.
    crowded = filed.filter(F.col("members") > max_paired).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64)])
    around = crowded.select("fp", F.explode(flips).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("neighbour"), (F.col("flip") == 0).alias("itself"))
    if bits == 2:
        hubs = around.groupBy("neighbour").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1")
        linked = around.join(hubs, "neighbour").filter("hub < fp").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    else:
        linked = around.filter(F.lit(bits == 1) & ~F.col("itself")).join(
            crowded.withColumnRenamed("fp", "neighbour"), "neighbour").filter("fp < neighbour") \
            .select(F.col("fp").alias("a"), F.col("neighbour").alias("b"))
    return pairs.union(linked).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes on an edge, the root being the smallest node reachable.

    Alternating stars: every node hooks its larger neighbours, then its smaller ones, onto its smallest
    neighbour, until nothing changes. Each round is written, so a lost executor costs that round only; rounds grow
    with the logarithm of a component, not with its diameter, and no round has more edges than the first.
    """
    edges = stored(edges.select("a", "b"), "stars")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.filter("b > a").join(least, "a").select(F.col("least").alias("a"), "b").distinct()
        down = large.filter("a < b").groupBy("b").agg(F.min("a").alias("least"))
        small = large.join(down, "b").select(F.col("a"), F.col("b"), "least")
        small = small.select(F.explode(F.array(F.struct(F.col("least").alias("a"), F.col("b")),
                                               F.struct(F.col("least").alias("a"), F.col("a").alias("b")))).alias("e")) \
            .select("e.*").filter("a < b").distinct()
        after = stored(small, "stars")
        if after.exceptAll(edges).isEmpty() and edges.exceptAll(after).isEmpty():
            return after.select(F.col("b").alias("node"), F.col("a").alias("root"))
        edges = after


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", carry: Iterable[str] = (), shingle: int = 3, bits: int = 2,
    max_paired: int = 32,
) -> DataFrame:
    """One row per row of ``df``: key, fingerprint, component_id, kept and ``carry`` as carry_0, carry_1, ...

    Words are split at white space, A-Z in lower case; a text of fewer than ``shingle`` words is one
    shingle, and one without words, or null, has the fingerprint zero, which links like any other. Documents
    at most ``bits`` bits apart are linked, and the component is the smallest key reachable (null only if all
    keys are). Repeated rows are in one component, of which the row with the smallest key (null last, then
    the carried columns) is kept; rows equal in all of these are kept together, so carry a row number to
    tell them apart. Other columns are not looked at; an empty table gives an empty result. ``max_paired`` only
    decides how a file of fingerprints is searched, not what is found.
    """
    carry = list(carry)
    rows = stored(fingerprints(df, key, text, carry, shingle), "fingerprints")
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", *[f"carry_{i}" for i in range(len(carry))])
    per_print = stored(rows.groupBy("fp").agg(F.min("key").alias("key"), F.min(order).alias("first")), "prints")
    found = components(close_pairs(per_print.select("fp"), bits, max_paired))
    named = per_print.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = named.groupBy("root").agg(F.min("key").alias("component"), F.min("first").alias("first"))
    by_print = named.select("fp", "root").join(groups, "root").select("fp", "component", "first")
    # A fingerprint may belong to a third of all rows: the join splits such a partition (AQE).
    return rows.join(by_print, "fp").select(
        F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"), (order == F.col("first")).alias("kept"),
        *[f"carry_{i}" for i in range(len(carry))])
