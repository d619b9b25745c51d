"""Katz backoff over word bigrams, from counts to scores, without a model that any task holds whole.

    P(b | a) = d(r) r / C(a)      if the pair was seen r > 0 times
             = alpha(a) P(b)      otherwise
    P(b)     = d(r) r / N         if the word was seen, else the mass that discounting left

d are Good-Turing discounts of counts 1 to 5 from smoothed counts of counts, and alpha(a) = (1 - sum of the seen P(b|a)) / (1 - sum of their P(b)),
so the probabilities after each context add up to one. All words never seen are one class.

Word counts are a stored table; the most frequent words, at most ``head`` of them, are known to all tasks and the rest
comes by join. Pairs travel once: a task packs the pairs of its texts, with the row and how often, into
compressed blocks for the bucket of the context. A bucket counts its pairs, scores what it can and hands on sums
for each row, what it knows of each context, and the pairs whose context or word needs a join. A context too
frequent for one bucket is spread by its next word; a pair of two such words by row, its counts going to all of
its buckets. Words are told apart by 62 bits of their hash.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trialmetrics.llm.common import LOWER, bytes_of, fresh, numbered, slices, stored

LOW = 5  # counts up to this are discounted
END, START, FIRST = 0, 1, 2  # codes of the end, of the context of a first word, and of the first frequent word
RARE = 1 << 62
BROADCAST_ROWS = 500_000  # of four numbers each
COUNT_ONLY = np.uint32(0xFFFFFFFF)
DOC, CONTEXT, RARE_PAIR, OPEN, OPEN_SPREAD, TOTALS, TEXT, RARE_WORD = range(8)
PACKED = "bucket int, first_row long, entries int, block binary, texts boolean"
FOUND = T.StructType([T.StructField("kind", T.ByteType()), *[T.StructField(c, T.LongType()) for c in ("row", "a", "b")],
                      T.StructField("x", T.DoubleType()), T.StructField("n", T.LongType()),
                      *[T.StructField(f"n{r}", T.LongType()) for r in range(1, LOW + 1)]])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def discounts(counts: list[int]) -> list[float]:
    """Good-Turing discounts of 1 to LOW from how many types were seen 1 to LOW + 1 times.

    Copies make these counts uneven, so they are smoothed first, by the line through their logarithms (Simple Good-Turing):
    n(r) = A * r ** slope. Katz's discount of r is then (((r + 1) / r) ** (slope + 1) - s) / (1 - s) with s = (LOW + 1) **
    (slope + 1), which lies between 0 and 1 for every slope under -1; a flatter line counts as one of -1, whose discounts are the
    limit of that. Only where fewer than two counts are known there is no line, and every type gives up half a count.
    """
    known = [(r, n) for r, n in enumerate(counts, 1) if n]
    if len(known) < 2:
        return [(r - 0.5) / r for r in range(1, LOW + 1)]
    # Types of a count stand for the counts around it that no type has.
    ends = [0, *[r for r, _ in known]]
    last = 2 * ends[-1] - ends[-2]
    x = np.log([r for r, _ in known])
    y = np.log([2 * n / (after - before) for (_, n), before, after in zip(known, ends, [*ends[2:], last])])
    slope = float(((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum())
    if slope > -1 - 1e-6:
        return [1 - math.log((r + 1) / r) / math.log(LOW + 1) for r in range(1, LOW + 1)]
    s = (LOW + 1) ** (slope + 1)
    return [(((r + 1) / r) ** (slope + 1) - s) / (1 - s) for r in range(1, LOW + 1)]


@dataclass
class Words:
    """What is known of all words: totals, discounts, and the codes and counts of the frequent ones."""

    tokens: int
    types: int
    texts: int
    d: list[float]
    left: float  # tokens' worth of probability that discounting leaves for unseen words
    extra: int  # if no count is low nothing is left; the unseen class then counts as one token more
    hashes: np.ndarray  # sorted
    counts: np.ndarray  # by code, from END on

    def probability(self, counts: np.ndarray) -> np.ndarray:
        d = np.ones(LOW + 1)
        d[1:] = self.d
        return counts * d[np.where(counts <= LOW, counts, 0)] / (self.tokens + self.extra)

    @property
    def unseen(self) -> float:
        return (self.left + self.extra) / (self.tokens + self.extra)


def _codes(flat: list[bytes], hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the different words, and for each word which of these it is."""
    index: defaultdict[bytes, int] = defaultdict(count().__next__)
    of = np.fromiter(map(index.__getitem__, flat), np.int64, len(flat))
    found = np.fromiter((xxhash.xxh64_intdigest(w) >> 2 for w in index), np.int64, len(index))
    if not len(hashes):
        return found | RARE, of
    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
    return np.where(hashes[at] == found, at + FIRST, found | RARE), of


def _split(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    words = [t.translate(LOWER).split() for t in texts]
    return list(chain.from_iterable(words)), np.fromiter(map(len, words), np.int64, len(words))


def word_counts(rows: DataFrame) -> DataFrame:
    """(h, n): the words of training texts by hash, with their counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            h, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return h, np.bincount(at, np.concatenate([x[1] for x in held])).astype(np.int64)

        for batch in slices(batches, "text"):
            flat, _ = _split(bytes_of(batch, "text"))
            if not flat:
                continue
            codes, of = _codes(flat, np.empty(0, np.int64))
            held.append((codes & ~RARE, np.bincount(of)))
            size += len(codes)
            if size > 1_000_000:
                held = [summed()]
                size = len(held[0][0])
                if size > 500_000:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, held[0])), ["h", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, summed())), ["h", "n"])

    return rows.filter("not held").select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def _known(rows: DataFrame, words: DataFrame, head: int) -> Words:
    texts = rows.filter("not held").count()
    low = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"),
                    *[F.coalesce(F.sum((F.col("n") == r).cast("long")), F.lit(0)) for r in range(1, LOW + 2)]).first()
    tokens, types, counts = low[0] + texts, low[1] + (texts > 0), list(low[2:])
    if 0 < texts <= LOW + 1:
        counts[texts - 1] += 1
    # Words of at least the least power of two that leaves no more than ``head``.
    power, above = 0, low[1]
    for row in words.groupBy(F.floor(F.log2("n")).alias("power")).count().orderBy("power").collect():
        if above <= head:
            break
        power, above = row["power"] + 1, above - row["count"]
    frequent = words.filter(F.col("n") >= (1 << power)).toPandas().sort_values("h")
    d = discounts(counts)
    left = sum(r * n * (1 - x) for r, (n, x) in enumerate(zip(counts, d), 1))
    return Words(tokens, types, texts, d, left, int(not any(counts[:LOW])), frequent["h"].to_numpy(np.int64),
                 np.concatenate([[texts, texts], frequent["n"].to_numpy(np.int64)]))


@dataclass
class Buckets:
    """Where a pair goes. ``limit`` is how often a word may come before its pairs are spread."""

    number: int
    limit: int
    counts: np.ndarray

    def spread(self, codes: np.ndarray) -> np.ndarray:
        """Over how many buckets the pairs of a context are dealt by their word."""
        wanted = -(-self.counts[np.where(codes < RARE, codes, END)] // self.limit)
        return np.where(codes < RARE, wanted, 1).clip(1, self.number)

    def home(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((self.mixed(a) % self.number) + self.mixed(b) % self.spread(a)) % self.number

    def salts(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Over how many buckets the rows of a pair are dealt; 1 unless both words are frequent."""
        return np.minimum(self.spread(a), self.spread(b))

    @staticmethod
    def mixed(codes: np.ndarray) -> np.ndarray:
        x = codes.astype(np.uint64) * _MIX
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(8)).astype(np.int64)


def _planes(column: np.ndarray) -> bytes:
    """The bytes of a column by their place in the number: equal high bytes then take no room."""
    return column.view(np.uint8).reshape(len(column), column.itemsize).T.tobytes()


def _unplaned(data: memoryview, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not n:
        return np.empty(0, kind)
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width).reshape(width, n).T).view(kind).ravel()


LAYOUT = (np.int64, np.int64, np.uint32, np.uint32)  # context, word, row after the first or COUNT_ONLY, twice n + held


def _pack(columns: tuple) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        b"".join(_planes(c.astype(kind)) for c, kind in zip(columns, LAYOUT)))


def _unpack(block: bytes, n: int) -> list[np.ndarray]:
    data, at, out = memoryview(zstandard.ZstdDecompressor().decompress(block)), 0, []
    for kind in LAYOUT:
        out.append(_unplaned(data[at:], n, kind))
        at += n * np.dtype(kind).itemsize
    return out


def _packed(buckets: Buckets, a, b, row, held) -> Iterator[pa.RecordBatch]:
    """Blocks of the pairs of some rows, by bucket."""
    first = int(row.min())
    if int(row.max()) - first >= int(COUNT_ONLY):  # files of a task may be far apart
        for part in np.unique(row >> 31):
            yield from _packed(buckets, *(x[row >> 31 == part] for x in (a, b, row, held)))
        return
    salts = buckets.salts(a, b)
    home = buckets.home(a, b)
    bucket = (home + np.where(salts > 1, row % salts, 0)) % buckets.number
    # By bucket, context and word, each but the first by some bits of its hash. Rows ascend already and the sort is
    # stable, so only a collision can part equal pairs of a row; they are added up in the bucket.
    mixed = (buckets.mixed(a) & 0xFFFFFF) << 20 | buckets.mixed(b) & 0xFFFFF
    entry = np.argsort((bucket << 44 | mixed) if buckets.number < 1 << 19 else bucket, kind="stable")
    columns = [x[entry] for x in (bucket, a, b, row, held)]
    new = np.ones(len(entry), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    starts = np.flatnonzero(new)
    n = np.diff(np.append(starts, len(entry)))
    bucket, a, b, row, held = (c[starts] for c in columns)
    after, times = (row - first).astype(np.uint32), (2 * n + held).astype(np.uint32)
    spread = np.flatnonzero((salts[entry][starts] > 1) & ~held)
    if len(spread):
        # Pairs that are dealt by row: their count in these rows goes to each of their buckets.
        pair = np.lexsort((b[spread], a[spread]))
        sa, sb, sn = a[spread][pair], b[spread][pair], n[spread][pair]
        edge = np.flatnonzero(np.append(True, (sa[1:] != sa[:-1]) | (sb[1:] != sb[:-1])))
        sa, sb, sn = sa[edge], sb[edge], np.add.reduceat(sn, edge)
        over = buckets.salts(sa, sb)
        which = np.repeat(np.arange(len(sa)), over)
        salt = np.arange(len(which)) - np.repeat(np.cumsum(over) - over, over)
        bucket = np.concatenate([bucket, (buckets.home(sa, sb)[which] + salt) % buckets.number])
        a, b = np.concatenate([a, sa[which]]), np.concatenate([b, sb[which]])
        after = np.concatenate([after, np.full(len(which), COUNT_ONLY)])
        times = np.concatenate([times, (2 * sn[which]).astype(np.uint32)])
        order = np.argsort(bucket, kind="stable")
        bucket, a, b, after, times = (c[order] for c in (bucket, a, b, after, times))
    cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    ends = np.append(cuts[1:], len(bucket))
    yield pa.RecordBatch.from_arrays([
        pa.array(bucket[cuts].astype(np.int32)), pa.array(np.full(len(cuts), first)), pa.array((ends - cuts).astype(np.int32)),
        pa.array([_pack((a[i:j], b[i:j], after[i:j], times[i:j])) for i, j in zip(cuts, ends)], pa.binary()),
        pa.array(np.zeros(len(cuts), bool))], ["bucket", "first_row", "entries", "block", "texts"])


#: Of texts: row, tokens, known tokens and base score; then of their rare words: row, hash and how often.
TEXT_LAYOUT = (np.int64, np.int64, np.int64, np.float64)
WORD_LAYOUT = (np.int64, np.int64, np.int64)


def _of_texts(words: Words, rows: np.ndarray, codes: np.ndarray, n: np.ndarray, number: int) -> pa.RecordBatch:
    """What texts have by themselves, on its way to a bucket that hands it on. Texts are split only once for it and their pairs."""
    log = np.log10((words.counts + 1) / (words.tokens + words.types + 1))
    doc, rare = np.repeat(np.arange(len(n)), n), codes >= RARE
    base = np.bincount(doc, np.where(rare, 0, log[np.where(rare, END, codes)]), len(n)) + log[END]
    have = np.bincount(doc, ~rare, len(n)).astype(np.int64) + (words.texts > 0)
    pairs = np.stack([doc[rare], codes[rare] & ~RARE])
    pairs = pairs[:, np.lexsort(pairs[::-1])]
    edge = np.flatnonzero(np.append(True, (pairs[:, 1:] != pairs[:, :-1]).any(0))) if pairs.shape[1] else np.empty(0, np.int64)
    times = np.diff(np.append(edge, pairs.shape[1]))
    columns = [rows, n + 1, have, base, rows[pairs[0, edge]], pairs[1, edge], times]
    block = zstandard.ZstdCompressor(level=1).compress(
        b"".join(_planes(c.astype(kind)) for c, kind in zip(columns, TEXT_LAYOUT + WORD_LAYOUT)))
    bucket = int(Buckets.mixed(rows[:1])[0]) % number
    return pa.RecordBatch.from_arrays([
        pa.array([bucket], pa.int32()), pa.array([len(edge)], pa.int64()), pa.array([len(n)], pa.int32()), pa.array([block], pa.binary()),
        pa.array([True])], ["bucket", "first_row", "entries", "block", "texts"])


def _told_of_texts(block: bytes, texts: int, words: int) -> Iterator[pa.RecordBatch]:
    data, at, columns = memoryview(zstandard.ZstdDecompressor().decompress(block)), 0, []
    for kind, size in [*((kind, texts) for kind in TEXT_LAYOUT), *((kind, words) for kind in WORD_LAYOUT)]:
        columns.append(_unplaned(data[at:], size, kind))
        at += size * np.dtype(kind).itemsize
    rows, n, have, base, of, word, times = columns
    emit = _Rows()
    emit.add(TEXT, row=rows, x=base, n=n, low=[have])
    emit.add(RARE_WORD, row=of, a=word, n=times)
    yield from emit.batches


def pair_blocks(rows: DataFrame, known: Broadcast, buckets: Broadcast, at_once: int = 600_000) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in slices(batches, "text"):
            flat, n = _split(bytes_of(batch, "text"))
            codes, of = _codes(flat, Words(**known.value).hashes)
            yield _of_texts(Words(**known.value), batch.column("row").to_numpy(), codes[of] if len(flat) else np.empty(0, np.int64), n,
                            Buckets(**buckets.value).number)
            ends = np.cumsum(n + 1) - 1
            words = np.zeros(len(flat) + len(n), np.int64)
            inside = np.ones(len(words), bool)
            inside[ends] = False
            words[inside] = codes[of] if len(flat) else []
            contexts = np.append(START, words[:-1])
            contexts[np.append(0, ends[:-1] + 1)] = START
            row = np.repeat(batch.column("row").to_numpy(), n + 1)
            out = np.repeat(batch.column("held").to_numpy(zero_copy_only=False).astype(bool), n + 1)
            held.append((contexts, words, row, out))
            size += len(words)
            if size >= at_once:
                yield from _packed(Buckets(**buckets.value), *map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield from _packed(Buckets(**buckets.value), *map(np.concatenate, zip(*held)))

    return rows.select("row", "held", "text").mapInArrow(pack, PACKED)


def _counted(blocks: list[tuple], bucket: int, known: Words, buckets: Buckets) -> Iterator[pa.RecordBatch]:
    """What one bucket finds out: see the kinds of rows at the top of the module."""
    columns = [_unpack(block, n) for _, n, block in blocks]
    a, b, after, times = (np.concatenate(c) for c in zip(*columns))
    first = np.repeat(np.array([f for f, _, _ in blocks], np.int64), [n for _, n, _ in blocks])
    del columns
    order = np.lexsort((b, a))
    a, b, after, times, first = a[order], b[order], after[order], times[order], first[order]
    del order
    n, held, only = (times >> 1).astype(np.int64), (times & 1).astype(bool), after == COUNT_ONLY
    row = first + after
    pair = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
    pa_, pb = a[pair], b[pair]
    of = np.repeat(np.arange(len(pair)), np.diff(np.append(pair, len(a))))
    salted = buckets.salts(pa_, pb) > 1
    r = np.bincount(of, np.where(~held & (only | ~salted[of]), n, 0), len(pair)).astype(np.int64)

    seen, mine = r > 0, buckets.home(pa_, pb) == bucket
    emit = _Rows()
    totals = [int(((r == k) & mine).sum()) for k in range(1, LOW + 2)]
    emit.add(TOTALS, n=[totals[LOW]], low=[[t] for t in totals[:LOW]])

    # Contexts: of what is seen here of each, how many pairs of each low count, all counts, and P of frequent words.
    context = np.flatnonzero(np.append(True, pa_[1:] != pa_[:-1]))
    cof = np.repeat(np.arange(len(context)), np.diff(np.append(context, len(pa_))))
    rare = pb >= RARE
    p = np.where(rare, 0.0, known.probability(known.counts[np.where(rare, END, pb)]))
    own = seen & mine
    c_low = [np.bincount(cof, own & (r == k), len(context)).astype(np.int64) for k in range(1, LOW + 1)]
    c_sum = np.bincount(cof, np.where(own, r, 0), len(context)).astype(np.int64)
    c_p = np.bincount(cof, np.where(own, p, 0), len(context))
    told = np.flatnonzero(c_sum)
    emit.add(CONTEXT, a=pa_[context][told], x=c_p[told], n=c_sum[told], low=[c[told] for c in c_low])
    tail = np.flatnonzero(own & rare)
    emit.add(RARE_PAIR, a=pa_[tail], b=pb[tail])

    # Rows. A spread context is known in part only here, so its total comes by join.
    spread = buckets.spread(pa_[context]) > 1
    total = c_sum + (sum(c_low) == 0)
    inside = ~only
    of, row, n = of[inside], row[inside], n[inside]
    was, where = seen[of], cof[of]
    x = np.where(was, n * np.log10(np.maximum(r, 1))[of], 0.0)
    x -= np.where(was & ~spread[where], n * np.log10(np.maximum(total, 1))[where], 0.0)
    docs, at = np.unique(row[was], return_inverse=True)
    if len(docs):
        emit.add(DOC, row=docs, x=np.bincount(at, x[was], len(docs)), low=[
            np.bincount(at, np.where(r[of[was]] == k, n[was], 0), len(docs)).astype(np.int64) for k in range(1, LOW + 1)])
    for kind, open_ in ((OPEN, ~was & ~spread[where]), (OPEN_SPREAD, spread[where])):
        if open_.any():
            emit.add(kind, **_open(pa_, pb, rare, p, of[open_], row[open_], n[open_], was[open_]))
    yield from emit.batches


def _open(pa_, pb, rare, p, of, row, n, was) -> dict:
    """What is left to score of some pairs, summed by row, context and word (-1 if the word needs no join)."""
    word = np.where(~was & rare[of], pb[of], -1)
    context = pa_[of]
    order = np.lexsort((word, context, row))
    of, row, n, was, word, context = (c[order] for c in (of, row, n, was, word, context))
    edge = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (context[1:] != context[:-1]) | (word[1:] != word[:-1])))
    log_p = np.where(was | rare[of], 0.0, n * np.log10(np.where(p[of] > 0, p[of], 1.0)))
    return {"row": row[edge], "a": context[edge], "b": word[edge], "x": np.add.reduceat(log_p, edge),
            "n": np.add.reduceat(np.where(was, 0, n), edge), "low": [np.add.reduceat(np.where(was, n, 0), edge)]}


class _Rows:
    def __init__(self):
        self.batches: list[pa.RecordBatch] = []

    def add(self, kind: int, low=(), **columns) -> None:
        values = {**columns, **{f"n{r}": c for r, c in enumerate(low, 1)}}
        size = len(next(iter(values.values())))
        types = [pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.float64()] + [pa.int64()] * (LOW + 1)
        values["kind"] = np.full(size, kind, np.int8)
        self.batches.append(pa.RecordBatch.from_arrays(
            [pa.array(values[f.name], t) if f.name in values else pa.nulls(size, t) for f, t in zip(FOUND, types)],
            [f.name for f in FOUND]))


def counted(blocks: DataFrame, known: Broadcast, buckets: Broadcast, number: int) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            for first, n, block, texts in zip(*(batch.column(c).to_pylist() for c in ("first_row", "entries", "block", "texts"))):
                if texts:
                    yield from _told_of_texts(block, n, first)
                else:
                    held.append((first, n, block))
        if held:
            yield from _counted(held, TaskContext.get().partitionId(), Words(**known.value), Buckets(**buckets.value))

    return blocks.repartitionById(number, "bucket").mapInArrow(count, FOUND)


def _probability(n: Column, known: Words) -> Column:
    """P of a word by its count; null is a word never seen."""
    share = n / float(known.tokens + known.extra)
    out = share
    for r, d in enumerate(known.d, 1):
        out = F.when(n == r, share * d).otherwise(out)
    return F.coalesce(out, F.lit(known.unseen))


def scored(
    df: DataFrame, key: str = "doc_id", text: str = "text", held_out: Column | None = None, head: int = 1 << 18,
    bucket_tokens: int = 1_000_000,
) -> DataFrame:
    """One row per row of ``df``: key, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Training is on the rows for which ``held_out`` is not true. Null and empty texts are the end alone: one token.
    Repeated rows count as often as they come and score alike. With nothing to train on, everything is of the unseen
    class and scores 0. An empty table gives an empty result; other columns are not looked at. ``df``
    has to be a scan of a written table, whose rows keep their numbers. ``head`` and ``bucket_tokens`` bound the
    memory of a task and change nothing else. A bucket holds the rows of a pair compressed, some bytes each.
    """
    spark = df.sparkSession
    number_column = fresh(df, "row")
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rows = numbered(df, number_column).select(
        F.col(number_column).alias("row"), F.col(key).alias("key"), held.alias("held"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = stored(word_counts(rows), "word-counts")
    known = _known(rows, words, head)
    number = max(-(-known.tokens * 6 // 5 // bucket_tokens), int(spark.conf.get("spark.sql.shuffle.partitions")))
    limit = max(1, known.tokens // (4 * number))
    # As plain arrays, so that executors need not have the package.
    told = spark.sparkContext.broadcast(vars(known))
    buckets = spark.sparkContext.broadcast(vars(Buckets(number, limit, known.counts)))
    found = stored(counted(pair_blocks(rows, told, buckets), told, buckets, number), "pair-counts")

    low = [f"n{r}" for r in range(1, LOW + 1)]
    totals = found.filter(f"kind = {TOTALS}").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in (*low, "n")]).first()
    d = discounts(list(totals))
    log_d = sum((F.col(c) * math.log10(x) for c, x in zip(low, d)), F.lit(0.0))

    p_rare = found.filter(f"kind = {RARE_PAIR}").select("a", F.col("b").bitwiseAND(F.lit(RARE - 1)).alias("h")) \
        .join(words, "h").groupBy("a").agg(F.sum(_probability(F.col("n"), known)).alias("p_rare"))
    contexts = found.filter(f"kind = {CONTEXT}").groupBy("a").agg(
        F.sum("x").alias("p"), F.sum("n").alias("total"), *[F.sum(c).alias(c) for c in low]).join(p_rare, "a", "left")
    extra = (sum((F.col(c) for c in low), F.lit(0)) == 0).cast("int")
    left = sum((F.col(c) * (r * (1 - x)) for r, (c, x) in enumerate(zip(low, d), 1)), F.lit(0.0)) + extra
    total = F.col("total") + extra
    unseen = F.lit(1.0) - F.col("p") - F.coalesce("p_rare", F.lit(0.0))
    contexts = contexts.select("a", "total", F.log10(total).alias("log_total"), (F.log10(left / total) - F.log10(
        F.greatest(unseen, F.lit(known.unseen)))).alias("log_alpha"))

    of_rare = F.when(F.col("b") >= 0, F.col("times") * F.log10(_probability(F.col("n"), known))).otherwise(F.lit(0.0))
    columns = ["row", "a", "x", F.col("n").alias("times"), F.col("n1").alias("seen"), "b",
               F.when(F.col("b") >= 0, F.col("b").bitwiseAND(F.lit(RARE - 1))).alias("h")]
    # A context is spread if it comes more than ``limit`` times, so there are at most 4 * number of them: known to be
    # few enough to broadcast, or left to Spark, which splits what a frequent one is joined to.
    spread = contexts.filter(F.col("total") > limit)
    if 4 * number <= BROADCAST_ROWS:
        spread = F.broadcast(spread)
    opened = found.filter(f"kind = {OPEN}").select(*columns).join(contexts, "a", "left").unionByName(
        found.filter(f"kind = {OPEN_SPREAD}").select(*columns).join(spread, "a", "left"))
    opened = opened.join(words, "h", "left").select("row", (
        F.col("x") + of_rare + F.col("times") * F.coalesce("log_alpha", F.lit(0.0))
        - F.col("seen") * F.coalesce("log_total", F.lit(0.0))).alias("x"))
    done = found.filter(f"kind = {DOC}").select("row", (F.col("x") + log_d).alias("x"))
    scores = done.union(opened).groupBy("row").agg(F.sum("x").alias("score"))

    texts = rows.select("row", "key", "held").join(found.filter(f"kind = {TEXT}").select(
        "row", F.col("n").alias("n_tokens"), F.col("n1").alias("n_known"), F.col("x").alias("base")), "row")
    log_base = F.log10((F.coalesce("c", F.lit(0)) + 1) / float(known.tokens + known.types + 1))
    rare = found.filter(f"kind = {RARE_WORD}").select("row", F.col("a").alias("h"), F.col("n").alias("times")) \
        .join(words.withColumnRenamed("n", "c"), "h", "left").groupBy("row").agg(
            F.sum(F.col("times") * log_base).alias("rare_base"),
            F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known"))
    return texts.join(rare, "row", "left").join(scores, "row", "left").select(
        F.col("key").alias(key), F.col("held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"), F.lit(known.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), F.coalesce("score", F.lit(0.0)).alias("score"))
