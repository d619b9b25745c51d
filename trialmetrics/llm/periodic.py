"""Runs: stretches of words that repeat with a smallest period at least four times.

Periods are found with string synchronising sets. At scale t, a power of two, every position has the hash of its t words as
its name; a position is in the set if the least name of the positions up to t further on is its own or the last one's. So
membership follows from the 2t words of its context alone, and any t positions in a row hold a member
unless the words around them have a period of a quarter of t or less. Two members that follow each other with equal contexts, t to
2t - 1 words apart, propose that distance as a period. A run of period q in [t, 2t) of four periods or more has such a pair: a
member among its first t positions has its equal one period on, and none between, or q would not be the smallest period.

Positions in highly periodic regions are left out of the set; their small periods are known by then, from smaller scales
or, for one to three words, from comparing the words with those behind them. A proposed period is extended to both sides over the
words themselves, so no result depends on a hash. Documents are searched together, as one sequence in which no two
documents share a symbol.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trialmetrics.llm.common import bytes_of, slices

REPEATS = 4
SHORTEST = 6  # words of a run at least
DIRECT = 3  # periods up to here are found by comparing words with those so far behind
Run = tuple[int, int, int]  # start, length, period
Change = Callable[[object, list[bytes]], list[bytes]]


def runs_of(documents: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each document by start, then period."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))  # larger scales need the long ones only
    sizes = np.fromiter((len(documents[i]) for i in order), np.int64, len(documents))
    number: defaultdict[bytes, int] = defaultdict(count().__next__)
    starts = np.cumsum(sizes + 1) - (sizes + 1)  # a symbol of its own behind each document
    words = np.empty(int(sizes.sum()) + len(documents), np.int64)
    for i, start, size in zip(order, starts.tolist(), sizes.tolist()):
        words[start:start + size] = np.fromiter(map(number.__getitem__, documents[i]), np.int64, size)
        words[start + size] = -1 - start
    found = _repetitions(words, sizes)
    out: list[list[Run]] = [[] for _ in documents]
    if found:
        at = np.array(sorted((start, period, end) for start, end, period in found))
        of = np.searchsorted(starts, at[:, 0], "right") - 1
        for i, (start, period, end) in zip(of.tolist(), at.tolist()):
            if end - start >= SHORTEST:
                out[order[i]].append((start - int(starts[i]), end - start, period))
    return out


def _repetitions(words: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all maximal repetitions of ``REPEATS`` periods or more, in documents of ``sizes``
    words, the longest first."""
    found: dict[tuple[int, int], int] = {}
    longest = int(sizes[0]) if len(sizes) else 0
    for period in range(1, min(DIRECT, longest // REPEATS) + 1):
        same = np.flatnonzero(np.diff(np.concatenate([[0], words[:-period] == words[period:], [0]]).astype(np.int8)))
        first, last = same[::2], same[1::2]
        long = last - first >= (REPEATS - 1) * period
        for start, end in zip(first[long].tolist(), (last[long] + period).tolist()):
            found.setdefault((start, end), period)  # a multiple of the smallest period gives the same stretch
    names, size = _mixed(words.view(np.uint64), np.uint64(0x9E3779B97F4A7C15)), 1
    while 2 * REPEATS * size <= longest:
        long = sizes[:np.searchsorted(-sizes, -2 * REPEATS * size, "right")]  # enough for periods of the next scale
        names = _joined(names[:int((long + 1).sum()) - size + 1], size)
        size *= 2
        if size > DIRECT:
            _at_scale(words, names, size, found)
    return [(start, end, period) for (start, end), period in found.items()]


def _mixed(x: np.ndarray, salt: np.uint64) -> np.ndarray:
    """A 64-bit hash of each number."""
    x = x + salt
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(names: np.ndarray, size: int) -> np.ndarray:
    """Names of stretches twice as long, from those of their halves."""
    return _mixed(names[:-size] * np.uint64(0x9E3779B97F4A7C15) + names[size:], np.uint64(size))


def _at_scale(words: np.ndarray, names: np.ndarray, scale: int, found: dict[tuple[int, int], int]) -> None:
    """Add the repetitions whose period is in [scale, 2 * scale)."""
    n = len(names) - scale  # positions with a whole context
    ranks = names.copy()
    highest = np.uint64(0xFFFFFFFFFFFFFFFF)
    for (start, end), period in found.items():
        if REPEATS * period <= scale <= end - start:
            ranks[start:end - scale + 1] = highest
    least, width = ranks, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:n], ranks[scale:scale + n])  # of a position and the ``scale`` after it
    members = np.flatnonzero((least != highest) & ((least == ranks[:n]) | (least == ranks[scale:scale + n])))
    contexts = _joined(names, scale)[members]
    order = np.argsort(contexts, kind="stable")
    members, contexts = members[order], contexts[order]
    apart = np.diff(members)
    near = np.flatnonzero((contexts[1:] == contexts[:-1]) & (apart >= scale) & (apart < 2 * scale))
    seen: dict[int, int] = {}  # period to the end of the stretch looked at last
    for i, period in sorted(zip(members[near].tolist(), apart[near].tolist())):
        if i + period < seen.get(period, 0):
            continue
        start, end = _stretch(words, i, period)
        seen[period] = end
        if end - start >= REPEATS * period:
            found.setdefault((start, end), period)


def _stretch(words: np.ndarray, i: int, period: int) -> tuple[int, int]:
    """The maximal stretch around ``i`` in which words ``period`` apart are equal, in steps that double."""
    end, step = i, period
    while end + period < len(words):
        a = words[end:end + step]
        b = words[end + period:end + period + step]
        differ = np.flatnonzero(a[:len(b)] != b)
        if len(differ):
            end += int(differ[0])
            break
        end += len(b)
        step *= 2
    start, step = i, period
    while start > 0:
        low = max(0, start - step)
        differ = np.flatnonzero(words[low:start] != words[low + period:start + period])
        if len(differ):
            start = low + int(differ[-1]) + 1
            break
        start = low
        step *= 2
    return start, end + period


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def with_repeats(key: object, words: list[bytes]) -> list[bytes]:
    """Every tenth document, by CRC-32 of its key, with an end that repeats: documents to find runs in."""
    h = zlib.crc32(str("" if key is None else key).encode())
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + period]
    return words[:a] + (unit * -(-(n - a) // period))[:n - a]


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", change: Change | None = None) -> DataFrame:
    """One row per row of ``df``: key, runs (start, length, period) by start and period, and the text with every run
    collapsed to one period, its words joined by one space.

    Words are split at white space. A run is a maximal stretch of words with a smallest period q, of 4q and of six
    words at least. ``change`` is applied to the words of each key first. Null and empty texts have no words and no runs;
    equal texts give equal rows, other columns are not looked at, and an empty table gives an empty result. A text is held whole.
    """
    def whole(words: list[bytes], runs: list[Run]) -> tuple:
        return [dict(zip(("start", "length", "period"), run)) for run in runs], b" ".join(collapsed(words, runs)).decode()

    kind = "array<struct<start:bigint,length:bigint,period:bigint>>"
    return _searched(df, key, text, change, [("runs", kind), ("collapsed", "string")], whole)


def run_digests(df: DataFrame, key: str = "doc_id", text: str = "text", change: Change | None = None) -> DataFrame:
    """As :func:`periodic_runs`, but digests: key, n_runs, start, length, period and exponent_milli of the run with the
    greatest length / period (of equal ones the first start, then the smallest period; nulls without a run), and the SHA-256 of
    all runs as lines of start, length and period, and of the collapsed text."""
    columns = [(name, "bigint") for name in ("n_runs", "start", "length", "period", "exponent_milli")]
    columns += [("runs_sha256", "string"), ("collapsed_sha256", "string")]

    def digests(words: list[bytes], runs: list[Run]) -> tuple:
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        lines = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest())

    return _searched(df, key, text, change, columns, digests)


def _searched(df: DataFrame, key: str, text: str, change: Change | None, columns: list[tuple[str, str]],
              of: Callable[[list[bytes], list[Run]], tuple]) -> DataFrame:
    """``of`` gives the values of ``columns`` for the words of a row and their runs."""
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns)
    schema = T.StructType([rows.schema["key"], *T.StructType.fromDDL(ddl)])

    kinds = [field.type for field in to_arrow_schema(schema)][1:]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            documents = [text.split() for text in bytes_of(batch, "text")]
            if change:
                documents = [change(k, words) for k, words in zip(batch.column("key").to_pylist(), documents)]
            values = [of(words, runs) for words, runs in zip(documents, runs_of(documents))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *[pa.array(column, kind) for column, kind in zip(zip(*values), kinds)]], schema.names)

    return rows.mapInArrow(search, schema).withColumnRenamed("key", key)
