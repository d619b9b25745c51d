"""Benchmark decontamination: windows of benchmark words in a broadcast hash set, scanned over training texts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F, types as T

from trialmetrics.llm.common import LOWER, bytes_of, slices

#: ASCII characters outside 0-9 and a-z separate words; A-Z are lower-cased first. Places stay the same.
_SPLIT = bytes(b if b >= 128 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in LOWER)
_WORD = re.compile(rb"[^ ]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def _hash(columns) -> np.ndarray:
    """One hash for each place over equally long columns of word codes."""
    out = np.uint64(0)
    for codes in columns:
        out = (out ^ codes.astype(np.uint64)) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


class Windows:
    """The windows of some items: codes of their words from 1 on, and each window's items, by its length."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.codes: dict[bytes, int] = {}
        self.items: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            codes = [self.codes.setdefault(word, len(self.codes) + 1) for word in words_of(text)]
            n = min(width, len(codes))
            for i in range(len(codes) - n + 1 if n else 0):
                self.items[n][tuple(codes[i:i + n])].add(item)
        self.hashes = {n: np.unique(_hash(np.array(list(windows), np.int64).T)) for n, windows in self.items.items()}

    def occurrences(self, codes: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """(place, words, items) of each window in a row of word codes; 0 is a word of no item. A place
        is looked up by hash and then verified word by word."""
        known = np.concatenate([[0], np.cumsum(codes != 0)])
        for n, hashes in self.hashes.items():
            places = np.flatnonzero(known[n:] - known[:len(known) - n] == n) if len(codes) >= n else []
            if not len(places):
                continue
            found = _hash(codes[places + i] for i in range(n))
            at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
            for place in places[hashes[at] == found].tolist():
                if items := self.items[n].get(tuple(codes[place:place + n].tolist())):
                    yield place, n, items


def _blocks(benchmark: DataFrame, key: str, text: str, limit: int) -> list[Broadcast]:
    """The items in broadcasts of about ``limit`` bytes of text each. Rows come one partition at a time."""
    context, blocks, held, size = benchmark.sparkSession.sparkContext, [], [], 0
    rows = benchmark.select(F.coalesce(F.col(key).cast("string"), F.lit("")), F.col(text).cast("binary")).na.drop()
    for item, value in rows.toLocalIterator():
        if held and size + len(value) > limit:
            blocks.append(context.broadcast(held))
            held, size = [], 0
        held.append((item, bytes(value)))
        size += len(value)
    return [*blocks, context.broadcast(held)]


def _hits(texts: list[bytes], blocks: list[Broadcast], width: int, only: dict) -> tuple[list[int], list, list]:
    """For each text the number of words, a mask of words hit or None, and the items that hit it.

    One block at a time is held as a table; a single block, the usual case, is kept over batches in ``only``.
    """
    words = [words_of(text) for text in texts]
    counts = [len(w) for w in words]
    starts = np.concatenate([[0], np.cumsum([n + 1 for n in counts])])
    marks, items = np.zeros(starts[-1] + 1, np.int64), defaultdict(set)
    for block in blocks:
        windows = only.get("windows") or Windows(block.value, width)
        if len(blocks) == 1:
            only["windows"] = windows
        look = windows.codes.get
        codes = np.fromiter((c for w in words for c in (*[look(x, 0) for x in w], 0)), np.int64, starts[-1])
        for place, n, of in windows.occurrences(codes):
            marks[place] += 1
            marks[place + n] -= 1
            items[int(np.searchsorted(starts, place, "right")) - 1] |= of
    hit = np.cumsum(marks) > 0
    masks = [hit[starts[i]:starts[i] + counts[i]] if i in items else None for i in range(len(texts))]
    return counts, masks, [items.get(i, ()) for i in range(len(texts))]


def _cut(text: bytes, mask: np.ndarray) -> bytes:
    """The text without its hit words and what stands between two of them."""
    out, at, last = [], 0, None
    for hit, word in zip(mask, _WORD.finditer(text.translate(_SPLIT))):
        if hit and last is None:
            out.append(text[at:word.start()])
        if hit:
            last = at = word.end()
        else:
            last = None
    return b"".join([*out, text[at:]])


def contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", width: int = 10, block_bytes: int = 16 << 20,
) -> DataFrame:
    """Per row of ``docs``: key, n_words, n_hit, n_items, items_sha256, contaminated.

    A window is ``width`` consecutive words of an item, or all words of a shorter one; every word inside an
    occurrence of a window is hit. Null and empty texts have no words; items without words have no windows;
    equal rows give equal results; a null item id counts as the empty id. An empty benchmark hits nothing, and
    empty ``docs`` give an empty result. Other columns are not looked at. A benchmark larger than
    ``block_bytes`` is broadcast and scanned in blocks of that size, so its size has no bound here and
    that of a broadcast has one.
    """
    blocks = _blocks(benchmark, item_key, item_text, block_bytes)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"]]).add("n_words", "long").add("n_hit", "long").add("n_items", "long") \
        .add("items_sha256", "string").add("contaminated", "boolean")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only: dict = {}
        for batch in slices(batches, "text"):
            counts, masks, items = _hits(bytes_of(batch, "text"), blocks, width, only)
            n_hit = [0 if mask is None else int(mask.sum()) for mask in masks]
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), pa.array(counts, pa.int64()), pa.array(n_hit, pa.int64()),
                pa.array([len(i) for i in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items]),
                pa.array([n > 0 for n in n_hit])], [f.name for f in schema])

    return rows.mapInArrow(judge, schema).withColumnRenamed("key", key)


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", width: int = 10, block_bytes: int = 16 << 20,
) -> DataFrame:
    """``docs`` with all its columns, without the rows that a window occurs in (``remove="documents"``) or
    without the hit words in their texts (``remove="spans"``). Clean rows are left as they are; see
    :func:`contamination` for the windows and edge cases."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    blocks = _blocks(benchmark, item_key, item_text, block_bytes)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only: dict = {}
        for batch in slices(batches, text):
            values = bytes_of(batch, text)
            _, masks, _ = _hits(values, blocks, width, only)
            if remove == "documents":
                yield batch.filter(pa.array([mask is None for mask in masks]))
                continue
            cut = [v.as_py() if m is None else _cut(t, m).decode() for v, t, m in zip(batch.column(text), values, masks)]
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))

    return docs.mapInArrow(clean, docs.schema)
