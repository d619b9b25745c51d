"""Spelling variants: words one edit apart, and the frequent form each of them stands for.

One edit changes the letter counts of a word little: a replaced letter moves the vector of counts by a squared distance of
two, an inserted or deleted one by one. Words of one length, or of lengths one apart, are therefore compared as blocks
of count vectors, whose squared distances NumPy gets from one matrix product; pairs at most two apart are
verified letter by letter. Letters are dealt into classes, and only cells whose class counts can be one edit apart are
compared, so that the work grows with the neighbourhood of a word and not with the vocabulary.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from trialmetrics.llm.common import LOWER, bytes_of, slices, stored

LETTERS = "A-Za-zÀ-ÿ"
PIECE = 1 << 20  # characters of a text whose words are held together
HELD = 200_000  # words a task counts before it hands them on
PAIRS = 1 << 16  # pairs that are verified together
CELL = 256  # words of a cell that classes are chosen for
_NONE = re.compile(f"[^{LETTERS}]")


def _pieces(text: str) -> Iterator[str]:
    """A long text cut between words."""
    at = 0
    while at < len(text):
        found = _NONE.search(text, at + PIECE) if at + PIECE < len(text) else None
        stop = found.start() if found else len(text)
        yield text[at:stop]
        at = stop


def occurrences(df: DataFrame, key: str, text: str, slip: int, shortest: int) -> DataFrame:
    """word, n: how often each word of ``shortest`` letters or more occurs, counted in the tasks first.

    Every ``slip``-th word, by CRC-32 of the key and the word, is taken without one of its letters.
    """
    rows = df.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(text).cast("string").alias("text"))
    words = re.compile(f"[{LETTERS}]{{{shortest},}}").findall

    def handed(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches, "text"):
            for key, raw in zip(batch.column("key").to_pylist(), bytes_of(batch, "text")):
                seed, lower = zlib.crc32(f"{key}:".encode()), raw.translate(LOWER).decode()
                for piece in _pieces(lower):
                    for word, n in Counter(words(piece)).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < shortest:
                                continue
                        total[word] += n
                    if len(total) >= HELD:
                        yield handed(total)
                        total = Counter()
        if total:
            yield handed(total)

    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def cell_of(word: str, classes: int) -> tuple[int, ...]:
    """How many letters of each class a word has, a letter's class being its code point modulo ``classes``."""
    counts = [0] * classes
    for letter in word:
        counts[ord(letter) % classes] += 1
    return tuple(counts)


def cells_around(cell: tuple[int, ...]) -> set[tuple[int, ...]]:
    """Cells of the words one edit away: a replaced letter leaves a class for a class, an inserted one joins a class."""
    def moved(leaves: int | None, joins: int | None) -> tuple[int, ...]:
        return tuple(n - (i == leaves) + (i == joins) for i, n in enumerate(cell))

    of = [None, *range(len(cell))]
    return {moved(a, b) for a in of for b in of if a is None or cell[a]}


def _cells(words: DataFrame, classes: int) -> DataFrame:
    """word, n, cell and neighbour: each word once for every cell with words that may be one edit away, its own included."""
    def named(cell: tuple[int, ...]) -> str:
        return " ".join(map(str, cell))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, ...], tuple[str, list[str]]] = {}
        for batch in batches:
            place, cell, neighbour = [], [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                here = cell_of(word, classes)
                if here not in known:
                    if len(known) >= HELD:
                        known.clear()
                    known[here] = named(here), [named(c) for c in cells_around(here)]
                own, others = known[here]
                place += [row] * len(others)
                cell += [own] * len(others)
                neighbour += others
            taken = batch.take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.string()), pa.array(neighbour, pa.string())],
                                             ["word", "n", "cell", "neighbour"])

    return words.select("word", "n").mapInArrow(around, "word string, n long, cell string, neighbour string")


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of each word, zeros behind them, and the lengths."""
    points = np.array(words, dtype=np.str_)
    wide = points.dtype.itemsize // 4
    return points.view(np.uint32).reshape(len(words), wide), np.char.str_len(points)


def _close(a: np.ndarray, b: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of words whose letter counts have a squared distance of at most two."""
    x, y = (_counts(words, alphabet) for words in (a, b))
    distance = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.nonzero(distance <= 2)


def _counts(points: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    at = np.searchsorted(alphabet, points)
    flat = at + np.arange(len(points))[:, None] * len(alphabet)
    counts = np.bincount(flat.ravel(), minlength=len(points) * len(alphabet)).reshape(len(points), -1).astype(np.float32)
    counts[:, 0] = 0  # what stands behind the words
    return counts


def _one_edit(a: np.ndarray, b: np.ndarray, length: int, other: int) -> np.ndarray:
    """Whether words of ``length`` letters and of ``other``, at most one more, differ by one edit, row by row."""
    if length == other:
        return (a[:, :length] != b[:, :length]).sum(1) == 1
    short, long = a[:, :length], b[:, :other]
    prefix = np.cumprod(short == long[:, :-1], axis=1).sum(1)
    suffix = np.cumprod((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return prefix + suffix >= length


def _near_words(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Both directions of the pairs one edit apart between two blocks, or in one. Memory is the product of the blocks."""
    group, ends = group.combine_chunks(), key[0].as_py()
    words, n, first = group.column("word").to_pylist(), group.column("n").to_numpy(), group.column("first").to_numpy(zero_copy_only=False)
    points, lengths = _letters(words)
    alphabet = np.unique(np.append(points, 0))
    alone = ends["a"] == ends["b"]
    second = first if alone else ~first
    left, right = [], []
    for length in np.unique(lengths[first]).tolist():
        for other in (length - 1, length, length + 1):
            a, b = np.flatnonzero(first & (lengths == length)), np.flatnonzero(second & (lengths == other))
            if len(a) and len(b):
                i, j = _close(points[a], points[b], alphabet)
                for at in range(0, len(i), PAIRS):
                    u, v = a[i[at:at + PAIRS]], b[j[at:at + PAIRS]]
                    good = _one_edit(*((points[u], points[v], length, other) if length <= other else (points[v], points[u], other, length)))
                    left.append(u[good])
                    right.append(v[good])
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    if not alone:  # a block with itself has both directions already
        i, j = np.concatenate([i, j]), np.concatenate([j, i])
    of = pa.array(words, pa.string())
    return pa.table({"word": of.take(pa.array(i)), "n": pa.array(n[i]), "near": of.take(pa.array(j)), "near_n": pa.array(n[j])})


def near_words(words: DataFrame, block: int = 2048) -> DataFrame:
    """word, n, near, near_n of all pairs one edit apart, in both directions. ``words`` (word, n) are distinct.

    Classes are added until a cell holds about ``CELL`` words on average; cells of more than ``block`` words are
    compared block by block. Neither changes what is found.
    """
    total = words.count()
    classes = 1
    while classes < 12 and math.comb(8 + classes - 1, classes - 1) * CELL < total / 8:
        classes += 1
    around = stored(_cells(words, classes), "cells")
    sizes = around.filter("cell = neighbour").groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    mine = sizes.select("cell", F.col("blocks").alias("own"))
    theirs = sizes.select(F.col("cell").alias("neighbour"), "blocks")
    placed = around.join(theirs, "neighbour").join(mine, "cell").withColumn("at", F.pmod(F.xxhash64("word"), F.col("own")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    here, there = F.struct("cell", F.col("at").alias("block")), F.struct(F.col("neighbour").alias("cell"), F.col("other").alias("block"))
    pairs = dealt.select("word", "n", F.struct(F.least(here, there).alias("a"), F.greatest(here, there).alias("b")).alias("group"),
                         (here <= there).alias("first"))
    return pairs.groupBy("group").applyInArrow(_near_words, "word string, n long, near string, near_n long")


def variants(
    df: DataFrame, key: str = "doc_id", text: str = "text", slip: int = 199, shortest: int = 6, least: int = 5, factor: int = 5,
    block: int = 2048,
) -> DataFrame:
    """One row per word: word, form, root, n, n_near and form_n.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z in lower case, of at least ``shortest`` letters and
    ``least`` occurrences; see :func:`occurrences` for ``slip``. A word's form is the most frequent word one edit away, of
    equally frequent ones the first in code-point order, if it is ``factor`` times as frequent or more; forms are followed to the root.
    Null and empty texts have no words, a null key counts as the empty text, repeated rows count each time, other columns
    are not looked at, and an empty table gives an empty result.
    """
    if factor < 2:
        raise ValueError("a form is at least twice as frequent, so that forms end")
    words = stored(occurrences(df, key, text, slip, shortest).filter(F.col("n") >= least), "words")
    found = near_words(words, block).groupBy("word").agg(
        F.count("*").alias("n_near"), F.max("near_n").alias("most"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    named = words.join(found, "word", "left")
    has_form = F.col("most") >= factor * F.col("n")
    named = stored(named.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has_form, F.col("best.near")).alias("form"),
        F.when(has_form, F.col("most")).alias("form_n")), "forms")
    # Every step is to a word that is ``factor`` times as frequent, so this many doublings reach the last.
    most = named.agg(F.max("n")).first()[0] or least
    longest = 1 + math.floor(math.log(max(1, most / least), factor))
    steps = named.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(max(1, math.ceil(math.log2(max(2, longest))))):
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stored(steps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return named.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
