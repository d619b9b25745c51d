"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to ``order`` bytes with the counts of the bytes that followed.
A byte seen in the longest known context c has probability count / (total + different); otherwise the
escape, different / (total + different), is spread over the next shorter context's distribution
without the bytes that c has seen, and so on down to a uniform distribution over 256 bytes. The
probabilities of a context add up to one exactly, so the sum of -log2 is the length of a code for
the text. The statistics are frozen after training, and the language with the shortest code is the answer.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F, types as T

from trialmetrics.llm.common import slices, stored

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Trees:
    """Contexts of all languages in one automaton, its costs resolved for each language."""

    languages: list[str]
    symbols: np.ndarray  # byte to symbol; 0 stands for every byte not seen in training
    after: np.ndarray  # [context, symbol]: the longest known context after that symbol
    bits: np.ndarray  # [context, symbol, language]: code length
    order: int


def train(samples: list[tuple[str, bytes]], order: int = 3, table_bytes: int = 48 << 20) -> Trees:
    """Trees over the samples. Contexts seen less often are left out until the table fits in
    ``table_bytes``; a context is never kept without its shorter ones."""
    languages = sorted({language for language, _ in samples})
    used = np.unique(np.frombuffer(b"".join(text for _, text in samples), np.uint8))
    symbols = np.zeros(256, np.int64)
    symbols[used] = np.arange(1, len(used) + 1)
    m = len(used) + 1
    grams = [[_grams([symbols[np.frombuffer(t, np.uint8)] for of, t in samples if of == language], n, m)
              for n in range(1, order + 2)] for language in languages]

    seen: Counter = Counter()  # context as (length, number) with its count over all languages
    for per_order in grams:
        for n, (numbers, counts) in enumerate(per_order[1:], 1):
            heads, at = np.unique(numbers // m, return_inverse=True)
            for head, count in zip(heads.tolist(), np.bincount(at, counts).tolist()):
                seen[n, head] += int(count)
    room = max(1, table_bytes // (m * 4 * max(1, len(languages) + 1)))
    least = sorted(seen.values(), reverse=True)[room - 1] + 1 if len(seen) >= room else 1
    contexts = [(0, 0)] + sorted(c for c, n in seen.items() if n >= least and _suffixes_known(c, m, seen, least))
    number_of = {c: i for i, c in enumerate(contexts)}

    after = np.zeros((len(contexts), m), np.int32)
    bits = np.zeros((len(contexts), m, len(languages)), np.float32)
    for (n, head), i in number_of.items():
        for x in range(m):
            length, number = n + 1, head * m + x
            if length > order:
                length, number = order, number % m ** order
            while (at := number_of.get((length, number))) is None:
                length, number = length - 1, number % m ** (length - 1)
            after[i, x] = at
    for k, per_order in enumerate(grams):
        p = np.zeros((len(contexts), m))
        width = np.ones(m)
        width[0] = 256 - len(used)  # the symbol of the bytes not seen
        for n, (numbers, counts) in enumerate(per_order):
            followed = _by_context(numbers, counts, m)
            for i, (length, head) in ((i, c) for i, c in enumerate(contexts) if c[0] == n):
                shorter = width / 256 if n == 0 else p[_shorter(number_of, length, head, m)]
                x, c = followed.get(head, ((), ()))
                if not len(x):
                    p[i] = shorter
                    continue
                x, c = np.asarray(x), np.asarray(c)
                total, rest = c.sum() + len(x), shorter.copy()
                rest[x] = 0
                left = rest.sum()
                p[i] = rest * (len(x) / total / left) if left > 0 else 0
                p[i, x] = c / total if left > 0 else c / c.sum()
        p[:, 0] /= max(1, 256 - len(used))  # for one of those bytes
        with np.errstate(divide="ignore"):
            bits[:, :, k] = np.minimum(-np.log2(p), 64)
    return Trees(languages, symbols.astype(np.int32), after, bits, order)


def _grams(texts: list[np.ndarray], n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct symbol sequences of length n, as numbers in base m, and their counts."""
    found = []
    for text in texts:
        if len(text) >= n:
            number = np.zeros(len(text) - n + 1, np.int64)
            for i in range(n):
                number = number * m + text[i:len(text) - n + 1 + i]
            found.append(number)
    return np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.int64),) * 2


def _suffixes_known(context, m: int, seen: Counter, least: int) -> bool:
    length, number = context
    return all(seen.get((n, number % m ** n), 0) >= least for n in range(1, length))


def _shorter(number_of: dict, length: int, head: int, m: int) -> int:
    return number_of[length - 1, head % m ** (length - 1) if length > 1 else 0]


def _by_context(numbers: np.ndarray, counts: np.ndarray, m: int) -> dict:
    heads, starts = np.unique(numbers // m, return_index=True)
    ends = np.append(starts[1:], len(numbers))
    return {h: (numbers[a:b] % m, counts[a:b]) for h, a, b in zip(heads.tolist(), starts, ends)}


def code_lengths(texts: list[bytes], trees: Trees, piece: int = 1 << 20) -> np.ndarray:
    """[text, language]: bits of each text's code. A context does not reach over the start of a text.

    Long texts are cut into pieces that begin with the context of their first byte, so memory does not grow with them.
    """
    out = np.zeros((len(texts), len(trees.languages)))
    held: list[tuple[int, int, bytes]] = []  # text, bytes of context, bytes
    size = 0
    for i, text in enumerate(texts):
        for start in range(0, len(text), piece):
            context = min(start, trees.order)
            held.append((i, context, text[start - context:start + piece]))
            size += len(held[-1][2])
            if size >= piece:
                _add_lengths(out, held, trees)
                held, size = [], 0
    if held:
        _add_lengths(out, held, trees)
    return out


def _add_lengths(out: np.ndarray, pieces: list[tuple[int, int, bytes]], trees: Trees) -> None:
    of, contexts, texts = zip(*pieces)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    x = trees.symbols[np.frombuffer(b"".join(texts), np.uint8)]
    m, after = trees.after.shape[1], trees.after.ravel()
    before = np.zeros(len(x), np.int32)  # the context of a byte, one byte longer with each turn
    for _ in range(trees.order):
        longer = after[before * np.int64(m) + x]
        before[1:] = longer[:-1]
        before[starts] = 0
    bits = trees.bits.reshape(-1, len(trees.languages))[before * np.int64(m) + x]
    for start, context in zip(starts, contexts):
        if context:
            bits[start:start + context] = 0
    np.add.at(out, list(of), np.add.reduceat(bits, starts, axis=0, dtype=np.float64))


def training_sample(
    df: DataFrame, text: str, language: str, where: Column, bytes_per_language: int = 1_000_000,
) -> list[tuple[str, bytes]]:
    """Texts and languages of about ``bytes_per_language`` bytes for each language, which is the bound on what
    the driver holds. Texts, not rows, are drawn, those of the lowest hash until the bound is filled, so copies count
    once; a text of over an eighth of the bound is drawn in pieces of that size. A language with any text has a sample.
    The order of rows and their partitioning make no difference."""
    most = max(1, bytes_per_language // 8)
    rows = df.filter(where & F.col(language).isNotNull() & (F.length(text) > 0)).select(
        F.col(language).cast("string").alias("language"), F.col(text).cast("string").cast("binary").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64(F.col("text").cast("string"))).withColumn("size", F.octet_length("text"))

    def pieces(texts: DataFrame) -> DataFrame:
        nth = F.explode(F.sequence(F.lit(0), F.floor((F.col("size") - 1) / most).cast("int")))
        by = F.when(F.col("nth") == 0, F.col("hash")).otherwise(F.xxhash64("hash", "nth"))
        return texts.withColumn("nth", nth).withColumn("draw", F.pmod(by, F.lit(1 << 30)) / float(1 << 30))

    distinct = stored(rows.groupBy("language", "hash").agg(F.max("size").alias("size")), "language-texts")
    held = {r["language"]: r["held"] for r in distinct.groupBy("language").agg(F.sum("size").alias("held")).collect()}
    share = {name: 1.25 * bytes_per_language / size for name, size in held.items()}

    def drawn(texts: DataFrame) -> DataFrame:
        below = F.lit(0.0)
        for name, part in share.items():
            below = F.when(F.col("language") == name, part).otherwise(below)
        return pieces(texts).filter(F.col("draw") < below)

    while True:
        size = F.least(F.lit(most), F.col("size") - F.col("nth") * most)
        have = {r["language"]: r["n"] for r in drawn(distinct).groupBy("language").agg(F.sum(size).alias("n")).collect()}
        short = [name for name, size in held.items() if share[name] <= 1 and have.get(name, 0) < bytes_per_language]
        if not short:
            break
        share.update((name, 2 * share[name]) for name in short)
    found = drawn(rows).groupBy("language", "draw", "hash", "nth").agg(
        F.min(F.expr(f"substring(text, nth * {most} + 1, {most})")).alias("piece")).collect()
    sample, sizes = [], Counter()
    for row in sorted(found, key=lambda r: (r["language"], r["draw"], r["hash"], r["nth"])):
        if sizes[row["language"]] < bytes_per_language:
            sizes[row["language"]] += len(row["piece"])
            sample.append((row["language"], bytes(row["piece"])))
    return sample


def _judged(texts: list[str | None], trees: Trees | None) -> tuple[list[str], np.ndarray]:
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
    if trees is None or not trees.languages or not known:
        return names, scores
    bits = code_lengths([texts[i].encode() for i in known], trees)
    best = bits.argmin(1)
    least = bits.min(1, keepdims=True)
    scores[known] = 1 / np.exp2(least - bits).sum(1)
    for i, k in zip(known, best):
        names[i] = trees.languages[k]
    return names, scores


def fitted(df: DataFrame, text: str, language: str, where: Column, **bounds) -> Broadcast:
    """Trees trained on the bounded sample, ready for the tasks; a table bounded by ``table_bytes``. They travel as
    plain arrays, so that executors need not have the package."""
    sample = training_sample(df, text, language, where, **bounds)
    return df.sparkSession.sparkContext.broadcast(vars(train(sample)) if sample else None)


def _trees(told: Broadcast) -> Trees | None:
    return None if told.value is None else Trees(**told.value)


def languages(df: DataFrame, trees: Broadcast, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, lang_pred and score, the probability of that language if all are equally likely at first.

    A null text or one without a letter is ``und`` with score 0, as is everything when nothing was trained on.
    Of equally short codes the first language by name wins. Whole texts are scored, equal texts equally;
    other columns are not looked at; an empty table gives an empty result.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"]]).add("lang_pred", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            names, scores = _judged(batch.column("text").to_pylist(), _trees(trees))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(names), pa.array(scores)],
                                             [f.name for f in schema])

    return rows.mapInArrow(predict, schema).withColumnRenamed("key", key)


def in_a_language(df: DataFrame, trees: Broadcast, text: str = "text", wanted: Collection[str] | None = None, least: float = 0.0) -> DataFrame:
    """``df`` with all its columns, without the rows whose language is ``und``, is not among ``wanted`` (None: all
    that were learned), or has a score under ``least``; edge cases as above, but if nothing was trained on, every text with
    a letter stays."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, 1 << 20):
            texts = batch.column(text).to_pylist()
            if trees.value is None:
                yield batch.filter(pa.array([bool(t and _LETTER.search(t)) for t in texts], pa.bool_()))
            else:
                names, scores = _judged(texts, _trees(trees))
                yield batch.filter(pa.array([name != UNKNOWN and (wanted is None or name in wanted) and score >= least
                                             for name, score in zip(names, scores.tolist())], pa.bool_()))

    return df.mapInArrow(keep, df.schema)
