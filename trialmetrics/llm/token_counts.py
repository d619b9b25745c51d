"""Token counts of byte-level BPE by merging in rounds over arrays.

Texts are cut into pre-tokens, and the different pre-tokens of a slice are laid end to end in one ragged array
of symbols. In each round every sequence merges all places of its own pair of lowest rank at once; sequences
without a pair left are done. A merge can only give pairs of higher rank than its own, so rounds
give the same symbols as merging one place at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from trialmetrics.llm.common import slices

NONE = np.int64(1) << 40
#: Different pre-tokens a worker remembers; beyond it starts anew, which costs time and changes nothing.
REMEMBERED = 400_000
#: Characters of a text whose pre-tokens are held together.
AT_ONCE = 4 << 20

# The pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabulary files: printable Latin-1 as it is, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@dataclass
class Merges:
    symbols: np.ndarray  # byte to symbol
    pairs: np.ndarray  # sorted left * size + right
    ranks: np.ndarray
    results: np.ndarray
    size: int
    special: list[str]

    @classmethod
    def read(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, before = data["model"], data.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or data.get("normalizer") or before.get("add_prefix_space"):
            raise ValueError("a byte-level BPE file without normaliser and prefix space is needed")
        plain = ("single_word", "lstrip", "rstrip", "normalized")
        if model.get("ignore_merges") or any(t[flag] for t in data["added_tokens"] for flag in plain):
            raise ValueError("options of this file are not covered")
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        size = max(vocabulary.values()) + 1
        pairs = np.array([vocabulary[a] * size + vocabulary[b] for a, b in merges], np.int64)
        results = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        return cls(np.array([vocabulary[c] for c in byte_characters()], np.int64), pairs[order],
                   np.arange(len(pairs))[order], results[order], size, [t["content"] for t in data["added_tokens"]])

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE without a merge) and place in the table of each pair."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], NONE), at


def merged_lengths(tokens: list[bytes], merges: Merges) -> np.ndarray:
    """How many symbols are left of each sequence of bytes."""
    out = np.fromiter(map(len, tokens), np.int64, len(tokens))
    number = np.flatnonzero(out > 1)  # sequence in ``tokens`` of each sequence still in work
    lengths = out[number]
    symbols = merges.symbols[np.frombuffer(b"".join(tokens[i] for i in number.tolist()), np.uint8)]
    if not len(symbols):
        return out

    def pair_ranks(at: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ranks, places = merges.look_up(symbols[at], symbols[np.minimum(at + 1, len(symbols) - 1)])
        return np.where(last[at], NONE, ranks), places

    ends = np.cumsum(lengths)
    last = np.zeros(len(symbols), bool)
    last[ends - 1] = True
    ranks, places = pair_ranks(np.arange(len(symbols)), last)
    while len(number):
        starts = ends - lengths
        lowest = np.minimum.reduceat(ranks, starts)
        live = lowest < NONE
        if not live.all():
            out[number[~live]] = lengths[~live]
            stay = np.repeat(live, lengths)
            symbols, ranks, places, last = symbols[stay], ranks[stay], places[stay], last[stay]
            number, lengths, lowest = number[live], lengths[live], lowest[live]
            ends = np.cumsum(lengths)
            if not len(number):
                break
        hit = ranks == np.repeat(lowest, lengths)
        at = np.flatnonzero(hit)
        # A pair of twice the same symbol can overlap itself: of adjoining places every other one counts.
        new_run = np.append(True, np.diff(at) > 1) | last[np.maximum(at - 1, 0)]
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        symbols[at] = merges.results[places[at]]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        of = np.repeat(np.arange(len(number)), lengths)
        lengths = lengths - np.bincount(of[at], minlength=len(number))
        symbols, ranks, places, last = symbols[keep], ranks[keep], places[keep], last[keep]
        ends = np.cumsum(lengths)
        moved = at - np.arange(len(at))  # each merge before a place has moved it by one
        changed = np.unique(np.concatenate([moved, np.maximum(moved - 1, 0)]))
        ranks[changed], places[changed] = pair_ranks(changed, last)
    return out


class Counter:
    """Counts tokens of texts with the pre-tokens seen before remembered."""

    def __init__(self, path: str):
        self.merges = Merges.read(path)
        self.pattern = regex.compile(PATTERN)
        self.find = self.pattern.findall
        special = sorted(self.merges.special, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, special))).split if special else None
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        out, short = [0] * len(texts), []
        for i, text in enumerate(texts):
            parts = self.split(text) if self.split else [text]
            out[i] = len(parts) - 1
            if len(text) <= AT_ONCE:
                short.append((i, [t for part in parts for t in self.find(part)]))
                continue
            for part in parts:  # so that the pre-tokens of a long text are never held all together
                found = (match[0] for match in self.pattern.finditer(part))
                while held := list(islice(found, AT_ONCE // 8)):
                    out[i] += self._sums([held])[0]
        for (i, _), n in zip(short, self._sums([tokens for _, tokens in short])):
            out[i] += n
        return out

    def _sums(self, tokens: list[list[str]]) -> list[int]:
        different = set().union(*tokens)
        new = [t for t in different if t not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(different)
        self.known.update(zip(new, merged_lengths([t.encode() for t in new], self.merges).tolist()))
        look = self.known.__getitem__
        return [sum(map(look, found)) for found in tokens]


_counters: dict[str, Counter] = {}


def token_counts(df: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens).

    Whole texts count, without begin or end tokens; the strings of special tokens inside a text are one token each.
    Null counts as empty: 0 bytes and 0 tokens. Equal rows give equal counts, other columns are not looked at,
    and an empty table gives an empty result. ``path`` is a byte-level BPE file that every executor can open.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"]]).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.get(path) or _counters.setdefault(path, Counter(path))
        for batch in slices(batches, "text", 2 << 20):
            values = batch.column("text")
            n = np.array(counter.counts([t or "" for t in values.to_pylist()]), np.int64)
            sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key"), sizes, pa.array(n), pa.array(n > limit)],
                                             [f.name for f in schema])

    return rows.mapInArrow(count, schema).withColumnRenamed("key", key)
