"""SentencePiece encoding and decoding by a streaming Viterbi search.

The search goes over a text once. For every place it holds the best last piece that ends there; pieces are at
most ``longest`` characters, so only that many places can still be continued. Whenever the paths back
from all of these meet in one boundary, the ids before it are final and leave the window.

A unigram model asks for the path of the greatest sum of scores. A BPE model does not: its segmentation
is what merging the best pair, again and again, leaves. There a step from piece a to piece b is allowed
only if merging a + b leaves exactly (a, b). A sequence is the model's own exactly if all its steps are
allowed, so one path survives at each place and the same window and convergence give the library's ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from sentencepiece import sentencepiece_model_pb2

from trialmetrics.llm.common import slices

SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)
REMEMBERED = 250_000  # words, and steps; twice that is held, and what was not asked for lately goes first
TOGETHER = 1 << 14  # words that are searched together
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class Remembered:
    """A table of bounded size: entries that are asked for stay, the others go when the younger half is full."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.turn()
        self.young[key] = value

    def turn(self) -> None:
        self.young, self.old = {}, self.young


class Codec:
    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models that leave texts as they are, but for the space mark, are covered")
        if model.trainer_spec.model_type not in (UNIGRAM, BPE) or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("only plain unigram and BPE models are covered")
        self.additive = model.trainer_spec.model_type == UNIGRAM
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == UNKNOWN)
        self.unknown_score = min(self.scores.values(), default=0.0) - 10
        self.longest = max(map(len, self.ids), default=1)
        surface = model.trainer_spec.unk_surface.encode()
        self.surface = [surface if p.type == UNKNOWN else b"" if p.type == CONTROL else
                        bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(SPACE, " ").encode()
                        for p in model.pieces]
        # If no piece goes on with a new word, every path has a boundary before each word.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.table = None if self.additive else _Backwards(self.ids)
        self.known = Remembered(REMEMBERED)  # words and their ids, four bytes each
        self.copied_steps, self.looked_up = _Table(np.zeros(0, np.int64), np.zeros(0, np.int64)), 0
        self.steps = Remembered(REMEMBERED)  # pairs of pieces by number, and whether the step is allowed

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_all([text])[0], np.int32).tolist()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each: the texts of a batch are put together from those of their words."""
        marked = [self.prefix + text.replace(" ", SPACE) if text else "" for text in texts]
        if not self.by_word:
            return [_packed(self._search(text)) for text in marked]
        words = [_WORD.findall(text) for text in marked]
        different = set(chain.from_iterable(words))
        new = different - self.known.young.keys()
        if len(self.known.young) + len(new) > self.known.size:
            self.known.turn()
            new = different
        known = self.known.young
        long, search = [], []
        for word in new:
            ids = self.known.old.get(word)
            if ids is not None:
                known[word] = ids
            elif self.additive or len(word) > 4 * self.longest:
                known[word] = _packed(self._search(word))
                if len(word) > 4 * self.longest:
                    long.append(word)
            else:
                search.append(word)
        search.sort(key=len, reverse=True)
        for i in range(0, len(search), TOGETHER):
            known.update(zip(search[i:i + TOGETHER], self._together(search[i:i + TOGETHER])))
        out = [b"".join(map(known.__getitem__, of)) for of in words]
        for word in long:
            del known[word]
        return out

    def decode(self, ids) -> str:
        """The text of the ids, without the mark of the beginning. Bytes that are not UTF-8 become U+FFFD."""
        joined = b"".join(map(self.surface.__getitem__, ids))
        return (joined[1:] if self.prefix and joined.startswith(b" ") else joined).decode(errors="replace")

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of different words that end before a window is looked at for a boundary, the longest first: the search of
        :meth:`_search` by steps, one place of all words after the other."""
        table = self.table
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        symbols = np.zeros((len(words), int(sizes[0])), np.int32)
        symbols[np.arange(symbols.shape[1]) < sizes[:, None]] = table.symbols(words)
        last = np.full((len(words), symbols.shape[1] + 1), -1, np.int64)  # number of the last piece of the path to a place
        back = np.zeros(last.shape, np.int8)  # letters of that piece
        last[:, 0] = table.beginning
        for end in range(1, symbols.shape[1] + 1):
            n = int(np.searchsorted(-sizes, -end, "right"))
            rows, nodes, found = np.arange(n), np.zeros(n, np.int64), []
            for letters in range(1, min(end, self.longest) + 1):  # back from the end as far as some piece goes on
                here = symbols[rows, end - letters]
                known, nodes = table.before(nodes, here)
                if letters == 1:
                    piece = np.full(n, -1)
                    piece[known] = table.piece[nodes]
                    found.append((rows, np.where(piece < 0, table.single + here, piece)))
                    rows = rows[known]
                else:
                    rows, piece = rows[known], table.piece[nodes]
                    found.append((rows[piece >= 0], piece[piece >= 0]))
                if not len(rows):
                    break
            open_ = np.ones(n, bool)
            for letters in range(len(found), 0, -1):
                rows, piece = found[letters - 1]
                previous = last[rows, end - letters]
                some = open_[rows] & (previous >= 0)
                rows, piece, previous = rows[some], piece[some], previous[some]
                allowed = self._allowed_steps(previous, piece)
                rows = rows[allowed]
                last[rows, end], back[rows, end], open_[rows] = piece[allowed], letters, False
        at, paths = sizes.copy(), []
        while at.any():
            rows = np.flatnonzero(at)
            paths.append((rows, last[rows, at[rows]]))
            at[rows] -= back[rows, at[rows]]
        rows, pieces = (np.concatenate(x[::-1]) for x in zip(*paths))
        order = np.argsort(rows, kind="stable")  # the pieces of a word in the order of the text
        rows, pieces = rows[order], pieces[order]
        ends = np.cumsum(np.bincount(rows, minlength=len(words))).tolist()
        normal = np.ones(len(words), bool)
        normal[rows[pieces >= table.single]] = False
        flat = table.ids[np.minimum(pieces, len(table.ids) - 1)].tobytes() if len(table.ids) else b""
        out = [flat[4 * start:4 * stop] for start, stop in zip([0, *ends], ends)]
        for i in np.flatnonzero(~normal).tolist():
            out[i] = _packed(self._spelled(words[i], pieces[ends[i - 1] if i else 0:ends[i]].tolist()))
        return out

    def _spelled(self, word: str, pieces: list[int]) -> Iterator[int]:
        at = 0
        for piece in pieces:
            size = len(self.table.pieces[piece]) if piece < self.table.single else 1
            yield from self._ids_of(word[at:at + size])
            at += size

    def _allowed_steps(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether these steps are allowed. Most are found in a copy of what is remembered."""
        pairs = left * self.table.numbers + right
        found = self.copied_steps.get(pairs)
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new, of = np.unique(pairs[unknown], return_inverse=True)
            found[unknown] = np.fromiter(map(self._allowed_pair, new.tolist()), bool, len(new))[of]
            self.looked_up += len(new)
            if self.looked_up > 4096 + self.copied_steps.entries // 8:
                held = {**self.steps.old, **self.steps.young}
                self.copied_steps = _Table(np.fromiter(held, np.int64, len(held)), np.fromiter(held.values(), np.int64, len(held)))
                self.looked_up = 0
        return found == 1

    def _allowed_pair(self, pair: int) -> bool:
        found = self.steps.get(pair)
        if found is None:
            left, right = divmod(pair, self.table.numbers)
            found = self._allowed(self.table.text(left), self.table.text(right))
            self.steps.put(pair, found)
        return found

    def _search(self, text: str) -> Iterator[int]:
        """Ids of ``text``, committed as soon as all paths that can still win agree on them."""
        longest, n, done, check = self.longest, len(text), 0, 4 * self.longest
        last: dict[int, str] = {0: ""}  # the last piece of the best path to a place; at ``done``, of what is committed
        best: dict[int, float] = {0: 0.0}
        extend = self._extend_by_score if self.additive else self._extend_by_step
        for end in range(1, n + 1):
            extend(text, end, done, last, best)
            if end == n or end - done >= check:
                meet = self._common(last, done, range(max(done, end - longest + 1), end + 1)) if end < n else n
                if meet > done:
                    path, at = [], meet
                    while at > done:
                        path.append(last[at])
                        at -= len(last[at])
                    for piece in reversed(path):
                        yield from self._ids_of(piece)
                    for place in range(done, meet):
                        last.pop(place, None)
                        best.pop(place, None)
                    done = meet
                check = end - done + longest

    def _extend_by_score(self, text: str, end: int, done: int, last: dict, best: dict) -> None:
        scores, top = self.scores, None
        for start in range(max(done, end - self.longest), end):
            piece = text[start:end]
            score = scores.get(piece)
            if score is None and end - start == 1:
                score = self.unknown_score
            if score is not None and start in best and (top is None or best[start] + score > top):
                top, last[end] = best[start] + score, piece
        best[end] = top

    def _extend_by_step(self, text: str, end: int, done: int, last: dict, _: dict) -> None:
        for start in range(max(done, end - self.longest), end):
            piece = text[start:end]
            if (piece in self.ids or end - start == 1) and (previous := last.get(start)) is not None and self._allowed_text(previous, piece):
                last[end] = piece
                return

    def _allowed_text(self, left: str, right: str) -> bool:
        return self._allowed_pair(self.table.number(left) * self.table.numbers + self.table.number(right))

    def _allowed(self, left: str, right: str) -> bool:
        return self._merged(left + right) == ([left, right] if left else [right])

    def _merged(self, text: str) -> list[str]:
        """What merging leaves of two pieces: the pair of the best score first, of equal ones the leftmost."""
        parts, score_of = list(text), self.scores.get
        scores = [score_of(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            top, at = None, -1
            for i, score in enumerate(scores):
                if score is not None and (top is None or score > top):
                    top, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score_of(parts[at - 1] + parts[at])
            if at < len(scores):
                scores[at] = score_of(parts[at] + parts[at + 1])

    def _common(self, last: dict, done: int, alive: range) -> int:
        """The boundary in which the paths from all places in ``alive`` meet; ``done`` if they have not met since."""
        places = {p for p in alive if p in last}
        while len(places) > 1:
            place = max(places)
            places.remove(place)
            places.add(place - len(last[place]) if place > done else done)
        return places.pop()

    def _ids_of(self, piece: str) -> list[int]:
        if (found := self.ids.get(piece)) is not None:
            return [found]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode()]
        return [self.unknown]


def _packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, np.int32).tobytes()


class _Table:
    """Numbers by number, for arrays of them: a hash table that is at most a quarter full."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(4, (4 * len(keys)).bit_length())
        self.entries, self._shift, self._last = len(keys), np.uint64(64 - bits), (1 << bits) - 1
        self._keys, self._values = np.full(1 << bits, -1), np.full(1 << bits, -1)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self._keys[slots] == -1)
            self._keys[slots[free]] = keys[free]  # of several, one stays
            placed = self._keys[slots] == keys
            self._values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self._last

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        slots = self._slots(keys)
        held = self._keys[slots]
        out = np.where(held == keys, self._values[slots], -1)
        left = np.flatnonzero((held != keys) & (held != -1))
        slots = slots[left]
        while len(left):
            slots = (slots + 1) & self._last
            held = self._keys[slots]
            hit = held == keys[left]
            out[left[hit]] = self._values[slots[hit]]
            on = ~hit & (held != -1)
            left, slots = left[on], slots[on]
        return out


class _Backwards:
    """The pieces as a tree from their last letter to the first, in sorted arrays, and numbers for all that a step can join:
    pieces, letters that are no piece, and the beginning. Letters of no piece never merge, so they count as one."""

    def __init__(self, ids: dict[str, int]):
        self.pieces = pieces = list(ids)
        self.ids = np.fromiter(ids.values(), np.int32, len(ids))
        self.of = {piece: i for i, piece in enumerate(pieces)}
        self.letters = sorted({letter for piece in pieces for letter in piece})
        self._symbol = np.zeros(0x110000, np.int32)
        self._symbol[[ord(letter) for letter in self.letters]] = np.arange(1, len(self.letters) + 1)
        self.single = len(pieces)
        self.beginning = self.single + len(self.letters) + 1
        self.numbers = self.beginning + 1
        self.unknown = next(chr(c) for c in range(0xE000, 0x110000) if not self._symbol[c])
        nodes: dict[tuple[int, int], int] = {}
        complete = {}
        for i, piece in enumerate(pieces):
            node = 0
            for letter in reversed(piece):
                node = nodes.setdefault((node, int(self._symbol[ord(letter)])), len(nodes) + 1)
            complete[node] = i
        self._width = len(self.letters) + 1
        keys = np.array([node * self._width + symbol for node, symbol in nodes], np.int64)
        self._next = _Table(keys, np.array(list(nodes.values()), np.int64))
        self.piece = np.full(len(nodes) + 1, -1, np.int64)
        self.piece[list(complete)] = list(complete.values())

    def symbols(self, words: list[str]) -> np.ndarray:
        return self._symbol[np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)]

    def before(self, nodes: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which nodes have one more letter before them, and the nodes that it leads to."""
        found = self._next.get(nodes * self._width + symbols)
        known = found >= 0
        return known, found[known]

    def number(self, text: str) -> int:
        if not text:
            return self.beginning
        found = self.of.get(text)
        return self.single + int(self._symbol[ord(text)]) if found is None else found

    def text(self, number: int) -> str:
        if number < self.single:
            return self.pieces[number]
        symbol = number - self.single
        return "" if number == self.beginning else self.letters[symbol - 1] if symbol else self.unknown


_codecs: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    return _codecs.get(path) or _codecs.setdefault(path, Codec(path))


def encoded(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, token_ids, n_tokens and round_trip, which says that decoding the ids gives the text again.

    Null and empty texts have no ids and come back empty. Only a text that itself holds the space mark U+2581
    does not come back, since the mark decodes to a space. Equal rows give equal ids, other columns are not
    looked at, and an empty table gives an empty result. A text of any length is held once, with a window of the search.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["key"]]).add("token_ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long").add("round_trip", "boolean")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in slices(batches, "text", 2 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            packed = codec.encode_all(texts)
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            values = np.frombuffer(b"".join(packed), np.int32)
            ids = [np.frombuffer(of, np.int32).tolist() for of in packed]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            back = [codec.decode(i) == t for i, t in zip(ids, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.ListArray.from_arrays(offsets, pa.array(values)), pa.array(sizes), pa.array(back)],
                [f.name for f in schema])

    return rows.mapInArrow(encode, schema).withColumnRenamed("key", key)


def decoded(df: DataFrame, path: str, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """Per row: key and the text of the ids. Null ids, and null among them, count as none."""
    rows = df.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([rows.schema["key"]]).add("text", "string")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            texts = [codec.decode([i for i in of or () if i is not None]) for of in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())], ["key", "text"])

    return rows.mapInArrow(decode, schema).withColumnRenamed("key", key)
