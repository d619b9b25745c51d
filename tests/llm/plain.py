"""The operators' contracts written the plain way, a text at a time."""

from __future__ import annotations

import hashlib
import math
import re
import statistics
import zlib
from collections import Counter, defaultdict

import xxhash

WHITE = re.compile(r"[\x20\x09-\x0D]")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def last_if_none(key):
    return (key is None, key or 0)


def exact(docs):
    groups = defaultdict(list)
    for i, (key, text) in enumerate(docs):
        groups[WHITE.sub("", text or "")].append((-len(text or ""), *last_if_none(key), i))
    out = []
    for content, members in groups.items():
        members.sort()
        keep = docs[members[0][-1]][0]
        out += [(docs[m[-1]][0], keep, len(members), m is members[0], sha(content)) for m in members]
    return out


def windows_of(words, width):
    n = min(width, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def contamination(docs, items, width=10):
    grams = [(str(k) if k is not None else "", windows_of(ALPHANUMERIC.findall((t or "").translate(UPPER)), width)) for k, t in items]
    out = []
    for key, text in docs:
        words = ALPHANUMERIC.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for item, windows in grams:
            for n in {len(w) for w in windows}:
                for i in range(len(words) - n + 1):
                    if tuple(words[i:i + n]) in windows:
                        hit |= set(range(i, i + n))
                        found.add(item)
        out.append((key, len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def fingerprint(text, shingle=3):
    words = WORDS.findall((text or "").translate(UPPER))
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(docs, bits=2, shingle=3):
    prints = [fingerprint(t, shingle) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), (True, 0)), last_if_none(key))
    return [(key, f"{prints[i]:016x}", None if least[find(i)][0] else least[find(i)][1]) for i, (key, _) in enumerate(docs)]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def disclosures(docs, window=None, two_texts=False, remove_at=0.95, generalise_at=0.8, support=1):
    """(places of base spans, of terms, number removed) for each document. With a window terms are words within it, and
    count where they stand in it; else they are words of the whole text, and count wherever they stand."""
    word = re.compile(r"[^\W\d_]{2,}")
    n, with_entity, with_term, near, texts = len(docs), defaultdict(set), Counter(), defaultdict(set), defaultdict(set)
    places = []
    for i, (_, text) in enumerate(docs):
        text = text or ""
        words = [(m[0].lower(), m.start(), m.end()) for m in word.finditer(text)]
        with_term.update({w for w, _, _ in words})
        here = []
        entities = {}
        for kind, a, b in base_spans(text):
            entities.setdefault((kind, text[a:b].lower()), []).append((a, b))
        for entity, spans in entities.items():
            with_entity[entity].add(i)
            if window is None:
                here += [(entity, *w) for w in words]
            for a, b in spans if window is not None else ():
                for start, stop in ((max(a - window, 0), a), (b, min(b + window, len(text)))):
                    for m in word.finditer(text[start:stop]):
                        if (m.start() > 0 or start == 0) and (start + m.end() < stop or stop == len(text)):
                            here.append((entity, m[0].lower(), start + m.start(), start + m.end()))
        for entity, term, _, _ in here:
            near[entity, term].add(i)
            texts[entity, term].add(text)
        places.append(here)
    score = {}
    for (entity, term), found in near.items():
        c = len(with_entity[entity])
        if len(texts[entity, term]) > two_texts and c < n and with_term[term] >= support:
            score[entity, term] = math.log(n * len(found) / (c * with_term[term])) / math.log(n / c)
    out = []
    for (key, text), here in zip(docs, places):
        base = base_spans(text)
        terms = {}
        for entity, term, a, b in here:
            if score.get((entity, term), 0) >= generalise_at and not any(s < b and a < e for _, s, e in base):
                terms[a, b] = terms.get((a, b), False) or score[entity, term] >= remove_at
        out.append((base, sorted(terms), sum(terms.values())))
    return out


def good_turing(counts):
    """Katz's discounts of counts 1 to 5 on the line through the logarithms of the counts of counts 1 to 6."""
    n = Counter(counts)
    rs = [r for r in range(1, 7) if n[r]]
    if len(rs) < 2:
        return [(r - 0.5) / r for r in range(1, 6)]
    points = []
    for i, r in enumerate(rs):
        before = rs[i - 1] if i else 0
        after = rs[i + 1] if i + 1 < len(rs) else 2 * r - before
        points.append((math.log(r), math.log(n[r] / (0.5 * (after - before)))))
    slope = statistics.linear_regression(*zip(*points)).slope
    if slope > -1 - 1e-6:
        return [1 - math.log((r + 1) / r, 6) for r in range(1, 6)]

    def smooth(r):
        return r ** slope

    share = 6 * smooth(6) / smooth(1)
    return [((r + 1) * smooth(r + 1) / (r * smooth(r)) - share) / (1 - share) for r in range(1, 6)]


class Katz:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for text in texts:
            tokens = [*WORDS.findall((text or "").translate(UPPER)), None]
            self.words.update(tokens)
            self.pairs.update(zip([False, *tokens[:-1]], tokens))
        self.n = sum(self.words.values())
        self.d1, self.d2 = good_turing(self.words.values()), good_turing(self.pairs.values())
        self.extra = int(not any(r <= 5 for r in self.words.values()))
        self.after = defaultdict(dict)
        for (a, b), r in self.pairs.items():
            self.after[a][b] = r

    def word(self, b):
        r = self.words[b]
        if not r:
            left = sum(r * (1 - self.d1[r - 1]) for r in self.words.values() if r <= 5) + self.extra
            return left / (self.n + self.extra)
        return r * (self.d1[r - 1] if r <= 5 else 1) / (self.n + self.extra)

    def pair(self, a, b):
        seen = self.after.get(a)
        if not seen:
            return self.word(b)
        total = sum(seen.values()) + int(not any(r <= 5 for r in seen.values()))
        p = {w: r * (self.d2[r - 1] if r <= 5 else 1) / total for w, r in seen.items()}
        if b in p:
            return p[b]
        return (1 - sum(p.values())) / (1 - sum(map(self.word, seen))) * self.word(b)

    def score(self, text):
        tokens = [*WORDS.findall((text or "").translate(UPPER)), None]
        base = sum(math.log10((self.words[t] + 1) / (self.n + len(self.words) + 1)) for t in tokens)
        score = sum(math.log10(self.pair(a, b)) for a, b in zip([False, *tokens[:-1]], tokens))
        return len(tokens), sum(self.words[t] > 0 for t in tokens), self.n, base, score


def remainder(key, modulus):
    return zlib.crc32(("" if key is None else str(key)).encode()) % modulus
