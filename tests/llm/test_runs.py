"""Runs, linked vectors and spelling variants against plain versions."""

import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from plain import UPPER, WORDS, sha
from tables import DOCUMENTS, connect, documents, given, odd_documents, written
from trialmetrics.llm import embeddings, periodic, queries, spelling


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


# Runs


def plain_runs(words, shortest=6):
    """Every period in turn; the first that has a stretch is its smallest."""
    n, seen, out = len(words), set(), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start >= 3 * q and (start, i + q) not in seen:
                seen.add((start, i + q))
                out.append((start, i + q - start, q))
            i += i == start or i + q < n and words[i] != words[i + q]
    return sorted(((s, n, q) for s, n, q in out if n >= shortest), key=lambda r: (r[0], r[2]))


def plain_digests(key, text, changed=True):
    words = WORDS.findall(text or "")
    h, n = zlib.crc32(("" if key is None else str(key)).encode()), len(words)
    if changed and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = sorted(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))[:1]
    return (key, len(runs), *(best[0] if best else (None,) * 3), 1000 * best[0][1] // best[0][2] if best else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def repeating(seed=5, n=400):
    draw, docs = random.Random(seed), []
    for _ in range(n):
        words, letters = [], "abcd"[:draw.randint(1, 4)]
        for _ in range(draw.randint(0, 6)):
            unit = [draw.choice(letters) for _ in range(draw.randint(1, draw.choice([3, 8, 40])))]
            words += unit * draw.randint(1, draw.choice([2, 7, 10])) + unit[:draw.randint(0, len(unit))]
        docs.append(words)
    return docs


def test_runs_of_words():
    docs = repeating() + [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 3, ["a", "b"] * 4, ["a"] * 4000, list("abcdefg" * 600)]
    found = periodic.runs_of([[w.encode() for w in doc] for doc in docs])
    assert found == [plain_runs(doc) for doc in docs]
    assert sum(map(len, found)) > 500


@pytest.mark.parametrize("together", [1, 7])
def test_runs_do_not_depend_on_neighbours(together):
    docs = [[w.encode() for w in doc] for doc in repeating(6, 60)]
    found = [runs for i in range(0, len(docs), together) for runs in periodic.runs_of(docs[i:i + together])]
    assert found == periodic.runs_of(docs)


def test_periods_of_every_size():
    """A period of q words beside text that has none, four times and a little less."""
    draw = random.Random(8)
    for q in [*range(1, 40), 63, 64, 65, 127, 128, 129, 500]:
        unit, noise = [b"%d" % i for i in range(q)], [b"x%d" % draw.randrange(3000) for _ in range(50)]
        whole, less = unit * 4 if q > 1 else unit * 6, unit * 4 if q > 1 else unit * 5
        found = periodic.runs_of([noise + whole + noise, noise + less[:-1] + noise])
        assert (50, len(whole), q) in found[0] and not any(r[2] == q for r in found[1])


def test_run_digests_of_odd_documents(spark, tmp_path):
    docs = [(k, t[:6_000] if t else t) for k, t in odd_documents()]
    docs += [(1_000 + i, " ".join(words)) for i, words in enumerate(repeating(9, 100))] + [(None, "a " * 30), (7_000, "\x85a " * 12)]
    found = periodic.run_digests(documents(spark, tmp_path / "d", docs), change=periodic.with_repeats)
    assert rows(found) == sorted((plain_digests(k, t) for k, t in docs), key=repr)
    assert periodic.run_digests(written(spark, tmp_path / "e", [], DOCUMENTS)).count() == 0


def test_runs_of_given_documents(spark):
    docs = [(r[0], r[1]) for r in given("documents")]
    found = queries.queries()["op11_periodic_runs"](spark, "/root/testdata/sf0.001")
    short = {k for k, t in docs if len(WORDS.findall(t or "")) <= 1_500}
    assert len(short) > 100
    assert [r for r in rows(found) if r[0] in short] == sorted((plain_digests(k, t) for k, t in docs if k in short), key=repr)


def test_collapsed_texts(spark, tmp_path):
    docs = [(1, "say  ho ho ho ho ho ho\nnow"), (2, "a b a b a b a b a"), (3, None), (4, "as it was")]
    found = {r[0]: r[1:] for r in periodic.periodic_runs(documents(spark, tmp_path / "d", docs)).collect()}
    assert found[1] == ([(1, 6, 1)], "say ho now") and found[2] == ([(0, 9, 2)], "a b") and found[3] == ([], "") and found[4] == ([], "as it was")


# Linked vectors


VECTORS = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("label", "integer").add("id", "string") \
    .add("digest", "double").add("key", "string")


def plain_links(vectors, least=0.93):
    unit = []
    for _, v, label in vectors:
        x = np.array([math.nan if c is None else c for c in v or ()], np.float64)
        unit.append(x / np.linalg.norm(x) if label is not None and len(x) and np.isfinite(x).all() and x.any() else None)
    links, root = Counter(), list(range(len(vectors)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(vectors)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and vectors[i][2] == vectors[j][2] and len(unit[i]) == len(unit[j]) \
                    and unit[i] @ unit[j] >= least:
                links.update((i, j))
                root[find(i)] = find(j)
    keys = {}
    for i, (k, _, _) in enumerate(vectors):
        keys[find(i)] = min(keys.get(find(i), math.inf), math.inf if k is None else k)
    least_key = [None if keys[find(i)] == math.inf else keys[find(i)] for i in range(len(vectors))]
    return sorted(((k, links[i], least_key[i], k == least_key[i]) for i, (k, _, _) in enumerate(vectors)), key=repr)


def vectors_of(groups, seed=4, dimensions=32):
    """Groups of (size, noise) around random directions, labels in turn; ids are mixed."""
    draw, out = np.random.default_rng(seed), []
    for label, (size, noise) in enumerate(groups):
        centre = draw.standard_normal(dimensions)
        out += [((centre + noise * draw.standard_normal(dimensions)).astype(np.float32).tolist(), label % 3) for _ in range(size)]
    return [(int(k), *v) for k, v in zip(draw.permutation(len(out)), out)]


def table_of(spark, folder, vectors):
    return written(spark, folder, [(*v, "id", 0.5, "k") for v in vectors], VECTORS)


@pytest.mark.parametrize("max_paired, block", [(64, 512), (1, 7), (4, 20)])
def test_linked_vectors(spark, tmp_path, max_paired, block):
    vectors = vectors_of([(70, 0.12), (30, 0.02), (5, 0.2), (40, 0.15), (2, 0.05), *[(1, 1)] * 60])
    vectors += [(500 + i, vectors[i][1], vectors[i][2]) for i in range(40)] + [(500, vectors[0][1], vectors[0][2]), (None, vectors[0][1], vectors[0][2])]
    vectors += [(600, [2 * x for x in vectors[0][1]], vectors[0][2]), (601, [-x for x in vectors[0][1]], vectors[0][2])]
    found = embeddings.near_duplicates(table_of(spark, tmp_path / "v", vectors), max_paired=max_paired, block=block)
    assert rows(found) == plain_links(vectors)


def test_vectors_that_link_with_nothing(spark, tmp_path):
    one = [1.0, 2.0]
    vectors = [(1, None, 0), (2, [], 0), (3, [0.0, -0.0], 0), (4, [1.0, None], 0), (5, [math.nan, 1.0], 0), (6, [math.inf, 1.0], 0),
               (7, one, None), (8, one, None), (9, one, 0), (10, one, 0), (11, one, 1), (12, [*one, 0.0], 0), (None, None, None),
               (13, [1e-30, 2e-30], 0), (14, [1e30, 2e30], 0), (15, [0.0, 1.0], 2), (16, [-0.0, 3.0], 2)]
    found = embeddings.near_duplicates(table_of(spark, tmp_path / "v", vectors))
    assert [r[:2] + r[2:3] for r in rows(found)] == [r[:2] + r[2:3] for r in plain_links(vectors)]
    assert {r[0]: r[1] for r in rows(found)}[9] == 3
    assert embeddings.near_duplicates(table_of(spark, tmp_path / "e", [])).count() == 0


def test_vectors_near_the_threshold(spark, tmp_path):
    """Pairs just above and below it: all above, none below."""
    draw, vectors = np.random.default_rng(11), []
    for i in range(300):
        a, b = np.linalg.qr(draw.standard_normal((32, 2)))[0].T
        cosine = 0.935 if i % 2 else 0.929
        for k, v in enumerate((a, cosine * a + math.sqrt(1 - cosine ** 2) * b)):
            vectors.append((2 * i + k, v.astype(np.float32).tolist(), 0))
    assert rows(embeddings.near_duplicates(table_of(spark, tmp_path / "v", vectors), recall=0.99999)) == plain_links(vectors)


def test_linked_vectors_in_sql(spark, tmp_path):
    vectors = vectors_of([(30, 0.1), (9, 0.02), *[(1, 1)] * 20]) + [(90, None, 1), (91, [1.0, None], 1), (92, [0.0] * 32, 1)]
    table_of(spark, tmp_path / "embeddings.parquet", vectors)
    connection = connect()
    connection.execute(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    wanted = connection.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({queries.EMBEDDING_DEDUP})").fetchall()
    assert rows(queries.queries()["op12_embedding_dedup"](spark, str(tmp_path))) == sorted(wanted, key=repr) == plain_links(vectors)


# Spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(docs, slip=199, shortest=6, least=5, factor=5):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {w: min(near[w], key=lambda v: (-words[v], v), default=None) for w in words}
    form = {w: v if v and words[v] >= factor * n else None for (w, n), v in zip(words.items(), form.values())}

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items()), key=repr)


def misspelt(seed=12, n=60):
    """Documents of frequent words and of their variants, down to variants of variants."""
    draw, letters = random.Random(seed), "abcdeéàÿ×÷Àst"
    stems = ["".join(draw.choice(letters) for _ in range(draw.randint(5, 12))) for _ in range(40)]

    def slip(word):
        at = draw.randrange(len(word))
        return draw.choice([word[:at] + word[at + 1:], word[:at] + draw.choice(letters) + word[at:], word[:at] + draw.choice(letters) + word[at + 1:]])

    words = []
    for stem in stems:
        for times in (400, 60, 10, 3):
            words += [stem] * draw.randint(times // 2, times)
            stem = slip(stem)
    draw.shuffle(words)
    return [(i, draw.choice([" ", "_", "1"]).join(words[i::n])) for i in range(n)]


@pytest.mark.parametrize("cell, block", [(256, 2048), (1, 3), (1, 1)])
def test_variants(spark, tmp_path, monkeypatch, cell, block):
    monkeypatch.setattr(spelling, "CELL", cell)
    docs = misspelt() + odd_documents() + [(9_000 + i, "HÉLLÒworld") for i in range(6)]
    found = spelling.variants(documents(spark, tmp_path / "d", docs), block=block)
    wanted = plain_variants(docs)
    assert rows(found) == wanted
    assert any(r[1] and r[2] != r[1] for r in wanted) and sum(r[4] for r in wanted) > 100


def test_variants_by_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 11)
    monkeypatch.setattr(spelling, "HELD", 5)
    docs = misspelt(13, 9)
    assert rows(spelling.variants(documents(spark, tmp_path / "d", docs), slip=7)) == plain_variants(docs, slip=7)
    assert spelling.variants(written(spark, tmp_path / "e", [], DOCUMENTS)).count() == 0


@pytest.mark.parametrize("classes", [1, 2, 5, 12])
def test_cells_hold_all_words_one_edit_away(spark, classes):
    draw = random.Random(classes)
    for word in {w for _, t in misspelt(n=1) for w in re.findall("[a-zà-ÿ]{6,}", t)}:
        at = draw.randrange(len(word))
        other = draw.choice([word[:at] + word[at + 1:], word[:at] + "z" + word[at:], word[:at] + "z" + word[at + 1:]])
        assert spelling.cell_of(other, classes) in spelling.cells_around(spelling.cell_of(word, classes))


def test_variants_in_sql(spark, tmp_path):
    docs = misspelt(14) + odd_documents()
    documents(spark, tmp_path / "documents.parquet", docs)
    connection = connect()
    connection.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = connection.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({queries.SPELLING_VARIANTS})").fetchall()
    assert rows(queries.queries()["op13_spelling_variants"](spark, str(tmp_path))) == sorted(wanted, key=repr)
