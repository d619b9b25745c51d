"""Exact and near duplicates against plain versions."""

import random

import pytest

import plain
from tables import DOCUMENTS, documents, given, odd_documents, written
from trialmetrics.llm import exact_dedup, simhash
from trialmetrics.llm.common import numbered


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_exact_groups(spark, tmp_path, partitions):
    docs = odd_documents()
    found = exact_dedup.exact_duplicates(documents(spark, tmp_path / "d", docs), partitions=partitions)
    assert rows(found, *EXACT) == sorted(plain.exact(docs), key=repr)


def test_exact_group_over_many_partitions(spark, tmp_path):
    """A group that splitters cut into many parts stays one group with one row kept."""
    docs = [(i, "one text " + " " * (i % 3)) for i in range(2_000)] + [(5_000 + i, f"other {i % 11}") for i in range(500)]
    found = exact_dedup.exact_duplicates(documents(spark, tmp_path / "d", docs, parts=8), partitions=16)
    assert rows(found, *EXACT) == sorted(plain.exact(docs), key=repr)


def test_exact_small_batches(spark, tmp_path):
    docs = [(i, "abc"[i % 3] * (i % 2 + 1)) for i in range(60)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        found = exact_dedup.exact_duplicates(documents(spark, tmp_path / "d", docs), partitions=3)
        assert rows(found, *EXACT) == sorted(plain.exact(docs), key=repr)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_exact_carries_columns_and_handles_nothing(spark, tmp_path):
    df = numbered(documents(spark, tmp_path / "d", [(1, "a"), (1, "a"), (1, "a")]), "number")
    found = exact_dedup.exact_duplicates(df, carry=["number"]).collect()
    assert len({r["carry_0"] for r in found}) == 3 and sum(r["kept"] for r in found) == 1
    assert exact_dedup.exact_duplicates(written(spark, tmp_path / "e", [], DOCUMENTS)).count() == 0


def near_copies(seed=3):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for group in range(12):
        base = [draw.choice(words) for _ in range(draw.choice([1, 2, 3, 40, 300]))]
        for copy in range(draw.randrange(1, 9)):
            text = list(base)
            if copy and len(text) > 40:
                text[draw.randrange(len(text))] = draw.choice(words)
            docs.append((len(docs), " ".join(text)))
    return docs


@pytest.mark.parametrize("max_paired", [1, 32])
@pytest.mark.parametrize("bits", [0, 1, 2])
def test_components(spark, tmp_path, bits, max_paired):
    docs = near_copies() + [(1_000 + i, t) for i, (_, t) in enumerate(odd_documents())] + [(None, None), (None, "w1 w2")]
    found = simhash.near_duplicates(documents(spark, tmp_path / "d", docs), bits=bits, max_paired=max_paired)
    assert rows(found, "doc_id", "fingerprint", "component_id") == sorted(plain.components(docs, bits), key=repr)


def test_components_of_given_documents(spark):
    docs = [(r[0], r[1]) for r in given("documents")]
    found = simhash.near_duplicates(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert rows(found, "doc_id", "fingerprint", "component_id") == sorted(plain.components(docs), key=repr)


@pytest.mark.parametrize("max_paired", [2, 64])
def test_links_between_fingerprints(spark, max_paired):
    """Chains and stars of fingerprints with bits flipped anywhere, the highest included."""
    draw = random.Random(1)
    prints = {0, (1 << 64) - 1}
    for _ in range(8):
        at = draw.getrandbits(64)
        for _ in range(25):
            prints.add(at)
            at ^= sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 3])))
        prints |= {at ^ 1 << b for b in range(64)}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.close_pairs(table, 2, max_paired)).collect()}
    want = plain_roots(signed)
    assert {p: found.get(p, p) for p in signed} == want


def plain_roots(prints):
    root = {p: p for p in prints}
    changed = True
    links = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    while changed:
        changed = False
        for a, b in links:
            least = min(root[a], root[b])
            if root[a] != least or root[b] != least:
                root[a] = root[b] = least
                changed = True
    return root


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
@pytest.mark.parametrize("shingle", [1, 3])
def test_fingerprints_by_pieces(monkeypatch, piece, shingle):
    monkeypatch.setattr(simhash, "PIECE", piece)
    for _, text in odd_documents():
        text = (text or "")[:4_000]
        assert simhash.fingerprint(text.encode(), shingle) == plain.fingerprint(text, shingle)


def test_no_pivot_discards_a_close_pair():
    draw = random.Random(2)
    for _ in range(2_000):
        a = draw.getrandbits(64)
        b = a ^ sum(1 << i for i in draw.sample(range(64), 2))
        assert all(abs((a ^ p % (1 << 64)).bit_count() - (b ^ p % (1 << 64)).bit_count()) <= 2 for p in simhash.PIVOTS)


def test_one_kept_in_each_component(spark, tmp_path):
    df = numbered(documents(spark, tmp_path / "d", near_copies() + [(900, "w1 w2"), (900, "w1 w2"), (None, "w1 w2")]), "number")
    found = simhash.near_duplicates(df, carry=["number"]).collect()
    kept = [r["component_id"] for r in found if r["kept"]]
    assert len(kept) == len(set(kept)) == len({r["component_id"] for r in found})
    assert simhash.near_duplicates(written(spark, tmp_path / "e", [], DOCUMENTS)).count() == 0


def test_numbers_of_rows_do_not_depend_on_splits(spark, tmp_path):
    """As after a lost executor: files are packed into tasks anew. Also for rows that are no scan."""
    docs = [(i % 50, f"text {i % 50} " * (1 + i % 7)) for i in range(400)]
    df = documents(spark, tmp_path / "d", docs, parts=9)
    scan = numbered(df, "number")
    made = numbered(df.groupBy("text").count(), "number")
    setting, found = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(setting)
    try:
        for size in (before, "3000", "500"):
            spark.conf.set(setting, size)
            rows = spark.read.parquet(str(tmp_path / "d"))
            found.append([sorted((r["number"], r["text"]) for r in frame.collect()) for frame in (
                scan.select("*"), made.select("*"), numbered(rows, "number"))])
    finally:
        spark.conf.set(setting, before)
    assert found[0] == found[1] == found[2] and found[0][0] == found[0][2]
    assert [n for n, _ in found[0][0]] == list(range(400)) and scan.columns == [*df.columns, "number"]
