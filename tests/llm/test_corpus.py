"""Archives, personal data, language-model scores, and the whole pipeline."""

import gzip
import hashlib
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

import plain
from compare import difference
from tables import DOCUMENTS, connect, documents, given, odd_documents, written
from trialmetrics.llm import katz, pii, queries, warc
from trialmetrics.llm.common import id_remainder

PAGES = T.StructType().add("page_id", "long").add("url", "string").add("html", "string").add("digest", "string").add("shard", "integer")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    assert difference(queries.queries()[name](spark, folder), connect(folder), queries.oracle_sql()[name]) is None


def pages():
    draw = random.Random(4)
    long = [f"<p>{'é' * n} {n}</p>" * 5 for n in (3, 30, 300)]
    made = [(i, f"http://a.example/{i}", draw.choice(long) if i % 2 else f"<p>{i}</p>" + "x" * draw.randrange(3_000)) for i in range(200)]
    made += [(500 + i, "http://b.example/ \r\nX: y", "short") for i in range(4)]
    made += [(600, None, None), (601, "", ""), (None, "u", long[0]), (None, None, None), (7, "u", long[1]), (7, "u", long[1]),
             (-5, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (602, "u", "y" * 99), (603, "u", "y" * 99), (604, "u", "z" * 100), (605, "u", "z" * 100)]
    return [(*p, "d", 3) for p in made]


def expected(made):
    first = {}
    for i, (key, _, html, *_) in enumerate(made):
        payload = (html or "").encode()
        first[payload] = min(first.get(payload, (True, 0, 0)), (*plain.last_if_none(key), i))
    for key, _, html, *_ in made:
        payload = (html or "").encode()
        yield key, len(payload), hashlib.sha256(payload).hexdigest(), payload, first[payload]


@pytest.mark.parametrize("shard_bytes,file_bytes", [(1 << 30, 1 << 30), (20_000, 1_500), (3_000, 1)])
def test_archives_come_back(spark, tmp_path, shard_bytes, file_bytes):
    made = pages()
    folder = str(tmp_path / "out")
    manifest = warc.write_warc(written(spark, tmp_path / "p", made, PAGES), folder, shard_bytes=shard_bytes, file_bytes=file_bytes)
    files = manifest.collect()
    assert sum(f["records"] for f in files) == len(made)
    assert {f["file"] for f in files} == {p.name for p in Path(folder).glob("*.warc.gz")} and not (tmp_path / "out/_temporary").exists()
    if shard_bytes < 1 << 30:
        assert len({f["shard"] for f in files}) > 3
        assert len(files) > len({f["shard"] for f in files})
    found = warc.read_warc(spark, folder, payloads=True).collect()
    want = list(expected(made))
    assert Counter((r["key"], r["payload_bytes"], r["payload_digest"]) for r in found) == Counter(w[:3] for w in want)
    of = {w[2]: w for w in want}
    for r in found:
        _, size, _, payload, (_, first, _) = of[r["payload_digest"]]
        if r["record_type"] == "revisit":
            assert size >= 100 and r["refers_to"] == first and r["payload"] is None
        else:
            assert r["refers_to"] is None and bytes(r["payload"]) == payload
    responses = Counter(r["payload_digest"] for r in found if r["record_type"] == "response")
    assert all(n == 1 for digest, n in responses.items() if of[digest][1] >= 100)


def test_archives_are_the_same_bytes_however_the_pages_lie(spark, tmp_path):
    made = [p for p in pages() if p[0] is not None and p[0] != 7]
    sums = []
    for parts in (1, 5):
        df = written(spark, tmp_path / f"p{parts}", made[::1 if parts == 1 else -1], PAGES, parts)
        manifest = warc.write_warc(df, str(tmp_path / f"o{parts}"), shard_bytes=20_000, file_bytes=1_500)
        sums.append(sorted(tuple(r) for r in manifest.collect()))
    assert sums[0] == sums[1]


def test_archives_are_plain_warc(spark, tmp_path):
    folder = tmp_path / "out"
    warc.write_warc(written(spark, tmp_path / "p", pages(), PAGES), str(folder))
    (file,) = folder.glob("*.warc.gz")
    data = gzip.decompress(file.read_bytes())
    at, kinds = 0, Counter()
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        kinds[fields["WARC-Type"]] += 1
        assert head.startswith(b"WARC/1.1\r\n") and re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", fields["WARC-Record-ID"])
        at += len(head) + 4 + int(fields["Content-Length"])
        assert data[at:at + 4] == b"\r\n\r\n"
        at += 4
    assert kinds["warcinfo"] == 1 and kinds["response"] + kinds["revisit"] == len(pages())


@pytest.mark.parametrize("key", [7, None])
def test_an_id_with_a_third_of_all_pages_is_spread(spark, tmp_path, key):
    draw = random.Random(9)
    made = [(key if i % 3 == 0 else 1_000 + i, f"u{i}", "".join(draw.choice("abcdef") for _ in range(600))) for i in range(600)]
    manifest = warc.write_warc(written(spark, tmp_path / "p", made, T.StructType().add("page_id", "long").add("url", "string").add("html", "string")),
                               str(tmp_path / "out"), shard_bytes=20_000).collect()
    sizes = Counter()
    for file in manifest:
        sizes[file["shard"]] += file["records"]
    assert len(sizes) > 12 and max(sizes.values()) < 120 and sum(sizes.values()) >= 600
    found = warc.read_warc(spark, str(tmp_path / "out")).collect()
    assert sorted((r["url"], r["payload_bytes"]) for r in found) == sorted((u, 600) for _, u, _ in made)


def test_damaged_archives_are_refused(spark, tmp_path):
    folder = tmp_path / "out"
    warc.write_warc(written(spark, tmp_path / "p", pages(), PAGES), str(folder))
    (file,) = folder.glob("*.warc.gz")
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"<p>0</p>", b"<p>1</p>")))
    with pytest.raises(Exception):
        warc.read_warc(spark, str(folder)).collect()
    empty = warc.write_warc(written(spark, tmp_path / "e", [], PAGES), str(tmp_path / "none"))
    assert empty.count() == 0 and warc.read_warc(spark, str(tmp_path / "none")).count() == 0


def spelled(base, terms):
    spans = [f"{k}:{a}:{b}" for k, a, b in base]
    return plain.sha(",".join(spans)), ",".join(spans + [f"term:{a}:{b}" for a, b in terms])


LIMITS = [pii.Thresholds(), pii.Thresholds(two_texts=True), pii.Thresholds(least_support=3), pii.Thresholds(window=64, two_texts=True), pii.Thresholds(window=64)]


def plain_disclosures(docs, limits):
    return plain.disclosures(docs, limits.window, limits.two_texts, support=limits.least_support)


@pytest.mark.parametrize("limits", LIMITS)
def test_personal_data(spark, tmp_path, limits):
    docs = odd_documents()
    found = pii.personal_data(documents(spark, tmp_path / "d", docs), limits=limits)
    want = []
    for (key, _), (base, terms, removed) in zip(docs, plain_disclosures(docs, limits)):
        kinds = Counter(k for k, *_ in base)
        want.append((key, *[kinds[k] for k in pii.KINDS], *spelled(base, terms), len(terms), removed))
    assert rows(found, "*") == sorted(want, key=repr)
    assert any(w[-2] for w in want)
    assert pii.personal_data(written(spark, tmp_path / "e", [], DOCUMENTS), limits=limits).count() == 0


@pytest.mark.parametrize("limits, folder", [(LIMITS[0], "/root/testdata/sf0.001"), (LIMITS[1], "/root/testdata/sf0.001"),
                                            (LIMITS[3], "/root/testdata/sf0.01")])
def test_personal_data_of_given_documents(spark, limits, folder):
    docs = [(r[0], r[1]) for r in given("documents", folder)]
    found = pii.personal_data(spark.read.parquet(f"{folder}/documents.parquet"), limits=limits)
    want = [(k, *spelled(base, terms), removed) for (k, _), (base, terms, removed) in zip(docs, plain_disclosures(docs, limits))]
    assert rows(found, "doc_id", "base_sha256", "spans", "n_removed") == sorted(want, key=repr)
    assert limits.two_texts or any("term:" in w[2] for w in want)


def test_an_entity_is_the_same_wherever_it_stands(spark, tmp_path):
    """Second in one text and first in another: two documents hold it, and only what both hold gives it away."""
    docs = [(1, "a@mail.example then b@mail.example quonsar once"), (2, "b@mail.example quonsar"), *((10 + i, "then once") for i in range(6))]
    for limits in LIMITS[:2]:
        found = {r["doc_id"]: r for r in pii.personal_data(documents(spark, tmp_path / str(limits.two_texts), docs), limits=limits).collect()}
        at = docs[0][1].index("quonsar")
        assert f"term:{at}:{at + 7}" in found[1]["spans"] and found[2]["spans"].endswith("term:15:22")


def test_a_page_of_addresses_costs_as_much_as_its_words(spark, tmp_path, monkeypatch):
    """Entities of the same documents are one class; a few that another text shares are another."""
    sizes, kept = {}, pii.stored

    def counted(df, name):
        out = kept(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(pii, "stored", counted)
    for n in (50, 100, 200):
        word = "".join(chr(97 + i % 26) for i in range(6))
        page = " ".join(f"{word}{chr(97 + i // 26)}{chr(97 + i % 26)} a{i}@mail.example" for i in range(n))
        docs = [(1, page), (2, "see a1@mail.example a2@mail.example here"), (3, "other words")]
        found = {r["doc_id"]: r for r in pii.personal_data(documents(spark, tmp_path / f"d{n}", docs)).collect()}
        assert found[1]["n_email"] == n and found[1]["n_term"] == n
        assert sizes["pii-classes"] == 3 and sizes["pii-pairs"] <= 2 * n + 10


def test_terms_of_an_entity_of_one_text(spark, tmp_path):
    docs = [(1, "write to jo@mail.example about Quonsar today"), (2, "about today"), (3, "write to all about it today")]
    folder = tmp_path / "sf"
    documents(spark, folder / "documents.parquet", docs)
    found = {r["doc_id"]: r for r in queries.queries()["op7_pii"](spark, str(folder)).collect()}
    at = docs[0][1].index("Quonsar")
    assert f"term:{at}:{at + 7}" in found[1]["spans"] and found[1]["n_removed"] == 1
    assert not any(found[k]["n_term"] for k in (2, 3))


def test_terms_far_from_their_entity(spark, tmp_path):
    """All places of a term in texts with the entity, and none in others; two rows of a text, as many entities as words."""
    text = "Quonsar came. " + "it was said of it " * 20 + "mail jo@mail.example or 10.0.0.1 " + "that it was " * 20 + "Quonsar quonsar"
    docs = [(1, text), (2, text), (3, "it was said that of it came or mail"), (4, "Zeb knows"), (5, None), (6, "or 10.0.0.1 then"),
            *((10 + i, "it was") for i in range(20))]
    folder = tmp_path / "sf"
    df = documents(spark, folder / "documents.parquet", docs)
    found = {r["doc_id"]: r for r in queries.queries()["op7_pii"](spark, str(folder)).collect()}
    for key in (1, 2):
        places = [m.span() for m in re.finditer("quonsar", text, re.I)]
        assert len(places) == 3 and all(f"term:{a}:{b}" in found[key]["spans"].split(",") for a, b in places)
    assert len(found) == len(docs) and not found[3]["n_term"] and not found[4]["n_term"] and found[6]["n_ip"] == 1
    limits = pii.Thresholds(window=None, two_texts=False)
    texts = {r["doc_id"]: r["text"] for r in pii.sanitised(df, limits=limits).collect()}
    assert "uonsar" not in texts[1] and "[EMAIL]" in texts[1] and texts[4] == "Zeb knows" and texts[5] is None


def test_running_totals_in_blocks(spark):
    draw = random.Random(3)
    arrays = [[draw.randrange(9) for _ in range(n)] for n in (0, 1, 127, 128, 129, 1_000)]
    df = spark.createDataFrame([(a,) for a in arrays], "a array<bigint>")
    assert [r[0] for r in df.select(pii._running(F.col("a"))).collect()] == [np.cumsum(a, dtype=int).tolist() for a in arrays]


def test_sanitised_texts(spark, tmp_path):
    docs = documents(spark, tmp_path / "d", odd_documents())
    out = pii.sanitised(docs)
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.schema == docs.schema and len(texts) == len({k for k, _ in odd_documents()})
    assert texts[505] == "🙂 é [IP] ü [PHONE]." and texts[300] is None and texts[301] == ""
    assert "[EMAIL]" in texts[400] and "[CARD]" in texts[400] and "Quonsar" not in texts[400] and "third" not in texts[400]
    assert dict(odd_documents())[0] == texts[0]


def katz_rows(spark, df, **options):
    found = katz.scored(df, held_out=id_remainder(F.col("doc_id"), 7) == 2, **options).collect()
    return sorted(found, key=lambda r: repr(r["doc_id"]))


@pytest.mark.parametrize("options", [{}, {"head": 0}, {"head": 5, "bucket_tokens": 500}, {"bucket_tokens": 50}])
def test_scores(spark, tmp_path, options):
    docs = odd_documents() + [(900 + i, "a a a a a a a a a") for i in range(40)] + [(950, "new words a that none knows")]
    docs = [(k, t) for k, t in docs if k not in (307, 502)]
    model = plain.Katz([t for k, t in docs if plain.remainder(k, 7) != 2])
    found = katz_rows(spark, documents(spark, tmp_path / "d", docs), **options)
    assert len(found) == len(docs) and any(r["held_out"] for r in found)
    texts = sorted(docs, key=lambda d: repr(d[0]))
    scores = sorted((repr(k), *model.score(t)) for k, t in texts)
    got = sorted((repr(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found)
    for a, b in zip(got, scores):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-9)


@pytest.mark.parametrize("texts", [["a b c"] * 50, ["x"], [None, None, ""], ["a b", "c d"] * 4])
def test_scores_of_regular_texts(spark, tmp_path, texts):
    """No low counts, one text, no words: probabilities stay positive and sum to one."""
    docs = list(enumerate(texts))
    model = plain.Katz([t for k, t in docs if plain.remainder(k, 7) != 2])
    for r in katz_rows(spark, documents(spark, tmp_path / "d", docs)):
        n, known, total, base, score = model.score(texts[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert (r["base_score"], r["score"]) == pytest.approx((base, score), rel=1e-9, abs=1e-12)
    for context in [*model.words, False, "never seen"]:
        assert sum(model.pair(context, b) for b in [*model.words, "never seen"]) == pytest.approx(1)


@pytest.mark.parametrize("counts", [[100, 40, 20, 12, 9, 7], [1266, 300, 150, 160, 80, 70], [5, 0, 0, 0, 0, 9], [3, 3, 3, 3, 3, 3], [0, 0, 4, 0, 0, 0],
                                    [0] * 6, [1, 50, 0, 0, 0, 0], [10 ** 9, 10 ** 7, 10 ** 6, 10 ** 5, 10 ** 5, 10 ** 5]])
def test_discounts_lie_between_zero_and_one(counts):
    """However uneven the counts of counts are; on a line they are Katz's own."""
    found = katz.discounts(counts)
    assert len(found) == katz.LOW and all(0 < d < 1 for d in found) and found == sorted(found)
    assert found == pytest.approx(plain.good_turing([r for r, n in enumerate(counts, 1) for _ in range(min(n, 2_000))]), rel=1e-9) or max(counts) > 2_000
    line = [10_000 * r ** -2.0 for r in range(1, 7)]
    share = 6 * line[5] / line[0]
    assert katz.discounts(line) == pytest.approx([((r + 1) * line[r] / (r * line[r - 1]) - share) / (1 - share) for r in range(1, 6)])


def test_scores_of_nothing_and_without_training(spark, tmp_path):
    assert katz.scored(written(spark, tmp_path / "e", [], DOCUMENTS)).count() == 0
    found = katz.scored(documents(spark, tmp_path / "d", [(1, "a b"), (2, None)]), held_out=F.lit(True)).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found) == [
        (1, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


def test_scores_of_given_documents(spark):
    docs = [(r[0], r[1]) for r in given("documents")]
    model = plain.Katz([t for k, t in docs if plain.remainder(k, 7) != 2])
    found = {r["doc_id"]: r for r in queries.queries()["op8_lm_scores"](spark, "/root/testdata/sf0.001").collect()}
    for key, text in docs:
        if key % 5 == 0 and len(text) < 3_000:
            assert found[key]["score"] == pytest.approx(model.score(text)[-1], rel=1e-9)


def test_pipeline(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    docs = [(r[0], r[1]) for r in given("documents", folder)]
    docs = [(k, t) for k, t in docs if re.search(r"[^\W\d_]", t or "")]
    by_id = dict(docs)
    kept = {r[0] for r in plain.exact(docs) if r[3]}
    docs = [(k, t) for k, t in docs if k in kept]
    least = {r[0] for r in plain.components(docs) if r[0] == r[2]}
    docs = [(k, t) for k, t in docs if k in least]
    clean = {r[0] for r in plain.contamination(docs, [(r[0], r[1]) for r in given("benchmark", folder)]) if not r[5]}
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in found} == clean and len(found) == len(clean) > 100
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) > 0 for r in found)
    assert len(by_id) > len(clean)


def test_pipeline_stages_with_odd_tables(spark, tmp_path):
    import corpus_pipeline

    for name, docs in (("odd", odd_documents() + [(None, None), (305, "same")]), ("empty", [])):
        folder = tmp_path / name
        df = documents(spark, folder / "documents.parquet", docs) if docs else written(spark, folder / "documents.parquet", [], DOCUMENTS)
        written(spark, folder / "benchmark.parquet", [(1, None), (None, "no such words here")], T.StructType().add("item_id", "long").add("text", "string"))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = stage(spark, df, str(folder))
            assert df.columns == [f.name for f in DOCUMENTS]
            path = str(tmp_path / f"{name}-{stage.__name__}")
            df.write.parquet(path)
            df = spark.read.parquet(path)
        ids = [r["doc_id"] for r in corpus_pipeline.run(spark, str(folder)).collect()]
        assert len(ids) == df.count() and ids.count(305) <= 1
