"""Tokens, languages, passages and shards against plain versions and the public libraries."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F, types as T
from sentencepiece import sentencepiece_model_pb2
from tokenizers import Tokenizer

import plain
from tables import DOCUMENTS, documents, given, odd_documents, written
from trialmetrics.llm import decontaminate, language_id, pieces, sharding, token_counts
from trialmetrics.llm.common import id_remainder

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def odd_texts():
    draw = random.Random(1)
    made = ["".join(draw.choice("ab \n▁'s1é😀,") for _ in range(draw.randrange(60))) for _ in range(500)]
    return made + [t for _, t in odd_documents()] + [
        None, "", " ", "  a  ", "aaaaaaa" * 99, "<|endoftext|>a<|endoftext|>", "日本語 テキスト🙂", " " * 777 + "a", "don't we'll I'd   've",
        "".join(draw.choice("abcdefgh") for _ in range(5_000)), "a\x1cb\x1d \x85 \xa0c", "½ ² ٣٤ x²", "<s> </s><unk><0x41>"]


def test_token_counts(spark, tmp_path):
    texts = odd_texts() + [r[1] for r in given("documents")]
    want = Tokenizer.from_file(BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)
    found = token_counts.token_counts(documents(spark, tmp_path / "d", list(enumerate(texts))), BPE, limit=20)
    assert rows(found, "*") == sorted(
        ((i, len((t or "").encode()), len(w.ids), len(w.ids) > 20) for i, (t, w) in enumerate(zip(texts, want))), key=repr)
    assert token_counts.token_counts(written(spark, tmp_path / "e", [], DOCUMENTS), BPE).count() == 0


def test_remembered_words_make_no_difference(monkeypatch):
    texts = [t or "" for t in odd_texts()]
    want = token_counts.Counter(BPE).counts(texts)
    monkeypatch.setattr(token_counts, "REMEMBERED", 50)
    counter = token_counts.Counter(BPE)
    assert [n for i in range(0, len(texts), 7) for n in counter.counts(texts[i:i + 7])] == want


def test_long_texts_go_by_in_pieces(monkeypatch):
    texts = [t or "" for t in odd_texts()]
    want = token_counts.Counter(BPE).counts(texts)
    monkeypatch.setattr(token_counts, "AT_ONCE", 16)
    assert token_counts.Counter(BPE).counts(texts) == want


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.Merges.read(public_tokenizers.path("word_bpe_49k.json"))


def test_pieces_as_the_library_gives_them(spark, tmp_path):
    texts = odd_texts() + [r[1] for r in given("documents")]
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = pieces.encoded(documents(spark, tmp_path / "d", list(enumerate(texts))), PIECES).cache()
    want = library.encode([t or "" for t in texts])
    got = {r["doc_id"]: r for r in found.collect()}
    assert [got[i]["token_ids"] for i in range(len(texts))] == want
    assert all(got[i]["n_tokens"] == len(want[i]) for i in got)
    assert all(got[i]["round_trip"] == (pieces.SPACE not in (t or "")) for i, t in enumerate(texts))
    back = dict(pieces.decoded(found, PIECES).collect())
    assert [back[i] for i in range(len(texts))] == [library.decode(w) for w in want]
    assert pieces.encoded(written(spark, tmp_path / "e", [], DOCUMENTS), PIECES).count() == 0


def test_streaming_search_without_words():
    """The window alone, over texts in which no word ends, commits the same ids."""
    draw, library = random.Random(5), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    codec = pieces.Codec(PIECES)
    codec.by_word = False
    for text in ["".join(draw.choice("theringaonst ") for _ in range(400)) for _ in range(30)] + [t or "" for t in odd_texts()[:200]]:
        assert codec.encode(text) == library.encode(text)


@pytest.mark.parametrize("together, remembered", [(1, 1), (7, 5), (1 << 14, 250_000)])
def test_words_are_searched_together(monkeypatch, together, remembered):
    """Whatever is searched at a time, and remembered; long words go by the window."""
    monkeypatch.setattr(pieces, "TOGETHER", together)
    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    library, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Codec(PIECES)
    texts = [(t or "")[:500] for t in odd_texts()[:60]] + ["a" * 70, "日本語 über " * 9, "\u2581\u2581x  y ", "🙂🙂é\x00"]
    found = [np.frombuffer(ids, np.int32).tolist() for ids in codec.encode_all(texts)]
    assert found == library.encode(texts) == [codec.encode(t) for t in texts]
    assert max(map(len, codec.known.young)) <= 4 * codec.longest and len(codec.steps.young) <= remembered
    if remembered > 1_000:
        before = dict(codec.known.young)
        assert codec.encode_all(texts) and codec.known.young == before


def test_tables_of_numbers():
    draw = np.random.default_rng(3)
    keys = np.unique(draw.integers(0, 1 << 40, 5_000))
    table = pieces._Table(keys, np.arange(len(keys)))
    assert table.get(keys).tolist() == list(range(len(keys)))
    other = np.setdiff1d(draw.integers(0, 1 << 40, 5_000), keys)
    assert (table.get(other) == -1).all() and pieces._Table(keys[:0], keys[:0]).get(keys[:3]).tolist() == [-1] * 3


def test_unigram_scores_by_viterbi():
    """The same pieces as a unigram model: the greatest sum of scores, as the library finds it."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = pieces.UNIGRAM
    draw = random.Random(6)
    for piece in proto.pieces:
        if piece.type == pieces.NORMAL:
            piece.score = -draw.uniform(5, 15)
    codec, library = pieces.Codec(PIECES), sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    codec.additive, codec.scores = True, {p.piece: p.score for p in proto.pieces if p.type == pieces.NORMAL}
    codec.unknown_score = min(codec.scores.values()) - 10
    for by_word in (True, False):
        codec.by_word, codec.known = by_word, pieces.Remembered(10)
        for text in ["".join(draw.choice("theringaonst é日") for _ in range(draw.randrange(1, 300))) for _ in range(60)]:
            assert codec.encode(text) == library.encode(text)


def test_wanted_languages_and_least_score(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trees = language_id.fitted(docs, "text", "lang", F.lit(True))
    judged = {r["doc_id"]: r for r in language_id.languages(docs, trees).collect()}

    def kept(**limits):
        out = language_id.in_a_language(docs, trees, **limits)
        assert out.schema == docs.schema
        return {r["doc_id"] for r in out.collect()}

    known = {k for k, r in judged.items() if r["lang_pred"] != "und"}
    one = {k for k in known if judged[k]["lang_pred"] == "en"}
    assert kept() == known and kept(wanted=["en"]) == one and kept(wanted=[]) == set() and 0 < len(one) < len(known)
    scores = sorted(r["score"] for r in judged.values())
    assert kept(least=scores[-1]) == {k for k in known if judged[k]["score"] >= scores[-1]}


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    trees = language_id.fitted(docs, "text", "lang", ~held_out)
    found = language_id.languages(docs.drop("lang", "source"), trees).join(docs.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in found if plain.remainder(r["doc_id"], 3) == 1]
    assert len(tested) > 250 and sum(r["lang_pred"] == r["lang"] for r in tested) > 0.97 * len(tested)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_code_lengths_are_exact():
    """Probabilities after each context add up to one; lengths are those of the definition, byte by byte."""
    samples = [("a", b"abracadabra abra"), ("b", "être à la mer".encode()), ("b", b"")]
    trees = language_id.train(samples, order=2)
    p = np.exp2(-trees.bits.astype(float))
    p[:, 0] *= 257 - p.shape[1]
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    texts = [b"abra", b"", b"xyz", "mer à".encode()]
    got = language_id.code_lengths(texts, trees)
    assert np.allclose(language_id.code_lengths(texts, trees, piece=2), got)
    for k, language in enumerate(trees.languages):
        sample = [t for of, t in samples if of == language]
        for i, text in enumerate(texts):
            want = sum(-np.log2(ppm(samples, sample, text[max(0, j - 2):j], text[j])) for j in range(len(text)))
            assert abs(got[i, k] - want) < 1e-3


def ppm(everything, sample, context, byte):
    """PPM by recursion; contexts that no language has seen are shortened, as in the shared automaton."""
    def followers(of, c):
        out = {}
        for t in of:
            for j in range(len(t) - len(c)):
                if t[j:j + len(c)] == c:
                    out[t[j + len(c)]] = out.get(t[j + len(c)], 0) + 1
        return out

    while context and not followers([t for _, t in everything], context):
        context = context[1:]

    def distribution(c):
        shorter = distribution(c[1:]) if c else dict.fromkeys(range(256), 1 / 256)
        seen = followers(sample, c)
        if not seen:
            return shorter
        total = sum(seen.values()) + len(seen)
        left = sum(p for x, p in shorter.items() if x not in seen)
        return {x: seen[x] / total if x in seen else len(seen) / total * shorter[x] / left for x in range(256)}

    return distribution(context)[byte]


def test_languages_of_odd_texts(spark, tmp_path):
    docs = documents(spark, tmp_path / "d", odd_documents())
    trees = language_id.fitted(docs, "text", "lang", F.lit(True))
    found = {r["doc_id"]: r for r in language_id.languages(docs, trees).collect() if r["doc_id"] is not None}
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (300, 301, 302, 303, 304, 503))
    assert found[308]["lang_pred"] == "en" and found[307]["lang_pred"] == "en"
    kept = language_id.in_a_language(docs, trees)
    assert kept.schema == docs.schema and kept.filter("doc_id between 300 and 304").count() == 0
    untrained = language_id.fitted(docs, "text", "lang", F.lit(False))
    assert {r["lang_pred"] for r in language_id.languages(docs, untrained).collect()} == {"und"}
    assert language_id.languages(written(spark, tmp_path / "e", [], DOCUMENTS), trees).count() == 0


def test_sample_is_bounded_and_drawn_by_text(spark, tmp_path):
    docs = documents(spark, tmp_path / "d", [(i, f"text number {i % 300} of many") for i in range(3_000)])
    sample = language_id.training_sample(docs, "text", "lang", F.lit(True), bytes_per_language=2_000)
    again = language_id.training_sample(docs.repartition(7), "text", "lang", F.lit(True), bytes_per_language=2_000)
    assert sample == again and 0 < sum(len(t) for _, t in sample) <= 3_000 and len(set(sample)) == len(sample)


def test_table_of_contexts_is_bounded():
    draw = random.Random(1)
    sample = [("a", bytes(draw.randrange(256) for _ in range(20_000)))]
    trees = language_id.train(sample, table_bytes=1 << 20)
    assert trees.bits.nbytes + trees.after.nbytes <= 1 << 20 and trees.after.max() < len(trees.after)


ITEMS = [(1, "The cat sat on the mat and looked at the big dog that slept"), (2, "too short"), (3, None), (4, " ... "),
         (5, "the cat sat on the mat and looked at the end of it all"), (None, "no id here at all"), (2, "too short")]


def passages():
    text = ITEMS[0][1]
    return [(1, text), (2, text.upper().replace(" ", "--")), (3, "x " + " ".join(text.split()[:9])), (4, "x " + " ".join(text.split()[:10])),
            (5, "nothing"), (6, None), (7, ""), (8, "it is Too,short. too short"), (8, "it is Too,short. too short"), (9, text + " " + text),
            (10, "no id here at all été"), (None, text), (11, "word " * 50_000 + text)]


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_contamination(spark, tmp_path, block_bytes):
    docs = passages() + odd_documents()
    items = written(spark, tmp_path / "i", ITEMS, T.StructType().add("item_id", "long").add("text", "string"))
    found = decontaminate.contamination(documents(spark, tmp_path / "d", docs), items, block_bytes=block_bytes)
    assert rows(found, "*") == sorted(plain.contamination(docs, ITEMS), key=repr)


def test_contaminated_documents_and_spans_go(spark, tmp_path):
    schema = T.StructType().add("item_id", "long").add("text", "string")
    items = written(spark, tmp_path / "i", ITEMS, schema)
    df = documents(spark, tmp_path / "d", passages())
    clean = decontaminate.decontaminated(df, items)
    assert clean.schema == df.schema and {r["doc_id"] for r in clean.collect()} == {3, 5, 6, 7}
    cut = {r["doc_id"]: r["text"] for r in decontaminate.decontaminated(df, items, remove="spans").collect()}
    assert cut[1] == "" and cut[4] == "x " and cut[8] == "it is " and cut[6] is None and cut[10] == " été" and cut[5] == "nothing"
    assert cut[11] == "word " * 50_000
    none = written(spark, tmp_path / "n", [], schema)
    assert decontaminate.decontaminated(df, none).count() == df.count()
    assert decontaminate.contamination(written(spark, tmp_path / "e", [], DOCUMENTS), items).count() == 0


@pytest.mark.parametrize("partitions", [1, 5, 30])
def test_shards(spark, tmp_path, partitions):
    docs = odd_documents() + [(7, "tie")] * 50
    found = sharding.byte_shards(documents(spark, tmp_path / "d", docs), shards=6, partitions=partitions).collect()
    sizes = {}
    assert sorted((r["doc_id"], r["size"]) for r in found if r["doc_id"] is not None) == sorted(
        (k, len((t or "").encode()) + 8) for k, t in docs if k is not None)
    order = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in order] == sorted((k for k, _ in docs), key=plain.last_if_none)
    total, before = sum(r["size"] for r in found), 0
    for r in order:
        assert r["shard"] == (2 * before + r["size"]) * 6 // (2 * total) and r["grown_shard"] is None and r["law"] == "bytes"
        assert r["slot"] == sizes.get(r["shard"], 0)
        sizes[r["shard"]] = r["slot"] + 1
        before += r["size"]
    assert {(r["doc_id"], r["text_crc32"]) for r in found} == {
        (k, __import__("zlib").crc32((t or "").encode())) for k, t in docs}


def test_shards_of_nothing(spark, tmp_path):
    assert sharding.byte_shards(written(spark, tmp_path / "e", [], DOCUMENTS)).count() == 0


def test_every_language_is_drawn(spark, tmp_path):
    """Copies of few texts, and one text longer than the bound, among many others."""
    docs = [(f"{i} some words of the usual kind", "en") for i in range(400)]
    docs += [(f"algunas palabras {i % 3}", "es") for i in range(3_000)] + [("ein langes Wort nach dem anderen " * 400, "de")]
    df = written(spark, tmp_path / "d", [(i, t, l) for i, (t, l) in enumerate(docs)], "doc_id long, text string, lang string")
    sample = language_id.training_sample(df, "text", "lang", F.lit(True), bytes_per_language=1_000)
    sizes = {name: sum(len(t) for l, t in sample if l == name) for name in ("de", "en", "es")}
    assert sorted(t for l, t in sample if l == "es") == [b"algunas palabras %d" % i for i in range(3)]
    assert 1_000 <= sizes["de"] <= 1_125 and 1_000 <= sizes["en"] <= 1_125 and max(len(t) for _, t in sample) <= 125
    again = language_id.training_sample(df.repartition(5), "text", "lang", F.lit(True), bytes_per_language=1_000)
    assert again == sample


def test_no_model_rejects_no_text(spark, tmp_path):
    df = written(spark, tmp_path / "d", [(1, "a word"), (2, None), (3, "12 3")], "doc_id long, text string")
    trees = language_id.fitted(df.withColumn("lang", F.lit(None).cast("string")), "text", "lang", F.lit(True))
    assert [r["doc_id"] for r in language_id.in_a_language(df, trees).collect()] == [1]
