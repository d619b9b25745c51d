"""The operators over whole tables, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from trialmetrics.llm import (
    embeddings, exact_dedup, katz, language_id, periodic, pieces, pii, sharding, simhash, spelling, token_counts, warc)
from trialmetrics.llm.common import id_remainder, new_folder
from trialmetrics.llm.decontaminate import contamination

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def _warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    archive = new_folder(pages, "warc")
    warc.write_warc(pages, archive)
    return warc.read_warc(spark, archive).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def _token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.token_counts(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def _sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def _language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = id_remainder(F.col("doc_id"), 3) == 1
    trees = language_id.fitted(docs, "text", "lang", ~held_out)
    return language_id.languages(docs, trees).select(
        "doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def _sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.byte_shards(table(spark, folder, "documents"), shards=24)


def _pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.personal_data(table(spark, folder, "documents"), limits=pii.Thresholds(window=None, two_texts=False))


def _lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return katz.scored(table(spark, folder, "documents"), held_out=id_remainder(F.col("doc_id"), 7) == 2)


def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10)


def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


def _periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.run_digests(table(spark, folder, "documents"), change=periodic.with_repeats)


def _embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"), least=0.93)


def _spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"), slip=199, shortest=6, least=5, factor=5)


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": _exact_dedup, "op2_warc": _warc, "op3_token_counts": _token_counts,
        "op4_sentencepiece": _sentencepiece,
        "op5_language_id": _language_id, "op6_sharding": _sharding, "op7_pii": _pii, "op8_lm_scores": _lm_scores,
        "op9_decontamination": _decontamination, "op10_simhash": _simhash, "op11_periodic_runs": _periodic_runs,
        "op12_embedding_dedup": _embedding_dedup, "op13_spelling_variants": _spelling_variants}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP, "op2_warc": WARC, "op6_sharding": SHARDING, "op9_decontamination": DECONTAMINATION,
            "op12_embedding_dedup": EMBEDDING_DEDUP, "op13_spelling_variants": SPELLING_VARIANTS}


EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents),
ranked AS (
  SELECT doc_id, content, row_number() OVER same AS place, first_value(doc_id) OVER same AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM texts WINDOW same AS (PARTITION BY content ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(content) AS text_sha256 FROM ranked
"""

WARC = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
firsts AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
         min(page_id) OVER (PARTITION BY html) AS first_id
  FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM firsts
"""

def _crc_table() -> str:
    """The 256 steps of CRC-32, a bit at a time."""
    text = "SELECT i, i::UBIGINT AS c FROM range(256) r(i)"
    for _ in range(8):
        text = f"SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END AS c FROM ({text})"
    return f"SELECT list(c ORDER BY i) AS steps FROM ({text})"


SHARDING = f"""
WITH crc AS ({_crc_table()}),
bytes AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 8 AS size, string_split(hex(encode(coalesce(text, ''))), '') AS hex FROM documents),
numbers AS (
  SELECT doc_id, size, list_transform(range(size - 8), lambda i: ('0x' || hex[2 * i + 1] || hex[2 * i + 2])::UBIGINT) AS bytes FROM bytes),
sized AS (
  SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(xor(list_reduce([4294967295::UBIGINT] || bytes,
    lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS INT) + 1])), 4294967295::UBIGINT) AS BIGINT) AS text_crc32
  FROM numbers, crc),
summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS LAST, size, text_crc32 ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER () AS total,
         row_number() OVER (ORDER BY doc_id NULLS LAST, size, text_crc32) AS nth
  FROM sized),
placed AS (SELECT *, CAST((2 * before + size) * 24 // (2 * total) AS INT) AS shard FROM summed)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(nth - min(nth) OVER (PARTITION BY shard) AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard
FROM placed
"""

DECONTAMINATION = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
item_starts AS (
  SELECT item, words, least(10, len(words)) AS width, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
  FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, width, array_to_string(words[i:i + width - 1], ' ') AS gram FROM item_starts),
widths AS (SELECT DISTINCT width FROM windows),
doc_starts AS (
  SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS i FROM docs, widths WHERE len(words) >= width),
hits AS (
  SELECT s.doc_id, s.i, s.width, w.item
  FROM doc_starts s JOIN windows w ON s.width = w.width AND array_to_string(s.words[s.i:s.i + s.width - 1], ' ') = w.gram),
hit_words AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + width)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(i.n_items, 0) AS n_items, coalesce(i.items_sha256, sha256('')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, vec_id, label,
         CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                   AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN CAST(embedding AS DOUBLE[]) END AS v
  FROM embeddings),
links AS (
  SELECT a.r AS x, b.r AS y
  FROM rows a JOIN rows b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
  WHERE CASE WHEN a.v IS NOT NULL AND b.v IS NOT NULL THEN list_cosine_similarity(a.v, b.v) >= 0.93 ELSE false END),
reached(r, other) AS (
  SELECT r, r FROM rows UNION SELECT e.r, l.y FROM reached e JOIN links l ON e.other = l.x)
SELECT any_value(a.vec_id) AS vec_id, CAST((SELECT count(*) FROM links WHERE x = e.r) AS BIGINT) AS n_links,
       min(b.vec_id) AS component_id, any_value(a.vec_id) IS NOT DISTINCT FROM min(b.vec_id) AS kept
FROM reached e JOIN rows a ON a.r = e.r JOIN rows b ON b.r = e.other GROUP BY e.r
"""

SPELLING_VARIANTS = rf"""
WITH RECURSIVE crc AS ({_crc_table()}),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents),
per_doc AS (SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc, run),
hexed AS (SELECT *, string_split(hex(encode(doc || ':' || run)), '') AS hex FROM per_doc),
hashed AS (
  SELECT run, n, CAST(xor(list_reduce([4294967295::UBIGINT] ||
    list_transform(range(len(hex) // 2), lambda i: ('0x' || hex[2 * i + 1] || hex[2 * i + 2])::UBIGINT),
    lambda c, b: xor(c >> 8, steps[CAST(xor(c, b) & 255 AS INT) + 1])), 4294967295::UBIGINT) AS BIGINT) AS h
  FROM hexed, crc),
slipped AS (
  SELECT n, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2)
                 ELSE run END AS word
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, left(word, CAST(i AS INT)) AS head, substring(word, CAST(i AS INT) + 2) AS tail
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.head || a.tail = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.head || a.tail = b.word),
found AS (SELECT word, count(*) AS n_near, max(other_n) AS most FROM near GROUP BY word),
best AS (SELECT word, min(other) AS other FROM near JOIN found USING (word) WHERE other_n = most GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(f.n_near, 0) AS n_near, CASE WHEN f.most >= 5 * w.n THEN b.other END AS form,
         CASE WHEN f.most >= 5 * w.n THEN f.most END AS form_n
  FROM words w LEFT JOIN found f USING (word) LEFT JOIN best b USING (word)),
followed(word, reached, step) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT p.word, f.form, p.step + 1 FROM followed p JOIN formed f ON p.reached = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, max_by(reached, step) AS root FROM followed GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""
