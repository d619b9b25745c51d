"""Personal data, and terms that give it away, with DataFrame functions alone.

Four kinds of protected entities are found by pattern. A term, a word within ``window`` characters of an entity or, if
that is None, anywhere in its text, gives it away as far as knowing the term tells that the entity is near. From the corpus, with n documents:

    information of an entity      IC(c) = log(n / n(c))
    what a term reveals of it     PMI(c, t) = log(n * n(c, t) / (n(c) * n(t)))
    disclosure of c by t          PMI / IC: 1 if t is never seen without c, 0 if t says nothing

n(c) and n(t) are documents with the entity and with the term, n(c, t) documents with the term near the entity. Terms above
``remove_at`` are removed, terms above ``generalise_at`` replaced by their kind. A word that is only ever seen beside an entity
that is seen once tells all of it; ``least_support`` asks for a term to be in so many documents at least, and leaves the
scores as they are. With ``two_texts`` a term has to be near the entity in two different texts at least.

Entities of the same documents have the same n(c) and n(c, t), so they are judged together, as one class: a page of
thousands of addresses costs as much as its words, not their product.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from trialmetrics.llm.common import fresh, numbered, stored

# What each kind looks like. Quantifiers are possessive where the next character cannot be part of
# what they have taken, and an address begins where its first run of characters begins or the last match
# ended, so that long runs are not tried from each of their characters.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)
TERM = "term"
_WORD = r"\p{L}{2,}"
_SPAN = "struct<start:bigint,stop:bigint,value:string>"


@dataclass(frozen=True)
class Thresholds:
    remove_at: float = 0.95
    generalise_at: float = 0.8
    window: int | None = None
    two_texts: bool = False
    least_support: int = 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body and its lambdas name it."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(lengths: Column) -> Column:
    """Running totals of an array, in blocks: appending to one long array would copy it for every element."""
    block, zero = 128, F.lit(0).cast("long")

    def totals(values: Column, start: Column) -> Column:
        sums = F.aggregate(values, F.array(start), lambda a, x: F.array_append(a, F.element_at(a, -1) + x))
        return F.slice(sums, 2, F.size(values))

    def of_blocks(blocks: Column) -> Column:
        bases = F.aggregate(blocks, F.array(zero), lambda a, b: F.array_append(
            a, F.element_at(a, -1) + F.aggregate(b, zero, lambda t, x: t + x)))
        return _let(bases, lambda starts: F.flatten(F.transform(blocks, lambda b, i: totals(b, F.element_at(starts, i + 1)))))

    def of(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.ceil(F.size(values) / block).cast("int") - 1)
        blocks = F.transform(numbers, lambda b: F.slice(values, b * block + 1, block))
        return F.when(F.size(values) > 0, _let(blocks, of_blocks)).otherwise(F.array().cast("array<bigint>"))

    return _let(lengths, of)


def _found(text: Column, pattern: str) -> Column:
    """Spans of all leftmost non-overlapping matches. What stands between them gives their places."""
    def spans(matches: Column) -> Column:
        lengths = F.zip_with(matches, F.split(text, pattern, -1), lambda m, gap: (F.length(m) + F.length(gap)).cast("long"))
        return F.zip_with(matches, _running(F.slice(lengths, 1, F.size(matches))), lambda m, stop: F.struct(
            (stop - F.length(m)).alias("start"), stop.alias("stop"), m.alias("value")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda matches: F.when(
        F.size(matches) > 0, spans(matches)).otherwise(F.array().cast(f"array<{_SPAN}>")))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})){3}$")
    if kind == "card":
        return _let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    return F.filter(_found(text, PATTERNS[kind]), lambda s: _valid(kind, s["value"]))


def _near(text: Column, spans: Column, kind: str, window: int) -> Column:
    """For each span, the words within ``window`` characters with their places; words cut by the window's end
    are left out."""
    def words(start: Column, stop: Column) -> Column:
        piece = F.substr(text, (start + 1).cast("int"), (stop - start).cast("int"))
        inside = _found(piece, _WORD)
        return F.transform(F.filter(inside, lambda w: ((w["start"] > 0) | (start == 0)) & (
            (start + w["stop"] < stop) | (stop == F.length(text)))), lambda w: F.struct(
                (start + w["start"]).alias("start"), (start + w["stop"]).alias("stop"), F.lower(w["value"]).alias("value")))

    def around(s: Column) -> Column:
        before = words(F.greatest(s["start"] - window, F.lit(0)), s["start"] + 0)
        after = words(s["stop"] + 0, F.least(s["stop"] + window, F.length(text).cast("long")))
        return F.struct(F.lit(kind).alias("kind"), F.lower(s["value"]).alias("entity"),
                        F.concat(before, after).alias("terms"))
    return F.transform(spans, around)


def detected(df: DataFrame, key: str, text: str, limits: Thresholds) -> DataFrame:
    """row, key, hash of the text, spans by kind, and what is near them; no texts. Without a window each entity is
    named once, without terms, and the texts that hold any are kept."""
    row = fresh(df, "row")
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = numbered(df, row).select(
        F.col(row).alias("row"), F.col(key).alias("key"), value.alias("text"), F.xxhash64(value).alias("hash"),
        *[base_spans(value, kind).alias(kind) for kind in KINDS])
    hit = F.greatest(*[F.size(kind) for kind in KINDS]) > 0
    if limits.window is None:
        def named(kind: str) -> Column:  # a lambda of two parameters would be given the place in the array
            return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), F.lower(s["value"]).alias("entity")))

        entities = F.array_distinct(F.concat(*map(named, KINDS)))
        return found.withColumn("near", F.when(hit, entities)).withColumn("text", F.when(hit, F.col("text")))
    near = F.concat(*[_near(F.col("text"), F.col(kind), kind, limits.window) for kind in KINDS])
    return found.withColumn("near", F.when(hit, near)).drop("text")


def disclosing(spans: DataFrame, corpus: DataFrame, text: str, limits: Thresholds) -> DataFrame:
    """kind, entity, term, disclosure and action of the terms that reveal too much, one row for each pair."""
    entities = spans.filter("near is not null").select("row", "hash", F.explode("near").alias("n")).select(
        "row", "hash", "n.kind", "n.entity", "n.terms")
    with_entity = entities.select("row", "kind", "entity").distinct().groupBy("kind", "entity").agg(F.count("*").alias("n_c"))
    pairs = entities.select("row", "hash", "kind", "entity", F.explode("terms.value").alias("term")).distinct() \
        .groupBy("kind", "entity", "term").agg(F.count("*").alias("n_ct"), F.min("hash").alias("a"), F.max("hash").alias("b")) \
        .filter(F.lit(not limits.two_texts) | (F.col("a") < F.col("b"))).drop("a", "b")
    with_term = corpus.select(F.explode(_words(F.col(text).cast("string"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_t"))
    n = F.lit(float(corpus.count()))
    disclosure = F.log2(n * F.col("n_ct") / (F.col("n_c").cast("double") * F.col("n_t"))) / F.log2(n / F.col("n_c"))
    return pairs.join(with_entity, ["kind", "entity"]).join(with_term, "term") \
        .filter((F.col("n_c") < n) & (F.col("n_t") >= limits.least_support)).withColumn("disclosure", disclosure) \
        .filter(F.col("disclosure") >= limits.generalise_at).select(
            "kind", "entity", "term", "disclosure",
            F.when(F.col("disclosure") >= limits.remove_at, "remove").otherwise("generalise").alias("action"))


def _words(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def _told(spans: DataFrame, corpus: DataFrame, text: str, limits: Thresholds, common: int = 10_000) -> DataFrame:
    """row, and the terms of its whole text that reveal too much of one of its entities, with their actions.

    As n(c, t) <= n(c), a term can reach ``generalise_at`` only if n(t) <= n ** (1 - generalise_at) * n(c) **
    generalise_at. Other pairs are dropped before they are counted, the most frequent terms before any shuffle.
    """
    n = float(spans.count())
    entities = spans.filter("near is not null").select("row", "hash", F.explode("near").alias("n")).select("row", "hash", "n.*")
    # A class is a set of rows, known by two sums over its hashes and its size.
    same_rows = [F.bit_xor(F.xxhash64("row", F.lit(salt))).alias(f"of_{salt}") for salt in (1, 2)]
    with_entity = entities.groupBy("kind", "entity").agg(F.count("*").alias("n_c"), *same_rows).filter(F.col("n_c") < n)
    of_class = ["n_c", "of_1", "of_2"]
    classes = stored(entities.join(with_entity, ["kind", "entity"]).select("row", "hash", *of_class).distinct(), "pii-classes")
    with_term = stored(corpus.select(F.explode(_words(F.col(text).cast("string"))).alias("term")).groupBy("term").agg(
        F.count("*").alias("n_t")), "pii-words")
    most = classes.agg(F.max("n_c")).first()[0] or 0

    def reach(n_c: Column) -> Column:
        return F.lit(n) ** (1 - limits.generalise_at) * n_c ** limits.generalise_at * (1 + 1e-9)

    often = with_term.filter(F.col("n_t") > reach(F.lit(float(most)))).orderBy(F.desc("n_t"), "term").limit(common)
    terms = spans.filter("near is not null").select("row", F.explode(_words(F.col("text"))).alias("term")) \
        .join(F.broadcast(often.select("term")), "term", "left_anti") \
        .join(with_term.filter((F.col("n_t") <= reach(F.lit(float(most)))) & (F.col("n_t") >= limits.least_support)), "term")
    pairs = stored(terms.join(classes, "row").filter(F.col("n_t") <= reach(F.col("n_c").cast("double"))), "pii-pairs")
    of_pair = [*of_class, "term"]
    disclosure = F.log2(n * F.col("n_ct") / (F.col("n_c").cast("double") * F.col("n_t"))) / F.log2(n / F.col("n_c"))
    told = pairs.groupBy(*of_pair, "n_t").agg(
        F.count("*").alias("n_ct"), F.min("hash").alias("a"), F.max("hash").alias("b")) \
        .filter(F.lit(not limits.two_texts) | (F.col("a") < F.col("b"))).withColumn("disclosure", disclosure) \
        .filter(F.col("disclosure") >= limits.generalise_at).select(
            *of_pair, F.when(F.col("disclosure") >= limits.remove_at, "remove").otherwise("generalise").alias("action"))
    return pairs.join(told, of_pair).groupBy("row", "term").agg(F.max("action").alias("action")).groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "action"))).alias("told"))


def _anywhere(spans: DataFrame, corpus: DataFrame, text: str, limits: Thresholds) -> DataFrame:
    """``spans`` with the places of all disclosing terms of a text, sorted, null if there are none."""
    places = F.filter(F.transform(_found(F.col("text"), _WORD), lambda w: F.struct(
        w["start"].alias("start"), w["stop"].alias("stop"), F.element_at("told", F.lower(w["value"])).alias("action"))),
        lambda t: t["action"].isNotNull())
    return spans.join(_told(spans, corpus, text, limits), "row", "left") \
        .withColumn("found", F.when(F.col("told").isNotNull(), places)).drop("told", "text", "near")


def _with_terms(df: DataFrame, key: str, text: str, limits: Thresholds) -> DataFrame:
    """row, key, base spans by kind, and the spans of disclosing terms, sorted, none over a base span."""
    spans = stored(detected(df, key, text, limits), "pii")
    placed = _anywhere(spans, df, text, limits) if limits.window is None else _in_window(spans, df, text, limits)
    base = F.concat(*KINDS)
    return placed.withColumn(TERM, F.coalesce(
        F.filter("found", lambda t: ~F.exists(base, lambda s: (s["start"] < t["stop"]) & (t["start"] < s["stop"]))),
        F.array().cast("array<struct<start:bigint,stop:bigint,action:string>>"))).drop("found")


def _in_window(spans: DataFrame, corpus: DataFrame, text: str, limits: Thresholds) -> DataFrame:
    """``spans`` with the places of disclosing terms near entities, sorted, null if there are none."""
    told = disclosing(spans, corpus, text, limits)
    near = spans.filter("near is not null").select("row", F.explode("near").alias("n")).select(
        "row", "n.kind", "n.entity", F.explode("n.terms").alias("t")).withColumn("term", F.col("t.value"))
    terms = near.join(told, ["kind", "entity", "term"]).groupBy("row", "t.start", "t.stop").agg(
        F.max("action").alias("action"))  # "remove" after "generalise"
    terms = terms.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "stop", "action"))).alias("found"))
    return spans.drop("near").join(terms, "row", "left")


def _joined(kinds: list[str]) -> Column:
    def named(kind: str) -> Column:
        return F.transform(kind, lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["stop"]))
    return F.array_join(F.concat(*map(named, kinds)), ",")


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text", limits: Thresholds = Thresholds()) -> DataFrame:
    """Per row: key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term and n_removed.

    Null counts as empty, with no spans. Places are code points. Repeated rows count as documents of their own, with
    equal results; the order of rows makes no difference. Other columns are not looked at, an empty table gives an empty
    result. Statistics cover all rows; only words near entities, as ``limits`` say, are candidates. An entity in every
    document has no information and nothing can disclose it.
    """
    found = _with_terms(df, key, text, limits)
    return found.select(
        F.col("key").alias(key), *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_joined(KINDS), 256).alias("base_sha256"), _joined([*KINDS, TERM]).alias("spans"),
        F.size(TERM).cast("long").alias("n_term"),
        F.size(F.filter(TERM, lambda t: t["action"] == "remove")).cast("long").alias("n_removed"))


def sanitised(df: DataFrame, text: str = "text", limits: Thresholds = Thresholds()) -> DataFrame:
    """``df`` with all columns and its texts sanitised: entities become [EMAIL], [IP], [CARD] or [PHONE], terms that
    disclose too much are cut, those that disclose less become [WORD]. Of overlapping entities the one that
    starts first (then the kind listed first) is named, and all their characters go. Null texts stay null."""
    row, out = fresh(df, "row"), fresh(df, "cuts")
    source = numbered(df, row)
    found = _with_terms(source, row, text, limits)

    def replaced(place: int, kind: str) -> Column:
        label = F.lit(f"[{kind.upper()}]")
        return F.transform(kind, lambda s: F.struct(
            s["start"].alias("start"), F.lit(place).alias("kind"), s["stop"].alias("stop"), label.alias("label")))

    terms = F.transform(TERM, lambda t: F.struct(
        t["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), t["stop"].alias("stop"),
        F.when(t["action"] == "remove", "").otherwise("[WORD]").alias("label")))
    cuts = F.array_sort(F.concat(*[replaced(i, kind) for i, kind in enumerate(KINDS)], terms))
    marked = source.join(found.select(F.col("key").alias(row), cuts.alias(out)), row)
    value = F.col(text)

    def cut(state: Column, s: Column) -> Column:
        gap = F.substr(value, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        return F.struct(F.greatest(state["at"], s["stop"]).alias("at"), F.when(
            s["start"] >= state["at"], F.concat(state["text"], gap, s["label"])).otherwise(state["text"]).alias("text"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("text"))
    done = F.aggregate(out, start, cut, lambda s: F.concat(
        s["text"], F.substr(value, (s["at"] + 1).cast("int"), F.greatest(F.length(value) - s["at"], F.lit(0)).cast("int"))))
    return marked.withColumn(text, F.when(F.size(out) > 0, done).otherwise(value)).select(*df.columns)
