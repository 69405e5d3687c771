"""Personal data with information-theoretic sanitisation, in DataFrame operations only.

Base findings are e-mail addresses, IP addresses, card and phone numbers. Each distinct finding is a
protected entity. From co-occurrence over all documents, a term in the documents of an entity reveals
the share ``PMI(term; entity) / IC(entity)`` of the entity's information:

    PMI = log(N * n(entity, term) / (n(entity) * n(term))),  IC = log(N / n(entity))

with counts of documents. Terms that reveal at least GENERALISE are generalised (a placeholder of
their kind), those at or above REMOVE are removed, wherever they occur. Pairs seen in fewer than
SUPPORT documents carry no evidence. A term is any whole word that touches no base finding, however
short and wherever it stands in the document.

Pairs are listed only where they can matter, which changes no result: entities of fewer than SUPPORT
documents are left out, entities of the same documents count as one, documents of the same texts as
one with a weight, and a term is paired only with entities for which it is rare enough (``_limit``).
Base spans and the hashes of each document's words are found in one pass and written; counts and pairs
are worked out from these hashes alone, combined before every shuffle. The terms found go to the texts
as a bounded row of bits; words that pass it are listed with their places, and only those meet the terms
themselves. No text is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import written
from . import tables

SUPPORT, GENERALISE, REMOVE, LEAST_BITS = 2, 0.7, 0.95, 1.0
KINDS = ("email", "ip", "card", "phone")
TERM, GONE = "term", "removed"

# Patterns of the base findings. Starts inside a run that was already refused are skipped (look
# behind or \G, possessive runs), which changes no match and keeps long runs linear. A card is a
# whole run of digits and single separators with 16 to 19 digits.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_HINT = {"email": "@", "ip": ".", "phone": "+"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK, _ONE_BLANK = r"[\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"
# a broadcast term hash with its value; most bits of the filter of terms, as a power of 2 (4 MiB)
_TERM_BYTES, MOST_BITS = 32, 25
_SPAN = "struct<start:int,end:int,hit:string>"


def _luhn(match: Column) -> Column:
    digits = F.reverse(F.regexp_replace(match, "[^0-9]", ""))

    def value(i: Column) -> Column:
        d = F.substr(digits, i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda s, i: s + value(i)) % 10 == 0


def _small_part(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def _passes(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _small_part)
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(F.regexp_replace(match, "[^0-9]", "")).between(8, 15)
    return F.lit(True)


def _located(matches: Column, pieces: Column) -> Column:
    """Spans of matches, from the pieces of text between them (code points, end exclusive)."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    pairs = F.zip_with(matches, F.slice(pieces, 1, F.size(matches)), lambda m, p: F.struct(
        m.alias("hit"), p.alias("piece")))
    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def _spans_of(df: DataFrame, name: str, text: str, pattern: Column, wanted: Column) -> DataFrame:
    """Adds the spans of all leftmost non-overlapping matches in a text column."""
    none = F.array().cast("array<string>")
    found = df.withColumn("_m", F.when(
        wanted, F.regexp_extract_all(text, pattern, F.lit(0))).otherwise(none))
    return found.withColumn(name, F.when(
        F.size("_m") > 0, _located(F.col("_m"), F.split(text, pattern, -1))).otherwise(
        F.array().cast(f"array<{_SPAN}>"))).drop("_m")


def _passing(kind: str) -> Column:
    return F.filter(kind, lambda s: _passes(kind, s["hit"]))


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds an array of (start, end, hit) per kind to ``docs(text)``."""
    for kind in KINDS:
        hint = _HINT.get(kind)
        wanted = F.coalesce(F.contains("text", F.lit(hint)), F.lit(False)) if hint else \
            F.coalesce(F.rlike("text", F.lit("[0-9]")), F.lit(False))
        docs = _spans_of(docs, kind, "text", F.lit(PATTERNS[kind]), wanted)
        docs = docs.withColumn(kind, _passing(kind))
    return docs


def _lower(text: Column | str) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _words_apart() -> Column:
    """Distinct lower-cased whole words of a text with base spans that touch none of them."""
    low, spans = _lower("text"), F.sort_array(F.concat(*KINDS))
    size = F.length("text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias(
        "gaps"))

    def gap(begin: Column, end: Column) -> Column:
        return F.array(F.struct(begin.alias("start"), end.alias("end")))

    def step(acc: Column, s: Column) -> Column:
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.concat(acc["gaps"], gap(acc["at"], s["start"])).alias("gaps"))

    def inside(g: Column) -> Column:
        """Words of a gap; a piece next to a span is part of a word that touches it, or empty."""
        pieces = F.split(F.substr(low, g["start"] + 1, F.greatest(g["end"] - g["start"], F.lit(0))),
                         _BLANK)
        skip = F.when(g["start"] == 0, 0).otherwise(1)
        last = F.when(g["end"] == size, 0).otherwise(1)
        return F.slice(pieces, skip + 1, F.greatest(F.size(pieces) - skip - last, F.lit(0)))

    gaps = F.aggregate(spans, start, step, lambda acc: F.concat(acc["gaps"], gap(acc["at"], size)))
    words = F.when(F.size(spans) == 0, F.split(low, _BLANK)).otherwise(
        F.flatten(F.transform(gaps, inside)))
    return F.array_distinct(F.filter(words, lambda w: F.length(w) > 0))


def _entities(kind: str) -> Column:
    return F.transform(kind, lambda s: F.xxhash64(F.lit(kind), _lower(s["hit"])))


def _limit(n: float, n_e: Column) -> Column:
    """Documents that a term can be in at most to reveal GENERALISE of an entity, as n_et <= n_e."""
    return n ** (1 - GENERALISE) * F.pow(n_e.cast("double"), F.lit(GENERALISE)) * (1 + 1e-9)


def _protected(found: DataFrame, n: float) -> DataFrame:
    """(doc_id, weight, entity, n_e): one entity of those in the same documents, one document of
    those with the same texts, of entities that can give evidence."""
    seen = written(found.where("doc_id is not null").select("doc_id", F.explode(F.array_distinct(
        F.concat(*map(_entities, KINDS)))).alias("entity")).distinct())
    per_entity = seen.groupBy("entity").agg(
        F.count("*").alias("n_e"), F.bit_xor(F.xxhash64("doc_id")).alias("in1"),
        F.bit_xor(F.xxhash64("doc_id", F.lit(1))).alias("in2"))
    held = per_entity.where((F.col("n_e") >= SUPPORT) & (
        F.log2(n / F.col("n_e")) >= LEAST_BITS)).groupBy("n_e", "in1", "in2").agg(
        F.min("entity").alias("entity")).select("entity", "n_e")
    near = written(tables.lookup(seen, held, ["entity"], "inner", row_bytes=24))
    texts = tables.lookup(found.select("doc_id", "_text"), near.select("doc_id").distinct(),
                          ["doc_id"], "left_semi", row_bytes=16)
    alike = texts.groupBy("doc_id").agg(F.xxhash64(F.sort_array(F.collect_set("_text"))).alias("same"))
    kept = alike.groupBy("same").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("weight"))
    return written(tables.lookup(near, kept.select("doc_id", "weight"), ["doc_id"], "inner", 24))


def _hashed(found: DataFrame) -> DataFrame:
    """doc_id, _text, spans by kind and the hashes of the words apart of ``found``, written.

    ``words`` is null where the id or the text is: such rows give and get no evidence.
    """
    words = F.when(F.col("doc_id").isNotNull() & F.col("text").isNotNull(), F.transform(
        _words_apart(), lambda w: F.xxhash64(w)))
    return written(found.select(
        "doc_id", F.xxhash64("text").alias("_text"), *KINDS, words.alias("words")))


def _disclosive(kept: DataFrame) -> DataFrame:
    """(term, reveals) of the hashes of terms over the threshold.

    ``kept``: what ``_hashed`` wrote. Documents are told apart by doc_id.
    """
    given = kept.where("words is not null")
    n = float(max(given.count(), 1))
    near = _protected(kept, n)
    weights = near.select("doc_id", "weight").distinct()
    every = given.select("doc_id", F.explode("words").alias("term"))
    inside = tables.lookup(given.select("doc_id", "words"), weights, ["doc_id"], "inner", 24).select(
        "doc_id", "weight", F.explode("words").alias("term"))
    # rows that repeat a doc_id may count twice here: more terms are tried, none is lost
    tried = inside.groupBy("term").agg(F.sum("weight").alias("n_r")).where(
        F.col("n_r") >= SUPPORT).select("term")
    most = near.agg(F.max("n_e")).first()[0] or 0
    # texts per term, combined before the shuffle and narrowed to what can be evidence
    counts = every.groupBy("term").agg(F.count("*").alias("n_t")).where(
        F.col("n_t").between(SUPPORT, _limit(n, F.lit(most))))
    of_term = written(counts.join(tried, "term", "left_semi"))
    pairs = tables.lookup(inside, of_term, ["term"], "inner", 24).distinct()
    pairs = tables.lookup(pairs, near.select("doc_id", "entity", "n_e"), ["doc_id"], "inner", 32)
    together = pairs.where(F.col("n_t") <= _limit(n, F.col("n_e"))).groupBy(
        "entity", "term", "n_e", "n_t").agg(F.sum("weight").alias("n_et")).where(
        F.col("n_et") >= SUPPORT)
    content = F.log2(n / F.col("n_e"))
    mutual = F.log2(n * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    scored = together.select("term", (mutual / content).alias("reveals"))
    return written(scored.groupBy("term").agg(F.max("reveals").alias("reveals")).where(
        F.col("reveals") >= GENERALISE))


def disclosive_terms(found: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, reveals) of terms over the threshold, and (doc_id, term) of their documents.

    ``found``: ``docs`` with their base spans. Terms are worked on by 64-bit hashes and named at the end.
    """
    terms = _disclosive(_hashed(found))
    words = F.array_distinct(F.split(_lower("text"), _BLANK))
    named = docs.where("doc_id is not null").select("doc_id", F.explode(words).alias("word"))
    places = written(tables.lookup(
        named.withColumn("term", F.xxhash64("word")), terms, ["term"], "inner", _TERM_BYTES).select(
        "doc_id", F.col("word").alias("term"), "reveals").distinct())
    return places.select("term", "reveals").distinct(), places


def _bitmap(terms: DataFrame) -> DataFrame:
    """One row: ``bits``, an array of longs with one bit per hash of a term.

    At least 16 bits a term up to MOST_BITS, so the row is bounded whatever there is to hide; beyond it
    more words pass the bits, and the join that follows tells them apart all the same.
    """
    size = 1 << min(max(12, (16 * max(terms.count(), 1)).bit_length()), MOST_BITS)
    place = F.pmod("term", F.lit(size))
    words = terms.groupBy(F.shiftright(place, 6).cast("int").alias("at")).agg(F.bit_or(
        F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))).alias("bits"))
    every = terms.sparkSession.range(size // 64).select(F.col("id").cast("int").alias("at"))
    return every.join(words, "at", "left").agg(F.transform(F.sort_array(F.collect_list(F.struct(
        "at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))), lambda x: x["bits"]).alias("bits"))


def _word_spans(low: str, size: Column) -> Column:
    """Spans (start, end, hit) of the whole words of a text that pass ``bits``, by one walk."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans"))

    def step(acc: Column, word: Column) -> Column:
        end = acc["at"] + F.length(word)
        span = F.struct(acc["at"].alias("start"), end.alias("end"), word.alias("hit"))
        place = F.pmod(F.xxhash64(word), size)
        kept = F.getbit(F.get(F.col("bits"), F.shiftright(place, 6).cast("int")), place % 64) == 1
        # every blank is one code point
        return F.struct((end + 1).alias("at"), F.when((word != "") & kept, F.concat(
            acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.split(low, _ONE_BLANK, -1), start, step, lambda acc: acc["spans"])


def _marked(base: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, _text, term, removed: spans of the terms in every text that holds one.

    Words that pass the bits are listed with their places where the text is; only these are joined
    with the terms and gathered by document. No text is shuffled, at any size.
    """
    bits = written(_bitmap(terms).withColumn("__one", F.lit(1)))
    low = base.where("doc_id is not null and text is not null").select(
        "doc_id", F.xxhash64("text").alias("_text"), _lower("text").alias("low"),
        F.lit(1).alias("__one"))
    # one row of at most 2^MOST_BITS bits
    seen = low.join(F.broadcast(bits), "__one").select("doc_id", "_text", F.explode(_word_spans(
        "low", (F.size("bits") * 64).cast("long"))).alias("s")).withColumn("term", F.xxhash64("s.hit"))
    hits = tables.lookup(seen, terms, ["term"], "inner", _TERM_BYTES)
    spans = {TERM: F.col("reveals") < REMOVE, GONE: F.col("reveals") >= REMOVE}
    return hits.groupBy("doc_id", "_text").agg(*[
        F.sort_array(F.collect_set(F.when(of, F.col("s")))).alias(name) for name, of in spans.items()])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, email, ip, card, phone, term, removed for every row of ``docs(doc_id, text)``.

    Each is an array of (start, end, hit) in code points, end exclusive, by start; ``term`` spans
    are to be generalised, ``removed`` ones to be deleted. Null and empty texts have none. Rows with a
    null doc_id get base spans only; rows that repeat a doc_id share its terms.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = _hashed(base_spans(base))
    terms = _disclosive(kept)
    marked = _marked(base, terms)
    joined = kept.drop("words").join(marked, ["doc_id", "_text"], "left")
    base_all = F.concat(*KINDS)

    def apart(name: str) -> Column:
        """Added spans that touch no base span: base ones stay as they are."""
        spans_ = F.coalesce(F.col(name), F.array().cast(f"array<{_SPAN}>"))
        return F.filter(spans_, lambda s: ~F.exists(base_all, lambda b: (
            s["start"] < b["end"]) & (b["start"] < s["end"])))

    return joined.select("doc_id", *KINDS, apart(TERM).alias(TERM), apart(GONE).alias(GONE))


def _shown(kind: str) -> Column:
    return F.transform(kind, lambda s: F.concat(
        F.lit(kind + ":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string")))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans, per row of ``docs(doc_id, text)``."""
    found = find_personal_data(docs)
    base = F.array_join(F.concat(*[_shown(k) for k in KINDS]), ",")
    every = F.array_join(F.concat(*[_shown(k) for k in (*KINDS, TERM, GONE)]), ",")
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(base, 256).alias("base_sha256"), every.alias("spans"),
        F.size(TERM).cast("long").alias("n_generalised"), F.size(GONE).cast("long").alias("n_removed"))


def sanitised(text: Column, spans: Column) -> Column:
    """Text with its spans replaced: ``spans`` is an array of (start, end, kind) in any order.

    Base kinds and generalised terms become ``[KIND]``; removed terms leave nothing. Of overlapping
    spans the earlier one is shown and both are gone.
    """
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        mark = F.when(s["kind"] == GONE, F.lit("")).otherwise(
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))
        ahead = s["start"] >= acc["at"]
        piece = F.when(ahead, F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.concat(acc["out"], F.coalesce(piece, F.lit(""))).alias("out"))

    return F.aggregate(F.sort_array(spans), first, step, lambda acc: F.concat(
        acc["out"], F.substr(text, acc["at"] + 1)))
