import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from vidguard.llm import pii

FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
TEXTS = [
    "a@b.cd_e@f.gh", "..a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.001",
    "00000000000000000000001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1111 2",
    "4111 1111 1111 1111 1111", "x4111111111111111y", "41111111111111111111111",
    "+1 (234) 567-8901", "+1--2 +44 20 7946 0958 ext", "é🙂 a@b.co 🙂+12345678", "1 " * 9000,
    "a" * 20000 + "@", "9" * 20000, "+1" * 300, "a@b-.c..d", None, "",
    "6011 0009 9013 9424x1.1.1.1@q.r", "a%@b.c a+@b.c-", "1-1-1-1-4111111111111111",
    "4111111111111111 - 4111111111111111", "+123456789.4111111111111111", "mail a@b.co\nb@c.de",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9)
    return total % 10 == 0


def brute(text):
    def ok(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15}[kind]

    return [[(m.start(), m.end()) for m in form.finditer(text) if ok(kind, m.group())]
            for kind, form in FORMS.items()]


def test_base_findings_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in pii.personal_data_digest(df).collect():
        found = brute(TEXTS[r["doc_id"]] or "")
        base = ",".join(f"{k}:{a}:{b}" for k, spans in zip(FORMS, found) for a, b in spans)
        assert [len(s) for s in found] == [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert r["spans"] == base


def test_terms_that_give_an_entity_away(spark):
    """'zorblax' stands only with one address, 'the' everywhere, 'rare' with two addresses."""
    rows = [(i, f"the office of Zorblax, at zorblax zed@corp.example the desk rare{i} end")
            for i in range(4)]
    rows += [(10 + i, f"the plain text number w{i} goes on and on") for i in range(60)]
    rows += [(100, "Zorblax, wrote nothing here but zorblax did")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in pii.find_personal_data(df).collect()}
    hits = {s["hit"] for k in ("term", "removed") for s in found[0][k]}
    assert "zorblax" in hits and "the" not in hits and "rare0" not in hits
    assert {s["hit"] for k in ("term", "removed") for s in found[100][k]} >= {"zorblax"}
    assert found[0]["email"][0]["hit"] == "zed@corp.example" and not found[10]["email"]


def test_sanitised_text(spark):
    row = spark.createDataFrame([("é mail a@b.co or Zed now",)], "text string").select(
        pii.sanitised(F.col("text"), F.array(
            F.struct(F.lit(17).alias("start"), F.lit(20).alias("end"), F.lit("removed").alias("kind")),
            F.struct(F.lit(7).alias("start"), F.lit(13).alias("end"), F.lit("email").alias("kind")),
        )).alias("t")).first()
    assert row["t"] == "é mail [EMAIL] or  now"


def test_main_path_is_native(spark, odd_docs):
    plan = pii.personal_data_digest(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_odd_rows(odd_docs, no_docs):
    rows = pii.personal_data_digest(odd_docs).collect()
    assert len(rows) == 13 and all(r["spans"] == "" for r in rows)
    assert pii.personal_data_digest(no_docs).count() == 0


def test_any_whole_word_of_a_document_can_give_an_entity_away(spark):
    """At the text's ends, far from the finding, with digits, short: 'first', 'jdoe42', 'qz', 'last'."""
    far = " ".join(["filler"] * 40)
    rows = [(i, f"First a@b.com {far} jdoe42 {far} QZ (a@b.com) once{i} x@y.org last")
            for i in range(2)]
    rows += [(2, "a@b.com tail2"), (3, "head3 a@b.com")]
    rows += [(10 + i, f"{far} plain n{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in pii.find_personal_data(df).collect():
        hits = {s["hit"] for k in ("term", "removed") for s in r[k]}
        assert hits == ({"first", "jdoe42", "qz", "last"} if r["doc_id"] < 2 else set())


def test_terms_equal_counting_all_pairs(spark):
    """Copies, repeated ids and entities of the same documents, against plain counting."""
    rng = random.Random(3)
    entities = [f"e{i}@x.org" for i in range(6)] + ["10.0.0.1", "+12345678"]
    rows = []
    for i in range(120):
        words = [f"w{int(rng.paretovariate(0.7)) % 90}" for _ in range(12)]
        words += rng.sample(entities, rng.choice([0, 0, 1, 2])) + ["a1(e0@x.org)"] * (i % 40 == 0)
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[i % 3][1]) for i in range(9)]
    apart, whole = {}, {}
    for d, t in rows:
        cut = re.sub(r"\S*@\S*|10\.0\.0\.1|\+12345678", " ", t)
        apart[d] = set(cut.split())
        whole[d] = set(re.findall(r"e\d@x\.org|10\.0\.0\.1|\+12345678", t))
    want, n = {}, len(rows)
    for e in entities:
        docs = {d for d in whole if e in whole[d]}
        if len(docs) < 2 or math.log2(n / len(docs)) < 1:
            continue
        for w in set().union(*(apart[d] for d in docs)):
            n_t, n_et = sum(w in apart[d] for d in apart), sum(w in apart[d] for d in docs)
            reveals = math.log2(n * n_et / (len(docs) * n_t)) / math.log2(n / len(docs))
            if n_et >= 2 and reveals >= pii.GENERALISE:
                want[w] = max(want.get(w, 0), reveals)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = pii.base_spans(df).withColumn("_text", F.xxhash64("text"))
    terms, _ = pii.disclosive_terms(found, df)
    got = {r["term"]: r["reveals"] for r in terms.collect()}
    assert want and got == pytest.approx(want)


def _rich(spark):
    """Texts with findings, terms of one and of several entities, and repeated words."""
    rng = random.Random(11)
    rows = []
    for i in range(80):
        words = [f"w{int(rng.paretovariate(0.8)) % 70}" for _ in range(15)]
        words += rng.sample(["e1@x.org", "e2@x.org", "10.0.0.1", "+12345678"], rng.choice([0, 0, 1, 2]))
        rng.shuffle(words)
        rows.append((i, rng.choice(["\n", " ", " \t"]).join(words)))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


@pytest.mark.parametrize("limit, bits", [(0, 26), (0, 6), (1 << 25, 7)])
def test_same_findings_beyond_every_broadcast_bound(spark, monkeypatch, limit, bits):
    """Every lookup by shuffle, a filter of a few bits that lets most words pass: the same rows."""
    df = _rich(spark)
    want = sorted(map(tuple, pii.personal_data_digest(df).collect()))
    assert any("term:" in r[6] or "removed:" in r[6] for r in want)
    monkeypatch.setattr(pii.tables, "BROADCAST_BYTES", max(limit, 1))
    monkeypatch.setattr(pii.tables.bounded, "__defaults__", (limit,))
    monkeypatch.setattr(pii, "MOST_BITS", bits)
    assert sorted(map(tuple, pii.personal_data_digest(df).collect())) == want


def test_main_path_with_findings_is_native(spark, monkeypatch):
    plans = []
    plain = pii.written

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df)

    monkeypatch.setattr(pii, "written", noted)
    monkeypatch.setattr(pii.tables, "written", noted)
    out = pii.personal_data_digest(_rich(spark).coalesce(1))
    plans.append(out._jdf.queryExecution().optimizedPlan().toString())
    assert len(plans) > 5 and not any(w in p for p in plans for w in ("Python", "Pandas", "Arrow"))
