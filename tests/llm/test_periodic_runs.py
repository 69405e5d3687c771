"""Periodic runs against a search of all periods, and the contract row by row."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vidguard.llm import periodic_runs as R
from vidguard.llm import queries


def brute(words, least_length=R.LEAST_LENGTH, least_exponent=R.LEAST_EXPONENT):
    """Every period is tried: stretches where words q apart are equal, kept if q is the smallest."""
    s, out = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True)[1], []
    for q in range(1, len(s) // least_exponent + 1):
        same = np.concatenate([[False], s[q:] == s[:-q], [False]]).astype(int)
        for i, j in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            part = s[i:j + q]
            if len(part) >= max(least_length, least_exponent * q) and not any(
                    (part[:-k] == part[k:]).all() for k in range(1, q)):
                out.append((int(i), len(part), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def contract(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    return (doc_id, len(runs), *(best or (None,) * 3),
            1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
            digest(" ".join(w for i, w in enumerate(words) if i not in drop)))


def rows_of(df):
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
               "collapsed_sha256"]
    return sorted(map(tuple, df.select(columns).collect()), key=repr)


def digests(docs):
    return rows_of(R.run_digests(R.periodic_runs(R.with_repeated_tail(docs))))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.lists(st.integers(0, 2), min_size=1, max_size=5),
       st.integers(0, 12), st.sampled_from([(6, 4), (2, 2), (1, 3)]))
def test_all_runs_are_found(head, block, times, least):
    s = head + block * times + head[:3]
    words = [str(x).encode() for x in s]
    assert [tuple(map(int, r)) for r in next(R._one_step([words, words], *least))[0]] == brute(s, *least)


def test_common_extensions_equal_a_loop():
    s = [random.Random(5).randrange(1, 4) for _ in range(90)]
    tree = R.SuffixTree(s)
    for i in range(90):
        for j in range(i + 1, 91):
            want = next((k for k in range(90 - j) if s[i + k] != s[j + k]), 90 - j)
            assert tree.extension(np.array([i]), np.array([j]))[0] == want


@pytest.mark.parametrize("step", [R.STEP_WORDS, 3])
def test_query_equals_the_contract(spark, monkeypatch, step):
    """Whole documents of the smallest scale, of which one in ten has a repeated tail."""
    monkeypatch.setattr(R, "STEP_WORDS", step)
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60 if step == 3 else 10 ** 9)
    want = sorted((contract(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert digests(docs) == want and any(r[1] for r in want)
    if step != 3:
        assert rows_of(queries.op12_periodic_runs(spark, sf)) == want


def test_odd_rows(spark, odd_docs, no_docs):
    assert digests(odd_docs) == sorted(
        (contract(r.doc_id, r.text) for r in odd_docs.collect()), key=repr)
    assert digests(no_docs) == []


def test_ids_beside_nulls_and_long_runs(spark):
    blank = " "
    docs = spark.createDataFrame([
        (None, "a b " * 5), (2 ** 53 + 1, "a b " * 5), (-2 ** 63, "x" + " y" * 20_000),
        (3, f"a{blank}b " * 7), (4, "a a a a a"), (5, "a a a a a a"), (6, "A a A a A a A a"),
        (7, "p q r " * 4 + "s " * 9 + "p q r " * 4), (8, "café \U0001f600 " * 6)],
        "doc_id long, text string").coalesce(1)
    got = digests(docs)
    assert got == sorted((contract(r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert [r[1:6] for r in got if r[0] == -2 ** 63] == [(1, 1, 20_000, 1, 20_000_000)]
