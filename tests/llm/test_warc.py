"""WARC archive: contract digests, exact round trip, odd rows."""

import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from vidguard.llm import tables, warc

PAGES = "page_id long, url string, html string, head string, payload string, row string, copies string"
BIG = "<p>" + "x" * 1200 + "</p>"


def pages(spark):
    rows = [(1, "http://a", BIG), (5, "http://b", BIG), (3, "http://c", BIG), (2, "http://d", "small"),
            (4, "http://e", "small"), (6, None, None), (7, "http://g", ""), (None, "http://h", BIG),
            (8, "http://i\r\nPage-ID: 99", "é" * 700), (9, "http://j", "é" * 700),
            (10, "http://k", BIG + "a"), (10, "http://k", BIG + "a"), (11, "http://l", "z" * 300_000)]
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], PAGES).repartition(3)


def brute(rows):
    """(page_id, bytes, digest, type, refers_to) by the words of the contract."""
    out = []
    by_payload = {}
    for page, _, html in rows:
        by_payload.setdefault((html or "").encode(), []).append(page)
    for payload, ids in by_payload.items():
        ids = sorted(ids, key=lambda i: -1 if i is None else i)
        for i, page in enumerate(ids):
            old = len(payload) >= warc.LEAST_BYTES and i < len(ids) - 1
            out.append((page, len(payload), hashlib.sha1(payload).hexdigest(),
                        "revisit" if old else "response", ids[-1] if old else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit, per_copy", [(tables.BROADCAST_BYTES, 2048), (0, 2)])
def test_digests_equal_brute_force(spark, monkeypatch, limit, per_copy):
    """Also with every lookup by shuffle and several salted copies of a payload."""
    monkeypatch.setattr(tables, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(tables.bounded, "__defaults__", (limit,))
    monkeypatch.setattr(warc, "RECORDS_PER_COPY", per_copy)
    given = pages(spark)
    got = warc.read_back(warc.restore(warc.archive(given)))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(
        [tuple(r)[:3] for r in given.collect()])


def test_payloads_are_stored_once_and_records_are_exact(spark):
    stored = warc.archive(pages(spark))
    assert stored.payloads.count() == stored.payloads.select("payload_key").distinct().count() == 6
    assert stored.records.select("record_id").distinct().count() == 13
    for r in warc.restore(stored).collect():
        head = r.head.encode()
        assert r.record == head + (bytes(r.payload) if r.stored else b"") + b"\r\n\r\n"
        top, http = r.head.split("\r\n\r\n", 1)
        length = int([v for v in top.split("\r\n") if v.startswith("Content-Length: ")][0][16:])
        assert len(r.record) == len(top.encode()) + 4 + length + 4
        assert top.split("\r\n")[0] == "WARC/1.1" and http.startswith("HTTP/1.1 200")


def test_a_changed_payload_is_refused(spark):
    stored = warc.archive(pages(spark))
    bent = stored.payloads.withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    with pytest.raises(Exception, match="does not have the digest"):
        warc.restore(warc.Archive(stored.records, bent)).collect()


def test_exported_files_hold_the_records(spark, tmp_path):
    restored = warc.restore(warc.archive(pages(spark)))
    warc.export_warc(restored, str(tmp_path / "out"))
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{tmp_path}/out/*.gz")))
    records = []
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        n = int(fields[b"Content-Length"])
        assert rest[n:n + 4] == b"\r\n\r\n"
        records.append(head + b"\r\n\r\n" + rest[:n + 4])
        data = rest[n + 4:]
    assert sorted(records) == sorted(bytes(r.record) for r in restored.collect())


def test_empty_table(spark):
    assert warc.read_back(warc.restore(warc.archive(pages(spark).limit(0)))).count() == 0
