"""Content-addressed WARC archive: payload bytes once, exact record headers apart.

``archive`` writes two Parquet tables. ``payloads`` holds every distinct payload once, under its
SHA-256; ``records`` holds, for every captured page, the exact bytes of its record up to the payload
(WARC header, blank line, HTTP header, blank line) and the key of its payload. ``restore`` joins them:
it checks each payload against its key and gives back every record byte for byte. ``export_warc``
writes the restored records as WARC files.

Keys, lengths and row numbers are taken in one scan into a slim table; only those are grouped, and
combined before the shuffle. A payload is chosen by that result, so page bytes are not shuffled to find
copies. In ``restore`` a payload that many records share is given in as many salted copies as its
number of records asks for, so one page copied by a third of the crawl is read by many tasks.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import forget, written
from . import tables

# payloads shorter than this are never replaced by a revisit
LEAST_BYTES = 1_000
# records of one payload that one salted copy of it serves
RECORDS_PER_COPY = 2_048
DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RESPONSE, REVISIT = "response", "revisit"
_END = "\r\n"


class Archive(NamedTuple):
    """records: record_id, head, stored, payload_key, n_sharing; payloads: payload_key, payload."""

    records: DataFrame
    payloads: DataFrame


def _payload() -> Column:
    return F.coalesce("html", F.lit("")).cast("binary")


def _record_id(page: Column, url: Column, row: Column) -> Column:
    """A record's URI: a UUID made from what tells its row apart."""
    digest = F.md5(F.to_json(F.struct(page.alias("p"), url.alias("u"), row.alias("r"))))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws(
        "-", *[F.substring(digest, at, n) for at, n in cuts]), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, '' for a null value; line breaks in a value are percent-encoded."""
    flat = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")),
                     F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), flat, F.lit(_END)), F.lit(""))


def _head(date: str) -> Column:
    """Exact bytes of a record before its payload, as text."""
    revisit = F.col("record_type") == REVISIT
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}"),
        _line("Content-Length", F.col("payload_bytes")), F.lit(_END))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    first = F.col("first")
    return F.concat(
        F.lit(VERSION + _END),
        _line("WARC-Type", F.col("record_type")), _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(
            first["page_id"], first["url"], first["row"]))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, first["url"])),
        _line("Page-ID", F.col("page_id")),
        _line("Refers-To-Page-ID", F.when(revisit, first["page_id"])),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", block), F.lit(_END), http)


def archive(pages: DataFrame, least_bytes: int = LEAST_BYTES, date: str = DATE) -> Archive:
    """Writes one record per row of ``pages(page_id, url, html)``; other columns are ignored.

    Of records with equal payloads of at least ``least_bytes`` bytes, the one with the largest
    (page_id, url) is the response and the others are revisits of it; of rows equal in these too, one
    is. Shorter payloads are all responses, and still stored once. A null html is an empty payload; a
    null page_id counts as the smallest and, like a null url, has no header line. Very long pages are
    one value of a row. An empty table gives an empty archive.
    """
    given = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    key = F.sha2(_payload(), 256)
    slim = written(given.select(
        "page_id", "url", key.alias("payload_key"), F.sha1(_payload()).alias("payload_digest"),
        F.octet_length(_payload()).cast("long").alias("payload_bytes"),
        F.monotonically_increasing_id().alias("row")))
    row = F.struct("page_id", "url", "row")
    shared = slim.groupBy("payload_key").agg(
        F.max(row).alias("first"), F.count("*").alias("n_sharing")).where("n_sharing > 1")
    shared, fits = tables.bounded(shared, 160 + F.coalesce(F.octet_length("first.url"), F.lit(0)))
    side = F.broadcast(shared) if fits else shared.hint("merge")
    # the row number makes the response one row, also among rows that are equal otherwise
    revisit = (F.col("payload_bytes") >= least_bytes) & F.col("first").isNotNull() & (row != F.col("first"))
    typed = slim.join(side, "payload_key", "left").withColumns({
        "record_type": F.when(revisit & F.col("first").isNotNull(), REVISIT).otherwise(RESPONSE),
        "record_id": _record_id(F.col("page_id"), F.col("url"), F.col("row")),
    })
    records = written(typed.select(
        "record_id", _head(date).alias("head"), (F.col("record_type") == RESPONSE).alias("stored"),
        "payload_key", F.coalesce("n_sharing", F.lit(1)).alias("n_sharing")))
    whole = given.select("page_id", "url", key.alias("payload_key"), _payload().alias("payload"))
    single = whole.join(side, "payload_key", "left_anti")
    chosen = whole.join(side, "payload_key").where(
        F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url")))
    copies = F.ceil(F.col("n_sharing") / RECORDS_PER_COPY).cast("int")
    payloads = written(
        single.select("payload_key", "payload", F.lit(1).alias("copies")).unionByName(
            chosen.dropDuplicates(["payload_key"]).select(
                "payload_key", "payload", copies.alias("copies"))))
    forget(slim)
    forget(shared)
    return Archive(records, payloads)


def _verified() -> Column:
    """The payload, after its bytes were compared with their key."""
    good = F.sha2(F.col("payload"), 256) == F.col("payload_key")
    return F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(
        F.lit("payload does not have the digest "), F.col("payload_key"))))


def restore(stored: Archive) -> DataFrame:
    """record_id, head, stored, payload, record of every record that was archived.

    ``payload`` is the page's full payload, of revisits too; ``record`` is the exact WARC record, with
    the payload only where the record type stores it. A payload that does not match its key ends the
    job.
    """
    copies = F.ceil(F.col("n_sharing") / RECORDS_PER_COPY).cast("int")
    payloads = stored.payloads.select(
        "payload_key", _verified().alias("payload"),
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    records = stored.records.withColumn("copy", F.pmod(F.xxhash64("record_id"), copies).cast("int"))
    size = records.agg(F.sum(F.octet_length("head") + 256)).first()[0] or 0
    side = F.broadcast(records) if size <= tables.BROADCAST_BYTES else records.hint("merge")
    body = F.when(F.col("stored"), F.col("payload")).otherwise(F.lit("").cast("binary"))
    return payloads.join(side, ["payload_key", "copy"]).select(
        "record_id", "head", "stored", "payload", F.concat(
            F.col("head").cast("binary"), body, F.lit(_END * 2).cast("binary")).alias("record"))


def field(name: str, head: str | Column = "head") -> Column:
    """A header line of a record, null where it has none."""
    found = F.regexp_extract(head, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(found != "", found)


def read_back(restored: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to from restored records.

    The digest is taken from the payload bytes and must be the one in the record's header.
    """
    digest = F.sha1("payload")
    same = F.concat(F.lit("sha1:"), digest) == field("WARC-Payload-Digest")
    return restored.select(
        field("Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(same, digest).otherwise(F.raise_error(F.concat(
            F.lit("payload differs from the header of "), F.col("record_id")))).alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("Refers-To-Page-ID").cast("long").alias("refers_to"))


def export_warc(restored: DataFrame, path: str, compression: str = "gzip") -> None:
    """Writes the restored records as WARC files, one per task, to a Hadoop path.

    A record of text ends in two line breaks, which is how the text writer ends a line.
    """
    whole = F.decode("record", "UTF-8")
    restored.select(F.substr(whole, F.lit(1), F.length(whole) - len(_END * 2)).alias("value")).write.option(
        "lineSep", _END * 2).option("compression", compression).text(path)


SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), q AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS payload_digest,
         max(page_id) OVER (PARTITION BY html) AS first
  FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> first THEN 'revisit'
            ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_BYTES} AND page_id <> first THEN first END AS refers_to
FROM q
"""
