"""A content-addressed WARC archive.

Method: payload bytes are stored once, under a verified strong digest; exact
record headers are kept separately; joins reconstruct the original records.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import doc_key, fresh_path, ship_package, stored

# Payloads below this size are never revisits.
MIN_REVISIT_BYTES = 100
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EOL = "\r\n"
RECORD_END = b"\r\n\r\n"
VERSION_START = b"WARC/1."
_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*([0-9]+)[ \t]*\r\n", re.IGNORECASE)


def digest_of(payload: Column) -> Column:
    return F.unhex(F.sha2(payload, 256))


def _record_id(key: str) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(">"))


def _field(name: str, value: Column) -> Column:
    """One header line; nothing for a null value. Line ends inside a value would end the line, so they go."""
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, "[\\r\\n]+", " "), F.lit(EOL))


def page_marks(pages: DataFrame) -> DataFrame:
    """``page_id, k, url, digest, n, h`` of every page: all but the payload, stored for the steps below."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    marks = pages.select(
        "page_id",
        doc_key("page_id").alias("k"),
        "url",
        digest_of(body).alias("digest"),
        F.octet_length(body).alias("n"),
        F.xxhash64(body).alias("h"),
    )
    return stored(marks, "marks")


def shared_digests(marks: DataFrame) -> DataFrame:
    """``digest, first, origin`` of payloads that several pages have: the page with the smallest id, by key and by id.

    Payloads that share a digest and differ in length or in a second hash fail.
    """
    second = F.struct("n", "h")
    found = marks.groupBy("digest").agg(
        F.min_by(F.struct("k", "page_id"), "k").alias("first"),
        F.min(second).alias("low"),
        F.max(second).alias("high"),
        F.count("*").alias("c"),
    )
    clash = F.raise_error(F.lit("two payloads share a digest")).cast("bigint")
    first = F.when(F.col("low") == F.col("high"), F.col("first.k")).otherwise(clash)
    shared = found.where("c > 1").select("digest", first.alias("first"), F.col("first.page_id").alias("origin"))
    return stored(shared, "shared")


def page_headers(marks: DataFrame, shared: DataFrame, *, date: str = DATE) -> DataFrame:
    """``header, digest``: the exact header of each page's record, and the digest of its payload.

    The header is that of the record and of the HTTP response in it, both with
    the empty line that ends them. Of equal payloads of at least
    MIN_REVISIT_BYTES bytes, the one with the smallest page id is a response and
    the others revisit it; rows that repeat that id are responses, too.
    """
    # A payload that many pages share is a skewed key, which adaptive execution splits: both sides are scans.
    again = (F.col("n") >= MIN_REVISIT_BYTES) & F.coalesce(F.col("first") != F.col("k"), F.lit(False))
    rows = marks.join(shared, "digest", "left").select("*", again.alias("again"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"),
        _field("Content-Length", F.col("n").cast("string")),
        F.lit(EOL),
    )
    block = F.length(http) + F.when(F.col("again"), 0).otherwise(F.col("n"))
    lines = [
        F.lit(f"WARC/1.1{EOL}"),
        _field("WARC-Type", F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _record_id("page_id")),
        F.coalesce(_field("WARC-Target-URI", F.col("url")), F.lit("")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
        F.when(F.col("again"), F.concat(_field("WARC-Refers-To", _record_id("origin")), _field("WARC-Profile", F.lit(PROFILE))))
        .otherwise(F.lit("")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit(EOL),
    ]
    return rows.select(F.encode(F.concat(*lines, http), "UTF-8").alias("header"), "digest")


def page_payloads(pages: DataFrame, marks: DataFrame, shared: DataFrame) -> DataFrame:
    """``digest, payload`` of each distinct payload, from the page with the smallest id that has it.

    The pages that do not give theirs are known by id, so payloads need not
    meet to be told apart: if those ids are few enough to be broadcast by
    Spark's own rule, no payload is shuffled here. Ids that several rows have
    tell no rows apart; their payloads meet by digest.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(doc_key("page_id").alias("k"), body.alias("payload"))
    many = stored(marks.groupBy("k").agg(F.count("*").alias("c")).where("c > 1").select("k"), "many")
    later = marks.join(shared, "digest").where("k != first").select("k")
    skipped = stored(later.unionByName(many).distinct(), "skipped")
    direct = rows.join(skipped, "k", "left_anti").select(digest_of(F.col("payload")).alias("digest"), "payload")
    owned = marks.join(many, "k", "left_semi").join(shared, "digest", "left").where("coalesce(first, k) = k")
    owned = owned.select("k", "digest").distinct()
    again = rows.join(many, "k", "left_semi").select("k", digest_of(F.col("payload")).alias("digest"), "payload")
    return direct.unionByName(distinct_payloads(again.join(owned, ["k", "digest"], "left_semi").select("payload")))


def distinct_payloads(payloads: DataFrame) -> DataFrame:
    """``digest, payload``, each payload once: copies meet in a partial aggregation before the shuffle.

    Payloads that share a digest and differ in length or in a second hash fail.
    """
    second = F.struct(F.octet_length("payload"), F.xxhash64("payload"))
    hashed = payloads.select("payload", digest_of(F.col("payload")).alias("digest"), second.alias("second"))
    once = hashed.groupBy("digest").agg(
        F.first("payload").alias("payload"), F.min("second").alias("low"), F.max("second").alias("high")
    )
    clash = F.raise_error(F.lit("two payloads share a digest")).cast("binary")
    return once.select("digest", F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(clash).alias("payload"))


def write_archive(headers: DataFrame, payloads: DataFrame, path: str) -> None:
    """Two tables under ``path``: ``headers`` (``header, digest``) and ``payloads`` (``digest, payload``, each once)."""
    headers.select("header", "digest").write.option("compression", "zstd").parquet(f"{path}/headers")
    payloads.select("digest", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")


def write_pages(pages: DataFrame, path: str) -> None:
    """An archive of ``pages`` (``page_id, url, html``)."""
    marks = page_marks(pages)
    shared = shared_digests(marks)
    write_archive(page_headers(marks, shared), page_payloads(pages, marks, shared), path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``header, digest, payload`` of every record; revisits get the payload that they stand for.

    Every stored payload is hashed again; one that does not match its digest,
    or a record whose payload is missing, fails the read.
    """
    headers = spark.read.schema("header binary, digest binary").parquet(f"{path}/headers")
    blobs = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")
    wrong = F.raise_error(F.lit("a payload does not match its digest")).cast("binary")
    missing = F.raise_error(F.lit("a payload is missing")).cast("binary")
    blobs = blobs.select(
        "digest", F.when(digest_of(F.col("payload")) == F.col("digest"), F.col("payload")).otherwise(wrong).alias("payload")
    )
    # Headers of a shared payload are a skewed key, which adaptive execution splits.
    return headers.join(blobs, "digest", "left").select(
        "header", "digest", F.coalesce("payload", missing).alias("payload")
    )


def header_field(name: str) -> Column:
    """The value of a field of the record's own header, or null."""
    found = F.regexp_extract(F.decode("header", "UTF-8"), f"\\r\\n{name}: ([^\\r]*)", 1)
    return F.when(found != "", found)


def _page(name: str) -> Column:
    return F.regexp_extract(header_field(name), "^<urn:page:(-?[0-9]+)>$", 1).try_cast("bigint")


def record_bytes() -> Column:
    """The whole record, to the empty lines that end it."""
    body = F.when(header_field("WARC-Type") != "revisit", F.col("payload")).otherwise(F.lit(b""))
    return F.concat("header", body, F.lit(RECORD_END))


def page_records(archive: DataFrame) -> DataFrame:
    """One row per record of an archive of pages.

    ``page_id``; ``payload_bytes`` (long) and ``payload_digest`` (lower-case hex
    SHA-256) of the full payload; ``record_type``; ``refers_to``, the page id of
    the response for revisits, else null; ``record_sha256`` of the record's
    exact bytes.
    """
    return archive.select(
        _page("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        header_field("WARC-Type").alias("record_type"),
        _page("WARC-Refers-To").alias("refers_to"),
        F.sha2(record_bytes(), 256).alias("record_sha256"),
    )


def archived_pages(pages: DataFrame) -> DataFrame:
    """``pages`` (``page_id, url, html``) through an archive in the shared folder and back: see ``page_records``.

    Null html is an empty payload, a null url gives no target field, and a null
    page id counts as the largest and comes back as null. Rows that repeat a
    page id each have a record. An empty table gives an empty table; extra
    columns are ignored.
    """
    path = fresh_path(pages.sparkSession, "warc")
    write_pages(pages, path)
    return page_records(read_archive(pages.sparkSession, path))


def export_warc(archive: DataFrame, path: str, *, compression: str = "none") -> None:
    """Write the records as WARC files, one per task. With ``gzip`` a file is one member."""
    # The writer ends each row with its separator, the second half of what ends a record.
    whole = record_bytes()
    row = F.substring(whole, F.lit(1), F.octet_length(whole) - 2).cast("string")
    archive.select(row.alias("value")).write.option("lineSep", EOL).option("compression", compression).text(path)


def split_records(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    """Header and payload of each record of a WARC file, plain or gzipped. An HTTP header belongs to the header.

    What is no record is passed over up to the next version line: other bytes,
    and headers without an end or a length. Of a damaged gzip file, what comes
    before the damage is read, and a record that is cut off has the payload that is there.
    """
    if data[:2] == b"\x1f\x8b":
        data = _unzipped(data)
    at = data.find(VERSION_START)
    while at >= 0:
        end = data.find(RECORD_END, at) + len(RECORD_END)
        if end < len(RECORD_END):
            return
        header = data[at:end]
        size = _LENGTH.search(header)
        if size is None:
            at = data.find(VERSION_START, at + len(VERSION_START))
            continue
        block = data[end : end + int(size[1])]
        inner = block.find(RECORD_END) + len(RECORD_END) if b"application/http" in header else 0
        if inner < len(RECORD_END):
            inner = 0
        yield header + block[:inner], block[inner:]
        at = data.find(VERSION_START, end + int(size[1]))


def _unzipped(data: bytes) -> bytes:
    """All members of a gzip file, up to the first damaged byte."""
    parts = []
    while data[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            for at in range(0, len(data), 1 << 16):
                parts.append(member.decompress(data[at : at + (1 << 16)]))
                if member.eof:
                    break
        except zlib.error:
            break
        data = member.unused_data + data[at + (1 << 16) :] if member.eof else b""
    return b"".join(parts)


def read_warc(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``header, payload`` of the records of WARC files; see ``split_records`` for damaged ones.

    A file is read whole by one task: split large ones before.
    """
    ship_package(spark)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                yield pd.DataFrame(list(split_records(data)), columns=["header", "payload"])

    files = spark.read.format("binaryFile").load(paths).select("content")
    return files.mapInPandas(parse, "header binary, payload binary")
