from __future__ import annotations

import gzip

import pytest
from definitions import sha, warc

from lexmill.llm import warc as W

ODD = [
    (10, "u", "x" * 200),
    (11, "u", "x" * 200),
    (11, "u", "x" * 200),
    (11, "u", "only here, under an id that other rows have" * 9),
    (9, "u", "first of its payload, twice" * 9),
    (9, "u", "first of its payload, twice" * 9),
    (23, "u", "first of its payload, twice" * 9),
    (None, "a\r\nWARC-Type: fake", "y" * 150),
    (12, None, "y" * 150),
    (13, "z", None),
    (14, "z", ""),
    (15, "z", "é"),
    (16, "z", "é"),
    (17, "z", "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 5\r\n\r\n" * 40),
    (18, "z", "z" * 99),
    (19, "z", "z" * 99),
    (20, "z", "v" * 100),
    (21, "z", "v" * 100),
]


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    odd = spark.createDataFrame(ODD, "page_id bigint, url string, html string")
    shifted = spark.read.parquet(f"{sf_dir}/pages.parquet").selectExpr("page_id + 100 AS page_id", "url", "html")
    return shifted.unionByName(odd).selectExpr("*", "'x' AS digest", "1 AS header", "2 AS payload", "3 AS first", "4 AS k", "5 AS n")


def test_all_pages(pages):
    found = W.archived_pages(pages).drop("record_sha256").collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, warc([r.asDict() for r in pages.collect()])))


def test_archive_stores_payloads_once_and_gives_exact_records(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    W.write_pages(pages, path)
    bodies = {(r.html or "").encode() for r in pages.collect()}
    assert sorted(bytes(r.payload) for r in spark.read.parquet(f"{path}/payloads").collect()) == sorted(bodies)
    archive = W.read_archive(spark, path)
    want = sorted(r.record_sha256 for r in W.page_records(archive).collect())
    for compression in ("none", "gzip"):
        files = str(tmp_path / compression)
        W.export_warc(archive, files, compression=compression)
        read = W.read_warc(spark, files)
        assert sorted(sha(bytes(r.header) + bytes(r.payload) + W.RECORD_END) for r in read.collect()) == want
    # And files into an archive and out again.
    again = str(tmp_path / "again")
    headers = read.select("header", W.digest_of(read["payload"]).alias("digest"))
    W.write_archive(headers, W.distinct_payloads(read), again)
    assert sorted(r.record_sha256 for r in W.page_records(W.read_archive(spark, again)).collect()) == want


def test_a_damaged_payload_is_found(spark, pages, tmp_path):
    path = str(tmp_path / "archive")
    W.write_pages(pages, path)
    payloads = spark.read.parquet(f"{path}/payloads")
    for name, rows in (
        ("wrong", payloads.selectExpr("digest", "concat(payload, cast('x' AS binary)) AS payload")),
        ("missing", payloads.where("length(payload) < 1000")),
    ):
        other = str(tmp_path / name)
        spark.read.parquet(f"{path}/headers").write.parquet(f"{other}/headers")
        rows.write.parquet(f"{other}/payloads")
        with pytest.raises(Exception, match="payload"):
            W.page_records(W.read_archive(spark, other)).collect()


def test_empty(pages):
    assert W.archived_pages(pages.where("false")).collect() == []


def test_damaged_archives():
    def record(payload: bytes, length: bytes | None = None) -> bytes:
        size = length if length is not None else b"Content-Length: %d\r\n" % len(payload)
        return b"WARC/1.1\r\nWARC-Type: resource\r\n" + size + b"\r\n" + payload + b"\r\n\r\n"

    def payloads(data: bytes) -> list[bytes]:
        return [p for _, p in W.split_records(data)]

    good, more = record(b"one\r\n\r\nWARC/1.0"), record(b"two")
    assert payloads(good + more) == [b"one\r\n\r\nWARC/1.0", b"two"]
    assert payloads(b"no archive at all") == payloads(b"") == payloads(b"WARC/1.1\r\nbroken off") == []
    assert payloads(b"junk" + good + b"junk" + more) == [b"one\r\n\r\nWARC/1.0", b"two"]
    assert payloads(record(b"x", b"") + record(b"x", b"Content-Length: many\r\n") + more) == [b"two"]
    assert payloads(good + more[:-6]) == [b"one\r\n\r\nWARC/1.0", b"t"]
    big = record(bytes(range(256)) * 2000)
    zipped = [gzip.compress(r) for r in (good, big, more)]
    assert payloads(b"".join(zipped)) == payloads(good + big + more)
    assert payloads(zipped[0] + zipped[1][: len(zipped[1]) // 2])[0] == b"one\r\n\r\nWARC/1.0"
    assert payloads(zipped[0] + b"\x1f\x8bno member") == [b"one\r\n\r\nWARC/1.0"]
