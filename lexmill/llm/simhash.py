"""SimHash near-dedup with deletion-variant signatures.

Method: a 64-bit fingerprint is cut into three segments, fewer than the four
differing bits allowed need, so that at least one segment of a linked pair
differs by at most one bit. Every segment is indexed under each of its
one-wildcard variants; fingerprints that share a variant are verified.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexmill.llm.common import LAST_ID, doc_key, packed, ship_package, stored, unpacked
from lexmill.llm.graph import components

MAX_BITS = 4
SHINGLE = 4
SEED = 42
# First bit and width of each segment. Two flips in all three would be six, over MAX_BITS: one has at most one.
SEGMENTS = ((0, 21), (21, 21), (42, 22))
# Hashes of one text that are held at a time.
BLOCK = 1 << 16
# Row v: the eight bits of the byte v, lowest first.
_BITS_OF_BYTE = (np.arange(256)[:, None] >> np.arange(8)) & 1
_BYTE_PLACE = np.arange(8) * 256


def fingerprint(body: bytes) -> int:
    """SimHash of a text in UTF-8, as a signed 64-bit integer.

    ``bytes`` methods know ASCII only: ``lower`` changes A-Z and ``split`` cuts
    at the white space of the contract.
    """
    words = body.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - SHINGLE + 1)
    last = ends[min(SHINGLE, len(words)) - 1 :]
    ones = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        cuts = zip(starts[at : min(n, at + BLOCK)].tolist(), last[at : at + BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64)
        places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _BYTE_PLACE
        ones += np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS_OF_BYTE
    over_half = (2 * ones > n).ravel()
    return int(np.packbits(over_half, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(bodies: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(body) for body in bodies], dtype="int64")


def fingerprint_of(text: str) -> Column:
    return _fingerprints(F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8"))


def _variants(prints: str) -> Column:
    """One key per bit: the bit's number, and its segment with that bit deleted."""
    p = F.col(prints)
    keys = []
    for start, width in SEGMENTS:
        segment = F.shiftrightunsigned(p, start).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            rest = segment.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            keys.append(rest + F.lit((start + bit) << 22))
    return F.explode(F.array(*keys))


def _near(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_BITS


def linked_prints(prints: DataFrame) -> DataFrame:
    """``p, label`` for distinct fingerprints ``p`` with a link: the smallest fingerprint that each can reach.

    A group of near copies has a link for every pair, but components need only
    as many as hold it together. So the fingerprints of a bucket are first
    linked to the smallest one there, and only buckets that still hold two
    components are joined with themselves, across components and verified in
    the join. Every link within MAX_BITS shares a bucket, so none that joins two
    components is missed. A bucket holds distinct fingerprints that agree in 20
    or 21 bits: no copies, but unrelated ones, as many as there are
    fingerprints for 2**20 values. Those never leave a window or a join.
    """
    bucket = Window.partitionBy("key")
    led = prints.select("p", _variants("p").alias("key")).select("p", F.min("p").over(bucket).alias("lead"))
    spokes = led.where((F.col("p") != F.col("lead")) & _near("p", "lead"))
    grouped = components(spokes.select(F.col("p").alias("a"), F.col("lead").alias("b")))
    named = prints.join(grouped, prints["p"] == grouped["node"], "left").select("p", F.coalesce("label", "p").alias("c"))
    members = named.select("p", "c", _variants("p").alias("key")).select(
        "*", F.min("c").over(bucket).alias("low"), F.max("c").over(bucket).alias("high")
    )
    open_rows = stored(members.where("low != high").select("key", "p", "c"), "open")
    left = open_rows.select("key", F.col("p").alias("p1"), F.col("c").alias("c1"))
    right = open_rows.select("key", F.col("p").alias("p2"), F.col("c").alias("c2"))
    across = left.join(right, (left["key"] == right["key"]) & (F.col("c1") < F.col("c2")) & _near("p1", "p2"))
    steps = across.select(F.col("c1").alias("a"), F.col("c2").alias("b")).distinct()
    merged = components(steps).select(F.col("node").alias("label"), F.col("label").alias("root"))
    both = grouped.select("node", "label").unionByName(
        merged.select(F.col("label").alias("node"), "label").join(
            grouped.select("node"), "node", "left_anti"
        )
    )
    return both.join(merged, "label", "left").select(
        F.col("node").alias("p"), F.coalesce("root", "label").alias("label")
    )


def simhash_groups(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``d, p, component`` per row: id, fingerprint, and the smallest id that can be reached over links."""
    ship_package(docs.sparkSession)
    prints = stored(docs.select(doc_key(doc).alias("d"), fingerprint_of(text).alias("p")), "prints")
    # Copies meet here: one row per fingerprint and task.
    distinct = stored(prints.groupBy("p").agg(F.min("d").alias("first")), "distinct")
    labelled = distinct.join(linked_prints(distinct.select("p")), "p", "left").select(
        "p", "first", F.coalesce("label", "p").alias("label")
    )
    firsts = labelled.groupBy("label").agg(F.min("first").alias("component"))
    found = stored(labelled.join(firsts, "label").select("p", "component"), "components")
    # A fingerprint that many documents share is a skewed key, which adaptive execution splits: both sides are scans.
    return prints.join(found, "p")


def _id(key: str) -> Column:
    return F.when(F.col(key) != LAST_ID, F.col(key))


def near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a shingle is 4 words
    joined by spaces, or the whole sequence if there are fewer. A bit of the
    fingerprint (16 lower-case hex digits) is 1 if it is set in over half the
    XXH64 hashes (seed 42) of the shingles, repeats included. Fingerprints with
    at most 4 differing bits are linked; ``component_id`` is the smallest id
    that can be reached.

    Null, empty and blank texts have the fingerprint 0, which is linked like
    any other. A null id counts as the largest. Repeated rows come back as
    often as they came. An empty table gives an empty table.
    """
    digits = F.lower(F.lpad(F.hex("p"), 16, "0"))
    return simhash_groups(docs, doc=doc, text=text).select(
        _id("d").alias("doc_id"), digits.alias("fingerprint"), _id("component").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the one with the smallest id.

    Rows that repeat an id are one document and stay or go together. All
    columns come back as they were, whatever their names.
    """
    keepers = simhash_groups(docs, doc=doc, text=text).where("d = component").select("d")
    rows = packed(docs, doc_key(doc).alias("d"))
    kept = rows.join(keepers, "d", "left_semi")
    return kept.select(*unpacked(kept, docs.columns, {}))
