"""Document fingerprints by Order MinHash.

Method: number the occurrences of each k-mer, select the minimal ones, keep
them in the order of the text, and hash the tuples. Two k-mers of a tuple that
change places change the hash, so the fingerprint is sensitive to edit distance
and not only to content. Native column expressions throughout.

The k-mers are dealt over BINS by their hash and each bin selects its own
minimal ones, so that every k-mer is hashed once instead of once per slot. A bin
with too few of them borrows the minimal ones of the bins that follow, so that
every slot of a text with two k-mers tells an order.
"""

from __future__ import annotations

import json
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import LAST_ID, doc_key, words_of

# Words of a k-mer, slots of a fingerprint, k-mers of a slot's tuple, bits of a slot's hash.
K = 3
BIN_BITS = 6
BINS = 1 << BIN_BITS
TUPLE = 2
SLOT_BITS = 16
# A selected k-mer is one integer: bin, hash, place in the text. No text that fits a row has more places.
PLACE_BITS = 31
_BIN_SHIFT = 63 - BIN_BITS
_HASH_MASK = (1 << 63) - (1 << PLACE_BITS)
# Documents, about, of a block within which the next document is looked up.
BLOCK_ROWS = 4096
# Blocks are larger in a table that would have more of them.
MAX_BLOCKS = 1 << 16


def with_signature(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with ``out``: the filled slots of the text in ``text``, as ``slot << SLOT_BITS | hash``, in order.

    A text of fewer than K words is one k-mer; without words it has no slots.
    Bins without k-mers are no slots. Expressions that a lambda refers to are
    columns of their own, so that they are computed once per text.
    """
    names = [c for c in df.columns if c != out]
    rows = df.select(*names, F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("_h"))
    n = F.size("_h")
    heads = F.slice("_h", 1, F.greatest(n - (K - 1), F.lit(0)))
    mers = F.transform(heads, lambda x, i: F.xxhash64(x, *[F.get("_h", i + j) for j in range(1, K)]))
    whole = F.array(F.aggregate("_h", F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x)))
    short = F.when(n == 0, F.array().cast("array<bigint>")).otherwise(whole)
    rows = rows.select(*names, F.when(n >= K, mers).otherwise(short).alias("_m"))
    # Most texts repeat no k-mer: all occurrences are the first. The others sort equal ones together to number them.
    repeats = F.size(F.array_distinct("_m")) < F.size("_m")
    together = F.sort_array(F.transform("_m", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.select(*names, "_m", F.when(repeats, together).alias("_t"))

    def opens(x: Column, j: Column) -> Column:
        return (j == 0) | (F.get("_t", j - 1)["h"] != x["h"])

    first = F.filter(F.transform("_t", lambda x, j: F.when(opens(x, j), j)), lambda j: j.isNotNull())
    rows = rows.select(*names, "_m", "_t", first.alias("_f"))

    def packed(h: Column, occurrence: Column, place: Column) -> Column:
        mixed = F.xxhash64(h, occurrence).bitwiseAND(F.lit(_HASH_MASK))
        return mixed + place

    def run(start: Column, r: Column) -> Column:
        end = F.coalesce(F.get("_f", r + 1), F.size("_t")) - start
        return F.transform(
            F.slice("_t", start + 1, end), lambda x, o: packed(x["h"], o.cast("bigint"), x["i"].cast("bigint"))
        )

    numbered = F.when(F.col("_t").isNotNull(), F.flatten(F.transform("_f", run))).otherwise(
        F.transform("_m", lambda h, i: packed(h, F.lit(0).cast("bigint"), i.cast("bigint")))
    )
    rows = rows.select(*names, F.sort_array(numbered).alias("_s"))

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, _BIN_SHIFT)

    minimal = F.filter("_s", lambda x, j: (j < TUPLE) | (bin_of(F.get("_s", j - TUPLE)) != bin_of(x)))
    rows = rows.select(*names, minimal.alias("_x"))
    # Bins are runs of one to TUPLE elements, and what a bin lacks comes next, around the end; a tuple is put in the order
    # of the text.
    place = F.lit((1 << PLACE_BITS) - 1)
    n = F.size("_x")

    def slot(x: Column, j: Column) -> Column:
        members = F.slice(F.array(*[F.get("_x", (j + k) % n) for k in range(TUPLE)]), F.lit(1), F.least(n, F.lit(TUPLE)))
        in_order = F.array_sort(
            F.transform(members, lambda y: F.struct(y.bitwiseAND(place).alias("p"), F.shiftright(y, PLACE_BITS).alias("h")))
        )
        hashed = F.aggregate(in_order, F.lit(0).cast("bigint"), lambda a, y: F.xxhash64(a, y["h"]))
        low = hashed.bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
        return (F.shiftleft(bin_of(x), SLOT_BITS) + low).cast("int")

    def leads(x: Column, j: Column) -> Column:
        return (j == 0) | (bin_of(F.get("_x", j - 1)) != bin_of(x))

    slots = F.transform("_x", lambda x, j: F.when(leads(x, j), slot(x, j)))
    return rows.select(*names, F.filter(slots, lambda v: v.isNotNull()).alias(out))


def signature_text(signature: str) -> Column:
    """A signature as text of fixed length: per slot its hash in hex, or as many dashes if it is empty."""
    digits = SLOT_BITS // 4
    # The filled slots come in order, so each brings the dashes since the one before.
    before = F.concat(F.array(F.lit(-1)), F.transform(F.col(signature), lambda v: F.shiftright(v, SLOT_BITS)))
    parts = F.transform(
        F.arrays_zip(F.col(signature).alias("v"), F.slice(before, 1, F.size(signature)).alias("b")),
        lambda x: F.concat(
            F.repeat(F.lit("-"), digits * (F.shiftright(x["v"], SLOT_BITS) - x["b"] - 1)),
            F.lower(F.lpad(F.hex(x["v"].bitwiseAND(F.lit((1 << SLOT_BITS) - 1))), digits, "0")),
        ),
    )
    return F.rpad(F.array_join(parts, ""), digits * BINS, "-")


def likeness(a: str, b: str) -> Column:
    """Equal slots per slot that either of two signatures fills; 1 if neither fills any."""
    bins_a, bins_b = (F.transform(F.col(c), lambda v: F.shiftright(v, SLOT_BITS)) for c in (a, b))
    filled = F.size(F.array_union(bins_a, bins_b))
    return F.when(filled == 0, 1.0).otherwise(F.size(F.array_intersect(F.col(a), F.col(b))) / filled)


def _search(bounds: list[int], value: Column) -> Column:
    """How many of the bounds, which ascend, are not above the value."""
    table = F.from_json(F.lit(json.dumps(bounds)), "array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, len(bounds).bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.get(table, p + s - 1) <= value, p + s).otherwise(p))


def _in_blocks(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` as ``doc_id, d, h, text, block, piece``, and whole rows that occur too often to be in a block each.

    Blocks are ranges of ids, and an id with more rows than a block is alone in
    its block, which is cut into pieces by the hash of the text. A row of which
    even copies of id and text are more than that stands in its piece once; the
    second result has such rows with ``times``, their other copies, dealt over
    several rows.

    What comes to the driver is at most some MAX_BLOCKS rows in each case:
    bounds, frequent ids, and frequent rows.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", doc_key("doc_id").alias("d"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.count()
    most = max(BLOCK_ROWS, ceil(total / MAX_BLOCKS))
    counted = rows.groupBy("d").agg(F.count("*").alias("n")).where(F.col("n") > most).collect()
    frequent = {r["d"]: ceil(r["n"] / most) for r in counted}
    blocks = max(1, ceil(total / most))
    bounds = {b for d in frequent for b in (d, min(d + 1, LAST_ID))}
    if blocks > 1:
        at = F.array(*[F.lit(i / blocks) for i in range(1, blocks)])
        found = rows.agg(F.percentile_approx("d", at, F.lit(max(10_000, 20 * blocks))).alias("at")).first()
        bounds |= set(found["at"])
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("block", _search(sorted(bounds), F.col("d")))
    if not frequent:
        return rows.withColumn("piece", F.lit(0).cast("bigint")), None
    cuts = spark.createDataFrame(list(frequent.items()), "d bigint, pieces bigint")
    rows = rows.join(F.broadcast(cuts), "d", "left")
    part = F.shiftright((F.shiftright("h", 32) + (1 << 31)) * F.col("pieces"), 32)
    rows = rows.withColumn("piece", F.coalesce(part, F.lit(0).cast("bigint")))
    copies = rows.where("pieces IS NOT NULL").groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    copies = [(r["doc_id"], r["h"], r["n"]) for r in copies.where(F.col("n") > most).collect()]
    rows = rows.drop("pieces")
    if not copies:
        return rows, None
    known = F.broadcast(spark.createDataFrame(copies, "of_id bigint, of_h bigint, n bigint"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h"))
    one = rows.join(known, same).groupBy("doc_id", "d", "h", "block", "piece", "n").agg(F.first("text").alias("text"))
    others = F.transform(
        F.sequence(F.lit(0), F.expr(f"(n - 2) div {most}")), lambda k: F.least(F.col("n") - 1 - k * most, F.lit(most))
    )
    repeated = one.select("doc_id", "text", F.explode(others).alias("times"))
    return rows.join(known, same, "left_anti").unionByName(one.drop("n")), repeated


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, sig``, and ``next_text, next_sig`` of the next document by descending id.

    The next of the last document is the first. Texts are shuffled once, to
    blocks of neighbouring ids, and the first document of a block is copied to
    the block before. ``times`` is how many rows a row stands for, which is one
    unless id and text repeat more often than a block has rows.
    """
    rows, repeated = _in_blocks(docs)
    found = rows.groupBy("block", "piece").agg(F.max("d").alias("d")).collect()
    # Ids descend from block to block, hashes ascend from piece to piece. After the last row of all comes the first.
    found = sorted(found, key=lambda r: (-r["block"], r["piece"]))
    before = [(*r, *found[i - 1][:2]) for i, r in enumerate(found)]
    ends = rows.sparkSession.createDataFrame(before, "block int, piece bigint, d bigint, to_block int, to_piece bigint")
    # At most a few times MAX_BLOCKS rows.
    first = rows.join(F.broadcast(ends), ["block", "piece", "d"]).groupBy("to_block", "to_piece")
    first = first.agg(F.min_by(F.struct("doc_id", "d", "h", "text"), "h").alias("row"))
    copied = first.select("row.*", F.col("to_block").alias("block"), F.col("to_piece").alias("piece"), F.lit(1).alias("copy"))
    placed = with_signature(rows.withColumn("copy", F.lit(0)).unionByName(copied), "text", "sig")
    order = Window.partitionBy("block", "piece").orderBy("copy", F.desc("d"), "h")
    following = placed.select(
        "doc_id", "text", "sig", "copy", F.lead("text").over(order).alias("next_text"), F.lead("sig").over(order).alias("next_sig")
    )
    following = following.where("copy = 0").select("doc_id", "text", "sig", "next_text", "next_sig", F.lit(1).cast("bigint").alias("times"))
    if repeated is None:
        return following
    # Copies of a row follow each other.
    itself = with_signature(repeated, "text", "sig")
    itself = itself.select("*", F.col("text").alias("next_text"), F.col("sig").alias("next_sig"))
    return following.unionByName(itself)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) with fingerprints of each text and of its edited text.

    ``n_chars`` (long) is the number of code points. In the edited text the last
    ``n_chars div 2`` of them are replaced by the first as many, or all, of the
    next document by descending id; the first follows the last.
    ``edited_sha256`` is its lower-case hex SHA-256 in UTF-8. ``fingerprint``
    and ``edited_fingerprint`` are as in ``signature_text``; ``near_edited`` and
    ``near_next`` the likeness (0 to 1) of the text's fingerprint to that of the
    edited text and of the next document.

    Equal texts have equal fingerprints. Null and empty texts have empty
    fingerprints, which are alike. A null id counts as the largest; rows that
    repeat an id follow each other in the order of a hash of their texts. A
    single document is next to itself, an empty table gives an empty table, and
    extra columns are ignored.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left("next_text", half))
    rows = with_next(docs).select(
        "doc_id", "times", F.length("text").cast("bigint").alias("n_chars"), "sig", "next_sig", edited.alias("edited")
    )
    rows = with_signature(rows, "edited", "edited_sig")
    found = rows.select(
        "times",
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        signature_text("sig").alias("fingerprint"),
        signature_text("edited_sig").alias("edited_fingerprint"),
        likeness("sig", "edited_sig").alias("near_edited"),
        likeness("sig", "next_sig").alias("near_next"),
    )
    return found.withColumn("times", F.explode(F.sequence(F.lit(1).cast("bigint"), "times"))).drop("times")
