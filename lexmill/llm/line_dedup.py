"""Line dedup: lines that many documents share stay in one of them only.

Method: explode normalised lines, hash them, count distinct documents per hash,
drop the lines of hashes over the threshold, and reassemble by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import BLANKS, ascii_lower, doc_key, fenced, packed, stored, unpacked

# A hash held by a large part of all lines is joined in this many pieces.
SALTS = 16


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """What makes two lines equal: white space at both ends and the case of A-Z do not count."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _row_id(doc: str, text: str) -> list[Column]:
    """Id and text hash. Rows that repeat both are one document, and lose the same lines."""
    return [doc_key(doc).alias("d"), F.xxhash64(F.col(f"`{text}`")).alias("t")]


def shared_lines(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """``d, t, dropped``: for each row that loses lines, their positions.

    A key is two 64-bit hashes, each of the whole normalised line. The hashed
    lines are stored once, since they are needed for the counts and again for
    the join.
    """
    # The filter sits inside the generator: outside it would be pushed below and split every text twice.
    numbered = F.transform(
        lines_of(F.col(f"`{text}`")), lambda line, i: F.struct(i.alias("pos"), line_key(line).alias("key"))
    )
    long_enough = F.filter(numbered, lambda x: F.length(x["key"]) >= min_chars)
    hashed = F.transform(
        long_enough,
        lambda x: F.struct(
            x["pos"].alias("pos"),
            F.xxhash64(x["key"]).alias("k1"),
            F.xxhash64(F.lit("line"), x["key"]).alias("k2"),
        ),
    )
    lines = stored(docs.select(*_row_id(doc, text), F.inline(hashed)), "lines")
    holders = lines.select("k1", "k2", "d").distinct()
    repeated = holders.groupBy("k1", "k2").agg(F.min("d").alias("first"), F.count("*").alias("docs"))
    salted = repeated.where(F.col("docs") >= min_docs).select(
        "k1", "k2", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    found = lines.withColumn("salt", F.pmod(F.xxhash64("d", "pos"), F.lit(SALTS)).cast("int"))
    drops = found.join(salted, ["k1", "k2", "salt"]).where(F.col("first") != F.col("d"))
    return drops.groupBy("d", "t").agg(F.collect_set("pos").alias("dropped"))


def line_dedup(
    docs: DataFrame, *, doc: str = "doc_id", text: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines`` and ``n_dropped`` (long).

    Lines are split at ``\\n``. Keys (see ``line_key``) of at least ``min_chars``
    code points found in at least ``min_docs`` documents lose all their lines
    except those in the document with the smallest id that holds the key;
    within that document repeated lines stay. Remaining lines are joined by
    ``\\n``.

    Null and empty texts have one empty line and come back empty. A null id
    counts as the largest id. Rows with equal id and text are one document, so
    all of them keep or lose the same lines; rows with equal id and different
    texts are one document, too, but each keeps its own positions. An empty
    table gives an empty table. Input columns named ``n_lines`` or
    ``n_dropped`` are replaced.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = packed(docs, *_row_id(doc, text), body.alias("body"))
    drops = shared_lines(docs.select(doc, text), doc=doc, text=text, min_chars=min_chars, min_docs=min_docs)
    # A column of its own: inside the lambda below, the text would be split for every line.
    lines = F.when(F.col("dropped").isNotNull(), F.split("body", "\n", -1))
    joined = rows.join(drops, ["d", "t"], "left").select("row", "body", "dropped", lines.alias("lines"))
    positions = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("dropped"))
    kept = F.array_join(F.transform(positions, lambda p: F.get("lines", p)), "\n")
    made = {
        "left": F.when(F.col("dropped").isNull(), F.col("body")).otherwise(kept),
        "n_lines": (F.length("body") - F.length(F.replace("body", F.lit("\n"), F.lit(""))) + 1).cast("bigint"),
        "n_dropped": F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint"),
    }
    found = fenced(joined, ["row"], made)
    renamed = {text: F.col("left"), "n_lines": F.col("n_lines"), "n_dropped": F.col("n_dropped")}
    return found.select(*unpacked(found, docs.columns, renamed))


def line_dedup_report(docs: DataFrame, **options: object) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of every document."""
    found = line_dedup(docs.select("doc_id", "text"), **options)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


LINE_DEDUP_SQL = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND s.first_id <> k.doc_id AS dropped
    FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
