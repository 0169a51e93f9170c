"""Merkle manifest of a dataset: one tree per group of rows, and one over the groups' roots.

Method: slot pivot. Conditional aggregates spread the children of each parent
into as many columns as the tree has fan-out; their concatenation is hashed into
the parent, and leaving out the own slot's column gives the siblings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import stored

FANOUT = 3
# Levels that are made without a shuffle between them: those over one block of FANOUT**TIER nodes.
TIER = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left: string, right: string>>"


def _digest(column: Column) -> Column:
    return F.sha2(column, 256)


def leaf_digest(*columns: Column) -> Column:
    """Hash of a row: each value as its UTF-8 bytes' number, a colon and the value, ``-`` for null."""
    texts = [c.cast("string") for c in columns]
    fields = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return _digest(F.concat(*fields))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest leads to along its path."""
    return F.aggregate(path, leaf, lambda at, step: _digest(F.concat(step["left"], at, step["right"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings on a path, from the leaf to the root, left to right in each run."""
    return _digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


def _numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with the place ``idx`` of each row in its group, from 0, and the group's size ``n``.

    A window over a group would put all of it into one task. So rows are dealt
    by range, counted by group and range, and numbered within; the running sums
    hold one row per range that a group touches.
    """
    dealt = stored(rows.repartitionByRange(group, *order).withColumn("part", F.spark_partition_id()), "dealt")
    counted = dealt.groupBy(group, "part").agg(F.count("*").alias("rows"))
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        F.col(group).alias("_group"),
        F.col("part").alias("_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
        F.sum("rows").over(of_group).alias("n"),
    )
    inside = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order)) - 1
    placed = dealt.select("*", inside.alias("inside"))
    joined = placed.join(starts, (F.col(group) == F.col("_group")) & (F.col("part") == F.col("_part")))
    return joined.select(*rows.columns, (F.col("start") + F.col("inside")).alias("idx"), "n")


def _node(level: int) -> Column:
    return F.expr(f"idx div {FANOUT**level}")


def _size(level: int) -> Column:
    """Nodes of the group that far up."""
    return F.expr(f"(n + {FANOUT**level - 1}) div {FANOUT**level}")


def _slots(digest: str, slot: Column) -> list[Column]:
    """The children of a parent, one aggregate per slot."""
    return [F.max(F.when(slot == s, F.col(digest))) for s in range(FANOUT)]


_SLOT_NAMES = [f"slot{s}" for s in range(FANOUT)]


def _roll_up(nodes: DataFrame, levels: int) -> DataFrame:
    """``g, idx, n, digest`` of the nodes that stand ``levels`` above ``nodes``.

    All levels keep to the partitioning by block. A group's last node stays as it is.
    """
    rows = nodes.select("g", _node(levels).alias("block"), "idx", "n", "digest").repartition("g", "block")
    for _ in range(levels):
        pivot = rows.groupBy("g", "block", "n", _node(1).alias("parent")).agg(
            *[c.alias(name) for c, name in zip(_slots("digest", F.col("idx") % FANOUT), _SLOT_NAMES, strict=True)]
        )
        parent = F.when(F.col("n") == 1, F.col("slot0")).otherwise(_digest(F.concat_ws("", *_SLOT_NAMES)))
        rows = pivot.select("g", "block", F.col("parent").alias("idx"), _size(1).alias("n"), parent.alias("digest"))
    return rows.select("g", "idx", "n", "digest")


def _with_siblings(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with ``block`` and ``path``, the siblings of each on the way up ``levels``."""
    rows = nodes.select("*", _node(levels).alias("block")).repartition("g", "block")
    rows = rows.select("*", F.col("digest").alias("at"), F.array().cast(PATH).alias("path"))
    for level in range(levels):
        slot = _node(level) % FANOUT
        run = Window.partitionBy("g", "block", _node(level + 1))
        pivot = [c.over(run).alias(name) for c, name in zip(_slots("at", slot), _SLOT_NAMES, strict=True)]
        rows = rows.select("*", *pivot)
        left = F.concat_ws("", *[F.when(slot > s, F.col(name)) for s, name in enumerate(_SLOT_NAMES)])
        right = F.concat_ws("", *[F.when(slot < s, F.col(name)) for s, name in enumerate(_SLOT_NAMES)])
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        alone = _size(level) == 1
        rows = rows.select(
            *nodes.columns,
            "block",
            F.when(alone, F.col("at")).otherwise(_digest(F.concat_ws("", *_SLOT_NAMES))).alias("at"),
            F.when(alone, F.col("path")).otherwise(F.concat("path", step)).alias("path"),
        )
    return rows.drop("at")


def _tree(leaves: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """Roots ``g, idx, n, digest`` of the groups, and the tables of nodes under them with the levels between.

    ``leaves`` is a stored table with ``g, idx, n, digest``. The driver gets one number, the largest group's size.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels = 0
    while FANOUT**levels < largest:
        levels += 1
    tiers, nodes = [], leaves
    while levels:
        up = min(TIER, levels)
        tiers.append((nodes, up))
        nodes, levels = stored(_roll_up(nodes, up), "nodes"), levels - up
    return nodes, tiers


def _paths(roots: DataFrame, tiers: list[tuple[DataFrame, int]]) -> DataFrame:
    """The lowest tier's nodes with the whole ``path`` and the columns that ``roots`` has beside its path."""
    above = roots
    for nodes, levels in reversed(tiers):
        named = [c for c in roots.columns if c not in ("g", "idx", "n", "digest", "path")]
        upper = above.select(
            F.col("g").alias("_g"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), *named
        )
        rows = _with_siblings(nodes, levels)
        joined = rows.join(upper, (F.col("g") == F.col("_g")) & (F.col("block") == F.col("_idx")))
        above = joined.select(*nodes.columns, F.concat("path", "_path").alias("path"), *named)
    return above


def manifest(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    group: str = "source",
    columns: Sequence[str] = COLUMNS,
    presented: dict[str, Column] | None = None,
) -> DataFrame:
    """``doc_id, source, leaf, presented, path, subroot, root`` of every row.

    Each row's digest over ``columns`` is a leaf. In each group the leaves
    ascend by id, and while there are several nodes, every FANOUT consecutive
    ones become the hash of their digests; the last run may be shorter. A
    group's last node is its subroot. Subroots ascend by group, bytewise and
    null first, and give the root in the same way. ``path`` holds the siblings
    left and right of the row's node, from the leaf to the root. ``presented``
    is the digest of the row with these columns put in place of its own, to be
    held against the root with ``folded``.

    A null group is a group of its own and a null id comes last. Rows of equal
    id are ordered by digest, so repeated rows stand side by side and results do not
    depend on how they are read. Null and empty texts differ, and texts of any
    length are hashed whole; only digests are shuffled. Other columns are left out,
    whatever their names. An empty table gives an empty table.
    """
    own = {c: F.col(f"`{c}`") for c in columns}
    leaf = leaf_digest(*own.values())
    shown = leaf_digest(*(own | (presented or {})).values()) if presented else leaf
    # The prefix tells the null group from an empty name and sorts it first.
    key = F.coalesce(F.concat(F.lit("."), F.col(f"`{group}`").cast("string")), F.lit(""))
    rows = docs.select(
        F.col(f"`{doc}`").alias("doc_id"),
        F.col(f"`{group}`").alias("source"),
        key.alias("g"),
        F.col(f"`{doc}`").isNull().alias("no_id"),
        leaf.alias("digest"),
        shown.alias("presented"),
    )
    # Stored, so that texts are read and hashed once, also for the bounds of the ranges.
    rows = stored(rows, "leaves")
    leaves = stored(_numbered(rows, "g", ["no_id", "doc_id", "digest"]), "numbered")
    subroots, tiers = _tree(leaves)
    tops = subroots.select(F.lit("").alias("all"), F.col("g").alias("name"), "digest")
    tops = _numbered(tops, "all", ["name"])
    tops = stored(tops.select(F.col("all").alias("g"), "name", "idx", "n", "digest"), "subroots")
    roots, over = _tree(tops)
    roots = roots.select("g", "idx", "n", "digest", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    if over:
        tops = _paths(roots, over)
    else:
        tops = tops.join(roots.select("g", "path", "root"), "g")
    tops = tops.select(
        F.col("name").alias("g"),
        F.lit(0).cast("bigint").alias("idx"),
        F.lit(1).cast("bigint").alias("n"),
        "digest",
        "path",
        F.col("digest").alias("subroot"),
        "root",
    )
    if tiers:
        found = _paths(tops, tiers)
    else:
        found = leaves.join(tops.select("g", "path", "subroot", "root"), "g")
    return found.select("doc_id", "source", F.col("digest").alias("leaf"), "presented", "path", "subroot", "root")


def manifest_report(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every document.

    Rows whose id has an even crc32 are presented without the line ends of their text.
    """
    even = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(docs, presented={"text": tampered})
    root = folded(F.col("presented"), F.col("path"))
    rows = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return rows.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


MERKLE_SQL = """
WITH RECURSIVE rows AS (
    SELECT doc_id, coalesce('.' || source, '') AS g, coalesce(doc_id::VARCHAR, '') AS id, text,
           concat(
               coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-'),
               coalesce(strlen(source) || ':' || source, '-'),
               coalesce(strlen(lang) || ':' || lang, '-'),
               coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-')) AS head
    FROM documents
), bits AS (
    -- CRC-32 of the decimal id, byte by byte, and bit by bit inside
    SELECT *, xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(id, ''), lambda c: ord(c)::BIGINT)),
               lambda crc, b: list_reduce(
                   list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                   lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)),
               4294967295::BIGINT) AS crc
    FROM rows
), hashed AS (
    SELECT doc_id, g, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           CASE WHEN crc % 2 = 0
                THEN sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-'))
                ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS shown
    FROM bits
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, leaf) - 1 AS idx,
           count(*) OVER (PARTITION BY g) AS n
    FROM hashed
), nodes AS (
    SELECT g, 0 AS lvl, idx, n, leaf AS digest FROM leaves
    UNION ALL
    SELECT g, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM nodes WHERE n > 1 GROUP BY g, lvl, n, idx // 3
), subroots AS (
    SELECT g, digest, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
    SELECT 0 AS lvl, idx, n, digest FROM subroots
    UNION ALL
    SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY idx))
    FROM tops WHERE n > 1 GROUP BY lvl, n, idx // 3
), steps AS (
    -- of every leaf, by its place, the siblings on each level; the levels of the tree over the subroots come after
    SELECT l.g, l.idx, s.lvl,
           coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < l.idx // (3 ** s.lvl)::BIGINT), '') AS lft,
           coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > l.idx // (3 ** s.lvl)::BIGINT), '') AS rgt
    FROM leaves l JOIN nodes s
      ON s.g = l.g AND s.n > 1 AND s.idx // 3 = l.idx // (3 ** (s.lvl + 1))::BIGINT
    GROUP BY ALL
    UNION ALL
    SELECT l.g, l.idx, 1000 + s.lvl,
           coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < r.idx // (3 ** s.lvl)::BIGINT), ''),
           coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > r.idx // (3 ** s.lvl)::BIGINT), '')
    FROM leaves l JOIN subroots r ON r.g = l.g
    JOIN tops s ON s.n > 1 AND s.idx // 3 = r.idx // (3 ** (s.lvl + 1))::BIGINT
    GROUP BY ALL
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY g, idx ORDER BY lvl) AS step FROM steps
), folds AS (
    SELECT g, idx, 0::BIGINT AS step, shown AS digest FROM leaves
    UNION ALL
    SELECT f.g, f.idx, s.step, sha256(s.lft || f.digest || s.rgt)
    FROM folds f JOIN numbered s ON s.g = f.g AND s.idx = f.idx AND s.step = f.step + 1
), ends AS (
    SELECT g, idx, arg_max(digest, step) AS folded_root FROM folds GROUP BY g, idx
), proofs AS (
    SELECT g, idx, sha256(string_agg(lft || rgt, '' ORDER BY step)) AS proof FROM numbered GROUP BY g, idx
), root AS (
    SELECT digest AS root FROM tops WHERE n = 1
)
SELECT l.doc_id, l.leaf, r.digest AS subroot, root.root, coalesce(p.proof, sha256('')) AS proof_sha256,
       e.folded_root, e.folded_root = root.root AS verified
FROM leaves l JOIN subroots r ON r.g = l.g JOIN ends e ON e.g = l.g AND e.idx = l.idx
LEFT JOIN proofs p ON p.g = l.g AND p.idx = l.idx CROSS JOIN root
"""
