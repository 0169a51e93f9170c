"""Mixing sources to target weights along a curriculum.

Method: every source has a weight schedule over training time; its integral is
the source's cumulative token demand. Inverting the demand gives each copy of a
document its training position, and documents are range-sorted by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.common import doc_key, packed, stored, unpacked

# Weights by rank of the source, repeating; words the mix takes per word there is; copies of a document at most.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
COPIES = 2
# Tilt of the weight over training time, by rank, repeating: weight(t) = weight * (1 + tilt * (2t - 1)), t in 0..1.
TILTS = (0.5, 0.0, -0.5)
# Leading hex digits of the hashed id: a source is laid out in 16**3 pieces.
DIGITS = 3


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit("[^ \\t-\\r]+")).cast("bigint")


def _by_rank(values: tuple, rank: Column) -> Column:
    """The value of a source's rank, from 1."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (rank - 1) % len(values) + 1)


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target, tilt`` from one row per source of ``source, source_size``.

    Sources are ranked by code point, null last. Each gets its weight's share
    of ``SHARE`` times all words, and no more than ``COPIES`` times its own;
    the excess is shared again by weight until none is above. That is the same
    as to fill the sources in the order of limit per weight. The windows hold
    one row per source.
    """
    ranked = sizes.select(
        "source", "source_size", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("rank")
    )
    ranked = ranked.select(
        "source",
        "source_size",
        (F.col("source_size") * COPIES).alias("limit"),
        _by_rank(WEIGHTS, F.col("rank")).cast("bigint").alias("weight"),
        _by_rank(TILTS, F.col("rank")).cast("double").alias("tilt"),
    )
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)

    def so_far(column: str) -> Column:
        return F.coalesce(F.sum(column).over(before), F.lit(0))

    rows = ranked.select(
        "*",
        (F.sum("source_size").over(every) * SHARE).alias("demand"),
        F.sum("weight").over(every).alias("weights"),
        so_far("limit").alias("limits_before"),
        so_far("weight").alias("weights_before"),
    )
    level = (F.col("demand") - F.col("limits_before")) / (F.col("weights") - F.col("weights_before"))
    rows = rows.select("*", (F.col("limit") <= F.col("weight") * level).alias("full"))
    filled = [F.coalesce(F.sum(F.when(F.col("full"), F.col(c))).over(every), F.lit(0)) for c in ("limit", "weight")]
    # Where every source is full there is no level, and none is needed.
    open_level = F.try_divide(F.col("demand") - filled[0], F.col("weights") - filled[1])
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return rows.select("*", open_level.alias("level")).select("source", "source_size", target.alias("target"), "tilt")


def _time(share: Column, tilt: Column) -> Column:
    """Training time by which the source's demand has reached ``share`` of its total: the integral inverted."""
    root = F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * share)
    return F.when(tilt == 0, share).otherwise((root - (1 - tilt)) / (2 * tilt))


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    found = F.lit(True)
    for name in names:
        found = found & a[name].eqNullSafe(b[name])
    return found


def curriculum(sized: DataFrame) -> DataFrame:
    """``d, source, size`` of every distinct row of ``sized``, with its place in the mix.

    Within a source, documents stand in the order of their hashed ids, one pass
    after the other. A copy is taken if its middle lies within the target, so a
    source misses its target by half a document at most. Returns also
    ``source_size, target, copies, positions`` (training time of each copy).

    A running sum over a source would put all of it in one task, so it is made
    of sums over pieces of the source and a running sum within each piece.
    """
    hashed = F.md5(F.col("d").cast("string"))
    # Rows that agree in all three are one unit; they are taken equally often.
    units = sized.groupBy("d", "source", "size").agg((F.count("*") * F.col("size")).alias("tokens"))
    units = stored(units.select("*", hashed.alias("h"), F.substring(hashed, 1, DIGITS).alias("piece")), "units")
    pieces = stored(units.groupBy("source", "piece").agg(F.sum("tokens").alias("tokens")), "pieces")
    targets = stored(source_targets(pieces.groupBy("source").agg(F.sum("tokens").alias("source_size"))), "targets")
    behind = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select("source", "piece", F.coalesce(F.sum("tokens").over(behind), F.lit(0)).alias("offset"))
    named = targets.withColumnRenamed("source", "name")
    offsets = offsets.join(named, offsets["source"].eqNullSafe(named["name"])).drop("name")
    inside = Window.partitionBy("source", "piece").orderBy("h", "d", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = units.select("*", F.coalesce(F.sum("tokens").over(inside), F.lit(0)).alias("within"))
    other = offsets.select(
        F.col("source").alias("name"), F.col("piece").alias("part"), "offset", "source_size", "target", "tilt"
    )
    rows = placed.join(other, placed["source"].eqNullSafe(other["name"]) & (placed["piece"] == other["part"]))
    start = F.col("offset") + F.col("within")
    middles = F.array(*[start + F.col("source_size") * k + F.col("tokens") / 2 for k in range(COPIES)])
    taken = F.filter(middles, lambda m: m <= F.col("target"))
    share = F.transform("taken", lambda m: F.when(F.col("target") > 0, m / F.col("target")).otherwise(0.0))
    rows = rows.select("d", "source", "size", "source_size", "target", "tilt", taken.alias("taken"))
    return rows.select(
        "d",
        "source",
        "size",
        "source_size",
        "target",
        F.size("taken").cast("bigint").alias("copies"),
        F.transform(share, lambda u: _time(u, F.col("tilt"))).alias("positions"),
    )


def mix_report(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken`` and ``position``, in the order of position.

    ``size`` is the number of words, ``taken`` the words that the mix takes of
    the document, repeats counted, and ``position`` the training time of its
    first copy, null if there is none.

    Null texts have size 0. A null id counts as the largest, a null source is a
    source of its own. Repeated rows are all listed and taken equally often. An
    empty table gives an empty table.
    """
    sized = docs.select(doc_key("doc_id").alias("d"), "source", word_count("text").alias("size"), "doc_id")
    sized = stored(sized, "sizes")
    plan = curriculum(sized.select("d", "source", "size"))
    plan = plan.select(*[F.col(c).alias(f"_{c}") for c in plan.columns])
    same = (sized["d"] == plan["_d"]) & sized["source"].eqNullSafe(plan["_source"]) & (sized["size"] == plan["_size"])
    rows = sized.join(plan, same).select(
        "doc_id",
        "size",
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("size")).alias("taken"),
        F.get("_positions", F.lit(0)).alias("position"),
    )
    return rows.orderBy("position", "doc_id")


def mix(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as the mix takes them: not at all, once, or ``COPIES`` times, range-sorted by position.

    All columns come back as they were, whatever their names; see
    ``mix_report`` for nulls, repeated rows and empty tables.
    """
    key = [doc_key(doc).alias("d"), F.col(f"`{source}`").alias("source"), word_count(text).alias("size")]
    plan = curriculum(docs.select(*key)).where("copies > 0")
    plan = stored(plan.select(*[F.col(c).alias(f"_{c}") for c in ("d", "source", "size", "positions")]), "plan")
    rows = packed(docs, *key)
    same = (rows["d"] == plan["_d"]) & rows["source"].eqNullSafe(plan["_source"]) & (rows["size"] == plan["_size"])
    taken = rows.join(plan, same).select("row", "d", F.explode("_positions").alias("position"))
    return taken.orderBy("position", "d").select(*unpacked(taken, docs.columns, {}))


MIX_SQL = """
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           md5(doc_id::VARCHAR) AS h
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS lim,
           row_number() OVER (ORDER BY source NULLS LAST) AS rnk
    FROM sized GROUP BY source
), weighted AS (
    SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
           CASE (rnk - 1) % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 0::DOUBLE ELSE -0.5::DOUBLE END AS tilt
    FROM sources
), sums AS (
    SELECT *, sum(source_size) OVER ()::DOUBLE * 1.5 AS demand, sum(w) OVER ()::DOUBLE AS weights,
           coalesce(sum(lim) OVER before, 0)::DOUBLE AS lims, coalesce(sum(w) OVER before, 0)::DOUBLE AS ws
    FROM weighted
    WINDOW before AS (ORDER BY lim::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
    SELECT *, lim <= w * ((demand - lims) / (weights - ws)) AS is_full FROM sums
), leveled AS (
    SELECT *, (demand - coalesce(sum(lim) FILTER (is_full) OVER (), 0)::DOUBLE)
              / nullif(weights - coalesce(sum(w) FILTER (is_full) OVER (), 0)::DOUBLE, 0) AS level
    FROM filled
), targets AS (
    SELECT source, source_size, tilt, CASE WHEN is_full THEN lim::DOUBLE ELSE w * level END AS target FROM leveled
), laid AS (
    SELECT d.*, t.source_size, t.target, t.tilt,
           (coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            + size::DOUBLE / 2)::DOUBLE AS middle
    FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), shares AS (
    SELECT *, CASE WHEN middle <= target THEN 1 ELSE 0 END
              + CASE WHEN middle + source_size <= target THEN 1 ELSE 0 END AS copies,
           CASE WHEN target > 0 THEN middle / target ELSE 0 END AS u
    FROM laid
)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken,
       CASE WHEN copies = 0 THEN NULL WHEN tilt = 0 THEN u
            ELSE (sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * u) - (1 - tilt)) / (2 * tilt) END AS position
FROM shares
"""
