"""Corpora as DataFrames: text folders by line or by document, and tables of documents."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.functions.text import split_lines
from lexmill.sources.sinks import stored

# One scan partition covers at most one 128 MB split, so this many pieces are
# enough to keep every core busy on a corpus that is a single small file.
PIECES_PER_SPLIT = 32
SOME_ROWS = 2_000
SOME_CHARS = 4_096


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per line of the text files, as ``line``.

    Small files share partitions and large ones are split, both at
    ``spark.sql.files.maxPartitionBytes``, which ``session(split_bytes=)`` sets.
    """
    return spark.read.text(paths).select(F.col("value").alias("line"))


def read_numbered_lines(
    spark: SparkSession, paths: str | Sequence[str], *, full_path: bool = True, across: bool = False
) -> DataFrame:
    """``file, line_no, line`` of text files, lines numbered from 0 in each file, or with ``across`` over all files.

    Large files are read in splits, and a split does not know how many lines
    stand before it. So lines are counted by split first, the counts summed up
    by file, and each line's place in its split added. That reads the files
    twice and shuffles no text as long as the counts, one row per split, are
    small enough for Spark to broadcast. ``across`` goes on from file to file in the order of their paths.
    """
    placed = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("line"),
    )
    counted = placed.groupBy("path", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    # Stored, so that its size is known; the same session reads the files in the same splits again.
    counted = stored(counted, "splits")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("path", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    if across:
        # One row per file.
        files = counted.groupBy("path").agg(F.sum("n").alias("n"))
        earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        files = files.select("path", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
        starts = starts.join(files, "path").select("path", "block", "first", (F.col("start") + F.col("offset")).alias("start"))
    found = placed.join(stored(starts, "starts"), ["path", "block"], "left")
    moved = F.raise_error(F.lit("the files changed, or are split in another way than a moment before"))
    place = F.when(F.col("start").isNull() | (F.col("id") < F.col("first")), moved.cast("bigint"))
    number = place.otherwise(F.col("start") + F.col("id") - F.col("first"))
    return found.select(F.col("path" if full_path else "name").alias("file"), number.alias("line_no"), "line")


def read_documents(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    full_path: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Text files as documents: ``doc_id`` and one row per ``line``.

    The id is the file's base name, so files of the same name in two folders
    are one document; ``full_path=True`` keeps them apart. ``whole=True``
    returns one row per file instead, with its content in ``text``: a file must
    then fit a row, which can have 2 GB.
    """
    doc_id = F.col("_metadata.file_path" if full_path else "_metadata.file_name").alias("doc_id")
    content = F.col("value").alias("text" if whole else "line")
    return spark.read.text(paths, wholetext=whole).select(doc_id, content)


def read_table(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns of a parquet corpus, spread over the cores when it is one small file."""
    return spread(spark.read.parquet(path).select(*columns))


def spread(df: DataFrame) -> DataFrame:
    """Repartition a scan of at most one split's bytes that has fewer partitions than there are cores.

    Tokenizing is CPU work, and so small a corpus may be a single row group,
    which no split size divides: one task would do it all. Anything larger is
    returned as it is, however many cores there are, and so is what has been
    shuffled before. Size and partitions come from the plan; no job runs here.
    """
    plan = df._jdf.queryExecution()
    if "Exchange" in plan.executedPlan().toString():
        return df
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    if int(str(plan.optimizedPlan().stats().sizeInBytes())) > conf.filesMaxPartitionBytes():
        return df
    have = df.rdd.getNumPartitions()
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(min(cores, have * PIECES_PER_SPLIT)) if have < cores else df


def some_rows(df: DataFrame, text: str) -> DataFrame:
    """The beginnings of the texts of a few rows, to see which words are frequent; only for what changes no result.

    They come through the driver, because ``take`` reads no more partitions than it needs, where a limit inside a plan would
    have every task shuffle its rows. At most SOME_ROWS texts of SOME_CHARS characters.
    """
    found = df.select(F.left(F.col(text), F.lit(SOME_CHARS)).alias(text)).take(SOME_ROWS)
    return df.sparkSession.createDataFrame(pa.table({text: pa.array([row[0] for row in found], pa.string())}))


def lines_of(df: DataFrame, *, text: str = "text", keep: Sequence[str] = (), numbered: bool = False) -> DataFrame:
    """Split a text column into lines: the ``keep`` columns, ``line_no`` from 0 if asked, and ``line``."""
    lines = split_lines(F.col(text))
    if numbered:
        return df.select(*keep, F.posexplode(lines).alias("line_no", "line"))
    return df.select(*keep, F.explode(lines).alias("line"))
