"""Stop words, vocabularies and DF tables read from text files."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import trim_blanks, whole_number
from lexmill.sources.sinks import stored

# Word lists up to this length become literals inside an expression; longer
# ones stay DataFrames and are joined.
LITERAL_WORDS = 10_000


def read_stop_words(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One ``word`` per line, trimmed and lowercased; blank lines are no words. A missing path raises."""
    word = F.lower(trim_blanks(F.col("value"))).alias("word")
    return spark.read.text(paths).select(word).where("word != ''").distinct()


def read_vocabulary(spark: SparkSession, paths: str | Sequence[str], *, fmt: str) -> DataFrame:
    """A vocabulary as one distinct ``word`` column.

    ``fmt="line"`` takes the whole line, lowercased. ``fmt="first_field"`` takes
    the first field and keeps its case, so it also reads ``word<TAB>count``.
    """
    line = trim_blanks(F.col("value"))
    if fmt == "line":
        word = F.lower(line)
    elif fmt == "first_field":
        word = F.split(line, r"\s+")[0]
    else:
        raise ValueError(f"fmt is 'line' or 'first_field', not {fmt!r}")
    return spark.read.text(paths).select(word.alias("word")).where("word != ''").distinct()


def _fields(line: Column) -> Column:
    return F.split(trim_blanks(line), "\t")


def read_counts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``term<TAB>df`` records, repeated terms kept.

    Lines that do not have exactly two fields, or whose second field is no
    64-bit integer, are dropped.
    """
    return _counts(spark.read.text(paths).select("value")).select("term", "df")


def read_df_table(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """As ``read_counts`` with one row per term: the last one in file order wins."""
    lines = spark.read.text(paths).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("place"),
    )
    return _counts(lines, "place").groupBy("term").agg(F.max_by("df", "place").alias("df"))


def _counts(lines: DataFrame, *keep: str) -> DataFrame:
    fields = lines.select(_fields(F.col("value")).alias("f"), *keep).where(F.size("f") == 2)
    number = whole_number(F.get("f", F.lit(1)))
    return fields.select(trim_blanks(F.get("f", F.lit(0))).alias("term"), number.alias("df"), *keep).where(
        "df IS NOT NULL"
    )


def word_frame(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """A word list held in Python as a DataFrame. Arrow input gives Spark its exact size. None is no word."""
    return spark.createDataFrame(pa.table({"word": pa.array(sorted(set(words) - {None}), pa.string())}))


def small_rows(df: DataFrame, limit: int) -> list[Row] | None:
    """All rows, or None when there are more than ``limit``: at most one more ever reaches the driver."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def as_literals(words: DataFrame | Sequence[str] | None, limit: int | None = None) -> list[str] | None:
    """The words as a sorted list, or None when there are more than ``limit``. Nulls are no words."""
    limit = LITERAL_WORDS if limit is None else limit
    if words is None:
        return []
    if isinstance(words, DataFrame):
        rows = small_rows(words.select("word").where("word IS NOT NULL").distinct(), limit)
        return None if rows is None else sorted(row.word for row in rows)
    found = sorted(set(words) - {None})
    return found if len(found) <= limit else None


def as_local_df_table(df_table: DataFrame, limit: int | None = None) -> tuple[DataFrame, list[str] | None]:
    """A DF table that can be joined, and its terms as literals if there are at most ``limit``.

    A short table is computed once here instead of inside every plan that uses
    it; a long one is stored in the scratch folder for the same reason.
    """
    limit = LITERAL_WORDS if limit is None else limit
    table = df_table.select("term", F.col("df").cast("bigint").alias("df")).where("df != 0 AND term IS NOT NULL")
    rows = small_rows(table, limit)
    if rows is None:
        return stored(table, "df"), None
    columns = {"term": pa.array([r.term for r in rows], pa.string()), "df": pa.array([r.df for r in rows], pa.int64())}
    return df_table.sparkSession.createDataFrame(pa.table(columns)), [r.term for r in rows]
