"""Word counts and top words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import WORDCOUNT, TokenProfile, explode_tokens, token_array
from lexmill.sources.wordlists import as_literals, word_frame


def without_stop_words(tokens: DataFrame, stop: DataFrame | Sequence[str] | None, column: str = "word") -> DataFrame:
    """Left anti join against a stop list too long for literals; Spark broadcasts it if its size allows."""
    if stop is None:
        return tokens
    if not isinstance(stop, DataFrame):
        stop = word_frame(tokens.sparkSession, stop)
    return tokens.join(stop.select(F.col("word").alias(column)), column, "left_anti")


def word_counts(
    df: DataFrame,
    *,
    text: str = "text",
    profile: TokenProfile = WORDCOUNT,
    stop: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """``word, n``. Map-side partial counts mean that a hot word crosses the shuffle once per task."""
    literals = as_literals(stop)
    tokens = explode_tokens(df, profile, text=text, stop=literals or ())
    counted = tokens.groupBy("word").agg(F.count("*").alias("n"))
    return without_stop_words(counted, stop) if literals is None else counted


def top_words(counts: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` most frequent words, ties in word order."""
    return counts.orderBy(F.desc("n"), "word").limit(k)


def top_terms(df_table: DataFrame, k: int = 100) -> DataFrame:
    """``rank, term, df`` of the ``k`` highest document frequencies, ties in term order."""
    top = df_table.orderBy(F.desc("df"), "term").limit(k)
    # The window has no partitions, but the limit leaves it k rows.
    rank = F.row_number().over(Window.orderBy(F.desc("df"), "term"))
    return top.select(rank.cast("bigint").alias("rank"), "term", "df")


def vocabulary_size(df_table: DataFrame) -> DataFrame:
    return df_table.agg(F.count("term").alias("n_terms"))


def token_stats(df: DataFrame, profile: TokenProfile, *, key: str, text: str = "text") -> DataFrame:
    """Tokens and distinct tokens per row, without a shuffle."""
    tokens = df.select(key, token_array(F.col(text), profile).alias("tokens"))
    return tokens.select(
        key,
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size(F.array_distinct("tokens")).cast("bigint").alias("n_distinct"),
    )
