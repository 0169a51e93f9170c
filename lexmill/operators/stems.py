"""Stemming a vocabulary once, and joining the stems back to tokens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.lookup import word_map
from lexmill.functions.porter import porter, porter_array
from lexmill.functions.text import DF, TokenProfile, explode_tokens
from lexmill.sources import wordlists
from lexmill.sources.corpus import some_rows

DICTIONARY = "term string, stem string"


def stem_vocabulary(df: DataFrame, *, text: str = "text", profile: TokenProfile = DF) -> DataFrame:
    """``term, stem`` for each distinct token: the corpus is reduced to its vocabulary before stemming."""
    return stem_words(explode_tokens(df, profile, text=text, out="term").distinct())


def stem_words(words: DataFrame) -> DataFrame:
    """``term, stem`` of distinct words in the column ``term``."""
    return words.select("term", F.array("term").alias("_words")).select("term", stems_of("_words").alias("stem"))


def frequent_stems(df: DataFrame, text: str, profile: TokenProfile) -> Callable[[Column], Column]:
    """Stems of words that are frequent in some rows of ``df``, to be looked up in the row; null for all others.

    Which rows these are decides on speed only: words without a stem here are stemmed where they stand.
    At most LITERAL_WORDS words reach the driver.
    """
    counted = explode_tokens(some_rows(df, text), profile, text=text, out="term").groupBy("term").agg(F.count("*").alias("n"))
    words = counted.where("n > 1").orderBy(F.desc("n"), "term").limit(wordlists.LITERAL_WORDS)
    return word_map({row["term"]: row["stem"] for row in stem_words(words.select("term")).collect()})


def read_stems(spark: SparkSession, path: str, *, distinct: bool = True) -> DataFrame:
    """The stem dictionary at ``path``, ``term, stem``; an empty one if there is none yet.

    Without ``distinct``, words that two updates appended at once are there twice.
    """
    try:
        found = spark.read.schema(DICTIONARY).parquet(path)
        return found.dropDuplicates(["term"]) if distinct else found
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], DICTIONARY)


def update_stems(words: DataFrame, path: str) -> DataFrame:
    """The stem dictionary at ``path`` after the words of the column ``term`` that it lacks were stemmed and appended.

    So a corpus that grows has only its new words stemmed. Repeating an update
    appends nothing, and words that two updates append at once count once when read.
    """
    spark = words.sparkSession
    known = read_stems(spark, path, distinct=False).select("term", F.lit(True).alias("known"))
    # One aggregation in place of distinct words and a join: a task need not hold its words in a hash table and sorted, too.
    both = words.select("term", F.lit(False).alias("known")).where("term IS NOT NULL").unionByName(known)
    unseen = both.groupBy("term").agg(F.max("known").alias("known")).where("NOT known").select("term")
    stem_words(unseen).write.mode("append").parquet(path)
    return read_stems(spark, path)


def stems_of(words: str, min_len: int = 1) -> Column:
    """Generate the stems of an array column that have ``min_len`` letters.

    A generator is where filters stop. On a plain stem column, Spark would push
    a later filter below the distinct, and stem every token of the corpus for it.
    """
    stems = porter_array(words)
    return F.explode(F.filter(stems, lambda s: F.length(s) >= min_len) if min_len > 1 else stems)


def attach_stems(tokens: DataFrame, stems: DataFrame, column: str) -> DataFrame:
    """Replace the token ``column`` by its stem.

    ``stems`` may hold any part of the vocabulary, say its frequent words: other
    tokens are stemmed where they stand. In a left join only ``stems`` can be
    broadcast, and Spark does that if its size allows.
    """
    others = [c for c in tokens.columns if c != column]
    looked_up = stems.select(F.col("term").alias(column), F.col("stem").alias("_stem"))
    joined = tokens.join(looked_up, column, "left")
    return joined.select(*others, F.coalesce("_stem", porter(column)).alias(column))
