"""Exact tests inside a row whether a word is in a list that is too long for literals.

A Bloom filter of the list goes into the row. It also lets some words of the
corpus through that are not in the list, but those are known: the corpus is
reduced to its distinct words, and the few wrong ones among them are excepted.
So no token crosses a shuffle, however frequent its word is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.lookup import bloom_filter, word_set
from lexmill.sources import wordlists
from lexmill.sources.sinks import stored
from lexmill.sources.wordlists import small_rows, word_frame


def membership(
    corpus_words: DataFrame, members: DataFrame | Sequence[str], limit: int | None = None
) -> Callable[[Column], Column] | None:
    """The test for ``members`` on words of ``corpus_words``, or None where one would need too many exceptions.

    Both have a column ``word``. ``corpus_words`` are the distinct words that
    the test will meet; of other words it tells nothing. Members that are in no
    text are left out. At most ``limit`` words, and one number per block of the
    filter, reach the driver.
    """
    limit = wordlists.LITERAL_WORDS if limit is None else limit
    if not isinstance(members, DataFrame):
        members = word_frame(corpus_words.sparkSession, members)
    known = members.select("word").where("word IS NOT NULL").distinct()
    marked = corpus_words.select("word").join(known.withColumn("member", F.lit(True)), "word", "left")
    # Both kinds of words are read several times below.
    marked = stored(marked.select("word", F.col("member").isNotNull().alias("member")), "words")
    present, others = marked.where("member"), marked.where("NOT member")
    rows = small_rows(present.select("word"), limit)
    if rows is not None:
        return word_set([row.word for row in rows])
    may_hold = bloom_filter(present, present.count())
    wrong = small_rows(others.where(may_hold(F.col("word"))).select("word"), limit)
    if wrong is None:
        return None
    excepted = word_set([row.word for row in wrong])
    return lambda word: may_hold(word) & ~excepted(word)
