"""End-to-end pipelines: readers, operators and writers put together.

Input is a DataFrame (a text folder from ``read_lines`` / ``read_documents`` or
a table of documents); output is a lazy DataFrame to show, join or write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.formats import COLLECTION_SIZE
from lexmill.functions.text import DF, PAIRS, STRIPES, TF, WORDCOUNT, WORDCOUNT_CASED, TokenProfile
from lexmill.operators.cooccur import pairs, stripes
from lexmill.operators.counts import top_terms, top_words, word_counts
from lexmill.operators.frequency import document_frequency, scores, term_frequency
from lexmill.sources.wordlists import read_counts

Words = DataFrame | Sequence[str]


def most_frequent_words(
    corpus: DataFrame,
    *,
    text: str = "text",
    stop: Words | None = None,
    k: int = 50,
    case_sensitive: bool = False,
    min_len: int = WORDCOUNT.min_len,
) -> DataFrame:
    """The ``k`` most frequent words of ``min_len`` letters or more that are not stop words, as ``word, n``.

    The stop list stays lowercase in a case-sensitive count, so ``The`` is counted then.
    """
    profile = replace(WORDCOUNT_CASED if case_sensitive else WORDCOUNT, min_len=min_len)
    return top_words(word_counts(corpus, text=text, profile=profile, stop=stop), k)


def pair_cooccurrence(
    lines: DataFrame, vocabulary: Words, distance: int, *, text: str = "line", **options: object
) -> DataFrame:
    """Pair counts ``w, u, n`` within lines, with the letters-only tokenizer."""
    return pairs(lines, vocabulary, distance, text=text, profile=PAIRS, **options)


def stripe_cooccurrence(
    lines: DataFrame, vocabulary: Words, distance: int, *, text: str = "line", **options: object
) -> DataFrame:
    """One neighbour map per word within lines, with the tokenizer that keeps digits and apostrophes."""
    return stripes(lines, vocabulary, distance, text=text, profile=STRIPES, **options)


def top_document_frequency(
    records: DataFrame,
    *,
    text: str = "text",
    doc: str | None = None,
    stop: Words | None = None,
    stem: bool = True,
    k: int = 100,
) -> DataFrame:
    """``rank, term, df`` of the terms found in the most records (lines or documents)."""
    return top_terms(document_frequency(records, text=text, doc=doc, profile=DF, stop=stop, stem=stem), k)


def top_terms_from_counts(spark: SparkSession, paths: str | Sequence[str], k: int = 100) -> DataFrame:
    """``rank, term, df`` of the ``k`` largest records of ``term<TAB>count`` files."""
    return top_terms(read_counts(spark, paths), k)


def tf_idf_scores(
    documents: DataFrame,
    df_table: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    stop: Words | None = None,
    stem: bool = True,
    row_is_document: bool = False,
    profile: TokenProfile = TF,
    n_docs: float = COLLECTION_SIZE,
) -> DataFrame:
    """``doc, term, score`` for the terms of the DF table; ``n_docs`` is the size of the collection in the formula."""
    tf = term_frequency(
        documents,
        doc=doc,
        text=text,
        profile=profile,
        stop=stop,
        stem=stem,
        row_is_document=row_is_document,
        df_table=df_table,
    )
    return scores(tf, doc=doc, n_docs=n_docs)


def merged(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of per-part results of the same shape, to be aggregated again."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def merged_word_counts(parts: Sequence[DataFrame]) -> DataFrame:
    """Word counts of a corpus from the ``word, n`` counts of its parts."""
    return merged(parts).groupBy("word").agg(F.sum("n").alias("n"))
