from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lexmill.functions.text import DF, TF
from lexmill.operators import frequency, stems
from lexmill.operators import index as I
from lexmill.sources import sinks, wordlists


@pytest.fixture
def docs(spark):
    rows = [(1, "cats run\nthe cat ran"), (2, "cats' cat\n\ncat 42 b2b x"), (3, "the the"), (4, ""), (5, None), (1, "cat dogs dog")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("long_lists", [False, True])
def test_index_equals_the_direct_way(spark, docs, monkeypatch, long_lists):
    stop = spark.createDataFrame([("the",), (None,)], "word string")
    table = spark.createDataFrame([("cat", 4), ("dog", 1), ("ran", 0), (None, 3)], "term string, df bigint")
    if long_lists:
        monkeypatch.setattr(wordlists, "LITERAL_WORDS", 0)
    index = I.forward_index(docs, stop=stop, row_is_document=False)
    direct = frequency.term_frequency(docs, stop=stop)
    assert rows(I.index_term_frequency(index)) == rows(direct)
    assert rows(I.index_document_frequency(index)) == rows(direct.groupBy("term").agg(F.count("*").alias("df")))
    assert rows(I.index_stripes(index)) == rows(frequency.tf_stripes(direct))
    stemmed = I.stemmed_index(index, stems.stem_words(I.index_words(index)), min_stem_len=2)
    assert rows(I.index_term_frequency(stemmed)) == rows(frequency.term_frequency(docs, stop=stop, stem=True))
    assert rows(I.index_scores(stemmed, table)) == rows(
        frequency.scores(frequency.term_frequency(docs, stop=stop, stem=True, df_table=table))
    )
    assert I.forward_index(docs.where("false")).collect() == []


def test_text_is_read_once(spark, docs, tmp_path):
    """The index is made while the text is there; everything else works without it."""
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    index = I.forward_index(spark.read.parquet(path).limit(100), stop=["the"])
    top = I.index_document_frequency(index)
    for found in (top, I.index_scores(index, top), I.stemmed_index(index, stems.stem_words(I.index_words(index)))):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert path not in plan and "split(" not in plan
        assert found.count()


def test_dictionary_grows_by_new_words(spark, tmp_path):
    path = str(tmp_path / "stems")
    assert stems.read_stems(spark, path).collect() == []
    first = stems.update_stems(spark.createDataFrame([("cats",), ("runs",), (None,), ("cats",)], "term string"), path)
    assert sorted(map(tuple, first.collect())) == [("cats", "cat"), ("runs", "run")]
    spark.createDataFrame([("cats", "kept")], stems.DICTIONARY).write.mode("overwrite").parquet(path)
    grown = stems.update_stems(spark.createDataFrame([("cats",), ("dogs",)], "term string"), path)
    # A word that is there is not stemmed again.
    assert sorted(map(tuple, grown.collect())) == [("cats", "kept"), ("dogs", "dog")]
    assert spark.read.parquet(path).count() == stems.update_stems(grown.select("term"), path).count() == 2


def test_new_words_are_found_without_a_join(spark, tmp_path, monkeypatch):
    path, joins = str(tmp_path / "stems"), []
    stem_words = stems.stem_words
    monkeypatch.setattr(stems, "stem_words", lambda w: joins.append(w._jdf.queryExecution().optimizedPlan().toString()) or stem_words(w))
    for words in (["cats", "runs", None], ["cats", "dogs", "dogs", None]):
        found = stems.update_stems(spark.createDataFrame([(w,) for w in words], "term string"), path)
    assert sorted(map(tuple, found.collect())) == [("cats", "cat"), ("dogs", "dog"), ("runs", "run")]
    assert len(joins) == 2 and not any("Join" in plan for plan in joins)


@pytest.mark.parametrize("limit", [0, 2, 10_000])
def test_stems_of_frequent_terms_are_not_joined(spark, docs, monkeypatch, limit):
    """Whatever part of the terms is looked up in the row, partial stem tables and one-letter stems included."""
    index = I.forward_index(docs)
    table = spark.createDataFrame([("cats", "cat"), ("dogs", "d"), ("run", None)], "term string, stem string")
    want = [(1, "cat", 1), (1, "cat", 2), (1, "dog", 1), (1, "ran", 1), (1, "run", 1), (1, "the", 1), (2, "b2b", 1), (2, "cat", 3), (3, "the", 2)]
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", limit)
    monkeypatch.setattr(I, "SOME_DOCUMENTS", 1.0)
    joined, attach = [], I.attach_stems
    monkeypatch.setattr(I, "attach_stems", lambda tokens, *rest: joined.append(tokens.count()) or attach(tokens, *rest))
    found = I.index_term_frequency(I.stemmed_index(index, table, min_stem_len=2))
    assert sorted(map(tuple, found.collect())) == want
    # The frequent terms, and the entries of all others.
    assert joined == {0: [0, 12], 2: [2, 7], 10_000: [8, 0]}[limit]


def test_no_stemming_above_the_text(spark, docs):
    table = spark.createDataFrame([("cat", 4), ("dog", 1)], "term string, df bigint")
    found = frequency.term_frequency(docs, stem=True, stop=["the"], df_table=table, row_is_document=True, profile=TF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "RLIKE" not in plan and "endswith" not in plan and "Exchange" not in plan
    assert sorted(map(tuple, found.collect())) == [(1, "cat", 1, 4), (1, "cat", 2, 4), (1, "dog", 2, 1), (2, "cat", 3, 4)]


def test_one_join_for_a_long_table(spark, docs, monkeypatch):
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 1)
    table = spark.createDataFrame([("cat", 4), ("dog", 1), ("run", 2)], "term string, df bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = frequency.term_frequency(docs, df_table=table, row_is_document=True)
        assert found._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, found.collect())) == [
        (1, "cat", 1, 4), (1, "cat", 1, 4), (1, "dog", 1, 1), (1, "run", 1, 2), (2, "cat", 2, 4)
    ]


def test_terms_are_distinct_below_the_join_with_stop_words(spark, docs, monkeypatch):
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 0)
    for stem in (False, True):
        found = frequency.document_frequency(docs, stop=["the"], stem=stem, profile=DF)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "array_distinct" in plan[plan.index("LeftAnti") :]


def test_runs_replace_their_part(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run, n in (("1", 5), ("b/c", 7), ("1", 6)):
        part = spark.range(n).selectExpr("'w' || id AS word", "id AS n")
        sinks.write_run(part, path, run)
    assert sinks.read_runs(spark, path, part.schema).count() == 13
