import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lexmill.functions import formats
from lexmill.functions.text import TF
from lexmill.operators import frequency
from lexmill.operators.stems import stem_vocabulary
from lexmill.plans import pipelines
from lexmill.sources import wordlists
from lexmill.sources.corpus import lines_of


@pytest.fixture
def docs(spark):
    rows = [
        (1, "cats run\nthe cat ran"),
        (2, "cats' cat\n\ncat 42 b2b x"),
        (3, "the the"),
        (4, ""),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def df_of(df):
    return {r.term: r.df for r in df.collect()}


def test_line_and_document_units_differ(docs):
    by_line = frequency.document_frequency(lines_of(docs), text="line", stop=["the"])
    assert df_of(by_line) == {"cats": 2, "run": 1, "cat": 3, "ran": 1, "x": 1}
    by_doc = frequency.document_frequency(docs, stop=["the"])
    assert df_of(by_doc) == {"cats": 2, "run": 1, "cat": 2, "ran": 1, "x": 1}


def test_rows_of_one_document_count_once(docs):
    by_line = lines_of(docs, keep=["doc_id"])
    grouped = frequency.document_frequency(by_line, text="line", doc="doc_id", stop=["the"])
    assert df_of(grouped) == df_of(frequency.document_frequency(docs, stop=["the"]))


def test_stemmed_terms_are_distinct_after_stemming(spark, docs):
    inside = df_of(frequency.document_frequency(lines_of(docs), text="line", stop=["the"], stem=True))
    assert inside == {"cat": 4, "run": 1, "ran": 1, "x": 1}
    expected = df_of(frequency.document_frequency(docs, stop=["the"], stem=True))
    assert expected["cat"] == 2
    stems = stem_vocabulary(docs)
    for doc in ("doc_id", None):
        assert df_of(frequency.document_frequency(docs, doc=doc, stop=["the"], stems=stems)) == expected


@pytest.mark.parametrize("stem", [False, True])
@pytest.mark.parametrize("row", [False, True])
@pytest.mark.parametrize("min_stem_len", [1, 3])
def test_results_do_not_depend_on_the_length_of_lists(spark, docs, monkeypatch, stem, row, min_stem_len):
    """Everything with lists as literals and as joined tables: repeated ids, null words, another profile."""
    again = docs.unionByName(spark.createDataFrame([(1, "cat cat dogs"), (2, None)], docs.schema))
    stop = spark.createDataFrame([("the",), ("run",), (None,)], "word string")
    table = spark.createDataFrame([("cat", 4), ("dog", 1), ("cats", 2), ("dogs", 2), ("ran", 0), (None, 3)], "term string, df bigint")
    profile = replace(TF, min_stem_len=min_stem_len)

    def everything():
        options = {"stop": stop, "stem": stem}
        tf = {"row_is_document": row, "profile": profile} | options
        found = [
            frequency.document_frequency(again, **options),
            frequency.document_frequency(again, doc="doc_id", **options),
            frequency.term_frequency(again, **tf),
            frequency.term_frequency(again, df_table=table, **tf),
            frequency.scores(frequency.term_frequency(again, **tf), table),
            frequency.row_stripes(again, profile=profile, **options),
            frequency.row_stripes(again, profile=profile, df_table=table, **options),
        ]
        return [sorted(repr(sorted(r.asDict(True).items())) for r in f.collect()) for f in found]

    short = everything()
    assert all(short)
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 0)
    assert everything() == short


def test_stems_can_be_joined(docs):
    want = sorted(map(tuple, frequency.term_frequency(docs, stop=["the"], stem=True).collect()))
    stems = stem_vocabulary(docs, profile=TF)
    for row in (False, True):
        found = frequency.term_frequency(docs, stop=["the"], stems=stems, row_is_document=row)
        assert sorted(map(tuple, found.collect())) == want


def test_only_distinct_words_of_a_row_are_stemmed(docs):
    """The stemmer reads the words of the counted cells, not the tokens."""
    plan = frequency.term_frequency(docs, stem=True, row_is_document=True)._jdf.queryExecution().optimizedPlan().toString()
    stemmed = [line for line in plan.splitlines() if "zip_with" in line]
    assert len(stemmed) == 1 and "_cells" in stemmed[0] and "split(" not in stemmed[0]


def test_merged_runs_of_different_tables(spark):
    runs = spark.createDataFrame([(1, "a", 2, 5), (1, "a", 3, 7)], "doc_id bigint, term string, tf bigint, df bigint")
    assert list(map(tuple, frequency.merge_counts(runs).collect())) == [(1, "a", 5)]


def test_stripes_of_long_documents_in_parts(spark):
    tf = spark.range(10_000).selectExpr("1L AS doc_id", "'t' || id AS term", "1L AS tf")
    found = frequency.tf_stripes(tf, parts=8).collect()
    assert len(found) == 8 and max(len(r.stripe) for r in found) < 2_000 and sum(len(r.stripe) for r in found) == 10_000


def test_term_frequency_by_row_and_by_line(docs):
    expected = [(1, "cat", 1), (1, "cats", 1), (1, "ran", 1), (1, "run", 1), (2, "b2b", 1), (2, "cat", 2), (2, "cats", 1)]
    rows = frequency.term_frequency(docs, stop=["the"], row_is_document=True)
    assert sorted(map(tuple, rows.collect())) == expected
    rows = frequency.term_frequency(lines_of(docs, keep=["doc_id"]), text="line", stop=["the"])
    assert sorted(map(tuple, rows.collect())) == expected
    stemmed = frequency.term_frequency(docs, stop=["the"], stem=True, row_is_document=True)
    assert (2, "cat", 3) in set(map(tuple, stemmed.collect()))


def test_short_stems_are_not_counted(spark):
    # "ies" stems to one letter.
    df = spark.createDataFrame([(1, "ies dogs")], "doc_id bigint, text string")
    rows = frequency.term_frequency(df, profile=TF, stem=True).collect()
    assert list(map(tuple, rows)) == [(1, "dog", 1)]


def test_recorded_scores(spark):
    rows = [("d", "american", 1, 5501), ("d", "extern", 1, 8008), ("d", "three", 1, 5598)]
    tf = spark.createDataFrame(rows, "doc_id string, term string, tf bigint, df bigint")
    found = {r.term: r.score for r in frequency.scores(tf).collect()}
    assert found == {"american": 1.035975, "extern": 0.810375, "three": 1.024733}


def test_scores_skip_terms_without_a_document_frequency(spark):
    tf = spark.createDataFrame([(1, "a", 2), (1, "b", 3), (1, "c", 1)], "doc_id bigint, term string, tf bigint")
    table = spark.createDataFrame([("a", 10), ("b", 0)], "term string, df bigint")
    rows = frequency.scores(tf, table).collect()
    assert list(map(tuple, rows)) == [(1, "a", round(2 * math.log(10000 / 10 + 1), 6))]


def test_score_text_has_six_places(spark):
    df = spark.createDataFrame([(1.5,), (0.0000005,)], "s double")
    assert [r.t for r in df.select(formats.score_text(F.col("s")).alias("t")).collect()] == ["1.500000", "0.000001"]


def test_tf_stripes_round_trip(docs):
    tf = frequency.term_frequency(docs, stop=["the"], row_is_document=True)
    stripes = frequency.tf_stripes(tf)
    assert {r.doc_id: r.stripe for r in stripes.collect()}[2] == {"b2b": 1, "cat": 2, "cats": 1}
    text = stripes.select("doc_id", formats.tf_stripe_text(F.col("stripe")).alias("s"))
    back = text.select("doc_id", F.inline(formats.tf_stripe_entries(F.col("s"))))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tf.collect()))


def test_malformed_stripe_cells_are_dropped(spark):
    df = spark.createDataFrame([("a:1,b,c:x,d:2:3, e : 4 ,\tf:5:,the:3000000000,g:99999999999999999999",)], "s string")
    rows = df.select(F.inline(formats.tf_stripe_entries(F.col("s")))).collect()
    assert list(map(tuple, rows)) == [("a", 1), ("e", 4), ("f", 5), ("the", 3_000_000_000)]


def test_chained_pipeline_with_restricted_terms(docs):
    top = pipelines.top_document_frequency(lines_of(docs), text="line", stop=["the"], k=1)
    assert list(map(tuple, top.collect())) == [(1, "cat", 4)]
    expected = [(1, "cat", round(2 * math.log(10000 / 4 + 1), 6)), (2, "cat", round(3 * math.log(10000 / 4 + 1), 6))]
    for row_is_document in (True, False):
        found = pipelines.tf_idf_scores(docs, top, stop=["the"], row_is_document=row_is_document)
        assert sorted(map(tuple, found.collect())) == expected


def test_one_letter_terms_can_be_frequent_but_are_never_scored(spark):
    df = spark.createDataFrame([(1, "s s dog")], "doc_id bigint, text string")
    top = pipelines.top_document_frequency(df)
    assert {r.term for r in top.collect()} == {"s", "dog"}
    assert {r.term for r in pipelines.tf_idf_scores(df, top).collect()} == {"dog"}


def test_row_documents_are_scored_without_a_shuffle_of_terms(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    table = spark.createDataFrame([("the", 5), ("of", 3)], "term string, df bigint")
    found = pipelines.tf_idf_scores(docs, table, row_is_document=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Join" not in plan
