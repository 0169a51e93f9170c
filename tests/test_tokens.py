from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.operators import counts


def tokens(spark, line, profile):
    row = spark.createDataFrame([(line,)], ["t"]).select(T.token_array(F.col("t"), profile).alias("a")).first()
    return row.a


CHARS = "Don't x_1 42 é b2b A"


def test_four_tokenizers_differ(spark):
    assert tokens(spark, CHARS, T.WORDCOUNT) == ["don"]
    assert tokens(spark, CHARS, T.WORDCOUNT_CASED) == ["Don"]
    assert tokens(spark, CHARS, T.PAIRS) == ["don", "t", "x", "b", "b", "a"]
    assert tokens(spark, CHARS, T.STRIPES) == ["don't", "x_1", "42", "b2b", "a"]
    assert tokens(spark, CHARS, T.DF) == ["don", "t", "a"]
    assert tokens(spark, CHARS, T.TF) == ["don", "b2b"]


def test_empty_and_separator_only_lines_have_no_tokens(spark):
    for line in ("", "  ", "--- !!"):
        for profile in (T.WORDCOUNT, T.PAIRS, T.STRIPES, T.DF, T.TF):
            assert tokens(spark, line, profile) == []


def test_array_form_equals_exploded_form(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    for profile in (T.WORDCOUNT, T.STRIPES, T.DF, T.TF):
        arrays = docs.select("doc_id", F.explode(T.token_array(F.col("text"), profile)).alias("word"))
        rows = T.explode_tokens(docs, profile, keep=["doc_id"])
        assert arrays.exceptAll(rows).isEmpty() and rows.exceptAll(arrays).isEmpty()


def test_trim_strips_control_characters(spark):
    df = spark.createDataFrame([("\t\x00 a b\r\n ",)], ["t"])
    assert df.select(T.trim_blanks(F.col("t")).alias("t")).first().t == "a b"


def test_explode_runs_counts_inside_the_row(spark):
    df = spark.createDataFrame([(1, list("banana")), (2, []), (3, ["x"])], "id int, a array<string>")
    rows = T.explode_runs(df, F.col("a"), name="v", count="n", keep=["id"]).collect()
    assert sorted(map(tuple, rows)) == [(1, "a", 3), (1, "b", 1), (1, "n", 2), (3, "x", 1)]


def test_word_counts_and_stop_words(spark):
    df = spark.createDataFrame([("The cat, the dog; a CAT",), ("cat's",)], ["text"])
    assert dict(map(tuple, counts.word_counts(df, stop=["the"]).collect())) == {"cat": 3, "dog": 1}
    cased = counts.word_counts(df, profile=T.WORDCOUNT_CASED, stop=["the"])
    assert dict(map(tuple, cased.collect())) == {"The": 1, "cat": 2, "CAT": 1, "dog": 1}


def test_top_words_break_ties_by_word(spark):
    df = spark.createDataFrame([("bb aa cc bb aa dd",)], ["text"])
    top = counts.top_words(counts.word_counts(df), 3).collect()
    assert list(map(tuple, top)) == [("aa", 2), ("bb", 2), ("cc", 1)]


def test_top_words_plan_keeps_only_k_rows_per_partition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    plan = counts.top_words(counts.word_counts(docs))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "partial_count" in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_top_terms_rank(spark):
    table = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "term string, df bigint")
    assert list(map(tuple, counts.top_terms(table, 2).collect())) == [(1, "c", 9), (2, "a", 2)]
    assert counts.vocabulary_size(table).first().n_terms == 3
