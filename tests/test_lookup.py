from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions.lookup import bloom_filter, word_map, word_set
from lexmill.operators.membership import membership

WORDS = ["a", "b\"x", "é", "\\", "tab\t", "中", ""]


def test_words_are_found_inside_lambdas(spark):
    values = {w: f"<{w}>" for w in WORDS}
    find, numbers = word_map(values), word_map({w: 2**40 + i for i, w in enumerate(WORDS)}, "bigint")
    df = spark.createDataFrame([(WORDS + ["other", None],)], "ws array<string>")
    found = df.select(F.transform("ws", find).alias("x"), F.transform("ws", numbers).alias("n"), F.filter("ws", word_set(WORDS)).alias("s"))
    assert "from_json" not in found._jdf.queryExecution().optimizedPlan().toString()
    row = found.first()
    assert row.x == [*values.values(), None, None] and row.s == WORDS
    assert row.n == [*range(2**40, 2**40 + len(WORDS)), None, None]
    assert df.select(F.filter("ws", word_set([])).alias("x")).first().x == []


def test_filters_hold_all_words_and_few_others(spark):
    words = spark.range(3000).selectExpr("'w' || id AS word")
    may_hold = bloom_filter(words, 3000)
    assert words.where(may_hold(F.col("word"))).count() == 3000
    assert spark.range(10_000).selectExpr("'x' || id AS word").where(may_hold(F.col("word"))).count() < 200
    assert words.where(bloom_filter(words.where("false"), 0)(F.col("word"))).count() == 0


def test_membership_is_exact_for_the_corpus(spark):
    corpus = spark.range(20_000).selectExpr("'w' || id AS word")
    members = spark.range(5_000).selectExpr("'w' || id * 3 AS word").unionByName(spark.sql("SELECT null AS word"))
    wanted = membership(corpus, members, limit=1_000)
    assert {r.word for r in corpus.where(wanted(F.col("word"))).collect()} == {f"w{i}" for i in range(0, 15_000, 3)}
    assert membership(corpus, members, limit=0) is None
    few = membership(corpus, ["w1", "nowhere", None], limit=10)
    assert [r.word for r in corpus.where(few(F.col("word"))).collect()] == ["w1"]
