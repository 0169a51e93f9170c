"""The band join over vocabularies of any length: what crosses shuffles, and rows that repeat or lack keys."""

from __future__ import annotations

import os
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from brute import window_pairs

from lexmill.functions.lookup import short_codes, word_table
from lexmill.functions.text import TokenProfile
from lexmill.operators import cooccur
from lexmill.operators.cooccur import pairs, stripes
from lexmill.sources import wordlists
from lexmill.sources.sinks import CLEANUP, stored
from pyspark.sql import functions as F

SCHEMA = "doc int, no int, line string"


def as_dict(df):
    return {(r.w, r.u): r.n for r in df.collect()}


def random_rows(seed):
    """Lines of several buckets with hot, rare and single words, and with keys that repeat or are null."""
    rnd, rows = random.Random(seed), []
    for k in range(60):
        words = [rnd.choice(["the", "of", f"w{chr(97 + rnd.randrange(26))}", f"x{chr(97 + rnd.randrange(5))}"]) for _ in range(rnd.randrange(200))]
        for _ in range(len(words) // 20):
            words.insert(rnd.randrange(len(words)), "once" + "".join(rnd.choices("bcdf", k=8)))
        rows.append((None if k % 10 == 9 else k // 3 if k % 7 == 0 else k, None if k % 11 == 10 else k % 2, " ".join(words)))
    return [*rows, *rows[:5], (100, 0, ""), (101, 0, None)]


def joined_pairs(rows, vocabulary, distance):
    """Words of a line with those after them in each line of the same key, in both orders."""
    found, by_key = Counter(), defaultdict(list)
    for doc, no, line in rows:
        if doc is not None and no is not None and line:
            by_key[doc, no].append([w if w in vocabulary else "" for w in re.split("[^a-z]+", line)])
    for group in by_key.values():
        for here in group:
            for there in group:
                for i, a in enumerate(here):
                    for b in there[i + 1 : i + 1 + distance]:
                        if a and b:
                            found[a, b] += 1
                            found[b, a] += 1
    return dict(found)


@pytest.mark.parametrize("words", [0, 3, 10_000])
@pytest.mark.parametrize("distance", [1, 3, 70])
def test_equals_a_join_in_python_whatever_is_looked_up_or_joined(spark, monkeypatch, words, distance):
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", words)
    rows = random_rows(distance)
    vocabulary = {"the", "xa", "absent", *(f"w{chr(97 + i)}" for i in range(0, 26, 2))}
    once = sorted({w for *_, line in rows for w in (line or "").split() if w.startswith("once")})
    vocabulary |= set(once[::3])
    df = spark.createDataFrame(rows, SCHEMA)
    listed = spark.createDataFrame([(w,) for w in [*vocabulary, None]], "word string")
    for preagg in ("task", "line"):
        found = pairs(df, listed, distance, strategy="band_join", preagg=preagg, key=["doc", "no"])
        assert as_dict(found) == joined_pairs(rows, vocabulary, distance)


def test_lines_of_equal_hashes_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(cooccur, "LINE_BITS", 0)
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 3)
    rows = [(k, 0, line) for k, (*_, line) in enumerate(random_rows(1))]
    vocabulary = {"the", "xa", "wb", "wc"}
    listed = spark.createDataFrame([(w,) for w in vocabulary], "word string")
    found = pairs(spark.createDataFrame(rows, SCHEMA), listed, 2, strategy="band_join", key=["doc"])
    assert as_dict(found) == window_pairs([line for *_, line in rows if line], vocabulary, 2)


def test_tokens_may_hold_what_the_coded_texts_use(spark, monkeypatch):
    """Separators, marks, escapes and codes inside tokens, which are looked up or not."""
    tokens = ["a b", "=a", "!", "%20", "%", "%25 =", "é", '"', "\\", "x"]
    profile = TokenProfile(",")
    df = spark.createDataFrame([(1, 0, ",".join(tokens)), (2, 0, ",".join(tokens[::-1]))], SCHEMA)
    for words in (0, 4, 10_000):
        monkeypatch.setattr(wordlists, "LITERAL_WORDS", words)
        found = pairs(df, tokens[:-1], 1, profile=profile, strategy="band_join", key=["doc"])
        near = [*zip(tokens[:-1], tokens[1:-1], strict=False)]
        assert as_dict(found) == {p: 2 for pair in near for p in (pair, pair[::-1])}


def test_lonely_words_are_seen_without_a_key(spark):
    df = spark.createDataFrame([(1, 0, "a b x"), (None, 0, "c d"), (None, 0, "x")], SCHEMA)
    found = stripes(df, ["a", "b", "c", "e"], 1, strategy="band_join", key=["doc"], keep_empty=True)
    assert {r.w: r.stripe for r in found.collect()} == {"a": {"b": 1}, "b": {"a": 1}, "c": {}}


def test_both_sides_are_one_shuffle_and_no_line_crosses_another(spark, monkeypatch):
    """Buckets are shuffled once, by their place; words that occur once, and few others, need no join with the text."""
    monkeypatch.setattr(wordlists, "LITERAL_WORDS", 100)
    texts = [f"the w{i} of only{i} the x{i % 7}" for i in range(400)]
    texts = [re.sub(r"\d", lambda m: chr(97 + int(m[0])), text) for text in texts]
    known = {"the", *(w for text in texts for w in text.split() if w[0] == "w")}
    df = spark.createDataFrame([(k, 0, text) for k, text in enumerate(texts)], SCHEMA)
    listed = spark.createDataFrame([(w,) for w in known], "word string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = pairs(df, listed, 2, strategy="band_join", key=["doc", "no"])
        assert as_dict(found) == window_pairs(texts, known, 2)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.partition("== Initial Plan ==")[0]
    assert len(re.findall(r"ReusedExchange \[.*words", final)) == 1
    # One of buckets, one of words by their place, one of counts.
    written = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(written) == 3 and "array_distinct" not in final


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in dirs for _, _, files in os.walk(top) for f in files if f.startswith("shuffle_")}


def test_what_a_stored_table_shuffled_is_removed(spark):
    counted = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before, setting = shuffle_files(spark), spark.conf.get(CLEANUP)
    table = stored(counted, "counted")
    for _ in range(20):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.5)
    assert not left and spark.conf.get(CLEANUP) == setting
    # Both the table and what it was computed from can still be read.
    assert table.count() == counted.count() == 10


def test_tables_of_words_as_arrays(spark):
    codes = short_codes([f"w{k}" for k in range(9000)], without=" =")
    assert len(set(codes.values())) == 9000 and {len(c) for c in codes.values()} == {1, 2, 3}
    assert not any(set(" =") & set(c) for c in codes.values()) and len(codes["w0"]) == 1
    assert short_codes([], without=" ") == {}
    code = word_table({f"w{k}": f"c{k}" for k in range(300)} | {"c1": "", 'é"': "\\"})
    df = spark.createDataFrame([(["w0", "w299", "c1", 'é"', "c2", "", None],)], "a array<string>")
    assert df.select(F.transform("a", code)).first()[0] == ["c0", "c299", "", "\\", None, None, None]
    assert df.select(F.transform("a", word_table({}))).first()[0] == [None] * 7
