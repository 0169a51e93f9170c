"""Quality rules: base statistics, and a likelihood ratio against trusted documents.

Method: hashed n-gram log-likelihood ratio between the multinomials of a trusted
target and of the raw corpus, length-normalised, with deterministic
thresholding of every document. Native column expressions throughout.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import BLANKS, fenced, packed, unpacked, words_of

# Hash buckets of the multinomials: the size of the one array that reaches every task.
BUCKETS = 1 << 16
# Trusted documents that the target is fitted on, at most: those with the smallest hashed ids.
TRUSTED_SAMPLE = 50_000
# Pseudo-counts per bucket on both sides, after the raw counts are scaled to the target's total.
SMOOTHING = 5.0
# Mean log-likelihood ratio per n-gram below which a document is rejected.
THRESHOLD = -0.15
WINDOW = 5


def _bucket(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(BUCKETS)).cast("int")


def _grams(hashes: str) -> Column:
    """Buckets of the unigrams and bigrams of an array of word hashes."""
    h = F.col(hashes)
    ones = F.transform(h, _bucket)
    heads = F.slice(h, 1, F.greatest(F.size(h) - 1, F.lit(0)))
    twos = F.transform(heads, lambda x, i: _bucket(F.xxhash64(x, F.get(h, i + 1))))
    return F.concat(ones, twos)


def hashed_words(docs: DataFrame, text: str, *columns: Column) -> DataFrame:
    """``row``, ``words`` and ``hashes`` (64-bit hash of each word) of every document."""
    split = packed(docs, words_of(F.col(f"`{text}`")).alias("words"), *columns)
    return split.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_SAMPLE) -> DataFrame:
    """Ids of trusted documents (``quality`` 1), at most ``limit``: a bounded, repeatable sample."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def log_ratios(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``weights``: the log-likelihood ratio of every bucket, as an array of ``BUCKETS`` doubles.

    Both counts come from one pass over all documents. Only counts per bucket
    and task are shuffled. Without trusted documents every ratio is 0.
    """
    # The sample has at most TRUSTED_SAMPLE rows of one integer.
    trusted = F.broadcast(trusted_ids(labels).select(F.col("doc_id").alias("id"), F.lit(1).alias("target")))
    flagged = docs.select(F.col(f"`{doc}`").alias("id"), F.col(f"`{text}`").alias("body")).join(trusted, "id", "left")
    hashed = flagged.select("target", words_of(F.col("body")).alias("words"))
    hashed = hashed.select("target", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    grams = hashed.select("target", F.explode(_grams("hashes")).alias("bucket"))
    counted = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("target").alias("target"))
    every = docs.sparkSession.range(BUCKETS, numPartitions=1).select(F.col("id").cast("int").alias("bucket"))
    # BUCKETS rows from here on, whatever the size of the corpus.
    filled = every.join(counted, "bucket", "left").na.fill(0, ["raw", "target"])
    cells = filled.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("cells"),
        F.sum("raw").alias("n_raw"),
        F.sum("target").alias("n_target"),
    )

    def ratio(cell: Column) -> Column:
        expected = cell["raw"] * F.col("n_target") / F.col("n_raw")
        return F.log((cell["target"] + SMOOTHING) / (expected + SMOOTHING))

    ratios = F.transform("cells", lambda c: F.when(F.col("n_raw") > 0, ratio(c)).otherwise(0.0))
    return cells.select(ratios.alias("weights"))


def base_statistics(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``row, hashes`` and the base statistics of every document; see ``quality_rules``."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    full_lines = F.filter(F.split(body, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    rows = hashed_words(
        docs,
        text,
        (F.length(body) - F.regexp_count(body, F.lit("[ \\t-\\r]"))).cast("bigint").alias("word_chars"),
        F.regexp_count(body, F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        full_lines.alias("full_lines"),
    )
    h = F.col("hashes")
    heads = F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0)))
    windows = F.transform(heads, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))
    rows = rows.select(
        "row",
        "hashes",
        F.size("words").cast("bigint").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("full_lines") - F.size(F.array_distinct("full_lines"))).cast("bigint").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    # Equal windows stand side by side when sorted. Most texts have none and skip the sort.
    has_repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("h"), i.alias("i"))))
    rows = rows.select("*", F.when(has_repeats, placed).alias("placed")).drop("windows")

    def repeated(x: Column, k: Column) -> Column:
        before = F.get(F.col("placed"), k - 1)["h"] == x["h"]
        after = F.get(F.col("placed"), k + 1)["h"] == x["h"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    starts = F.sort_array(F.transform(F.filter("placed", repeated), lambda x: x["i"]))
    rows = rows.select("*", starts.alias("starts")).drop("placed")
    # A window covers its own words up to the start of the next repeated one.
    covered = F.transform(
        "starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), k + 1) - p, F.lit(WINDOW)))
    )
    n_repeat = F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("bigint")
    return rows.select("*", n_repeat.alias("n_repeat_words")).drop("starts")


def quality_rules(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with base statistics, ``llr`` (double), ``base_failed`` and ``kept`` (boolean).

    The statistics (all long) are those of the whole text: ``n_words``;
    ``word_chars``, code points in words; ``n_symbols``, characters of
    ``[#*$%&|<>]``; ``n_dup_lines``, lines with a word that equal an earlier
    line; ``n_repeat_words``, words in 5-word windows found twice or more in the
    text, the first included. ``base_failed`` is true under 10 words or when
    more than 20 % of the words are in repeated windows. ``llr`` is the mean
    log-likelihood ratio of the text's unigrams and bigrams between trusted and
    raw documents; ``kept`` is false if ``base_failed`` or ``llr < THRESHOLD``.

    Null and blank texts have no words and fail. Repeated rows are judged
    alike, each counted in the corpus. An empty table gives an empty table;
    without trusted documents ``llr`` is 0. Input columns with the names of the
    new ones are replaced.
    """
    # One row of BUCKETS doubles comes to the driver and goes out as one folded literal: a higher-order
    # function takes no subquery, and a join would need a row for every n-gram.
    row = log_ratios(docs.select(doc, text), labels, doc=doc, text=text).first()
    weights = F.from_json(F.lit(json.dumps([round(x, 4) for x in row["weights"]])), "array<double>")
    stats = base_statistics(docs, text=text)
    n_grams = F.greatest(2 * F.size("hashes") - 1, F.lit(1))
    total = F.aggregate(_grams("hashes"), F.lit(0.0), lambda a, b: a + F.get(weights, b))
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
    scored = stats.select("*", failed.alias("base_failed"), (total / n_grams).alias("llr")).drop("hashes")
    made = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr")}
    made |= {"base_failed": F.col("base_failed"), "kept": ~F.col("base_failed") & (F.col("llr") >= THRESHOLD)}
    judged = fenced(scored, ["row"], made)
    return judged.select(*unpacked(judged, docs.columns, {c: F.col(c) for c in made}))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The judgement of every document, without its text."""
    found = quality_rules(docs.select("doc_id", "text"), labels)
    return found.drop("text")
