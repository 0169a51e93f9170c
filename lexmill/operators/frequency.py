"""Document frequency, term frequency and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lexmill.functions.formats import COLLECTION_SIZE, tf_idf
from lexmill.functions.lookup import bloom_filter, word_map
from lexmill.functions.porter import porter_array
from lexmill.functions.text import (
    DF,
    TF,
    TokenProfile,
    add_runs,
    explode_tokens,
    raw_tokens,
    run_counts,
    token_array,
    token_ok,
)
from lexmill.operators.counts import without_stop_words
from lexmill.operators.stems import attach_stems, frequent_stems, stems_of
from lexmill.sources import wordlists
from lexmill.sources.sinks import stored
from lexmill.sources.wordlists import as_literals, small_rows


def document_frequency(
    df: DataFrame,
    *,
    text: str = "text",
    doc: str | None = None,
    profile: TokenProfile = DF,
    stop: DataFrame | Sequence[str] | None = None,
    stem: bool = False,
    stems: DataFrame | None = None,
) -> DataFrame:
    """``term, df``: the number of documents that hold a term.

    Without ``doc`` every row is one document (pass lines to count lines): terms
    are made distinct inside the row and only the counts are shuffled. With
    ``doc`` the rows that share it are one document, and distinct (document,
    term) keys are shuffled first. ``stem=True`` stems inside the row;
    ``stems`` joins a table from ``stem_vocabulary`` instead; that stems each
    word once, but has to shuffle (document, term) keys.
    """
    literals = as_literals(stop)
    if literals is None and not stem and stems is None:
        # Counts by term are far fewer than terms: the long list is joined with those.
        return without_stop_words(_counted(_row_terms(df, text, doc, profile, [], False), doc), stop, "term")
    if literals is not None and stems is None:
        return _counted(_row_terms(df, text, doc, profile, literals, stem), doc)
    if doc is None:
        df, doc = df.withColumn("_row", F.monotonically_increasing_id()), "_row"
    # The terms of a row are distinct before they are joined.
    terms = _row_terms(df, text, doc, profile, literals or [], False)
    if literals is None:
        terms = without_stop_words(terms, stop, "term")
    if stems is not None:
        terms = attach_stems(terms, stems, "term")
        if profile.min_stem_len > 1:
            terms = terms.where(F.length("term") >= profile.min_stem_len)
    else:
        words = terms.select(doc, F.array("term").alias("_words"))
        terms = words.select(doc, stems_of("_words", profile.min_stem_len).alias("term"))
    return _counted(terms, doc)


def _counted(terms: DataFrame, doc: str | None) -> DataFrame:
    """``term, df`` from one row per term of a document, or from terms of rows that ``doc`` puts together."""
    return (terms.distinct() if doc else terms).groupBy("term").agg(F.count("*").alias("df"))


def _row_terms(
    df: DataFrame, text: str, doc: str | None, profile: TokenProfile, stop: Sequence[str], stem: bool
) -> DataFrame:
    """``doc, term`` with the terms of each row once."""
    keep = [doc] if doc else []
    terms = token_array(F.col(text), profile, stop, distinct=True)
    if not stem:
        return df.select(*keep, F.explode(terms).alias("term"))
    stem_of = frequent_stems(df, text, profile)
    rows = df.select(*keep, terms.alias("_terms"))
    # Looked up once; words without a stem there are known by their places.
    rows = rows.select(*keep, "_terms", F.transform("_terms", stem_of).alias("_stems"))
    words = F.filter("_terms", lambda w, i: F.get("_stems", i).isNull())
    rows = rows.select(*keep, "_stems", words.alias("_words"))
    known = F.filter("_stems", lambda s: s.isNotNull())
    stemmed = F.filter(F.concat(known, porter_array("_words")), lambda s: F.length(s) >= profile.min_stem_len)
    return rows.select(*keep, F.explode(F.array_distinct(stemmed)).alias("term"))


def term_frequency(
    df: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    profile: TokenProfile = TF,
    stop: DataFrame | Sequence[str] | None = None,
    stem: bool = False,
    stems: DataFrame | None = None,
    row_is_document: bool = False,
    df_table: DataFrame | None = None,
) -> DataFrame:
    """``doc, term, tf``, and ``df`` when a DF table restricts the terms.

    Counts are made inside each row. With ``row_is_document`` they are those of
    the row; otherwise the rows of one document are summed up. ``stem=True``
    stems the distinct terms of a row inside it; ``stems`` joins a table from
    ``stem_vocabulary`` instead. How long the stop list is decides only whether
    it is looked up in the row or joined.

    A DF table, with one row per term, turns this around: the words that count
    for its terms are found first, stemmed once each, and looked up in the row.
    """
    if df_table is not None:
        near, far = split_table(_table_words(df, text, profile, stop, stem, stems, df_table))
        return _table_frequency(df, doc, text, profile, near, far, row_is_document)
    literals = as_literals(stop)
    inline = stem and stems is None and literals is not None
    keep = [doc]
    if row_is_document and (literals is None or stems is not None):
        # Counts of a row are joined and grouped again below, by row.
        df, keep = df.withColumn("_row", F.monotonically_increasing_id()), ["_row", doc]
    rows, cells = row_cells(df, keep, text, profile, literals or [], inline)
    counted = rows.select(*keep, F.inline(cells))
    if literals is None:
        counted = without_stop_words(counted, stop, "term")
    if stems is not None:
        counted = attach_stems(counted, stems, "term")
    elif stem and not inline:
        words = counted.select(*keep, "tf", F.array("term").alias("_words"))
        counted = words.select(*keep, stems_of("_words").alias("term"), "tf")
    counted = counted.where(F.length("term") >= profile.min_stem_len)
    if not row_is_document or len(keep) > 1:
        counted = counted.groupBy(*keep, "term").agg(F.sum("tf").alias("tf"))
    return counted.select(doc, "term", "tf")


def _table_words(
    df: DataFrame,
    text: str,
    profile: TokenProfile,
    stop: DataFrame | Sequence[str] | None,
    stem: bool,
    stems: DataFrame | None,
    df_table: DataFrame,
) -> DataFrame:
    """``word, term, df``: the words that count for a term of a DF table, without stop words.

    With stems, one pass reduces the corpus to its vocabulary, each word of it
    is stemmed once, and those whose stem is in the table stay. Stop words go
    from this list, never from tokens.
    """
    table = df_table.where("term IS NOT NULL AND df != 0").groupBy("term")
    table = table.agg(F.max("df").cast("bigint").alias("df")).where(F.length("term") >= profile.min_stem_len)
    if stem or stems is not None:
        words = explode_tokens(df, profile, text=text, out="word").distinct()
        if stems is not None:
            known = attach_stems(words.select("word", F.col("word").alias("term")), stems, "term")
        else:
            known = words.select("word", F.array("word").alias("_words")).select("word", stems_of("_words").alias("term"))
        found = known.join(table, "term")
    else:
        found = table.withColumn("word", F.col("term")).where(token_ok(F.col("word"), profile))
    literals = as_literals(stop)
    if literals is None:
        found = without_stop_words(found, stop, "word")
    elif literals:
        found = found.where(~F.col("word").isin(*literals))
    return found.select("word", "term", "df")


def split_table(words: DataFrame, limit: int | None = None) -> tuple[list[Row], DataFrame | None]:
    """The words of the most frequent terms, at most ``limit``, and a stored table of all others if there are any.

    All words of one term fall on the same side.
    """
    limit = wordlists.LITERAL_WORDS if limit is None else limit
    # Stored before its length is known: to find that out is to compute it, and a long one is read again.
    words = stored(words, "words")
    rows = small_rows(words, limit)
    if rows is not None:
        return rows, None
    rows = words.orderBy(F.desc("df"), "term", "word").limit(limit + 1).collect()
    last = rows[-1]
    far = words.where((F.col("df") < last["df"]) | ((F.col("df") == last["df"]) & (F.col("term") >= last["term"])))
    return [row for row in rows if row["term"] != last["term"]], far


def _table_cells(
    df: DataFrame, keep: Sequence[str], text: str, profile: TokenProfile, near: Sequence[Row]
) -> tuple[DataFrame, Column]:
    """Rows, and the array expression over them with ``term, tf, df`` of the terms whose words are ``near``."""
    term_of = word_map({row["word"]: row["term"] for row in near})
    df_of = word_map({row["term"]: row["df"] for row in near}, "bigint")
    terms = F.filter(F.transform(raw_tokens(F.col(text), profile), term_of), lambda t: t.isNotNull())
    rows, cells = run_counts(df, terms, name="term", count="tf", keep=keep)
    return rows, F.transform(cells, lambda c: F.struct(c["term"].alias("term"), c["tf"].alias("tf"), df_of(c["term"]).alias("df")))


def _table_frequency(
    df: DataFrame,
    doc: str,
    text: str,
    profile: TokenProfile,
    near: Sequence[Row],
    far: DataFrame | None,
    row_is_document: bool,
) -> DataFrame:
    """``doc, term, tf, df``: frequent terms from inside the row, the others by one join of the words a filter lets through.

    No term of the join is frequent, so none of its keys is hot.
    """
    keep, stemmed = [doc], any(row["word"] != row["term"] for row in near)
    rows, cells = _table_cells(df, keep, text, profile, near)
    counted = rows.select(*keep, F.inline(cells))
    if far is not None:
        stemmed = stemmed or not far.where("word != term").isEmpty()
        again, by = df, keep
        if row_is_document and stemmed:
            again, by = df.withColumn("_row", F.monotonically_increasing_id()), ["_row", doc]
        near_term = word_map({row["word"]: 1 for row in near}, "int")
        other = F.filter(raw_tokens(F.col(text), profile), lambda w: near_term(w).isNull() & token_ok(w, profile))
        rows, cells = run_counts(again, other, name="word", count="tf", keep=by)
        may_hold = bloom_filter(far, far.count())
        # The filter is in the generator: outside it would be pushed below, and the array be computed twice.
        likely = rows.select(*by, F.inline(F.filter(cells, lambda c: may_hold(c["word"]))))
        joined = likely.join(far, "word").select(*by, "term", "tf", "df")
        if row_is_document and stemmed:
            joined = joined.groupBy(*by, "term", "df").agg(F.sum("tf").alias("tf"))
        counted = counted.unionByName(joined.select(doc, "term", "tf", "df"))
    if not row_is_document:
        counted = counted.groupBy(doc, "term", "df").agg(F.sum("tf").alias("tf"))
    return counted.select(doc, "term", "tf", "df")


def row_cells(
    df: DataFrame, keep: Sequence[str], text: str, profile: TokenProfile, stop: Sequence[str], stem: bool
) -> tuple[DataFrame, Column]:
    """Rows, and the array expression over them that holds each row's distinct terms as ``term, tf``."""

    def long_enough(term: Column) -> Column:
        return F.length(term) >= profile.min_stem_len

    tokens = token_array(F.col(text), profile, stop)
    if not stem:
        rows = df.select(*keep, tokens.alias("_terms"))
        return run_counts(rows, F.filter("_terms", long_enough), name="term", count="tf", keep=keep)
    rows, cells = run_counts(df, tokens, name="term", count="tf", keep=keep)
    stem_of = frequent_stems(df, text, profile)
    rows = rows.select(*keep, cells.alias("_all"))
    rows = rows.select(
        *keep,
        F.transform("_all", lambda c: F.struct(stem_of(c["term"]).alias("term"), c["tf"].alias("tf"))).alias("_known"),
        F.filter("_all", lambda c: stem_of(c["term"]).isNull()).alias("_cells"),
    )
    rows = rows.select(*keep, "_known", "_cells", F.transform("_cells", lambda c: c["term"]).alias("_words"))
    # Each distinct word of the row is stemmed once; words of one stem add up.
    others = F.zip_with(porter_array("_words"), "_cells", lambda s, c: F.struct(s.alias("term"), c["tf"].alias("tf")))
    stemmed = F.concat(F.filter("_known", lambda c: c["term"].isNotNull()), others)
    return add_runs(rows, F.filter(stemmed, lambda c: long_enough(c["term"])), name="term", count="tf", keep=keep)


def merge_counts(counted: DataFrame, doc: str = "doc_id") -> DataFrame:
    """``doc, term, tf``: counts of one document that come from several rows, parts or runs, added up.

    A ``df`` column is left behind: join one DF table after the merge.
    """
    return counted.groupBy(doc, "term").agg(F.sum("tf").alias("tf"))


def tf_stripes(tf: DataFrame, doc: str = "doc_id", *, parts: int = 1) -> DataFrame:
    """``doc, stripe``: one ``map<term, tf>`` per document that has a term.

    The map is as long as the document has distinct terms in ``tf``; restrict
    them with a DF table first. Where that is not enough, ``parts`` splits a
    document's map over so many rows, numbered by ``part``.
    """
    cells = F.sort_array(F.collect_list(F.struct("term", "tf")))
    key = [F.col(doc)] if parts == 1 else [F.col(doc), F.pmod(F.xxhash64("term"), F.lit(parts)).cast("int").alias("part")]
    return tf.groupBy(*key).agg(F.map_from_entries(cells).alias("stripe"))


def row_stripes(
    df: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    profile: TokenProfile = TF,
    stop: DataFrame | Sequence[str] | None = None,
    stem: bool = False,
    df_table: DataFrame | None = None,
) -> DataFrame:
    """``doc, stripe`` for one row per document: one map per row that has a term.

    With a short stop list and DF table the map is built inside the row and
    nothing is shuffled; longer ones are joined, and the row is put together again.
    """
    far, literals = None, [] if df_table is not None else as_literals(stop)
    if df_table is not None:
        near, far = split_table(_table_words(df, text, profile, stop, stem, None, df_table))
    if literals is None or far is not None:
        rows = df.select(F.struct(F.monotonically_increasing_id().alias("row"), F.col(doc).alias("id")).alias("_key"), text)
        if far is not None:
            tf = _table_frequency(rows, "_key", text, profile, near, far, False)
        else:
            tf = term_frequency(rows, doc="_key", text=text, profile=profile, stop=stop, stem=stem)
        return tf_stripes(tf, "_key").select(F.col("_key.id").alias(doc), "stripe")
    if df_table is not None:
        rows, cells = _table_cells(df, [doc], text, profile, near)
        cells = F.transform(cells, lambda c: F.struct(c["term"].alias("term"), c["tf"].alias("tf")))
    else:
        rows, cells = row_cells(df, [doc], text, profile, literals, stem)
    filled = rows.select(doc, cells.alias("_cells"))
    # A generator drops the empty rows, because a filter would be pushed down and compute the array twice.
    found = F.when(F.size("_cells") > 0, F.array(F.map_from_entries("_cells")))
    return filled.select(doc, F.explode(found).alias("stripe"))


def scores(tf: DataFrame, df_table: DataFrame | None = None, *, doc: str = "doc_id", n_docs: float = COLLECTION_SIZE) -> DataFrame:
    """``doc, term, score`` from term frequencies that carry ``df`` or are joined with a DF table."""
    if df_table is not None:
        tf = tf.join(df_table.select("term", "df").where("df != 0"), "term")
    return tf.select(doc, "term", tf_idf(F.col("tf"), F.col("df"), n_docs).alias("score"))
