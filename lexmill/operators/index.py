"""A stored forward index: the text is read once, and document frequency, term frequency, stripes and scores read the index.

An index has one row per document, ``doc, terms``, with ``terms`` an
``array<struct<term, tf>>`` of its distinct terms in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.formats import COLLECTION_SIZE
from lexmill.functions.lookup import bloom_filter, word_map
from lexmill.functions.text import TF, TokenProfile, add_runs
from lexmill.operators.counts import without_stop_words
from lexmill.operators.frequency import row_cells, scores, split_table
from lexmill.operators.stems import attach_stems
from lexmill.sources import wordlists
from lexmill.sources.sinks import stored
from lexmill.sources.wordlists import as_literals

# Share of the documents that tell which terms are frequent.
SOME_DOCUMENTS = 0.1


def forward_index(
    df: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    profile: TokenProfile = TF,
    stop: DataFrame | Sequence[str] | None = None,
    row_is_document: bool = True,
    root: str | None = None,
) -> DataFrame:
    """Tokenize the documents and store their index in the scratch folder or under ``root``.

    Rows of one document are put together unless each row is one. A long stop
    list is joined with the index, not with the text.
    """
    literals = as_literals(stop)
    rows, cells = row_cells(df, [doc], text, profile, literals or [], False)
    index = rows.select(doc, cells.alias("terms"))
    if not row_is_document:
        index = _grouped(index.select(doc, F.inline("terms")), [doc], doc)
    index = stored(index, "index", root)
    if literals is None:
        left = without_stop_words(_entries(index, doc), stop, "term")
        index = stored(_grouped(left, ["_row", doc], doc), "index", root)
    return index


def _entries(index: DataFrame, doc: str) -> DataFrame:
    """``_row, doc, term, tf``."""
    rows = index.select(F.monotonically_increasing_id().alias("_row"), doc, "terms")
    return rows.select("_row", doc, F.inline("terms"))


def _grouped(entries: DataFrame, by: Sequence[str], doc: str) -> DataFrame:
    """An index from entries, in which equal terms of a document add up."""
    lists = entries.groupBy(*by).agg(F.collect_list(F.struct("term", "tf")).alias("_cells"))
    rows, cells = add_runs(lists, F.col("_cells"), name="term", count="tf", keep=[doc])
    return rows.select(doc, cells.alias("terms"))


def index_words(index: DataFrame) -> DataFrame:
    """``term``: the distinct terms of an index."""
    return index.select(F.explode(F.transform("terms", lambda c: c["term"])).alias("term")).distinct()


def stemmed_index(index: DataFrame, stems: DataFrame, *, doc: str = "doc_id", min_stem_len: int = 1, root: str | None = None) -> DataFrame:
    """The index of the stems, from a table ``term, stem`` that may be partial; stored, so that stems are applied once.

    Stems of terms that are frequent in some documents are looked up in the row,
    at most LITERAL_WORDS of them; only entries of other terms are joined. Which
    terms these are decides on speed only.
    """
    stems = stored(stems.select("term", "stem"), "stems", root)
    some = index_document_frequency(index.sample(SOME_DOCUMENTS, seed=0))
    frequent = some.orderBy(F.desc("df"), "term").limit(wordlists.LITERAL_WORDS)
    near = attach_stems(frequent.select("term", F.col("term").alias("stem")), stems, "stem").collect()
    stem_of = word_map({row["term"]: row["stem"] for row in near})
    rows = index.select(F.monotonically_increasing_id().alias("_row"), doc, "terms")

    def with_stem(cell: Column) -> Column:
        return F.struct(stem_of(cell["term"]).alias("term"), cell["tf"].alias("tf"))

    # The index is stored, so its rows have the same numbers each time it is read. Null stems are those of other terms.
    known = F.filter(F.transform("terms", with_stem), lambda c: F.length(c["term"]) >= min_stem_len)
    others = rows.select("_row", doc, F.inline(F.filter("terms", lambda c: stem_of(c["term"]).isNull())))
    found = attach_stems(others, stems, "term").where(F.length("term") >= min_stem_len)
    one = F.array(F.struct("term", "tf"))
    cells = rows.select("_row", doc, known.alias("_part")).unionByName(found.select("_row", doc, one.alias("_part")))
    lists = cells.groupBy("_row", doc).agg(F.flatten(F.collect_list("_part")).alias("_cells"))
    # A generator drops documents without a term.
    summed, terms = add_runs(lists, F.col("_cells"), name="term", count="tf", keep=[doc])
    whole = summed.select(doc, terms.alias("terms"))
    return stored(whole.select(doc, F.explode(F.when(F.size("terms") > 0, F.array("terms"))).alias("terms")), "stemmed", root)


def index_document_frequency(index: DataFrame) -> DataFrame:
    """``term, df``; one shuffle of partial counts."""
    terms = F.transform("terms", lambda c: c["term"])
    return index.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def index_term_frequency(index: DataFrame, df_table: DataFrame | None = None, *, doc: str = "doc_id") -> DataFrame:
    """``doc, term, tf``, and ``df`` when a DF table restricts the terms: frequent ones in the row, others by one join."""
    if df_table is None:
        return index.select(doc, F.inline("terms"))
    table = df_table.where("term IS NOT NULL AND df != 0").groupBy("term").agg(F.max("df").cast("bigint").alias("df"))
    near, far = split_table(table.select(F.col("term").alias("word"), "term", "df"))
    df_of = word_map({row["term"]: row["df"] for row in near}, "bigint")
    with_df = F.transform("terms", lambda c: F.struct(c["term"].alias("term"), c["tf"].alias("tf"), df_of(c["term"]).alias("df")))
    counted = index.select(doc, F.inline(F.filter(with_df, lambda c: c["df"].isNotNull())))
    if far is not None:
        may_hold = bloom_filter(far, far.count())
        likely = F.filter("terms", lambda c: df_of(c["term"]).isNull() & may_hold(c["term"]))
        others = index.select(doc, F.inline(likely)).join(far.select("term", "df"), "term")
        counted = counted.unionByName(others.select(doc, "term", "tf", "df"))
    return counted


def index_stripes(index: DataFrame, *, doc: str = "doc_id") -> DataFrame:
    """``doc, stripe``: one ``map<term, tf>`` per document that has a term; no shuffle."""
    found = F.when(F.size("terms") > 0, F.array(F.map_from_entries("terms")))
    return index.select(doc, F.explode(found).alias("stripe"))


def index_scores(index: DataFrame, df_table: DataFrame, *, doc: str = "doc_id", n_docs: float = COLLECTION_SIZE) -> DataFrame:
    """``doc, term, score`` for the terms of the DF table."""
    return scores(index_term_frequency(index, df_table, doc=doc), doc=doc, n_docs=n_docs)
