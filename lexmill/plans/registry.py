"""The checked queries: each takes ``(spark, sf_dir)`` and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as T
from lexmill.functions.formats import (
    pair_key,
    score_text,
    stripe_text,
    tf_stripe_entries,
    tf_stripe_text,
)
from lexmill.operators import counts, frequency
from lexmill.operators import index as I
from lexmill.operators.cooccur import merge_pairs, merge_stripes
from lexmill.operators.stems import stem_vocabulary, stem_words, update_stems
from lexmill.plans import pipelines as P
from lexmill.plans.defaults import STOP_WORDS
from lexmill.sources.corpus import lines_of, read_documents, read_lines, read_numbered_lines, read_table
from lexmill.sources.sinks import read_runs, scratch_path, stored, write_run, write_sorted_tsv, write_top_tsv, write_tsv
from lexmill.sources.wordlists import as_local_df_table, read_counts, read_df_table, read_stop_words, read_vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", ["doc_id", "text"])


def texts(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/documents.parquet", ["text"])


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/conversations.parquet", ["conv_id", "text"])


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, f"{sf}/pages.parquet", ["page_id", "html"])


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(texts(spark, sf))


def numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(documents(spark, sf), keep=["doc_id"], numbered=True)


def vocabulary(spark: SparkSession, sf: str) -> list[str]:
    """The 50 most frequent words: the list that feeds the co-occurrence jobs."""
    return [row.word for row in P.most_frequent_words(texts(spark, sf), stop=STOP_WORDS).collect()]


def mixed_vocabulary(spark: SparkSession, sf: str) -> list[str]:
    """20 frequent and 200 of the rarest words, so that some never meet a neighbour."""
    counted = counts.word_counts(texts(spark, sf)).select("word", "n")
    frequent = counted.orderBy(F.desc("n"), "word").limit(20)
    rare = counted.orderBy("n", "word").limit(200)
    return [row.word for row in frequent.unionByName(rare).select("word").collect()]


# Word counts


def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return P.most_frequent_words(texts(spark, sf), stop=STOP_WORDS)


def top_words_case_sensitive(spark: SparkSession, sf: str) -> DataFrame:
    return P.most_frequent_words(texts(spark, sf), stop=STOP_WORDS, case_sensitive=True)


def top_words_pages(spark: SparkSession, sf: str) -> DataFrame:
    return P.most_frequent_words(pages(spark, sf), text="html", stop=STOP_WORDS)


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return counts.word_counts(texts(spark, sf), stop=STOP_WORDS)


def word_counts_all(spark: SparkSession, sf: str) -> DataFrame:
    return counts.word_counts(texts(spark, sf))


def word_counts_merged(spark: SparkSession, sf: str) -> DataFrame:
    corpora = [
        texts(spark, sf),
        conversations(spark, sf).select("text"),
        pages(spark, sf).select(F.col("html").alias("text")),
        read_table(spark, f"{sf}/benchmark.parquet", ["text"]),
    ]
    return P.merged_word_counts([counts.word_counts(c, stop=STOP_WORDS) for c in corpora])


def _token_stats(profile: T.TokenProfile) -> Query:
    return lambda spark, sf: counts.token_stats(documents(spark, sf), profile, key="doc_id")


# Co-occurrence


def _pairs(distance: int, **options: object) -> Query:
    return lambda spark, sf: P.pair_cooccurrence(lines(spark, sf), vocabulary(spark, sf), distance, **options)


def cooc_pairs_band_d2(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_cooccurrence(
        numbered_lines(spark, sf), vocabulary(spark, sf), 2, strategy="band_join", key=["doc_id", "line_no"]
    )


def cooc_pairs_pages_d2(spark: SparkSession, sf: str) -> DataFrame:
    html = pages(spark, sf)
    words = [row.word for row in P.most_frequent_words(html, text="html", stop=STOP_WORDS).collect()]
    return P.pair_cooccurrence(lines_of(html, text="html"), words, 2)


def _frequent(spark: SparkSession, sf: str) -> DataFrame:
    """Every word that occurs twice or more: a vocabulary that stays a DataFrame."""
    return counts.word_counts(texts(spark, sf)).where("n > 1").select("word")


def cooc_pairs_large_vocabulary_d1(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_cooccurrence(lines(spark, sf), _frequent(spark, sf), 1, strategy="marked")


def cooc_pairs_large_vocabulary_d4(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_cooccurrence(lines(spark, sf), _frequent(spark, sf), 4)


def cooc_pairs_large_vocabulary_band_d1(spark: SparkSession, sf: str) -> DataFrame:
    return P.pair_cooccurrence(
        numbered_lines(spark, sf), _frequent(spark, sf), 1, strategy="band_join", key=["doc_id", "line_no"]
    )


def _stripes(distance: int, **options: object) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        found = P.stripe_cooccurrence(lines(spark, sf), vocabulary(spark, sf), distance, **options)
        return found.select("w", stripe_text(F.col("stripe")).alias("stripe"))

    return run


def cooc_stripes_keep_empty_d1(spark: SparkSession, sf: str) -> DataFrame:
    found = P.stripe_cooccurrence(lines(spark, sf), mixed_vocabulary(spark, sf), 1, keep_empty=True)
    return found.select("w", stripe_text(F.col("stripe")).alias("stripe"))


def cooc_stripes_in_parts_d1(spark: SparkSession, sf: str) -> DataFrame:
    """Stripes split over three rows per word, put together again."""
    found = P.stripe_cooccurrence(lines(spark, sf), vocabulary(spark, sf), 1, parts=3)
    whole = merge_stripes([found.where(f"part = {k}").select("w", "stripe") for k in range(3)])
    return whole.select("w", stripe_text(F.col("stripe")).alias("stripe"))


def _corpora(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Documents, conversations and pages as lines."""
    return [
        lines(spark, sf),
        lines_of(conversations(spark, sf)),
        lines_of(pages(spark, sf), text="html"),
    ]


def cooc_pairs_merged_d2(spark: SparkSession, sf: str) -> DataFrame:
    words = vocabulary(spark, sf)
    return merge_pairs([P.pair_cooccurrence(part, words, 2) for part in _corpora(spark, sf)])


def cooc_stripes_merged_d2(spark: SparkSession, sf: str) -> DataFrame:
    words = vocabulary(spark, sf)
    found = merge_stripes([P.stripe_cooccurrence(part, words, 2) for part in _corpora(spark, sf)])
    return found.select("w", stripe_text(F.col("stripe")).alias("stripe"))


# Document frequency


def doc_freq_line(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.document_frequency(lines(spark, sf), text="line", stop=STOP_WORDS)


def doc_freq_doc(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.document_frequency(texts(spark, sf), stop=STOP_WORDS)


def doc_freq_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """A conversation is one document made of several rows."""
    return frequency.document_frequency(conversations(spark, sf), doc="conv_id", stop=STOP_WORDS)


def doc_freq_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.document_frequency(lines(spark, sf), text="line", stop=STOP_WORDS, stem=True)


def doc_freq_doc_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.document_frequency(texts(spark, sf), stop=STOP_WORDS, stem=True)


def doc_freq_vocab_stems(spark: SparkSession, sf: str) -> DataFrame:
    """As ``doc_freq_doc_stemmed``, from an index: the text is read once, and each distinct token stemmed once."""
    index = I.forward_index(documents(spark, sf), profile=T.DF, stop=STOP_WORDS)
    return I.index_document_frequency(I.stemmed_index(index, stem_words(I.index_words(index))))


def vocab_stems(spark: SparkSession, sf: str) -> DataFrame:
    return stem_vocabulary(texts(spark, sf))


def vocab_stems_grown(spark: SparkSession, sf: str) -> DataFrame:
    """A stem dictionary of conversations, grown by the new words of documents."""
    path = scratch_path(spark, "stems")
    for corpus in (conversations(spark, sf), texts(spark, sf)):
        found = update_stems(T.explode_tokens(corpus, T.DF, out="term"), path)
    return found


def vocab_stems_alnum(spark: SparkSession, sf: str) -> DataFrame:
    return stem_vocabulary(texts(spark, sf), profile=T.TF)


def df_top100(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_document_frequency(lines(spark, sf), text="line", stop=STOP_WORDS, stem=False)


def df_top100_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    return P.top_document_frequency(lines(spark, sf), text="line", stop=STOP_WORDS)


def df_vocab_size(spark: SparkSession, sf: str) -> DataFrame:
    return counts.vocabulary_size(doc_freq_line(spark, sf))


# Term frequency and scores


def term_freq(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.term_frequency(documents(spark, sf), stop=STOP_WORDS, row_is_document=True)


def term_freq_by_line(spark: SparkSession, sf: str) -> DataFrame:
    """The same counts from one row per line, summed up by document."""
    by_line = lines_of(documents(spark, sf), keep=["doc_id"])
    return frequency.term_frequency(by_line, text="line", stop=STOP_WORDS)


def term_freq_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.term_frequency(conversations(spark, sf), doc="conv_id", stop=STOP_WORDS, stem=True)


def tf_stripes(spark: SparkSession, sf: str) -> DataFrame:
    found = frequency.row_stripes(documents(spark, sf), stop=STOP_WORDS, df_table=df_top100(spark, sf))
    return found.select("doc_id", tf_stripe_text(F.col("stripe")).alias("stripe"))


def tf_stripes_by_line(spark: SparkSession, sf: str) -> DataFrame:
    """The same stripes from one row per line, merged by document."""
    by_line = lines_of(documents(spark, sf), keep=["doc_id"])
    tf = frequency.term_frequency(by_line, text="line", stop=STOP_WORDS, df_table=df_top100(spark, sf))
    return frequency.tf_stripes(tf).select("doc_id", tf_stripe_text(F.col("stripe")).alias("stripe"))


def tf_stripe_decode(spark: SparkSession, sf: str) -> DataFrame:
    entries = tf_stripe_entries(F.col("stripe"))
    return tf_stripes(spark, sf).select("doc_id", F.inline(entries))


def tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return P.tf_idf_scores(
        documents(spark, sf), df_top100(spark, sf), stop=STOP_WORDS, stem=False, row_is_document=True
    )


def tfidf_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    return P.tf_idf_scores(documents(spark, sf), df_top100_stemmed(spark, sf), stop=STOP_WORDS, row_is_document=True)


def tfidf_long_df_table(spark: SparkSession, sf: str) -> DataFrame:
    """Scores for every term of the whole DF table."""
    return P.tf_idf_scores(
        documents(spark, sf), doc_freq_line(spark, sf), stop=STOP_WORDS, stem=False, row_is_document=True
    )


def tfidf_long_df_table_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    return P.tf_idf_scores(documents(spark, sf), doc_freq_stemmed(spark, sf), stop=STOP_WORDS, row_is_document=True)


def _index(spark: SparkSession, sf: str, stem: bool = False) -> DataFrame:
    index = I.forward_index(documents(spark, sf), stop=STOP_WORDS)
    return I.stemmed_index(index, stem_words(I.index_words(index)), min_stem_len=T.TF.min_stem_len) if stem else index


def _index_tfidf(stem: bool) -> Query:
    """The chained run from one pass over the text: an index, its top terms, and scores."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        index = _index(spark, sf, stem)
        return I.index_scores(index, counts.top_terms(I.index_document_frequency(index)))

    return run


def index_tfidf_all_terms(spark: SparkSession, sf: str) -> DataFrame:
    index = _index(spark, sf)
    return I.index_scores(index, I.index_document_frequency(index))


def index_tf_stripes(spark: SparkSession, sf: str) -> DataFrame:
    found = I.index_stripes(_index(spark, sf))
    return found.select("doc_id", tf_stripe_text(F.col("stripe")).alias("stripe"))


def tfidf_doc_unit(spark: SparkSession, sf: str) -> DataFrame:
    top = P.top_document_frequency(texts(spark, sf), stop=STOP_WORDS, stem=False)
    return P.tf_idf_scores(documents(spark, sf), top, stop=STOP_WORDS, stem=False, row_is_document=True)


def tfidf_conversations(spark: SparkSession, sf: str) -> DataFrame:
    talk = conversations(spark, sf)
    top = P.top_document_frequency(talk, doc="conv_id", stop=STOP_WORDS)
    return P.tf_idf_scores(talk, top, doc="conv_id", stop=STOP_WORDS)


def tfidf_merged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Even and odd lines of the documents counted in two runs, merged by id, then scored with one DF table."""
    top, _ = as_local_df_table(df_top100(spark, sf))
    by_line = numbered_lines(spark, sf)
    runs = [
        frequency.term_frequency(by_line.where(f"line_no % 2 = {k}"), text="line", stop=STOP_WORDS, df_table=top)
        for k in (0, 1)
    ]
    return frequency.scores(frequency.merge_counts(P.merged([run.drop("df") for run in runs])), top)


def _long_stop_list(spark: SparkSession, sf: str) -> DataFrame:
    """All words of pages: more than are looked up as literals."""
    return counts.word_counts(pages(spark, sf), text="html").select("word")


def term_freq_long_stop_list(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.term_frequency(documents(spark, sf), stop=_long_stop_list(spark, sf), row_is_document=True)


def doc_freq_long_stop_list(spark: SparkSession, sf: str) -> DataFrame:
    return frequency.document_frequency(texts(spark, sf), stop=_long_stop_list(spark, sf))


def tfidf_small_collection(spark: SparkSession, sf: str) -> DataFrame:
    """Scores with the true size of the collection in place of the constant."""
    docs = documents(spark, sf)
    return P.tf_idf_scores(
        docs, df_top100(spark, sf), stop=STOP_WORDS, stem=False, row_is_document=True, n_docs=docs.count()
    )


def tfidf_text(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf(spark, sf).select("doc_id", "term", score_text(F.col("score")).alias("score"))


# Files: what the corpus gives is written to fresh scratch folders and read back


def src_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    lines(spark, sf).select(F.col("line").alias("value")).write.text(path)
    return read_lines(spark, path).groupBy("line").agg(F.count("*").alias("n"))


def src_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written to files by language, read as documents: totals over the files of a language."""
    path = scratch_path(spark, "docs")
    corpus = read_table(spark, f"{sf}/documents.parquet", ["lang", "text"])
    by_lang = lines_of(corpus, keep=["lang"]).select("lang", F.col("line").alias("value"))
    by_lang.write.partitionBy("lang").text(path)
    lang = F.regexp_extract("doc_id", "lang=([^/]*)/", 1)
    files = read_documents(spark, path, full_path=True)
    per_file = files.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("line")).alias("c"))
    return per_file.groupBy(lang.alias("lang")).agg(F.sum("n").alias("n_lines"), F.sum("c").alias("n_chars"))


def stop_words_read(spark: SparkSession, sf: str) -> DataFrame:
    """Every word of the corpus, written in capitals and padded, comes back as it was; blank lines do not."""
    path = scratch_path(spark, "stop")
    messy = F.array(F.concat(F.lit("\t "), F.upper("word"), F.lit("  ")), F.lit("  "), F.col("word"))
    counts.word_counts(texts(spark, sf)).select(F.explode(messy).alias("value")).write.text(path)
    return read_stop_words(spark, path)


def vocab_from_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "vocabulary")
    messy = F.array(F.concat(F.lit(" "), F.initcap("word"), F.lit("\t")), F.lit(""))
    counts.word_counts(texts(spark, sf)).select(F.explode(messy).alias("value")).write.text(path)
    return read_vocabulary(spark, path, fmt="line")


def vocab_from_tsv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "vocabulary")
    write_tsv(counts.word_counts(texts(spark, sf), profile=T.WORDCOUNT_CASED), path, "word", "n")
    return read_vocabulary(spark, path, fmt="first_field")


def _messy_df_file(spark: SparkSession, sf: str) -> str:
    """The DF table as a file in which each good line stands among malformed and outdated ones."""
    path = scratch_path(spark, "df")
    term, df = F.col("term"), F.col("df").cast("string")
    tab = F.lit("\t")
    messy = F.array(
        F.concat(term, tab, (F.col("df") + 1).cast("string")),
        term,
        F.concat(term, tab, df, tab, df),
        F.concat(term, tab, F.lit("x")),
        F.concat(term, tab, df, F.lit(".0")),
        F.concat(term, tab, F.lit("99999999999999999999")),
        F.concat(term, F.lit("+"), tab, (F.col("df") + 3_000_000_000).cast("string")),
        F.lit(" "),
        F.concat(F.lit("  "), term, F.lit(" "), tab, F.lit(" +"), df, F.lit(" ")),
    )
    doc_freq_line(spark, sf).select(F.explode(messy).alias("value")).write.text(path)
    return path


def df_table_read(spark: SparkSession, sf: str) -> DataFrame:
    return read_df_table(spark, _messy_df_file(spark, sf))


def count_table_read(spark: SparkSession, sf: str) -> DataFrame:
    return read_counts(spark, _messy_df_file(spark, sf))


def top100_from_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Document frequencies written to files, read back, and ranked."""
    path = scratch_path(spark, "counts")
    write_tsv(doc_freq_line(spark, sf), path, "term", "df")
    return P.top_terms_from_counts(spark, path)


#: Bytes of text, about, in one of the files that documents are written to.
FILE_BYTES = 64 << 20


def _document_files(spark: SparkSession, sf: str) -> str:
    """Documents as text files of bounded size, folders by source and language, as many in each as its bytes ask for."""
    path = scratch_path(spark, "corpus")
    corpus = read_table(spark, f"{sf}/documents.parquet", ["doc_id", "source", "lang", "text"])
    folder = ["source", "lang"]
    n_files = F.ceil(F.sum(F.octet_length("text")) / F.lit(FILE_BYTES)).alias("n_files")
    counted = corpus.groupBy(*[F.col(c).alias(f"of_{c}") for c in folder]).agg(n_files)
    # Only folders of several files. Stored, so that Spark knows their size and broadcasts them if they are few.
    several = stored(counted.where("n_files > 1"), "folders")
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in folder]
    piece = F.pmod(F.xxhash64("doc_id", "text"), F.coalesce("n_files", F.lit(1))).alias("piece")
    dealt = corpus.join(several, same, "left").select(*folder, "text", piece)
    by_file = lines_of(dealt, keep=[*folder, "piece"]).select(*folder, "piece", F.col("line").alias("value"))
    # One file for each piece.
    by_file.repartition(*folder, "piece").write.partitionBy(*folder, "piece").text(path)
    return path


def src_docs_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Files read as documents by base name: all lines are there, and no name has a folder in it."""
    files = read_documents(spark, _document_files(spark, sf))
    plain = F.col("doc_id").rlike("^[^/=]+$")
    return files.where(plain).agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"))


def src_docs_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Whole files as documents: lines and characters by source and language."""
    files = read_documents(spark, _document_files(spark, sf), full_path=True, whole=True)
    folder = [F.regexp_extract("doc_id", f"{c}=([^/]*)/", 1).alias(c) for c in ("source", "lang")]
    n_lines = F.size(F.split("text", "\n")) - 1
    return files.groupBy(*folder).agg(
        F.sum(n_lines).cast("bigint").alias("n_lines"), F.sum(F.length("text") - n_lines).alias("n_chars")
    )


def tfidf_of_files(spark: SparkSession, sf: str) -> DataFrame:
    """TF-IDF whose documents are files, by source and language."""
    files = read_documents(spark, _document_files(spark, sf), full_path=True)
    folder = F.regexp_extract("doc_id", "(source=[^/]*/lang=[^/]*)/", 1)
    docs = files.select(folder.alias("doc_id"), "line")
    return P.tf_idf_scores(docs, df_top100(spark, sf), text="line", stop=STOP_WORDS, stem=False)


def _line_files(spark: SparkSession, sf: str) -> str:
    """All lines, in the order of documents and places, in four files or as many as their bytes ask for."""
    path = scratch_path(spark, "ordered")
    n_bytes = texts(spark, sf).agg(F.sum(F.octet_length("text")).cast("bigint")).first()[0] or 0
    files = max(4, -(-n_bytes // FILE_BYTES))
    write_sorted_tsv(numbered_lines(spark, sf), path, "line", key=["doc_id", "line_no"], files=files)
    return path


def src_numbered_lines(spark: SparkSession, sf: str) -> DataFrame:
    return read_numbered_lines(spark, _line_files(spark, sf), across=True).select("line_no", "line")


def cooc_pairs_of_files_d2(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs by the band join, with lines of files known by file and number."""
    numbered = read_numbered_lines(spark, _line_files(spark, sf))
    return P.pair_cooccurrence(numbered, vocabulary(spark, sf), 2, strategy="band_join", key=["file", "line_no"])


def sink_sorted_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs written in order, read back file by file."""
    path = scratch_path(spark, "pairs")
    pair = pair_key(F.col("w"), F.col("u"))
    write_sorted_tsv(_pairs(1)(spark, sf), path, pair, "n", key=[pair])
    return read_numbered_lines(spark, path, across=True).select("line_no", "line")


def word_counts_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over parts of the corpus, one of them twice; the second time replaces the first."""
    path = scratch_path(spark, "runs")
    corpus = documents(spark, sf)
    for part in (0, 1, 2, 1):
        counted = counts.word_counts(corpus.where(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == part), stop=STOP_WORDS)
        write_run(counted, path, f"part{part}")
    return P.merged_word_counts([read_runs(spark, path, counted.schema)])


def sink_tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "counts")
    write_tsv(word_counts(spark, sf), path, "word", "n")
    return read_counts(spark, path).select(F.col("term").alias("word"), F.col("df").alias("n"))


def sink_pairs_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "pairs")
    write_tsv(_pairs(1)(spark, sf), path, pair_key(F.col("w"), F.col("u")), "n")
    return read_counts(spark, path).select(F.col("term").alias("pair"), F.col("df").alias("n"))


def sink_top100_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "top100")
    write_top_tsv(df_top100_stemmed(spark, sf), path, "term", "df")
    return read_df_table(spark, path)


def tfidf_from_files(spark: SparkSession, sf: str) -> DataFrame:
    """The chained run through files: DF table written and read back, then scores."""
    path = scratch_path(spark, "top100")
    write_top_tsv(df_top100(spark, sf), path, "term", "df")
    return P.tf_idf_scores(
        documents(spark, sf), read_df_table(spark, path), stop=STOP_WORDS, stem=False, row_is_document=True
    )


def sink_stripes_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stripes")
    write_tsv(_stripes(1)(spark, sf), path, "w", "stripe")
    return read_lines(spark, path)


def sink_tfidf_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scores")
    write_tsv(tfidf_text(spark, sf), path, "doc_id", "term", "score")
    return read_lines(spark, path)


def cooc_stripes_from_files_d1(spark: SparkSession, sf: str) -> DataFrame:
    """The chained run through files: top words written as ``word<TAB>count``, read back as vocabulary."""
    path = scratch_path(spark, "top50")
    write_top_tsv(top_words(spark, sf), path, "word", "n")
    found = P.stripe_cooccurrence(lines(spark, sf), read_vocabulary(spark, path, fmt="first_field"), 1)
    return found.select("w", stripe_text(F.col("stripe")).alias("stripe"))


QUERIES: dict[str, Query] = {
    "top_words": top_words,
    "top_words_case_sensitive": top_words_case_sensitive,
    "top_words_pages": top_words_pages,
    "word_counts": word_counts,
    "word_counts_all": word_counts_all,
    "word_counts_merged": word_counts_merged,
    "word_counts_resumed": word_counts_resumed,
    "tokens_alpha": _token_stats(T.WORDCOUNT),
    "tokens_word_apos": _token_stats(T.STRIPES),
    "tokens_nonword": _token_stats(T.DF),
    "tokens_alnum": _token_stats(T.TF),
    "stop_words_read": stop_words_read,
    "vocab_from_lines": vocab_from_lines,
    "vocab_from_tsv": vocab_from_tsv,
    "cooc_pairs_d1": _pairs(1),
    "cooc_pairs_d2": _pairs(2),
    "cooc_pairs_d3": _pairs(3),
    "cooc_pairs_d4": _pairs(4),
    "cooc_pairs_band_d2": cooc_pairs_band_d2,
    "cooc_pairs_line_preagg_d2": _pairs(2, preagg="line"),
    "cooc_pairs_pages_d2": cooc_pairs_pages_d2,
    "cooc_pairs_of_files_d2": cooc_pairs_of_files_d2,
    "cooc_pairs_large_vocabulary_d1": cooc_pairs_large_vocabulary_d1,
    "cooc_pairs_large_vocabulary_d4": cooc_pairs_large_vocabulary_d4,
    "cooc_pairs_large_vocabulary_band_d1": cooc_pairs_large_vocabulary_band_d1,
    "cooc_stripes_d1": _stripes(1),
    "cooc_stripes_d2": _stripes(2),
    "cooc_stripes_d3": _stripes(3),
    "cooc_stripes_d4": _stripes(4),
    "cooc_stripes_line_preagg_d2": _stripes(2, preagg="line"),
    "cooc_stripes_keep_empty_d1": cooc_stripes_keep_empty_d1,
    "cooc_stripes_in_parts_d1": cooc_stripes_in_parts_d1,
    "cooc_pairs_merged_d2": cooc_pairs_merged_d2,
    "cooc_stripes_merged_d2": cooc_stripes_merged_d2,
    "doc_freq_line": doc_freq_line,
    "doc_freq_doc": doc_freq_doc,
    "doc_freq_conversations": doc_freq_conversations,
    "doc_freq_stemmed": doc_freq_stemmed,
    "doc_freq_doc_stemmed": doc_freq_doc_stemmed,
    "doc_freq_vocab_stems": doc_freq_vocab_stems,
    "vocab_stems": vocab_stems,
    "vocab_stems_alnum": vocab_stems_alnum,
    "vocab_stems_grown": vocab_stems_grown,
    "df_top100": df_top100,
    "df_top100_stemmed": df_top100_stemmed,
    "df_vocab_size": df_vocab_size,
    "df_table_read": df_table_read,
    "count_table_read": count_table_read,
    "term_freq": term_freq,
    "term_freq_by_line": term_freq_by_line,
    "term_freq_conversations": term_freq_conversations,
    "tf_stripes": tf_stripes,
    "tf_stripes_by_line": tf_stripes_by_line,
    "tf_stripe_decode": tf_stripe_decode,
    "tfidf": tfidf,
    "tfidf_stemmed": tfidf_stemmed,
    "tfidf_long_df_table": tfidf_long_df_table,
    "tfidf_long_df_table_stemmed": tfidf_long_df_table_stemmed,
    "tfidf_doc_unit": tfidf_doc_unit,
    "tfidf_conversations": tfidf_conversations,
    "tfidf_merged_runs": tfidf_merged_runs,
    "term_freq_long_stop_list": term_freq_long_stop_list,
    "index_tfidf_all_terms": index_tfidf_all_terms,
    "index_tf_stripes": index_tf_stripes,
    "index_tfidf": _index_tfidf(False),
    "index_tfidf_stemmed": _index_tfidf(True),
    "doc_freq_long_stop_list": doc_freq_long_stop_list,
    "tfidf_small_collection": tfidf_small_collection,
    "tfidf_of_files": tfidf_of_files,
    "top100_from_counts": top100_from_counts,
    "src_docs_by_name": src_docs_by_name,
    "src_docs_whole": src_docs_whole,
    "tfidf_text": tfidf_text,
    "tfidf_from_files": tfidf_from_files,
    "src_lines": src_lines,
    "src_docs": src_docs,
    "src_numbered_lines": src_numbered_lines,
    "sink_tsv_roundtrip": sink_tsv_roundtrip,
    "sink_pairs_roundtrip": sink_pairs_roundtrip,
    "sink_sorted_roundtrip": sink_sorted_roundtrip,
    "sink_top100_roundtrip": sink_top100_roundtrip,
    "sink_stripes_roundtrip": sink_stripes_roundtrip,
    "sink_tfidf_roundtrip": sink_tfidf_roundtrip,
    "cooc_stripes_from_files_d1": cooc_stripes_from_files_d1,
}
