"""The same queries as SQL over the parquet tables, for checking with another engine.

The SQL works on exploded tokens with joins and GROUP BY. It shares neither
plans nor values with the library: separators, token filters, stemming rules and
stop words are written out here a second time.
"""

from __future__ import annotations

from types import SimpleNamespace as Values

# The tokenizers.
T = Values(
    WORDCOUNT=Values(separator="[^a-zA-Z]+", lowercase=True, min_len=2, keep=None, drop=None),
    WORDCOUNT_CASED=Values(separator="[^a-zA-Z]+", lowercase=False, min_len=2, keep=None, drop=None),
    PAIRS=Values(separator="[^a-zA-Z]+", lowercase=True, min_len=1, keep=None, drop=None),
    STRIPES=Values(separator="[^\\w']+", lowercase=True, min_len=1, keep=None, drop=None),
    DF=Values(separator="\\W+", lowercase=True, min_len=1, keep="^[a-zA-Z]+$", drop=None),
    TF=Values(separator="[^a-z0-9]+", lowercase=True, min_len=2, keep=None, drop="^[0-9]+$", min_stem_len=2),
    LINE_END="\\r\\n|\\r|\\n",
)
# The published rules of Porter's stemmer; Y stands for y as a consonant.
R = Values(
    VOWEL="[aeiouy]",
    MEASURE_OVER_0="^[^aeiouy]*[aeiouy]+[^aeiouy]",
    MEASURE_OVER_1="^[^aeiouy]*[aeiouy]+[^aeiouy]+[aeiouy]+[^aeiouy]",
    SHORT_END="[^aeiouy][aeiouy][^aeiouywxY]$",
    CONSONANT_Y="(^|[aeiou])y",
    STEP_2=[
        ("ational", "ate"),
        ("tional", "tion"),
        ("enci", "ence"),
        ("anci", "ance"),
        ("izer", "ize"),
        ("bli", "ble"),
        ("alli", "al"),
        ("entli", "ent"),
        ("eli", "e"),
        ("ousli", "ous"),
        ("ization", "ize"),
        ("ation", "ate"),
        ("ator", "ate"),
        ("alism", "al"),
        ("iveness", "ive"),
        ("fulness", "ful"),
        ("ousness", "ous"),
        ("aliti", "al"),
        ("iviti", "ive"),
        ("biliti", "ble"),
        ("logi", "log"),
    ],
    STEP_3=[
        ("icate", "ic"),
        ("ative", ""),
        ("alize", "al"),
        ("iciti", "ic"),
        ("ical", "ic"),
        ("ful", ""),
        ("ness", ""),
    ],
    STEP_4=[
        "al",
        "ance",
        "ence",
        "er",
        "ic",
        "able",
        "ible",
        "ant",
        "ement",
        "ment",
        "ent",
        "ion",
        "ou",
        "ism",
        "ate",
        "iti",
        "ous",
        "ive",
        "ize",
    ],
)
STOP_WORDS = [
    "and", "are", "as", "at", "auf", "avec", "by", "das", "de", "den", "der", "des", "die", "du",
    "ein", "en", "es", "et", "for", "he", "in", "is", "ist", "it", "la", "le", "les", "mit", "of",
    "on", "or", "que", "qui", "that", "the", "this", "to", "un", "und", "une", "was", "with",
]

TOP50 = "ORDER BY n DESC, word LIMIT 50"
TOP100 = "ORDER BY df DESC, term LIMIT 100"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_stop(word: str) -> str:
    return f"{word} IN ({', '.join(map(q, STOP_WORDS))})"


def split(text: str, profile: Values) -> str:
    text = f"lower({text})" if profile.lowercase else text
    return f"regexp_split_to_array({text}, {q(profile.separator)})"


def ok(word: str, profile: Values, stop: bool = True) -> str:
    tests = [f"length({word}) >= {profile.min_len}"]
    if profile.keep:
        tests.append(f"regexp_matches({word}, {q(profile.keep)})")
    if profile.drop:
        tests.append(f"NOT regexp_matches({word}, {q(profile.drop)})")
    if stop:
        tests.append(f"NOT ({in_stop(word)})")
    return " AND ".join(tests)


def tokens(source: str, profile: Values, keep: str = "", text: str = "text", stop: bool = True) -> str:
    """``keep, word``: one row per token."""
    cols = f"{keep}, " if keep else ""
    return (
        f"SELECT {cols}word FROM (SELECT {cols}unnest({split(text, profile)}) AS word FROM {source}) "
        f"WHERE {ok('word', profile, stop)}"
    )


def counts(source: str, profile: Values = T.WORDCOUNT, text: str = "text", stop: bool = True) -> str:
    return f"SELECT word, count(*) AS n FROM ({tokens(source, profile, '', text, stop)}) GROUP BY word"


SPLIT_LINES = f"regexp_split_to_array(text, {q(T.LINE_END)})"


def lines(source: str, keep: str) -> str:
    """``keep, line_no, line``: one row per line of ``text``."""
    return (
        f"(SELECT {keep}, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no "
        f"FROM (SELECT {keep}, {SPLIT_LINES} AS ls FROM {source}))"
    )


LINES = lines("documents", "doc_id")
PAGE_LINES = lines("(SELECT page_id AS doc_id, html AS text FROM pages)", "doc_id")
ALL_LINES = lines(
    "(SELECT row_number() OVER () AS doc_id, text FROM (SELECT text FROM documents UNION ALL "
    "SELECT text FROM conversations UNION ALL SELECT html FROM pages))",
    "doc_id",
)
VOCABULARY = f"SELECT word FROM ({counts('documents')}) {TOP50}"
PAGE_VOCABULARY = f"SELECT word FROM ({counts('pages', text='html')}) {TOP50}"
FREQUENT = f"SELECT word FROM ({counts('documents', stop=False)}) WHERE n > 1"
MIXED = (
    f"(SELECT word FROM ({counts('documents', stop=False)}) ORDER BY n DESC, word LIMIT 20) UNION "
    f"(SELECT word FROM ({counts('documents', stop=False)}) ORDER BY n, word LIMIT 200)"
)


def pair_ctes(distance: int, profile: Values, vocabulary: str = VOCABULARY, lines: str = LINES) -> str:
    offsets = ", ".join(f"({k}), ({-k})" for k in range(1, distance + 1))
    return f"""
        vocabulary AS MATERIALIZED ({vocabulary}),
        placed AS (
            SELECT doc_id, line_no, unnest(ts) AS w, generate_subscripts(ts, 1) AS pos
            FROM (SELECT doc_id, line_no, {split('line', profile)} AS ts FROM {lines})),
        kept AS MATERIALIZED (SELECT * FROM placed WHERE w <> '' AND w IN (SELECT word FROM vocabulary)),
        near AS (SELECT a.doc_id, a.line_no, a.w, a.pos + o.k AS pos FROM kept a, (VALUES {offsets}) o(k)),
        pair AS MATERIALIZED (
            SELECT a.w, b.w AS u, count(*) AS n
            FROM near a JOIN kept b ON a.doc_id = b.doc_id AND a.line_no = b.line_no AND a.pos = b.pos
            GROUP BY a.w, b.w)"""


def pairs(distance: int, **options: str) -> str:
    return f"WITH {pair_ctes(distance, T.PAIRS, **options)} SELECT w, u, n FROM pair"


STRIPE = "'{' || string_agg(u || '=' || n, ', ' ORDER BY u) || '}'"


def stripes(distance: int, **options: str) -> str:
    return f"WITH {pair_ctes(distance, T.STRIPES, **options)} SELECT w, {STRIPE} AS stripe FROM pair GROUP BY w"


def stripes_keep_empty(distance: int) -> str:
    return f"""WITH {pair_ctes(distance, T.STRIPES, MIXED)},
        stripe AS (SELECT w, {STRIPE} AS stripe FROM pair GROUP BY w)
        SELECT k.w, coalesce(s.stripe, '{{}}') AS stripe
        FROM (SELECT DISTINCT w FROM kept) k LEFT JOIN stripe s ON k.w = s.w"""


# Document frequency


def df(source: str, keep: str, text: str = "text") -> str:
    """``term, df`` where ``keep`` identifies the unit that counts once."""
    return (
        f"SELECT word AS term, count(*) AS df FROM "
        f"(SELECT DISTINCT {keep}, word FROM ({tokens(source, T.DF, keep, text)})) GROUP BY word"
    )


DF_LINE = df(LINES, "doc_id, line_no", "line")
DF_DOC = df("documents", "doc_id")


def stem_ctes(words: str) -> str:
    """Porter's steps over distinct ``words``, as one CTE per step, ending in ``stems(term, stem)``."""

    def less(n: int) -> str:
        return f"left(s, length(s) - {n})"

    def over0(x: str) -> str:
        return f"regexp_matches({x}, {q(R.MEASURE_OVER_0)})"

    def over1(x: str) -> str:
        return f"regexp_matches({x}, {q(R.MEASURE_OVER_1)})"

    def vowel(x: str) -> str:
        return f"regexp_matches({x}, {q(R.VOWEL)})"

    def short(x: str) -> str:
        return f"regexp_matches({x}, {q(R.SHORT_END)})"

    def rules(table: list[tuple[str, str]], over: object) -> str:
        cases = " ".join(
            f"WHEN suffix(s, '{old}') THEN CASE WHEN {over(less(len(old)))} "
            f"THEN {less(len(old))} || '{new}' ELSE s END"
            for old, new in table
        )
        return f"CASE {cases} ELSE s END"

    def last(old: str) -> str:
        extra = f" AND regexp_matches({less(3)}, '[st]$')" if old == "ion" else ""
        return (
            f"WHEN suffix(s, '{old}') THEN CASE WHEN {over1(less(len(old)))}{extra} "
            f"THEN {less(len(old))} ELSE s END"
        )

    steps = [
        f"replace(regexp_replace(s, {q(R.CONSONANT_Y)}, '\\1Y', 'g'), 'yy', 'yY')",
        f"CASE WHEN suffix(s, 'sses') OR suffix(s, 'ies') THEN {less(2)} WHEN suffix(s, 'ss') THEN s "
        f"WHEN suffix(s, 's') THEN {less(1)} ELSE s END",
        f"CASE WHEN suffix(s, 'eed') THEN CASE WHEN {over0(less(3))} THEN {less(1)} ELSE s END "
        f"WHEN suffix(s, 'ed') THEN CASE WHEN {vowel(less(2))} THEN {less(2)} || '#' ELSE s END "
        f"WHEN suffix(s, 'ing') THEN CASE WHEN {vowel(less(3))} THEN {less(3)} || '#' ELSE s END ELSE s END",
        f"CASE WHEN NOT suffix(s, '#') THEN s WHEN regexp_matches(s, '(at|bl|iz)#$') THEN {less(1)} || 'e' "
        f"WHEN lower(substr(s, length(s) - 1, 1)) = substr(s, length(s) - 2, 1) AND regexp_matches(s, '[^aeiouy]#$') "
        f"THEN CASE WHEN regexp_matches(s, '[lsz]#$') THEN {less(1)} ELSE {less(2)} END "
        f"WHEN {over0(less(1))} AND NOT {over1(less(1))} AND {short(less(1))} THEN {less(1)} || 'e' "
        f"ELSE {less(1)} END",
        f"CASE WHEN regexp_matches(s, '[yY]$') AND {vowel(less(1))} THEN {less(1)} || 'i' ELSE s END",
        rules(R.STEP_2, over0),
        rules(R.STEP_3, over0),
        "CASE " + " ".join(map(last, R.STEP_4)) + " ELSE s END",
        f"CASE WHEN suffix(s, 'e') AND ({over1(less(1))} OR ({over0(less(1))} AND NOT {over1(less(1))} "
        f"AND NOT {short(less(1))})) THEN {less(1)} ELSE s END",
        f"CASE WHEN suffix(s, 'll') AND {over1('s')} THEN {less(1)} ELSE s END",
    ]
    ctes = [f"p0 AS MATERIALIZED (SELECT DISTINCT word AS term, word AS s FROM ({words}))"]
    for i, step in enumerate(steps):
        ctes.append(f"p{i + 1} AS MATERIALIZED (SELECT term, {step} AS s FROM p{i})")
    ctes.append(
        "stems AS MATERIALIZED (SELECT term, CASE WHEN length(term) <= 2 THEN term ELSE lower(s) END AS stem "
        f"FROM p{len(steps)})"
    )
    return ", ".join(ctes)


def stems(profile: Values) -> str:
    return f"WITH {stem_ctes(tokens('documents', profile, stop=False))} SELECT term, stem FROM stems"


def stemmed_df(source: str, keep: str, text: str = "text") -> str:
    found = tokens(source, T.DF, keep, text)
    return f"""WITH toks AS MATERIALIZED ({found}), {stem_ctes('SELECT word FROM toks')}
        SELECT stem AS term, count(*) AS df
        FROM (SELECT DISTINCT {keep}, stem FROM toks JOIN stems ON word = stems.term) GROUP BY stem"""


DF_LINE_STEMMED = stemmed_df(LINES, "doc_id, line_no", "line")


# Term frequency and scores


def tf(source: str, doc: str) -> str:
    return f"SELECT {doc}, word AS term, count(*) AS tf FROM ({tokens(source, T.TF, doc)}) GROUP BY {doc}, word"


def stemmed_tf(source: str, doc: str) -> str:
    found = tokens(source, T.TF, doc)
    return f"""WITH toks AS MATERIALIZED ({found}), {stem_ctes('SELECT word FROM toks')}
        SELECT {doc}, stem AS term, count(*) AS tf FROM toks JOIN stems ON word = stems.term
        WHERE length(stem) >= {T.TF.min_stem_len} GROUP BY {doc}, stem"""


def scored(tf_sql: str, df_sql: str, doc: str, top: str = TOP100) -> str:
    return f"""SELECT t.{doc}, t.term, round(t.tf * ln(10000.0 / d.df + 1), 6) AS score
        FROM ({tf_sql}) t JOIN (SELECT * FROM ({df_sql}) {top}) d ON t.term = d.term"""


TF_DOC = tf("documents", "doc_id")
TF_ALL = f"SELECT doc_id, word AS term, count(*) AS tf FROM ({tokens('documents', T.TF, 'doc_id', stop=False)}) GROUP BY ALL"
DF_ALL = (
    f"SELECT word AS term, count(DISTINCT doc_id) AS df FROM ({tokens('documents', T.DF, 'doc_id', stop=False)}) GROUP BY word"
)
PAGE_WORDS = counts("pages", text="html", stop=False)
FILES = "(SELECT 'source=' || source || '/lang=' || lang AS doc_id, text FROM documents)"
SCORED_TF = f"SELECT t.* FROM ({TF_DOC}) t JOIN (SELECT * FROM ({DF_LINE}) {TOP100}) d ON t.term = d.term"
TF_STRIPES = (
    f"SELECT doc_id, string_agg(term || ':' || tf, ',' ORDER BY term) AS stripe FROM ({SCORED_TF}) GROUP BY doc_id"
)
TF_STEMMED = stemmed_tf("documents", "doc_id")
DF_OF_TF = "SELECT term, count(*) AS df FROM ({}) GROUP BY term"
STEMS_OF_TWO = (
    f"WITH {stem_ctes(tokens('documents', T.DF, stop=False) + ' UNION ALL ' + tokens('conversations', T.DF, stop=False))} "
    "SELECT term, stem FROM stems"
)
TFIDF = scored(TF_DOC, DF_LINE, "doc_id")
LARGE = "SELECT term || '+' AS term, df + 3000000000 AS df FROM t"
MERGED = " UNION ALL ".join(
    f"SELECT word, n FROM ({counts(source, text=text)})"
    for source, text in [("documents", "text"), ("conversations", "text"), ("pages", "html"), ("benchmark", "text")]
)


def token_stats(profile: Values) -> str:
    return f"""SELECT d.doc_id, count(t.word) AS n_tokens, count(DISTINCT t.word) AS n_distinct
        FROM documents d LEFT JOIN ({tokens('documents', profile, 'doc_id', stop=False)}) t USING (doc_id)
        GROUP BY d.doc_id"""


ORACLES: dict[str, str] = {
    "top_words": f"{counts('documents')} {TOP50}",
    "top_words_case_sensitive": f"{counts('documents', T.WORDCOUNT_CASED)} {TOP50}",
    "top_words_pages": f"{counts('pages', text='html')} {TOP50}",
    "word_counts": counts("documents"),
    "word_counts_all": counts("documents", stop=False),
    "word_counts_merged": f"SELECT word, CAST(sum(n) AS BIGINT) AS n FROM ({MERGED}) GROUP BY word",
    "tokens_alpha": token_stats(T.WORDCOUNT),
    "tokens_word_apos": token_stats(T.STRIPES),
    "tokens_nonword": token_stats(T.DF),
    "tokens_alnum": token_stats(T.TF),
    "stop_words_read": f"SELECT word FROM ({counts('documents', stop=False)})",
    "vocab_from_lines": f"SELECT word FROM ({counts('documents', stop=False)})",
    "vocab_from_tsv": f"SELECT word FROM ({counts('documents', T.WORDCOUNT_CASED, stop=False)})",
    **{f"cooc_pairs_d{d}": pairs(d) for d in (1, 2, 3, 4)},
    "cooc_pairs_band_d2": pairs(2),
    "cooc_pairs_line_preagg_d2": pairs(2),
    "cooc_pairs_pages_d2": pairs(2, vocabulary=PAGE_VOCABULARY, lines=PAGE_LINES),
    "cooc_pairs_large_vocabulary_d1": pairs(1, vocabulary=FREQUENT),
    "cooc_pairs_large_vocabulary_d4": pairs(4, vocabulary=FREQUENT),
    "cooc_pairs_large_vocabulary_band_d1": pairs(1, vocabulary=FREQUENT),
    **{f"cooc_stripes_d{d}": stripes(d) for d in (1, 2, 3, 4)},
    "cooc_stripes_in_parts_d1": stripes(1),
    "cooc_pairs_of_files_d2": pairs(2),
    "cooc_stripes_line_preagg_d2": stripes(2),
    "cooc_stripes_keep_empty_d1": stripes_keep_empty(1),
    "doc_freq_line": DF_LINE,
    "doc_freq_doc": DF_DOC,
    "doc_freq_conversations": df("conversations", "conv_id"),
    "doc_freq_stemmed": DF_LINE_STEMMED,
    "doc_freq_doc_stemmed": stemmed_df("documents", "doc_id"),
    "doc_freq_vocab_stems": stemmed_df("documents", "doc_id"),
    "vocab_stems": stems(T.DF),
    "vocab_stems_grown": STEMS_OF_TWO,
    "vocab_stems_alnum": stems(T.TF),
    "df_top100": f"SELECT row_number() OVER (ORDER BY df DESC, term) AS rank, term, df FROM ({DF_LINE}) {TOP100}",
    "df_top100_stemmed": f"SELECT row_number() OVER (ORDER BY df DESC, term) AS rank, term, df "
    f"FROM ({DF_LINE_STEMMED}) {TOP100}",
    "df_vocab_size": f"SELECT count(*) AS n_terms FROM ({DF_LINE})",
    "df_table_read": f"WITH t AS ({DF_LINE}) SELECT term, df FROM t UNION ALL {LARGE}",
    "count_table_read": f"WITH t AS ({DF_LINE}) SELECT term, df FROM t UNION ALL SELECT term, df + 1 FROM t UNION ALL {LARGE}",
    "term_freq": TF_DOC,
    "term_freq_by_line": TF_DOC,
    "term_freq_conversations": stemmed_tf("conversations", "conv_id"),
    "tf_stripes": TF_STRIPES,
    "tf_stripes_by_line": TF_STRIPES,
    "tf_stripe_decode": SCORED_TF,
    "tfidf": TFIDF,
    "tfidf_stemmed": scored(stemmed_tf("documents", "doc_id"), DF_LINE_STEMMED, "doc_id"),
    "tfidf_long_df_table": scored(TF_DOC, DF_LINE, "doc_id", top=""),
    "tfidf_long_df_table_stemmed": scored(TF_STEMMED, DF_LINE_STEMMED, "doc_id", top=""),
    "index_tfidf": scored(TF_DOC, DF_OF_TF.format(TF_DOC), "doc_id"),
    "index_tfidf_stemmed": scored(TF_STEMMED, DF_OF_TF.format(TF_STEMMED), "doc_id"),
    "index_tfidf_all_terms": scored(TF_DOC, DF_OF_TF.format(TF_DOC), "doc_id", top=""),
    "index_tf_stripes": "SELECT doc_id, string_agg(term || ':' || tf, ',' ORDER BY term) AS stripe "
    f"FROM ({TF_DOC}) GROUP BY doc_id",
    "tfidf_doc_unit": scored(TF_DOC, DF_DOC, "doc_id"),
    "tfidf_conversations": scored(
        stemmed_tf("conversations", "conv_id"), stemmed_df("conversations", "conv_id"), "conv_id"
    ),
    "tfidf_merged_runs": TFIDF,
    "term_freq_long_stop_list": f"SELECT * FROM ({TF_ALL}) WHERE term NOT IN (SELECT word FROM ({PAGE_WORDS}))",
    "doc_freq_long_stop_list": f"SELECT * FROM ({DF_ALL}) WHERE term NOT IN (SELECT word FROM ({PAGE_WORDS}))",
    "tfidf_small_collection": TFIDF.replace("10000.0", "(SELECT count(*)::DOUBLE FROM documents)"),
    "tfidf_of_files": scored(tf(FILES, "doc_id"), DF_LINE, "doc_id"),
    "top100_from_counts": f"SELECT row_number() OVER (ORDER BY df DESC, term) AS rank, term, df FROM ({DF_LINE}) {TOP100}",
    "src_docs_by_name": "SELECT count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars "
    f"FROM {lines('documents', 'lang')}",
    "src_docs_whole": "SELECT source, lang, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars "
    f"FROM {lines('documents', 'source, lang')} GROUP BY source, lang",
    "tfidf_text": f"SELECT doc_id, term, printf('%.6f', score) AS score FROM ({TFIDF})",
    "tfidf_from_files": TFIDF,
    "src_lines": f"SELECT line, count(*) AS n FROM {LINES} GROUP BY line",
    "src_docs": "SELECT lang, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars "
    f"FROM {lines('documents', 'lang')} GROUP BY lang",
    "src_numbered_lines": "SELECT row_number() OVER (ORDER BY doc_id, line_no) - 1 AS line_no, line FROM " + LINES,
    "sink_sorted_roundtrip": "SELECT row_number() OVER (ORDER BY pair) - 1 AS line_no, pair || chr(9) || n AS line "
    f"FROM (SELECT w || ',' || u AS pair, n FROM ({pairs(1)}))",
    "word_counts_resumed": counts("documents"),
    "sink_tsv_roundtrip": counts("documents"),
    "sink_pairs_roundtrip": f"SELECT w || ',' || u AS pair, n FROM ({pairs(1)})",
    "cooc_pairs_merged_d2": pairs(2, lines=ALL_LINES),
    "cooc_stripes_merged_d2": stripes(2, lines=ALL_LINES),
    "cooc_stripes_from_files_d1": stripes(1),
    "sink_stripes_roundtrip": f"SELECT w || chr(9) || stripe AS line FROM ({stripes(1)})",
    "sink_tfidf_roundtrip": f"SELECT doc_id || chr(9) || term || chr(9) || printf('%.6f', score) AS line "
    f"FROM ({TFIDF})",
    "sink_top100_roundtrip": f"SELECT term, df FROM ({DF_LINE_STEMMED}) {TOP100}",
}
