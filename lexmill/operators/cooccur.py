"""Co-occurrence of vocabulary words within a distance of token positions in one line.

Positions are those of all tokens: words outside the vocabulary are not
counted, but they do take up a position. Each unordered pair of positions is
produced once, keyed by its words in order, and mirrored after the
aggregation; that halves the rows to count and to shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lexmill.functions.lookup import MAX_BLOCKS, bloom_filter, short_codes, word_map, word_set, word_table
from lexmill.functions.text import PAIRS, STRIPES, TokenProfile, explode_runs, raw_tokens
from lexmill.operators.membership import membership
from lexmill.sources import wordlists
from lexmill.sources.sinks import stored
from lexmill.sources.wordlists import as_literals, small_rows, word_frame

STRATEGIES = ("auto", "nested", "marked", "band_join")
# Where tokens are joined with a word list, those of a hot word are dealt over so many keys. Hot are so many of the most
# frequent words that are left to the join; which they are changes no result.
SALTS = 16
HOT_WORDS = 100
# Filters with fewer bits a word let nearly everything through.
USEFUL_BITS = 4
# Positions in a bucket of the band join, at least.
BAND = 64
# Bits of the hash of a line in the band join. Lines of equal hashes meet there before their keys are compared.
LINE_BITS = 40
# Words of a bucket are one text, and so are those of a pair: short codes, and rarer words behind a mark that no code has.
SEPARATOR, MARK = " ", "="


def pairs(
    lines: DataFrame,
    vocabulary: DataFrame | Sequence[str],
    distance: int,
    *,
    text: str = "line",
    profile: TokenProfile = PAIRS,
    strategy: str = "auto",
    preagg: str = "task",
    key: Sequence[str] = (),
) -> DataFrame:
    """``w, u, n``: how often ``u`` stands within ``distance`` positions of ``w``.

    ``strategy`` is ``"nested"`` (pairs of vocabulary words are made inside the
    row; of the corpus only partial counts are shuffled), ``"marked"`` (frequent
    words are looked up in the row, others that are not in the vocabulary are
    found by a join and sent to their lines, and pairs are made inside those),
    ``"band_join"`` (tokens are joined by line and buckets of positions, for
    cross-checks; others go to their buckets) or ``"auto"``, which is nested as far
    as that goes: a vocabulary short enough becomes literals, and a longer one
    a filter with exceptions (``membership``), for which the corpus is reduced to
    its distinct words first. A vocabulary too long even for that takes the
    marked way, also under ``"nested"``, with the same result.
    ``preagg`` is ``"task"`` (Spark's partial aggregation) or ``"line"`` (counts
    inside each line before that). ``key`` names columns that identify a line;
    the band join needs them.
    """
    return _mirror(_count(lines, vocabulary, distance, text, profile, strategy, preagg, key, False))


def stripes(
    lines: DataFrame,
    vocabulary: DataFrame | Sequence[str],
    distance: int,
    *,
    text: str = "line",
    profile: TokenProfile = STRIPES,
    strategy: str = "auto",
    preagg: str = "task",
    key: Sequence[str] = (),
    keep_empty: bool = False,
    require_vocabulary: bool = True,
    parts: int = 1,
) -> DataFrame:
    """``w, stripe``: one ``map<neighbour, count>`` per word.

    ``keep_empty`` also returns words that occur but never have a neighbour,
    with an empty map. An empty vocabulary raises unless
    ``require_vocabulary=False``. A map has at most one entry per vocabulary
    word; for a vocabulary that makes it too long for a row, ``parts`` splits
    each map over so many rows by the neighbour's hash, numbered by ``part``.
    """
    counted = _count(
        lines, vocabulary, distance, text, profile, strategy, preagg, key, keep_empty, require_vocabulary
    )
    return _as_stripes(_mirror(counted), parts)


def merge_pairs(parts: Sequence[DataFrame]) -> DataFrame:
    """Pair counts of a corpus from those of its parts."""
    return _union(parts).groupBy("w", "u").agg(F.sum("n").alias("n"))


def merge_stripes(parts: Sequence[DataFrame]) -> DataFrame:
    """Stripes of a corpus from those of its parts: maps of one word add up, cell by cell."""
    cells = _union(parts).select("w", F.explode_outer("stripe").alias("u", "n"))
    return _as_stripes(cells.groupBy("w", "u").agg(F.sum("n").alias("n")))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _as_stripes(cells: DataFrame, parts: int = 1) -> DataFrame:
    """One map per word and part. Words that were only seen carry a null neighbour, which collect_list skips."""
    cell = F.when(F.col("u").isNotNull(), F.struct("u", "n"))
    # The null neighbour has part 0, like any other that falls there.
    part = F.when(F.col("u").isNull(), 0).otherwise(F.pmod(F.xxhash64("u"), F.lit(parts)))
    key = [F.col("w")] if parts == 1 else [F.col("w"), part.cast("int").alias("part")]
    return cells.groupBy(*key).agg(F.map_from_entries(F.sort_array(F.collect_list(cell))).alias("stripe"))


def _count(
    lines: DataFrame,
    vocabulary: DataFrame | Sequence[str],
    distance: int,
    text: str,
    profile: TokenProfile,
    strategy: str,
    preagg: str,
    key: Sequence[str],
    seen: bool,
    required: bool = False,
) -> DataFrame:
    """Counts by unordered pair as ``lo, hi, n``; with ``seen`` also each word with a null ``hi``."""
    if distance < 1:
        raise ValueError("the distance is at least 1")
    if strategy not in STRATEGIES or preagg not in ("task", "line"):
        raise ValueError(f"unknown strategy {strategy!r} or preagg {preagg!r}")
    if isinstance(vocabulary, DataFrame):
        # Computed once, and of known size; stored before its length is known, since to find that out is to compute it.
        vocabulary = stored(vocabulary.select("word").where("word IS NOT NULL").distinct(), "vocabulary")
    words = as_literals(vocabulary) if strategy in ("auto", "nested") else None
    if words is not None:
        words = [word for word in words if word]
    elif not isinstance(vocabulary, DataFrame):
        vocabulary = stored(word_frame(lines.sparkSession, vocabulary), "vocabulary")
    if required and (vocabulary.isEmpty() if words is None else not words):
        raise ValueError("the vocabulary is empty")
    if words is not None:
        wanted = (lambda w: w.isin(*words)) if words else (lambda w: F.lit(False))
        return _nested(lines, wanted, distance, text, profile, preagg, seen)
    if strategy == "band_join":
        if not key:
            raise ValueError("the band join needs columns that identify a line")
        return _band_join(lines, vocabulary, distance, text, profile, preagg, key, seen)
    tokens = lines.select(F.explode(raw_tokens(F.col(text), profile)).alias("word")).where("word != ''")
    # Read several times: for the test in the row, and for the lists of the marked way.
    corpus_words = stored(tokens.groupBy("word").agg(F.count("*").alias("n")), "corpus")
    if strategy != "marked":
        wanted = membership(corpus_words, vocabulary.where("word != ''"))
        if wanted is not None:
            return _nested(lines, lambda w: (w != "") & wanted(w), distance, text, profile, preagg, seen)
    marked, wanted = _marked(lines, corpus_words, vocabulary, text, profile)
    return _nested(marked, wanted, distance, text, profile, preagg, seen, keep=["_others"])


def _ordered(a: Column, b: Column) -> Column:
    return F.struct(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))


def _alone(word: Column) -> Column:
    return F.struct(word.alias("lo"), F.lit(None).cast("string").alias("hi"))


def _nested(
    lines: DataFrame,
    wanted: Callable[[Column], Column],
    distance: int,
    text: str,
    profile: TokenProfile,
    preagg: str,
    seen: bool,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Pairs of the words that are wanted, from array expressions inside the row; the test may read the ``keep`` columns."""
    tokens = lines.select(*keep, raw_tokens(F.col(text), profile).alias("tokens"))
    rows = tokens.select(_kept(wanted).alias("kept"))

    # Any two kept positions within the distance have fewer than `distance` kept
    # positions between them, so the next `distance` entries are all candidates.
    if preagg == "line":

        def ahead(p: Column, i: Column) -> Column:
            near = F.filter(F.slice("kept", i + 2, F.lit(distance)), lambda q: q["pos"] - p["pos"] <= distance)
            return F.transform(near, lambda q: _ordered(p["w"], q["w"]))

        found = F.flatten(F.transform("kept", ahead))
        if seen:
            found = F.concat(found, F.array_distinct(F.transform("kept", lambda p: _alone(p["w"]))))
        counted = explode_runs(rows, found, name="pair", count="n")
        return counted.groupBy("pair.lo", "pair.hi").agg(F.sum("n").alias("n"))
    # A word with its candidates is a row, so that pairs are made in generated code and not in lambdas.
    near = F.transform("kept", lambda p, i: F.slice("kept", i + 1, F.lit(distance + 1)))
    words = rows.select(F.explode(near).alias("near"))
    first = F.get("near", F.lit(0))
    pairs = words.select(
        first["pos"].alias("p"), first["w"].alias("a"), F.inline(F.slice("near", 2, distance)).alias("q", "b")
    )
    found = pairs.where(F.col("q") - F.col("p") <= distance).select("a", "b")
    if seen:
        found = found.unionByName(words.select(first["w"].alias("a"), F.lit(None).cast("string").alias("b")))
    return _in_pairs(found).groupBy("lo", "hi").agg(F.count("*").alias("n"))


def _kept(wanted: Callable[[Column], Column]) -> Column:
    """``pos, w`` of the wanted words of the array ``tokens``, in order."""
    known = F.transform("tokens", lambda w, i: F.when(wanted(w), F.struct(i.alias("pos"), w.alias("w"))))
    return F.filter(known, lambda t: t.isNotNull())


def _in_pairs(found: DataFrame, *keep: str) -> DataFrame:
    """``lo, hi`` of the words ``a, b``. A word that was only seen has none beside it."""
    a, b = F.col("a"), F.col("b")
    return found.select(F.least(a, b).alias("lo"), F.when(b.isNotNull(), F.greatest(a, b)).alias("hi"), *keep)


def _marked(
    lines: DataFrame, corpus_words: DataFrame, vocabulary: DataFrame, text: str, profile: TokenProfile
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Lines with the words that are not in the vocabulary as ``_others``, and the test for words of these lines.

    The most frequent words of the corpus are looked up in the row, and filters
    settle some others. The rest is joined with the corpus words that are not in
    the vocabulary, and what is found there goes to its line. Lines are known by
    a short hash: where two have the same, each gets the words of both, and as
    no such word is in the vocabulary, that changes nothing.
    """
    body = F.col(text)
    words, frequent, rest = _by_frequency(corpus_words, vocabulary)
    is_known = word_set([row["word"] for row in frequent])
    is_known_other = word_set([row["word"] for row in frequent if not row["member"]])
    others = rest.where("NOT member")
    may_be_other, may_be_member = _filter(others), _filter_of_members(words, rest)

    def doubtful(word: Column) -> Column:
        return (word != "") & ~is_known(word) & may_be_member(word) & may_be_other(word)

    full, line = lines.where(body != ""), F.hash(body)
    in_doubt = F.array_distinct(F.filter(raw_tokens(body, profile), doubtful))
    likely = full.select(line.alias("line_hash"), F.explode(in_doubt).alias("word"))
    by_line = _among(likely, others, "line_hash").groupBy("line_hash").agg(F.collect_set("word").alias("_others"))
    marked = full.select(body.alias(text), line.alias("line_hash")).join(by_line, "line_hash", "left")

    def wanted(word: Column) -> Column:
        other = is_known_other(word) | F.coalesce(F.array_contains("_others", word), F.lit(False))
        return (word != "") & may_be_member(word) & ~other

    return marked, wanted


def _by_frequency(corpus_words: DataFrame, vocabulary: DataFrame) -> tuple[DataFrame, list[Row], DataFrame]:
    """The corpus words with ``member``, those of them that are looked up in the row, and the rest."""
    words = corpus_words.join(vocabulary.withColumn("member", F.lit(True)), "word", "left")
    words = stored(words.withColumn("member", F.col("member").isNotNull()), "words")
    frequent = words.orderBy(F.desc("n"), "word").limit(wordlists.LITERAL_WORDS).collect()
    rest = words
    if frequent:
        last = frequent[-1]
        rest = words.where((F.col("n") < last["n"]) | ((F.col("n") == last["n"]) & (F.col("word") > last["word"])))
    return words, frequent, rest


def _filter_of_members(words: DataFrame, rest: DataFrame) -> Callable[[Column], Column]:
    """A filter of the members, frequent ones included: it spares tokens where most of the rest are no members."""
    tokens_of = {row["member"]: row["n"] for row in rest.groupBy("member").agg(F.sum("n").alias("n")).collect()}
    if tokens_of.get(False, 0) > tokens_of.get(True, 0):
        return _filter(words.where("member"))
    return lambda word: F.lit(True)


def _among(likely: DataFrame, others: DataFrame, place: str) -> DataFrame:
    """The rows of ``likely`` whose ``word`` is one of ``others``.

    Those of a hot word are joined with one of many copies of it.
    """
    is_hot = word_set([row["word"] for row in others.orderBy(F.desc("n"), "word").limit(HOT_WORDS).collect()])
    salted = likely.withColumn("salt", F.when(is_hot(F.col("word")), F.pmod(place, F.lit(SALTS))).otherwise(0))
    copies = F.when(is_hot(F.col("word")), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(others.select("word", F.explode(copies).alias("salt")), ["word", "salt"], "left_semi")


def _filter(words: DataFrame) -> Callable[[Column], Column]:
    """A Bloom filter of the words, or one that lets all through where they are too many for it."""
    n = words.count()
    return bloom_filter(words, n) if USEFUL_BITS * n <= 64 * MAX_BLOCKS else lambda word: F.lit(True)


def _band_join(
    lines: DataFrame,
    vocabulary: DataFrame,
    distance: int,
    text: str,
    profile: TokenProfile,
    preagg: str,
    key: Sequence[str],
    seen: bool,
) -> DataFrame:
    """Equi-join on line and bucket of positions.

    The words of a bucket and the first ones after it are one row, empty in the
    places of others. Rows of a bucket meet each other: the words of one meet
    those after them in the other. Buckets are as wide as the distance at least,
    and a long line is spread over many keys.

    Both sides of the join are one shuffle, and as little of the text as possible
    crosses it: frequent words are looked up in the row and replaced by short
    codes, also in the counted pairs. Of the words that are not in the vocabulary,
    those that occur once are known by their place, which is found while words are
    counted; more often they are looked up in the row if they are few, and joined
    where filters leave them in doubt if not. What is found goes to its bucket.
    Buckets are known by a short hash: where two have the same, each gets the words
    of both, and as no such word is in the vocabulary, that changes nothing.
    """
    width, names = max(BAND, distance), [f"_key{k}" for k in range(len(key))]
    keys = [F.col(k).alias(name) for k, name in zip(key, names, strict=True)]
    # Buckets of a line have hashes in a row, so that of the one before is known. Lines that lack a key have no place.
    line_hash = F.xxhash64(*key).bitwiseAND(F.lit((1 << LINE_BITS) - 1))
    line_hash = F.when(reduce(and_, (F.col(k).isNotNull() for k in key)), line_hash)
    full = lines.where(F.col(text) != "").select(*keys, line_hash.alias("line_hash"), F.col(text).alias("body"))
    keyed = full.where("line_hash IS NOT NULL")
    raw = raw_tokens(F.col("body"), profile)

    # The place of a token: its bucket, and whether the one before has it, too.
    placed = full.select("line_hash", F.posexplode(raw).alias("p", "word"))
    bucket, offset = F.floor(F.col("p") / F.lit(width)), F.pmod("p", F.lit(width))
    at = (F.col("line_hash") + bucket) * 2 + (offset < distance).cast("int")
    counted = placed.where("word != ''").groupBy("word").agg(F.count("*").alias("n"), F.min(at).alias("at"))
    words, frequent, rest = _by_frequency(counted, vocabulary)
    once, others = rest.where("NOT member AND n = 1"), rest.where("NOT member AND n > 1")
    may_be_member = _filter_of_members(words, rest.where("member OR n > 1"))
    codes = short_codes([row["word"] for row in frequent if row["member"]], without=SEPARATOR + MARK)
    # Where the others are few, they are looked up in the row, too.
    few = small_rows(others.select("word"), wordlists.LITERAL_WORDS)
    ignored = ["", *(row["word"] for row in [*frequent, *(few or [])])]
    code = word_table(dict.fromkeys(ignored, "") | codes)

    def kept(word: Column) -> Column:
        rare = F.concat(F.lit(MARK), _escaped(word))
        return F.coalesce(code(word), F.when(may_be_member(word), rare).otherwise(""))

    def buckets(tokens: Column, shape: Callable[[Column], Column], *keep: str) -> DataFrame:
        """``place, words`` of each bucket, with the words that come after it as far as the distance."""

        def cut(start: Column, i: Column) -> Column:
            return F.struct(i.alias("bucket"), shape(F.slice("tokens", start, width + distance)).alias("words"))

        rows = keyed.select(*keep, "line_hash", tokens.alias("tokens"))
        starts = F.sequence(F.lit(1), F.size("tokens"), F.lit(width))
        found = rows.select(*keep, "line_hash", F.inline(F.transform(starts, cut)))
        return found.select(*keep, (F.col("line_hash") + F.col("bucket")).alias("place"), "words")

    places = F.when(F.col("at") % 2 == 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    wrong = once.where("at IS NOT NULL").select("at", "word", F.explode(places).alias("before"))
    wrong = wrong.select((F.shiftright("at", 1) - F.col("before")).alias("place"), "word")
    if few is None:
        is_known = word_set([row["word"] for row in frequent])
        may_be_other = _filter(others)

        def doubtful(word: Column) -> Column:
            return (word != "") & ~is_known(word) & may_be_member(word) & may_be_other(word)

        in_doubt = F.array_distinct(F.filter("words", doubtful))
        likely = buckets(raw, lambda tokens: tokens).select("place", F.explode(in_doubt).alias("word"))
        wrong = _among(likely, others, "place").select("place", "word").unionByName(wrong)
    marked_words = wrong.select("place", F.concat(F.lit(MARK), _escaped(F.col("word"))).alias("word"))
    by_place = marked_words.groupBy("place").agg(F.collect_set("word").alias("_others"))

    rows = buckets(F.transform(raw, kept), lambda tokens: F.array_join(tokens, SEPARATOR), *names)
    rows = rows.where(F.trim("words") != "")
    left, right = rows.alias("l"), rows.alias("r")
    # As two comparisons each, so that Spark does not shuffle by them, too, but by the place alone, like the words above.
    same = [(F.col(f"l.{k}") <= F.col(f"r.{k}")) & (F.col(f"l.{k}") >= F.col(f"r.{k}")) for k in names]
    both = left.join(right, reduce(and_, same, F.col("l.place") == F.col("r.place")))
    sides = F.col("l.words").alias("here"), F.col("r.words").alias("there")
    both = both.select(*[f"l.{k}" for k in names], "l.place", *sides).join(by_place, "place", "left")

    def known(words: str) -> Column:
        tokens = F.split(words, SEPARATOR)
        tested = F.transform(tokens, lambda word: F.when(F.array_contains("_others", word), "").otherwise(word))
        return F.when(F.col("_others").isNull(), tokens).otherwise(tested)

    steps = F.explode(F.sequence(F.lit(1), F.lit(distance))).alias("step")
    both = both.withColumn("after", known("there"))
    # Most rows meet themselves alone, and their text is taken apart once.
    words_here = F.when(F.col("here") == F.col("there"), F.col("after")).otherwise(known("here"))
    both = both.select(*names, words_here.alias("from"), "after", steps)
    placed = both.select(*names, F.posexplode(F.slice("from", 1, width)).alias("p", "a"), "after", "step")
    # Null where the line ends.
    pairs = placed.where("a != ''").select(*names, "a", F.get("after", F.col("p") + F.col("step")).alias("b"))
    # One text for both words takes half the bytes of two.
    pair = F.when(F.col("a") <= F.col("b"), F.concat("a", F.lit(SEPARATOR), "b")).otherwise(F.concat("b", F.lit(SEPARATOR), "a"))
    found = pairs.where("b != ''").select(*names, pair.alias("pair"))
    if preagg == "line":
        per_line = found.groupBy(*names, "pair").agg(F.count("*").alias("n"))
        counted = per_line.groupBy("pair").agg(F.sum("n").alias("n"))
    else:
        counted = found.groupBy("pair").agg(F.count("*").alias("n"))
    word_of = word_map({code: word for word, code in codes.items()})

    def decoded(k: int) -> Column:
        word = F.substring_index("pair", SEPARATOR, k)
        return F.when(word.startswith(MARK), _unescaped(F.substring(word, 2, 1 << 30))).otherwise(word_of(word))

    result = counted.select(decoded(1).alias("lo"), decoded(-1).alias("hi"), "n")
    if seen:
        alone = words.where("member").select(F.col("word").alias("lo"), F.lit(None).cast("string").alias("hi"), "n")
        result = result.unionByName(alone)
    return result


def _escaped(word: Column) -> Column:
    """A word without the separator."""
    return F.replace(F.replace(word, F.lit("%"), F.lit("%25")), F.lit(SEPARATOR), F.lit("%20"))


def _unescaped(word: Column) -> Column:
    return F.replace(F.replace(word, F.lit("%20"), F.lit(SEPARATOR)), F.lit("%25"), F.lit("%"))


def _mirror(counted: DataFrame) -> DataFrame:
    """``lo, hi, n`` to both orders; a word next to itself is seen from both positions."""

    def cell(w: str, u: str, n: Column) -> Column:
        return F.struct(F.col(w).alias("w"), F.col(u).alias("u"), n.alias("n"))

    n = F.col("n")
    both = (
        F.when(F.col("hi").isNull(), F.array(cell("lo", "hi", n * 0)))
        .when(F.col("lo") == F.col("hi"), F.array(cell("lo", "hi", n * 2)))
        .otherwise(F.array(cell("lo", "hi", n), cell("hi", "lo", n)))
    )
    return counted.select(F.inline(both))
