"""Toxicity of documents, scored on deobfuscated text.

Method: a noisy channel. Spans that look disguised become character lattices of
leetspeak, spacing and repetition; Viterbi decoding under a character language
model of the whole corpus restores them; the restored text is scored with words
learned from labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from lexmill.llm.common import packed, ship_package, stored, unpacked, words_of

# Symbols of the language model: everything that is no letter, a to z, and other letters.
SYMBOLS = 28
_GAP, _OTHER = 0, 27
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
# What a sign can stand for. An asterisk can stand for any letter.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "€": "e", "*": _LETTERS,
}
SEPARATORS = frozenset(".-_~'/,: \t\n\r\x0b\x0c")
# The channel, as log-probabilities.
SUBSTITUTED = -1.0
MASKED = -1.5
UNMASKED = -7.0
LITERAL = -12.0
# More asterisks than that in a row are a line, and hide no letters.
MAX_MASK = 32
# Log-odds that these signs are punctuation where a span starts or ends.
MARKS = {"!": 1.5, "|": 1.5, "+": 0.0, "*": 3.0}
REPEATED = -0.3
DOUBLED = -8.0
SPACED = -0.5
# Decoded spans that a worker keeps, and their longest; longer ones are decoded each time.
MAX_KEPT = 100_000
KEPT_SPAN = 64
# Beginnings and ends of spans whose part of the decoding a worker keeps.
MAX_SHARED = 2_000
# Labelled documents that the words are learned from, at most: those with the smallest hashed ids.
LABELLED_SAMPLE = 50_000
# Learned words at most, documents that a word must be in, and evidence beyond what chance gives among all words.
MAX_WORDS = 2_000
MIN_DOCS = 3
# Smallest hashes in which documents must agree to count as one.
AGREEING = 4
EVIDENCE = 6.0
# Letters of a learned word that is found anywhere in a run of lone letters, at least.
RUN_WORD = 4

_LETTER = r"[^\W\d_]"
_SIGN = r"0-9@$!|+€*"
_SIGNS = "0123456789@$!|+€*"
# Places where a span looks disguised: a sign beside a letter, separators between letters, or quotes around one. All
# begin with a rare character, so that other text is passed over at once; a letter three times is looked for apart.
_DISGUISED = re.compile(
    rf"[{_SIGN}._~'-](?:(?<=[{_SIGN}])(?:(?<={_LETTER}.)|(?={_LETTER}))"
    rf"|(?<={_LETTER}[._~-])[{_SIGN}._~-]*{_LETTER}|(?<={_LETTER}'){_LETTER}'{_LETTER})"
)
# Three or more letters or signs on their own, whatever blanks, line ends and separators are between them.
_LONE = rf"(?:{_LETTER}|[{_SIGN}])"
_LONE_LETTERS = re.compile(rf"(?<![\w@$€])(?<!\w[._~'-]){_LONE}(?:[\s._~'/,:-]++{_LONE}(?![!*+|]*[\w@$€])){{2,}}+")
_BLANK = re.compile(r"\s")
# Letters with asterisks inside, most of them letters.
_MASKED = re.compile(rf"{_LETTER}+(?:\*{_LETTER}+)+")
_MASK_LINE = re.compile(rf"\*{{{MAX_MASK + 1},}}")
# Characters that take no space.
_INVISIBLE = re.compile("[\u00ad\u200b\u200c\u200d\u2060\ufeff]+")
_WORD = re.compile(r"[^\W\d_]+")
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in LEET)
_OUTER = _EDGES + "".join(MARKS) + " \t\n\r\x0b\x0c"


def _symbol_of_byte() -> np.ndarray:
    """Symbol of each byte of lower-cased UTF-8: a letter beyond ASCII counts once, by its first byte."""
    table = np.zeros(256, np.int64)
    for i, c in enumerate(_LETTERS):
        table[ord(c)] = table[ord(c.upper())] = i + 1
    table[0xC3:0xF5] = _OTHER
    table[0x80:0xC0] = -1
    return table


_SYMBOL = _symbol_of_byte()


def count_trigrams(texts: Iterator[bytes]) -> np.ndarray:
    """Trigrams of symbols, gaps collapsed, with gaps around each text: SYMBOLS**3 counts."""
    counts = np.zeros(SYMBOLS**3, np.int64)
    for text in texts:
        symbols = _SYMBOL[np.frombuffer(b"  " + text + b" ", np.uint8)]
        symbols = symbols[symbols >= 0]
        inside = np.ones(len(symbols), bool)
        inside[1:] = (symbols[1:] != _GAP) | (symbols[:-1] != _GAP)
        symbols = symbols[inside]
        grams = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
        counts += np.bincount(grams, minlength=SYMBOLS**3)
    return counts


def corpus_trigrams(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """``gram, n`` over all documents: each task sends its counts once, at most SYMBOLS**3 of them."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            total += count_trigrams(batch["body"])
        (seen,) = np.nonzero(total)
        yield pd.DataFrame({"gram": seen, "n": total[seen]})

    bodies = docs.select(F.encode(F.coalesce(F.col(f"`{text}`"), F.lit("")), "UTF-8").alias("body"))
    return bodies.mapInPandas(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))


#: Score and reading by pair of last symbols.
Best = dict[tuple[int, int], tuple[float, tuple | None]]


def _symbol(text: str) -> int | None:
    """Symbol of a piece of a reading; None if it is empty."""
    if not text:
        return None
    return _GAP if text == " " else ord(text) - 96 if text in _LETTERS else _OTHER


class Tail:
    """Scores of the best completions from all states, and which edges they take."""

    def __init__(self, value: list[list[float]], steps: list[tuple[list[tuple[str, float]], np.ndarray]]) -> None:
        self.value = value
        self.steps = steps

    def read(self, a: int, b: int) -> str:
        pieces = []
        for edges, choice in self.steps:
            text = edges[choice[a, b]][0]
            symbol = _symbol(text)
            if symbol is None or (symbol == _GAP and b == _GAP):
                continue
            pieces.append(text)
            a, b = b, symbol
        return "".join(pieces)


class Channel:
    """Restores disguised spans of a text."""

    def __init__(self, counts: np.ndarray) -> None:
        self.counts = counts
        three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(float)
        # Witten-Bell style backing off: to bigrams, to single symbols, to all alike.
        one = three.sum(axis=(0, 1)) + 1.0
        one /= one.sum()
        two = three.sum(axis=0) + 20.0 * one
        two /= two.sum(axis=1, keepdims=True)
        three = three + 20.0 * two
        log = np.log(three / three.sum(axis=2, keepdims=True))
        self.scores = log
        self.log = log.tolist()
        self.masked = log[:, :, 1 : 1 + len(_LETTERS)]
        self.kept: dict[str, str] = {}
        self.begun: dict[str, Best] = {}
        self.tails: dict[str, Tail] = {}

    @staticmethod
    def _edges(span: str, at: int) -> list[tuple[str, float]]:
        """What one character of the span can mean: text and log-probability. Empty text leaves it out."""
        c = span[at]
        left_out = []
        if at > 0 and span[at - 1] == c:
            # Letters are doubled as a matter of course, but not written three times.
            long_run = span[max(0, at - 2) : at + 2].count(c) > 2
            left_out = [("", REPEATED if long_run else DOUBLED)]
        if c in _LETTERS:
            return [(c, 0.0), *left_out]
        if c == "*":
            return [(letter, MASKED) for letter in _LETTERS] + [("", UNMASKED)]
        if c in LEET:
            return [(letter, SUBSTITUTED) for letter in LEET[c]] + [(" ", LITERAL), *left_out]
        if c in SEPARATORS or c.isspace():
            return [("", SPACED), (" ", SPACED)]
        return [(c, 0.0), *left_out] if c.isalpha() else [(" ", 0.0)]

    def decode(self, span: str) -> str:
        """The most likely reading of a span, by Viterbi decoding over pairs of symbols.

        Most spans are a word with signs around it. Signs at the end are read
        by a table of the best completion from every state, and what signs at
        the beginning lead to is kept with the letters after them; both are exact.
        """
        known = self.kept.get(span)
        if known is not None:
            return known
        head, tail = len(span) - len(span.lstrip(_OUTER)), len(span.rstrip(_OUTER))
        # Beyond that, the edges of the first characters do not depend on what follows.
        key, start = span[: head + 3], min(head + 2, tail)
        best = self.begun.get(key) if head and head + 3 <= tail else None
        if best is None:
            best = self._steps({(_GAP, _GAP): (0.0, None)}, span, 0, start, head, tail)
            if head and head + 3 <= tail:
                if len(self.begun) >= MAX_SHARED:
                    self.begun.clear()
                self.begun[key] = best
        best = self._steps(best, span, start, tail, head, tail)
        end = self._tail(span, tail)
        most = max(score + end.value[a][b] for (a, b), (score, _) in best.items())
        found = max(
            self._spelled(read) + end.read(a, b)
            for (a, b), (score, read) in best.items()
            if score + end.value[a][b] == most
        )
        if len(span) <= KEPT_SPAN:
            if len(self.kept) >= MAX_KEPT:
                self.kept.clear()
            self.kept[span] = found
        return found

    def _outer_edges(self, span: str, at: int) -> list[tuple[str, float]]:
        """Edges of a character where the span starts or ends: there, some signs are punctuation as a rule."""
        edges = self._edges(span, at)
        return [*edges, (" ", MARKS[span[at]])] if span[at] in MARKS else edges

    def _steps(self, best: Best, span: str, start: int, stop: int, head: int, tail: int) -> Best:
        """States after the characters from ``start`` to ``stop``.

        Readings are chains of pieces from the last one back: long spans share them instead of copying text.
        """
        for at in range(start, stop):
            edges = self._edges(span, at) if head <= at < tail else self._outer_edges(span, at)
            after: Best = {}
            if span[at] == "*" and len(best) > len(_LETTERS):
                after = self._any_letter(best)
                edges = edges[len(_LETTERS) :]
            for text, cost in edges:
                symbol = _symbol(text)
                for (a, b), (score, read) in best.items():
                    if symbol is None or (symbol == _GAP and b == _GAP):
                        state, total, longer = (a, b), score + cost, read
                    else:
                        state, total, longer = (b, symbol), score + cost + self.log[a][b][symbol], (read, text)
                    if state not in after or total > after[state][0]:
                        after[state] = (total, longer)
            best = after
        return best

    def _tail(self, span: str, tail: int) -> Tail:
        """The best completions of what stands after the last letter or inner sign of a span."""
        signs = span[tail:]
        known = self.tails.get(signs)
        if known is not None:
            return known
        value = self.scores[:, :, _GAP].copy()
        value[:, _GAP] = 0.0
        steps = []
        for at in range(len(span) - 1, tail - 1, -1):
            edges = self._outer_edges(span, at)
            options = np.stack([self._after_edge(value, text, cost) for text, cost in edges])
            steps.append((edges, options.argmax(axis=0)))
            value = options.max(axis=0)
        found = Tail(value.tolist(), steps[::-1])
        if len(signs) <= KEPT_SPAN:
            if len(self.tails) >= MAX_SHARED:
                self.tails.clear()
            self.tails[signs] = found
        return found

    def _after_edge(self, value: np.ndarray, text: str, cost: float) -> np.ndarray:
        """Score of all states if the next character is read as ``text``, by that of the states it leads to."""
        symbol = _symbol(text)
        if symbol is None:
            return value + cost
        found = self.scores[:, :, symbol] + value[:, symbol] + cost
        if symbol == _GAP:
            found[:, _GAP] = value[:, _GAP] + cost
        return found

    def _any_letter(self, best: Best) -> Best:
        """The step for an asterisk that hides a letter, from all states at once."""
        scores = np.full((SYMBOLS, SYMBOLS), -np.inf)
        for (a, b), (score, _) in best.items():
            scores[a, b] = score
        totals = (scores + MASKED)[:, :, None] + self.masked
        came, most = totals.argmax(axis=0).tolist(), totals.max(axis=0).tolist()
        return {
            (b, i + 1): (most[b][i], (best[came[b][i], b][1], letter))
            for b in sorted({b for _, b in best})
            for i, letter in enumerate(_LETTERS)
        }

    @staticmethod
    def _spelled(read: tuple | None) -> str:
        pieces = []
        while read is not None:
            read, piece = read
            pieces.append(piece)
        return "".join(reversed(pieces))

    def restore(self, text: str, runs: list[str] | None = None, spans: list[str] | None = None) -> str:
        """The text in lower case with its disguised spans restored.

        ``runs`` gets the letters of each run of lone ones, and ``spans`` what was decoded.
        """
        text = _MASK_LINE.sub(" ", _INVISIBLE.sub("", text.lower()))
        parts, at = [], 0
        for start, end, lone in self._spans(text):
            if start < at:
                continue
            span = text[start:end].strip(_EDGES)
            found = f" {self.decode(span)} " if span.strip(_OUTER) else text[start:end]
            if lone and runs is not None:
                runs.append("".join(found.split()))
            if spans is not None:
                spans.append(span)
            parts += [text[at:start], found]
            at = end
        parts.append(text[at:])
        return "".join(parts)

    @staticmethod
    def _marked(text: str) -> list[tuple[int, int]]:
        """Starts and ends of places that look disguised, in order."""
        found = [match.span() for match in _DISGUISED.finditer(text)]
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        (thrice,) = np.nonzero((codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]))
        found += [(i, i + 3) for i in thrice.tolist() if text[i].isalpha()]
        return sorted(found)

    @staticmethod
    def _spans(text: str) -> list[tuple[int, int, bool]]:
        spans, at = [], 0
        marked, k = Channel._marked(text), 0
        for run in (*_LONE_LETTERS.finditer(text), None):
            stop = run.start() if run else len(text)
            while k < len(marked) and marked[k][0] < stop:
                start, end = marked[k]
                k += 1
                # A place grows to all that stands between blanks, once.
                if start < at:
                    continue
                while start > at and not text[start - 1].isspace():
                    start -= 1
                blank = _BLANK.search(text, min(end, stop), stop)
                at = blank.start() if blank else stop
                spans.append((start, at, False))
            if run:
                at = run.end()
                # Digits with points between them are a number.
                if any(map(str.isalpha, run[0])) or not any(c in "._~'/,:-" for c in run[0]):
                    spans.append((*run.span(), True))
        return spans


@lru_cache(maxsize=2)
def _channel(counts: bytes) -> Channel:
    """The channel of a Python worker: spans that it has decoded are known to all tasks that come after."""
    return Channel(np.frombuffer(counts, np.int64))


def fit_channel(docs: DataFrame, *, text: str = "text") -> Channel:
    """The channel with the language model of all documents. Its SYMBOLS**3 counts come to the driver."""
    counts = np.zeros(SYMBOLS**3, np.int64)
    for row in corpus_trigrams(docs, text=text).collect():
        counts[row["gram"]] = row["n"]
    return Channel(counts)


def restored(docs: DataFrame, channel: Channel, *, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` in lower case and its disguised spans restored; null texts become empty."""
    ship_package(docs.sparkSession)
    counts = channel.counts.tobytes()

    @F.pandas_udf(StringType())
    def restore(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _channel(counts)
        for batch in batches:
            yield pd.Series([own.restore(body) for body in batch], dtype=object)

    rows = packed(docs, restore(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("restored"))
    return rows.select(*unpacked(rows, docs.columns, {text: F.col("restored")}))


def held_out(doc: str = "doc_id") -> Column:
    """Documents whose labels are never learned from. A missing id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc).cast("string"), F.lit(""))) % 5 == 0


def labelled_ids(labels: DataFrame, limit: int = LABELLED_SAMPLE) -> DataFrame:
    """``id, toxic`` of labelled documents to learn from, at most ``limit``: a bounded, repeatable sample."""
    usable = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    one = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select(F.col("doc_id").alias("id"), "toxic")


def learn_words(docs: DataFrame, labels: DataFrame, channel: Channel) -> tuple[float, dict[str, float]]:
    """Bias and weights by word, from the restored texts of labelled documents: naive Bayes on the words that tell.

    A word tells if it is in more toxic documents than expected, and the
    likelihood ratio between its rates in toxic and other documents exceeds what
    the best of that many words reaches by chance. At most MAX_WORDS words and
    their counts come to the driver.
    """
    ship_package(docs.sparkSession)
    counts = channel.counts.tobytes()

    @F.pandas_udf(ArrayType(StringType()))
    def words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _channel(counts)
        for batch in batches:
            yield pd.Series([sorted(set(_WORD.findall(own.restore(body)))) for body in batch], dtype=object)

    # LABELLED_SAMPLE rows of two integers.
    sample = F.broadcast(labelled_ids(labels))
    known = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("id")).drop("id")
    # Copies and near copies agree in their smallest hashes of three words, as a rule, and texts that only share a
    # passage do not. One of them counts, or their words would seem to tell what only a label or two said.
    hashed = known.select("doc_id", "toxic", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("h"))
    threes = F.transform("h", lambda x, i: F.xxhash64(x, F.get("h", i + 1), F.get("h", i + 2)))
    least = F.slice(F.array_sort(F.array_distinct(threes)), 1, AGREEING)
    apart = hashed.groupBy(least.alias("least")).agg(F.min(F.struct("doc_id", "toxic")).alias("one"))
    chosen = stored(apart.select(F.col("one.doc_id").alias("id"), "one.toxic").distinct(), "labelled")
    per_toxic = {r["toxic"]: r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic = sum(n for label, n in per_toxic.items() if label)
    n_clean = sum(n for label, n in per_toxic.items() if not label)
    if not n_toxic or not n_clean:
        return math.log((n_toxic + 0.5) / (n_clean + 1.5)), {}
    bodies = F.coalesce("text", F.lit(""))
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
    seen = picked.select("toxic", F.explode(words(bodies)).alias("word"))
    counted = seen.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).where(F.col("n") >= MIN_DOCS)
    total = n_toxic + n_clean

    def part(observed: Column, expected: Column) -> Column:
        return F.when(observed > 0, observed * F.log(observed / expected)).otherwise(0.0)

    k, n = F.col("k"), F.col("n")
    cells = [
        (k, n * n_toxic / total),
        (n - k, n * n_clean / total),
        (n_toxic - k, (total - n) * n_toxic / total),
        (n_clean - n + k, (total - n) * n_clean / total),
    ]
    ratio = 2 * sum((part(*cell) for cell in cells), F.lit(0.0))
    # Stored, because the number of words comes first, and each text is to be decoded once.
    counted = stored(counted.select("word", "n", "k", ratio.alias("ratio")), "counted")
    limit = 2 * math.log(max(counted.count(), 1)) + EVIDENCE
    more = F.col("k") * total > F.col("n") * n_toxic
    rows = counted.where(more & (F.col("ratio") > limit)).orderBy(F.desc("ratio"), "word").limit(MAX_WORDS).collect()
    bias = math.log(n_toxic / n_clean)
    weights = {}
    for row in rows:
        in_toxic = (min(row["k"], n_toxic) + 0.5) / (n_toxic + 1.0)
        in_clean = (min(row["n"] - row["k"], n_clean) + 0.5) / (n_clean + 1.0)
        absent = math.log((1 - in_toxic) / (1 - in_clean))
        bias += absent
        weights[row["word"]] = math.log(in_toxic / in_clean) - absent
    return bias, weights


def _other_readings(span: str, words: dict[str, float]) -> set[str]:
    """Known words that a span can mean though they are not its likeliest reading.

    That is a word with nothing but signs around it, or one in which each asterisk hides a letter.
    """
    found = set()
    core = span.strip(_OUTER + _SIGNS)
    if core in words:
        found.add(core)
    for match in _MASKED.finditer(span):
        hidden = re.compile(match[0].replace("*", _LETTER))
        found |= {w for w in words if len(w) == len(match[0]) and hidden.fullmatch(w)}
    return found


def score_text(text: str, channel: Channel, bias: float, weights: dict[str, float]) -> float:
    runs: list[str] = []
    spans: list[str] = []
    found = weights.keys() & set(_WORD.findall(channel.restore(text, runs, spans)))
    # Equal blanks between all letters of a sentence do not tell where a word ends.
    found |= {w for w in weights if len(w) >= RUN_WORD and any(w in run for run in runs)}
    for span in spans:
        found |= _other_readings(span, weights)
    return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, bias + sum(weights[w] for w in sorted(found))))))


def toxicity(docs: DataFrame, labels: DataFrame, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``held_out`` (boolean), ``score`` (double, 0 to 1) and ``predicted`` (int).

    Labels are learned only from rows with crc32(id as text) mod 5 not 0;
    ``held_out`` marks the others. ``score`` depends on the text alone, and
    ``predicted`` is 1 if it is at least 0.5.

    Null and empty texts get the score of a text without any telling word.
    Without labels of both kinds no word tells. Repeated rows score alike, and
    an empty table gives an empty table. Input columns with the names of the
    new ones are replaced.
    """
    ship_package(docs.sparkSession)
    corpus = docs.select(F.col(f"`{doc}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    channel = fit_channel(corpus)
    bias, weights = learn_words(corpus, labels, channel)
    counts = channel.counts.tobytes()

    @F.pandas_udf(DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = _channel(counts)
        for batch in batches:
            yield pd.Series([score_text(body, own, bias, weights) for body in batch], dtype="float64")

    rows = packed(docs, F.col(f"`{doc}`").alias("id"), score(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("score"))
    rows = rows.select("row", "score", held_out("id").alias("held_out"))
    made = {c: F.col(c) for c in ("held_out", "score")} | {"predicted": (F.col("score") >= 0.5).cast("int")}
    return rows.select(*unpacked(rows, docs.columns, made))
