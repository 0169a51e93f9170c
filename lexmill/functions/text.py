"""Tokenizers and text helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The token separators and token filters of the five presets,
# the line terminators, and the characters that a field is trimmed of.
ALPHA = r"[^a-zA-Z]+"
WORD_APOSTROPHE = r"[^\w']+"
NON_WORD = r"\W+"
ALNUM = r"[^a-z0-9]+"
ALL_LETTERS = r"^[a-zA-Z]+$"
ALL_DIGITS = r"^[0-9]+$"
LINE_END = r"\r\n|\r|\n"
BLANKS_AT_ENDS = r"^[\x00-\x20]+|[\x00-\x20]+$"


@dataclass(frozen=True)
class TokenProfile:
    """How a text becomes tokens: separator, case, and which tokens stay."""

    separator: str
    lowercase: bool = True
    min_len: int = 1
    keep: str | None = None
    drop: str | None = None
    min_stem_len: int = 1


WORDCOUNT = TokenProfile(ALPHA, min_len=2)
WORDCOUNT_CASED = TokenProfile(ALPHA, lowercase=False, min_len=2)
PAIRS = TokenProfile(ALPHA)
STRIPES = TokenProfile(WORD_APOSTROPHE)
DF = TokenProfile(NON_WORD, keep=ALL_LETTERS)
TF = TokenProfile(ALNUM, min_len=2, drop=ALL_DIGITS, min_stem_len=2)


def trim_blanks(col: Column) -> Column:
    """Strip every character up to U+0020 from both ends (``trim`` strips only spaces)."""
    return F.regexp_replace(col, BLANKS_AT_ENDS, "")


def whole_number(col: Column) -> Column:
    """A 64-bit integer in decimal digits with an optional sign and blanks around it; null for anything else."""
    digits = trim_blanks(col)
    return F.when(digits.rlike(r"^[+-]?[0-9]+$"), digits.try_cast("bigint"))


def split_lines(text: Column) -> Column:
    """The lines of a text, ended by any of the three terminators.

    A single character splits without the regex engine, so the others are replaced first.
    """
    unix = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.split(unix, "\n")


def raw_tokens(text: Column, profile: TokenProfile) -> Column:
    """All tokens, empty ones included: the index in this array is the token's position."""
    return F.split(F.lower(text) if profile.lowercase else text, profile.separator)


def token_ok(token: Column, profile: TokenProfile, stop: Sequence[str] = ()) -> Column:
    """The token filters of a profile and a stop list, cheapest first."""
    ok = F.length(token) >= profile.min_len if profile.min_len > 1 else token != ""
    if stop:
        ok = ok & ~token.isin(*stop)
    if profile.keep:
        ok = ok & token.rlike(profile.keep)
    if profile.drop:
        ok = ok & ~token.rlike(profile.drop)
    return ok


def token_array(
    text: Column, profile: TokenProfile, stop: Sequence[str] = (), *, distinct: bool = False
) -> Column:
    """The filtered tokens of one row as an array, in order; with ``distinct`` each one once."""
    tokens = raw_tokens(text, profile)
    return F.filter(F.array_distinct(tokens) if distinct else tokens, lambda token: token_ok(token, profile, stop))


def explode_tokens(
    df: DataFrame,
    profile: TokenProfile,
    *,
    text: str = "text",
    keep: Sequence[str] = (),
    out: str = "word",
    stop: Sequence[str] = (),
) -> DataFrame:
    """One row per token that passes the profile's filters, with the ``keep`` columns."""
    rows = df.select(*keep, F.explode(raw_tokens(F.col(text), profile)).alias(out))
    return rows.where(token_ok(F.col(out), profile, stop))


def _run_ends(df: DataFrame, items: Column, keep: Sequence[str]) -> DataFrame:
    """``keep``, the sorted ``_items`` and the index ``_ends`` after each run of equal ones.

    Both arrays are read more than once, so they are columns.
    """
    rows = df.select(*keep, F.sort_array(items).alias("_items"))
    ends = F.filter(
        F.transform("_items", lambda x, i: F.when(~x.eqNullSafe(F.get("_items", i + 1)), i + 1)),
        lambda i: i.isNotNull(),
    )
    return rows.select(*keep, "_items", ends.alias("_ends"))


def _run_counts(name: str, count: str) -> Column:
    """``array<struct<name, count>>`` from the columns of ``_run_ends``."""
    return F.transform(
        "_ends",
        lambda end, i: F.struct(
            F.get("_items", end - 1).alias(name),
            (end - F.coalesce(F.get("_ends", i - 1), F.lit(0))).cast("bigint").alias(count),
        ),
    )


def run_counts(
    df: DataFrame, items: Column, *, name: str, count: str, keep: Sequence[str] = ()
) -> tuple[DataFrame, Column]:
    """Rows, and the array expression over them that holds each distinct element with its count, in order."""
    return _run_ends(df, items, keep), _run_counts(name, count)


def explode_runs(df: DataFrame, items: Column, *, name: str, count: str, keep: Sequence[str] = ()) -> DataFrame:
    """Count equal elements of an array inside the row: one row per distinct element.

    The elements are sorted and counted by run length, so the cost is that of
    the sort and nothing is shuffled. The counts go into ``inline`` as an
    expression: from a column Spark would infer a filter, push it down and
    compute the array twice.
    """
    rows, cells = run_counts(df, items, name=name, count=count, keep=keep)
    return rows.select(*keep, F.inline(cells))


def add_runs(
    df: DataFrame, cells: Column, *, name: str, count: str, keep: Sequence[str] = ()
) -> tuple[DataFrame, Column]:
    """As ``run_counts`` for elements that have counts already: those of equal elements add up."""
    rows = df.select(*keep, F.sort_array(cells).alias("_items"))
    ends = F.filter(
        F.transform("_items", lambda x, i: F.when(~x[name].eqNullSafe(F.get("_items", i + 1)[name]), i + 1)),
        lambda i: i.isNotNull(),
    )
    rows = rows.select(*keep, "_items", ends.alias("_ends"))

    def total(end: Column, i: Column) -> Column:
        start = F.coalesce(F.get("_ends", i - 1), F.lit(0))
        last = F.get("_items", end - 1)
        run = F.slice("_items", start + 1, end - start)
        added = F.aggregate(run, F.lit(0).cast("bigint"), lambda a, x: a + x[count])
        # Most runs are of one element.
        return F.struct(last[name].alias(name), F.when(end - start == 1, last[count]).otherwise(added).alias(count))

    return rows, F.transform("_ends", total)
