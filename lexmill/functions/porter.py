"""Porter stemming (M. F. Porter, 1980, with the author's later revisions) as a Column expression.

Each step maps a word to a word and reads it several times, so the steps are
chained as ``transform`` calls over an array: the lambda variable is bound once
per step and the expression stays linear in size. The steps are SQL text,
which Spark parses in one go; building them from Column calls takes seconds.

State travels inside the word: ``Y`` is a consonant y, a final ``#`` says that
step 1b took off -ed or -ing, and a final ``.`` shields words that are too short
to stem. Tokens hold only letters, digits and underscores, so the marks cannot
clash.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published rule tables and word-shape patterns.
CONSONANT = "[^aeiouy]"
VOWEL = "[aeiouy]"
MEASURE_OVER_0 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}"
MEASURE_OVER_1 = f"^{CONSONANT}*{VOWEL}+{CONSONANT}+{VOWEL}+{CONSONANT}"
SHORT_END = f"{CONSONANT}{VOWEL}[^aeiouywxY]$"
# Measure 0, or measure 1 with a short end: a stem of one vowel between consonants.
KEEPS_E = f"^({CONSONANT}*{VOWEL}*|{CONSONANT}+{VOWEL}[^aeiouywxY]e)$"
CONSONANT_Y = "(^|[aeiou])y"
DOUBLE_STAYS = "[lsz]$"
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


def _less(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _ends(*suffixes: str) -> str:
    return " OR ".join(f"endswith(w, '{suffix}')" for suffix in suffixes)


def _case(*branches: tuple[str, str]) -> str:
    """The first condition that holds decides; otherwise the word stays."""
    return "CASE " + " ".join(f"WHEN {test} THEN {result}" for test, result in branches) + " ELSE w END"


def _over_0(stem: str) -> str:
    return f"{stem} RLIKE '{MEASURE_OVER_0}'"


def _over_1(stem: str) -> str:
    return f"{stem} RLIKE '{MEASURE_OVER_1}'"


def _first_suffix(
    rules: Sequence[tuple[str, str]], condition: Callable[[str, str], str], shortest_stem: int
) -> str:
    """The first matching suffix decides, also when its condition then fails.

    Suffixes with different final letters exclude each other, so the rules are
    grouped by final letter and most words fail after a few one-letter tests.
    Words too short for the condition to hold skip even those.
    """
    groups: dict[str, list[tuple[str, str]]] = {}
    for suffix, new in rules:
        stem = _less(len(suffix))
        replaced = f"concat({stem}, '{new}')" if new else stem
        groups.setdefault(suffix[-1], []).append((_ends(suffix), _case((condition(stem, suffix), replaced))))
    shortest = min(len(suffix) for suffix, _ in rules) + shortest_stem
    by_letter = [(_ends(letter), _case(*group)) for letter, group in groups.items()]
    return _case((f"length(w) < {shortest}", "w"), *by_letter)


def _replaceable(stem: str, suffix: str) -> str:
    return _over_0(stem)


def _droppable(stem: str, suffix: str) -> str:
    return f"{_over_1(stem)} AND {stem} RLIKE '[st]$'" if suffix == "ion" else _over_1(stem)


def _plural_and_mark() -> str:
    ends_in_s = _case((_ends("sses", "ies"), _less(2)), (_ends("ss"), "w"), ("true", _less(1)))
    singular = _case((_ends("s"), ends_in_s))
    # Marking looks at the letters before a y only, so it can come after the plural.
    marked = f"replace(regexp_replace({singular}, '{CONSONANT_Y}', '$1Y'), 'yy', 'yY')"
    return f"CASE WHEN length(w) <= 2 THEN concat(w, '.') WHEN contains(w, 'y') THEN {marked} ELSE {singular} END"


def _past() -> str:
    def cut(n: int) -> str:
        return _case((f"{_less(n)} RLIKE '{VOWEL}'", f"concat({_less(n)}, '#')"))

    ends_in_eed = _case((_over_0(_less(3)), _less(1)))
    return _case((_ends("ed"), f"if({_ends('eed')}, {ends_in_eed}, {cut(2)})"), (_ends("ing"), cut(3)))


def _repair() -> str:
    stem = _less(1)
    with_e = f"concat({stem}, 'e')"
    # A consonant Y after a vowel y is a double letter, too.
    doubled = f"lower(substring(w, -2, 1)) = substring(w, -3, 1) AND {stem} RLIKE '{CONSONANT}$'"
    short = f"{_over_0(stem)} AND NOT {_over_1(stem)} AND {stem} RLIKE '{SHORT_END}'"
    return _case(
        (
            _ends("#"),
            _case(
                (_ends("at#", "bl#", "iz#"), with_e),
                (doubled, f"if({stem} RLIKE '{DOUBLE_STAYS}', {stem}, {_less(2)})"),
                (short, with_e),
                ("true", stem),
            ),
        )
    )


def _final_y() -> str:
    return _case((_ends("y", "Y"), _case((f"{_less(1)} RLIKE '{VOWEL}'", f"concat({_less(1)}, 'i')"))))


def _final_e() -> str:
    return _case((_ends("e"), _case((f"NOT w RLIKE '{KEEPS_E}'", _less(1)))))


def _final_l_and_unmark() -> str:
    drop_l = f"{_ends('ll')} AND {_over_1('w')}"
    return f"CASE WHEN {_ends('.')} THEN {_less(1)} WHEN {drop_l} THEN lower({_less(1)}) ELSE lower(w) END"


STEPS = [
    _plural_and_mark(),
    _past(),
    _repair(),
    _final_y(),
    _first_suffix(STEP_2, _replaceable, 2),
    _first_suffix(STEP_3, _replaceable, 2),
    _first_suffix([(suffix, "") for suffix in STEP_4], _droppable, 4),
    _final_e(),
    _final_l_and_unmark(),
]


def may_stem_to(word: Column, stems: Sequence[str]) -> Column:
    """False for words that have none of the stems, from their first letters: most words need not be stemmed.

    Every step drops an ending or puts one in its place that differs in its last
    letter at most: ``i`` for ``y``, an added ``e``, or what is left of ``ble``
    for ``biliti``. So a word starts with its stem, or with all of it but an
    ``i``, ``e`` or ``l`` at the end.
    """
    beginnings: dict[int, set[str]] = {}
    for stem in stems:
        start = stem[:-1] if stem[-1:] in ("i", "e", "l") else stem
        beginnings.setdefault(len(start), set()).add(start)
    if 0 in beginnings:
        return F.lit(True)
    found = F.lit(False)
    for length, starts in sorted(beginnings.items()):
        found = found | F.substring(word, 1, length).isin(*sorted(starts))
    return found


def porter_array(words: str) -> Column:
    """Stem every element of an array column, given by name, of lowercase words."""
    stems = f"`{words}`"
    for step in STEPS:
        stems = f"transform({stems}, w -> {step})"
    return F.expr(stems)


def porter(word: str) -> Column:
    """Stem a string column, given by name, of lowercase words."""
    stems = f"array(`{word}`)"
    for step in STEPS:
        stems = f"transform({stems}, w -> {step})"
    return F.expr(f"{stems}[0]")
