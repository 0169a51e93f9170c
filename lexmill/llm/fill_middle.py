"""Fill-in-the-middle transformation of whole texts, and its inverse.

Method: repeated-capture matching. One full match of ``(unit)*`` retains every
repetition of its group, so the ends of the captures give the number of units
and both cut offsets without a loop over units.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import packed, ship_package, unpacked

# A line with its end, or what follows the last line end.
LINE_UNIT = r"[^\n]*\n|[^\n]+"
# Before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 7
# Of 100 texts, those that are transformed, and of 100 of these, those with the suffix first.
RATE = 100
SUFFIX_FIRST = 50
PARTS = ("prefix", "suffix", "middle")


def _checked(marks: Sequence[str]) -> tuple[str, str, str]:
    """Marks by which the parts can be told apart again: no mark can begin inside another one."""
    own = tuple(marks)
    clash = any(a.endswith(b[:k]) for a in own for b in own for k in range(1, len(b))) or any(
        a in b for i, a in enumerate(own) for j, b in enumerate(own) if i != j
    )
    if len(own) != 3 or not all(own) or clash:
        raise ValueError(f"three marks that do not overlap are needed, not {own}")
    return own


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the hashed seed and key; a null key counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def cut_points(text: str, whole: regex.Pattern, first: int, second: int) -> tuple[int, int, int]:
    """Units of a text, and the code points after which prefix and middle end, drawn by two numbers."""
    match = whole.fullmatch(text)
    if match is None:
        raise ValueError("the units do not cover the text")
    ends = match.ends(1)
    a, b = first % (len(ends) + 1), second % (len(ends) + 1)
    a, b = min(a, b), max(a, b)
    return len(ends), ends[a - 1] if a else 0, ends[b - 1] if b else 0


def fill_middle(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    unit: str = LINE_UNIT,
    marks: Sequence[str] = MARKS,
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
) -> DataFrame:
    """``docs`` with ``output``, ``form``, ``n``, ``prefix_chars`` and ``middle_chars``.

    A text of ``n`` units is cut after two drawn numbers of units into prefix,
    middle and suffix. ``form`` tells their order in ``output``: ``psm`` is
    prefix, suffix, middle, and ``spm`` suffix, prefix, middle, each part after
    its mark. A text stays ``plain`` if it is empty, contains a mark, or is not
    drawn by ``rate``. ``prefix_chars`` and ``middle_chars`` are code points,
    null if plain; ``n`` is 64-bit. What is drawn depends on ``seed`` and the
    id alone. ``unit`` is a pattern without groups whose repetitions cover any text.

    A null text counts as empty and gives an empty output with ``n`` 0. A null
    id draws as an empty one. Repeated rows come back alike, rows of equal id
    are drawn alike, and an empty table gives an empty table. Texts of any
    length are matched whole. Input columns with the names of the new ones are
    replaced.
    """
    ship_package(docs.sparkSession)
    own = _checked(marks)
    # No position is given up once matched: units are found in one pass, without stacked ways back.
    pattern = rf"((?>{unit}))*+"

    @F.pandas_udf("output string, form string, n bigint, prefix_chars bigint, middle_chars bigint")
    def transform(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        whole = regex.compile(pattern)
        for batch in batches:
            rows = []
            for body, first, second, third, fourth in zip(*batch, strict=True):
                n, a, b = cut_points(body, whole, first, second)
                if not body or third % 100 >= rate or any(mark in body for mark in own):
                    rows.append((body, "plain", n, None, None))
                    continue
                prefix, middle, suffix = own[0] + body[:a], own[2] + body[a:b], own[1] + body[b:]
                if fourth % 100 < suffix_first:
                    rows.append((suffix + prefix + middle, "spm", n, a, b - a))
                else:
                    rows.append((prefix + suffix + middle, "psm", n, a, b - a))
            made = pd.DataFrame(rows, columns=["output", "form", "n", "prefix_chars", "middle_chars"])
            yield made.astype({c: "Int64" for c in ("n", "prefix_chars", "middle_chars")})

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = packed(docs, transform(body, *draws(F.col(f"`{doc}`"), seed)).alias("made"))
    names = ("output", "form", "n", "prefix_chars", "middle_chars")
    return rows.select(*unpacked(rows, docs.columns, {c: F.col("made").getField(c) for c in names}))


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The exact text from output and form; native. Marks cannot occur inside the parts, so splitting tells them apart."""
    p, s, m = _checked(marks)
    rest = {"psm": F.substring(output, len(p) + 1, 2**31 - 1), "spm": F.substring(output, len(s) + 1, 2**31 - 1)}
    between = {"psm": f"\\Q{s}\\E|\\Q{m}\\E", "spm": f"\\Q{p}\\E|\\Q{m}\\E"}
    parts = {f: F.split(rest[f], between[f], 3) for f in rest}
    order = {"psm": (0, 2, 1), "spm": (1, 2, 0)}
    built = {f: F.concat(*[F.get(parts[f], F.lit(i)) for i in order[f]]) for f in rest}
    return F.when(form == "psm", built["psm"]).when(form == "spm", built["spm"]).otherwise(output)


def fill_middle_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of every document."""
    made = fill_middle(docs.select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.encode("output", "UTF-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(restored(F.col("output"), F.col("form")), "UTF-8"), 256).alias("restored_sha256"),
    )


FILL_MIDDLE_SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS body, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
    FROM documents
), numbers AS (
    SELECT doc_id, body, units, len(units) AS n,
           ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4
    FROM drawn
), cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM numbers
), parts AS (
    SELECT doc_id, body, n, h4,
           coalesce(array_to_string(units[1:a], ''), '') AS prefix,
           coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
           coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix,
           CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') THEN 'plain'
                WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN body ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
