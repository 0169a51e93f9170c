from __future__ import annotations

import hashlib
import re

import pytest
import regex
from pyspark.sql import functions as F

from lexmill.llm import fill_middle as M
from definitions import sha


def definition(doc_id: int | None, text: str | None) -> tuple:
    """Units by a plain pattern, cut and put together as the contract says."""
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    assert prefix + middle + suffix == text
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return len(units), "plain", None, None, text
    if h4 % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_all_documents(docs, rows):
    found = {r.doc_id: r for r in M.fill_middle_report(docs).collect()}
    forms = set()
    for d in rows("documents"):
        n, form, prefix, middle, output = definition(d["doc_id"], d["text"])
        r = found[d["doc_id"]]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, prefix, middle, sha(output))
        assert r.restored_sha256 == sha(d["text"])
        forms.add(form)
    assert forms >= {"psm", "spm"}


def test_odd_rows(odd_docs):
    made = M.fill_middle(odd_docs)
    assert set(made.columns) == {*odd_docs.columns, "output", "form", "n", "prefix_chars", "middle_chars"}
    rows = made.withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == definition(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert M.fill_middle_report(odd_docs.where("false")).collect() == []


TEXTS = [
    "a<P>b", "<M>", "<S>\n", "<P", "P>", "<", "<\n<\n>\n", "<S\n>", "a\n\n\n<", "x\r\ny\x00\n", "<<P", "<P>>\n<P",
    "ab\u2028c\nd\x85e\x0cf", "\U0001f600\né", "\\E\n\\Q$1", "\n",
]


def test_marks_and_line_ends(spark):
    table = spark.createDataFrame([(i, t) for i in range(40) for t in TEXTS], "doc_id bigint, text string")
    made = M.fill_middle(table).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == definition(r.doc_id, r.text)
        assert r.back == r.text


def test_rates_units_and_marks(spark):
    table = spark.range(2000).selectExpr("id AS doc_id", "concat('w', id, ' x y z') AS text")
    some = M.fill_middle(table, rate=30, suffix_first=20, unit=r"\S+\s*|\s+", marks=("[pre]", "[suf]", "[mid]"), seed=3)
    rows = some.withColumn("back", M.restored(F.col("output"), F.col("form"), ("[pre]", "[suf]", "[mid]"))).collect()
    assert all(r.back == r.text and r.n == 4 for r in rows)
    drawn = [r.form for r in rows if r.form != "plain"]
    assert 500 < len(drawn) < 700 and 80 < drawn.count("spm") < 160
    for marks in (("a", "a", "b"), ("", "b", "c"), ("<P>", "><", "c"), ("x", "yx", "z"), ("a", "b")):
        with pytest.raises(ValueError):
            M.fill_middle(table, marks=marks)


def test_long_texts_are_matched_whole():
    whole = regex.compile(rf"((?>{M.LINE_UNIT}))*+")
    text = "some words of a line\n" * 300_000 + "end"
    assert M.cut_points(text, whole, 300_001, 7) == (300_001, 7 * 21, len(text))
    assert M.cut_points("\n" * 500_000, whole, 500_000, 0) == (500_000, 0, 500_000)
    assert M.cut_points("x" * 3_000_000, whole, 0, 1) == (1, 0, 3_000_000)
    assert M.cut_points("", whole, 5, 6) == (0, 0, 0)
