from __future__ import annotations

from definitions import line_dedup as expected
from definitions import sha

from lexmill.llm.line_dedup import line_dedup, line_dedup_report


def test_all_documents(docs, rows):
    table = rows("documents")
    want = {(d["doc_id"], n, k, sha(t)) for d, (t, n, k) in zip(table, expected(table), strict=True)}
    assert {tuple(r) for r in line_dedup_report(docs).collect()} == want
    assert any(k for _, _, k, _ in want)


def test_odd_rows(odd_docs):
    found = line_dedup(odd_docs)
    assert set(found.columns) == {*odd_docs.columns, "n_lines", "n_dropped"}
    table = [r.asDict() for r in odd_docs.collect()]
    want = sorted((repr(d["doc_id"]), *x) for d, x in zip(table, expected(table), strict=True))
    assert sorted((repr(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in found.collect()) == want
    assert {r.dropped for r in found.collect()} == {"my dropped"}


def test_a_line_of_a_third_of_all_documents(spark):
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'the hot line of many\\n', '') || 'own line number ' || id AS text"
    )
    found = line_dedup(docs).where("text LIKE '%hot line%'").collect()
    assert [r.doc_id for r in found] == [0]


def test_thresholds(spark):
    docs = spark.createDataFrame([(i, "short\na longer line") for i in range(3)], "doc_id bigint, text string")
    assert line_dedup(docs, min_docs=4).where("n_dropped > 0").isEmpty()
    assert {r.text for r in line_dedup(docs, min_chars=3).where("doc_id > 0").collect()} == {""}


def test_no_python_and_empty(docs, odd_docs):
    plan = line_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert line_dedup(odd_docs.where("false")).collect() == []
