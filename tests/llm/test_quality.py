from __future__ import annotations

import pytest
from definitions import quality_base, quality_llr

from lexmill.llm import quality as Q


@pytest.fixture(scope="module")
def judged(docs, labels):
    return {r.doc_id: r for r in Q.quality_report(docs, labels).collect()}


def test_statistics_and_ratio(judged, rows):
    table = rows("documents")
    trusted = {r["doc_id"] for r in rows("labels") if r["quality"] == 1}
    ratios = quality_llr(table, trusted, Q.BUCKETS, Q.SMOOTHING)
    for d, llr in zip(table, ratios, strict=True):
        row, want = judged[d["doc_id"]], quality_base(d["text"])
        assert {k: row[k] for k in want} == want
        assert row.llr == pytest.approx(llr, abs=1e-9)
        assert row.kept == (not want["base_failed"] and row.llr >= Q.THRESHOLD)


def test_trusted_documents_stay(spark):
    """On a larger table: nearly all that labels call good, and few that they do not."""
    sf = "/root/testdata/sf0.01"
    known = spark.read.parquet(f"{sf}/labels.parquet")
    found = Q.quality_report(spark.read.parquet(f"{sf}/documents.parquet"), known).join(known, "doc_id")
    share = {r.quality: r["avg(x)"] for r in found.where("n_words >= 10").selectExpr("quality", "int(kept) AS x").groupBy("quality").avg("x").collect()}
    assert share[1] > 0.97 and share[0] < 0.1


def test_odd_rows(odd_docs, labels):
    found = Q.quality_rules(odd_docs, labels)
    assert set(odd_docs.columns) < set(found.columns)
    for r in found.collect():
        want = quality_base(r.text)
        assert {k: r[k] for k in want} == want


def test_without_trusted_documents(docs, labels, odd_docs):
    found = Q.quality_report(docs, labels.where("false")).collect()
    assert {r.llr for r in found} == {0.0} and all(r.kept != r.base_failed for r in found)
    assert Q.quality_rules(odd_docs.where("false"), labels).collect() == []


def test_a_filter_does_not_multiply_the_work(docs, labels):
    plan = Q.quality_rules(docs, labels).where("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter (isnotnull(kept") < plan.index("Generate inline")
    assert "Python" not in plan and "Arrow" not in plan
