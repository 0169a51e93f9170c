from __future__ import annotations

import duckdb
import pytest
from definitions import WORD, targets

from lexmill.llm import mixing as M


def test_sql(docs, sf_dir):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = connection.sql(M.MIX_SQL)
    found = M.mix_report(docs)
    assert sorted(found.columns) == sorted(want.columns)
    assert sorted(tuple(r[c] for c in want.columns) for r in found.collect()) == sorted(want.fetchall())


def check(found: list, sources: dict) -> None:
    """Targets by their definition, and each source near its own."""
    sizes: dict = {}
    for r in found:
        sizes[sources[r.doc_id]] = sizes.get(sources[r.doc_id], 0) + r.size
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        source = sources[r.doc_id]
        assert r.source_size == sizes[source] and r.target == pytest.approx(want[source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] += r.taken
    longest = max(r.size for r in found)
    assert all(abs(taken[s] - want[s]) <= max(longest, 1) for s in sizes)


def test_targets(docs):
    found = M.mix_report(docs).collect()
    check(found, {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()})
    places = [r.position for r in found if r.position is not None]
    assert places == sorted(places) and 0 <= places[0] and places[-1] <= 1
    assert found == M.mix_report(docs).collect()


def test_odd_rows(odd_docs):
    found = M.mix_report(odd_docs).collect()
    assert len(found) == odd_docs.count()
    sizes = sorted((repr(r.doc_id), len(WORD.findall(r.text or ""))) for r in odd_docs.collect())
    assert sorted((repr(r.doc_id), r.size) for r in found) == sizes
    check(found, {r.doc_id: r.source for r in odd_docs.collect()})
    taken = M.mix(odd_docs)
    assert taken.columns == odd_docs.columns
    assert sum(len(WORD.findall(r.text or "")) for r in taken.collect()) == sum(r.taken for r in found)
    assert M.mix(odd_docs.where("false")).collect() == M.mix_report(odd_docs.where("false")).collect() == []


def test_one_source_and_empty_texts(spark):
    one = spark.createDataFrame([(i, "a b c", "s") for i in range(100)], "doc_id bigint, text string, source string")
    assert sum(r.taken for r in M.mix_report(one).collect()) == 450
    blank = one.selectExpr("doc_id", "'' AS text", "source")
    assert {(r.target, r.taken) for r in M.mix_report(blank).collect()} == {(0.0, 0)}


def test_curriculum(spark):
    """A source whose weight rises comes later than one whose weight falls."""
    sized = spark.range(3000).selectExpr("id AS d", "concat('s', id % 3) AS source", "3L AS size")
    found = M.curriculum(sized).selectExpr("source", "explode(positions) AS position").groupBy("source").avg("position")
    mean = {r.source: r["avg(position)"] for r in found.collect()}
    assert mean["s2"] < 0.45 < mean["s1"] < 0.55 < mean["s0"]
    share = 0.3
    for tilt in (-0.5, 0.0, 0.5):
        t = spark.range(1).select(M._time(M.F.lit(share), M.F.lit(tilt))).first()[0]
        assert (1 - tilt) * t + tilt * t * t == pytest.approx(share)
