from __future__ import annotations

import math
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill.llm import merkle as M
from definitions import sha

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf(row: dict) -> str:
    values = [None if row[f] is None else str(row[f]) for f in FIELDS]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def climb(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each node the siblings left and right on its way up."""
    paths = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        for at in range(len(nodes)):
            run = at // 3 * 3
            left, right = "".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])
            for i in below[at]:
                paths[i].append((left, right))
        below = [sum(below[k : k + 3], []) for k in range(0, len(nodes), 3)]
        nodes = [sha("".join(nodes[k : k + 3])) for k in range(0, len(nodes), 3)]
    return nodes[0], paths


def definition(docs: list[dict]) -> list[tuple]:
    groups = defaultdict(list)
    for d in docs:
        groups[b"" if d["source"] is None else b"." + d["source"].encode()].append(d)
    order = sorted(groups)
    trees = {}
    for g in order:
        groups[g].sort(key=lambda d: (math.inf if d["doc_id"] is None else d["doc_id"], leaf(d)))
        trees[g] = climb([leaf(d) for d in groups[g]])
    root, over = climb([trees[g][0] for g in order]) if order else ("", [])
    out = []
    for g, above in zip(order, over, strict=True):
        for d, own in zip(groups[g], trees[g][1], strict=True):
            path = own + above
            even = zlib.crc32(str("" if d["doc_id"] is None else d["doc_id"]).encode()) % 2 == 0
            at = leaf(d | {"text": d["text"].replace("\n", "")}) if even and d["text"] is not None else leaf(d)
            for left, right in path:
                at = sha(left + at + right)
            proof = sha("".join(a + b for a, b in path))
            out.append((d["doc_id"], leaf(d), trees[g][0], root, proof, at, at == root))
    return out


def report(docs) -> list[tuple]:
    return sorted((tuple(r) for r in M.manifest_report(docs).collect()), key=repr)


@pytest.mark.parametrize("tier", [1, 2, 6])
def test_all_documents(monkeypatch, docs, rows, tier):
    monkeypatch.setattr(M, "TIER", tier)
    found = report(docs)
    assert found == sorted(definition(rows("documents")), key=repr)
    verified = {r[0]: r[-1] for r in found}
    assert 0 < sum(verified.values()) < len(verified)
    for d in rows("documents"):
        intact = zlib.crc32(str(d["doc_id"]).encode()) % 2 or "\n" not in d["text"]
        assert verified[d["doc_id"]] == bool(intact)


def test_odd_rows(odd_docs):
    whole = odd_docs.withColumn("lang", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("bigint"))
    rows = [r.asDict() for r in whole.collect()]
    assert report(whole) == sorted(definition(rows), key=repr)
    assert report(whole.where("false")) == []
    assert M.manifest(whole).columns == ["doc_id", "source", "leaf", "presented", "path", "subroot", "root"]


def test_one_row_has_no_siblings(docs):
    (row,) = M.manifest_report(docs.limit(1)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("")


@pytest.mark.parametrize("n", [2, 3, 4, 9, 10, 28, 82])
def test_sizes(spark, n):
    made = spark.range(n).selectExpr(
        "id AS doc_id", "if(id % 7 < 5, 'hot', concat('s', id)) AS source", "'xx' AS lang", "id AS n_chars", "'a\nb' AS text"
    )
    assert report(made) == sorted(definition([r.asDict() for r in made.collect()]), key=repr)


def test_a_hot_group_is_not_one_partition(spark):
    """Places are counted by ranges, not by a window over a group: no window is partitioned by the group alone."""
    made = spark.range(3000).selectExpr("id AS doc_id", "'hot' AS source", "'x' AS lang", "id AS n_chars", "'t' AS text")
    numbered = M._numbered(made.selectExpr("source AS g", "doc_id"), "g", ["doc_id"])
    rows = numbered.collect()
    assert [r.idx for r in sorted(rows, key=lambda r: r.doc_id)] == list(range(3000)) and {r.n for r in rows} == {3000}
    parts = made.selectExpr("source AS g", "doc_id").repartitionByRange(4, "g", "doc_id")
    assert parts.groupBy(F.spark_partition_id()).count().count() == 4
