from __future__ import annotations

import random

import pytest
from definitions import near_components, signed, simhash, simhash_rows

from lexmill.llm import simhash as S


def test_all_documents(docs, rows):
    found = {tuple(r) for r in S.near_duplicates(docs).collect()}
    assert found == set(simhash_rows(rows("documents")))


def test_odd_rows(odd_docs):
    table = [r.asDict() for r in odd_docs.collect()]
    assert sorted(map(repr, map(tuple, S.near_duplicates(odd_docs).collect()))) == sorted(map(repr, simhash_rows(table)))
    kept = S.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    # The blank texts are one group. Rows of one id stay or go together.
    want = {i for i, _, component in simhash_rows(table) if i == component}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(d["doc_id"]) for d in table if d["doc_id"] in want)
    assert 3 in want and 4 not in want


def test_empty(odd_docs):
    assert S.near_duplicates(odd_docs.where("false")).collect() == []
    assert S.drop_near_duplicates(odd_docs.where("false")).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_links_of_flipped_bits(spark, seed):
    """Chains, dense groups and strangers: every component is found."""
    draw = random.Random(seed)
    prints = []
    for _ in range(30):
        at = draw.getrandbits(64)
        for _ in range(draw.choice([1, 2, 5, 30])):
            prints.append(at)
            flipped = at
            for bit in draw.sample(range(64), draw.randint(0, 5)):
                flipped ^= 1 << bit
            at = flipped if draw.random() < 0.7 else at
    prints = sorted(set(prints), key=signed)
    found = {r.p: r.label for r in S.linked_prints(spark.createDataFrame([(signed(p),) for p in prints], "p bigint")).collect()}
    groups = near_components(prints)
    want = {signed(p): signed(prints[g]) for p, g in zip(prints, groups, strict=True) if groups.count(g) > 1}
    assert found == want


def test_long_texts_in_blocks(monkeypatch):
    text = "alpha beta gamma delta epsilon zeta " * 50
    whole = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "BLOCK", 7)
    assert S.fingerprint(text.encode()) == whole == signed(simhash(text))
