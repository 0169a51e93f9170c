from __future__ import annotations

import pytest
import xxhash
from definitions import likeness, order_minhash, sha

from lexmill.llm import order_minhash as O


def spark_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text, seed=42) - (1 << 64) * (xxhash.xxh64_intdigest(text, seed=42) >> 63)


def as_text(slots: dict[int, int]) -> str:
    return "".join(f"{slots[s]:04x}" if s in slots else "----" for s in range(O.BINS))


def check(found: list, texts: list[tuple]) -> None:
    """``texts``: id and text, in descending order."""
    by_id = {r.doc_id: r for r in found}
    for i, (doc_id, text) in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = order_minhash(text), order_minhash(edited)
        row = by_id[doc_id]
        assert (row.n_chars, row.edited_sha256) == (len(text), sha(edited))
        assert (row.fingerprint, row.edited_fingerprint) == (as_text(own), as_text(changed))
        assert row.near_edited == pytest.approx(likeness(own, changed))
        assert row.near_next == pytest.approx(likeness(own, order_minhash(after)))


@pytest.mark.parametrize("block", [7, 4096])
def test_all_documents(docs, rows, monkeypatch, block):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    texts = sorted(((d["doc_id"], d["text"]) for d in rows("documents")), reverse=True)
    found = O.fingerprints(docs).collect()
    assert len(found) == len(texts)
    check(found, texts)


def test_odd_rows(spark, odd_docs):
    once = odd_docs.where("doc_id IS NULL OR doc_id NOT IN (2, 9)")
    texts = [(r.doc_id, r.text) for r in once.collect()]
    texts.sort(key=lambda x: x[0] if x[0] is not None else 1 << 62, reverse=True)
    check(O.fingerprints(once).collect(), texts)
    assert O.fingerprints(odd_docs).count() == odd_docs.count()
    assert O.fingerprints(odd_docs.where("false")).collect() == []
    (alone,) = O.fingerprints(odd_docs.where("doc_id = 1")).collect()
    assert alone.near_next == 1.0


def test_frequent_ids_and_rows(spark, monkeypatch):
    """Null ids, an id that repeats, and rows that repeat as a whole, each more often than a block has rows."""
    monkeypatch.setattr(O, "BLOCK_ROWS", 7)
    text = lambda i: " ".join(f"w{(i * i + j) % 97}" for j in range(30))
    rows = [(i, text(i)) for i in range(60)] + [(None, text(i)) for i in range(100, 160)]
    rows += [(30, text(i)) for i in range(200, 240)] + [(30, "one two three four")] * 50 + [(None, None)] * 20 + [(7, "")] * 9
    rows.sort(key=lambda r: (-(r[0] if r[0] is not None else O.LAST_ID), spark_hash(r[1] or "")))
    want = []
    for i, (doc_id, body) in enumerate(rows):
        body, after = body or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(body) // 2
        edited = body[: len(body) - half] + after[:half]
        near = likeness(order_minhash(body), order_minhash(after))
        want.append((str(doc_id), sha(edited), as_text(order_minhash(body)), round(near, 9)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = O.fingerprints(docs).collect()
    got = [(str(r.doc_id), r.edited_sha256, r.fingerprint, round(r.near_next, 9)) for r in found]
    assert sorted(got) == sorted(want)
    # No piece is much larger than a block, and rows of whole copies stand there once.
    placed, repeated = O._in_blocks(docs)
    sizes = [r["count"] for r in placed.groupBy("block", "piece").count().collect()]
    assert max(sizes) <= 3 * 7 and sum(sizes) == len(rows) - 49 - 19 - 8
    assert [r.times for r in repeated.orderBy("times").collect()] == [1, 5, 7, 7, 7, 7, 7, 7, 7, 7, 7, 7]


def test_order_counts(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[200:] + words[:200]), " ".join(reversed(words)), " ".join(words[:390])]
    found = O.with_signature(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), "text", "sig")
    a, moved, turned, cut = (
        {v >> O.SLOT_BITS: v & 0xFFFF for v in r.sig} for r in found.orderBy("doc_id").collect()
    )
    assert likeness(a, cut) > 0.8 > 0.7 > likeness(a, moved) > likeness(a, turned) == 0.0


@pytest.mark.parametrize("n", [20, 40, 150, 800])
def test_order_counts_in_short_texts(spark, n):
    """Half of all pairs of k-mers keep their order when halves change places."""
    texts = []
    for t in range(40):
        words = [f"w{t}x{i}" for i in range(n)]
        texts += [(2 * t, " ".join(words)), (2 * t + 1, " ".join(words[n // 2 :] + words[: n // 2]))]
    found = O.with_signature(spark.createDataFrame(texts, "doc_id bigint, text string"), "text", "sig").collect()
    slots = {r.doc_id: {v >> O.SLOT_BITS: v & 0xFFFF for v in r.sig} for r in found}
    mean = sum(likeness(slots[2 * t], slots[2 * t + 1]) for t in range(40)) / 40
    assert 0.3 < mean < 0.56


def test_no_python(docs):
    plan = O.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
