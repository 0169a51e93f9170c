from __future__ import annotations

import random

import pytest
import public_tokenizers
import sentencepiece

from lexmill.llm import token_counts as T

MODEL = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(T.MODEL))


def test_all_documents(docs, rows):
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in T.token_counts(docs).drop("text").collect()}
    for d in rows("documents"):
        n = len(MODEL.encode(d["text"]))
        assert found[d["doc_id"]] == (len(d["text"].encode()), n, n > 4096)


def test_odd_rows(odd_docs):
    found = T.token_counts(odd_docs)
    assert set(found.columns) == {*odd_docs.columns, "n_bytes", "n_tokens", "over_limit"}
    for r in found.collect():
        assert (r.n_bytes, r.n_tokens) == (len((r.text or "").encode()), len(MODEL.encode(r.text or "")))
    assert T.token_counts(odd_docs.where("false")).collect() == []


@pytest.mark.parametrize("segment", [1, 2, 7, 50])
def test_boundaries_are_safe(monkeypatch, rows, segment):
    draw = random.Random(segment)
    alphabet = [*map(chr, range(32, 127)), "\n", "\t", "▁", "é", "中", "\U0001f600", " ", "　", *"     "]
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 200))) for _ in range(300)]
    texts += [d["text"][:2000] for d in rows("documents")] + ["a" * 500, " " * 300, "<s>" * 40, "", "▁ ▁", "\n\n a"]
    monkeypatch.setattr(T, "SEGMENT", segment)
    monkeypatch.setattr(T, "BATCH_BYTES", 300)
    counter = T.PieceCounter(public_tokenizers.path(T.MODEL))
    assert counter.counts(iter(texts)) == [len(ids) for ids in MODEL.encode(texts)]
    assert "".join(counter.segments(texts[0])) == texts[0]
