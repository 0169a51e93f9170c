from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

from lexmill.llm import piece as P
from definitions import sha

PATH = public_tokenizers.path(P.MODEL)
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def encoded(encoder: P.ChunkEncoder, texts: list[str]) -> list[list[int]]:
    found = []
    for ids, numbers in encoder.encode(texts):
        starts = [sum(numbers[:k]) for k in range(len(numbers) + 1)]
        assert starts[-1] == len(ids)
        found += [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)]
    return found


def test_all_documents(spark, docs, rows, sf_dir):
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in P.piece_report(docs).collect()}
    for d in rows("documents"):
        ids = MODEL.encode(d["text"])
        assert found[d["doc_id"]] == (len(ids), sha(",".join(map(str, ids))), sha(MODEL.decode(ids)))


def test_odd_rows(odd_docs):
    made = P.encoded(odd_docs)
    assert set(made.columns) == set(odd_docs.columns)
    for r in P.decoded(made, out="back").collect():
        want = MODEL.encode(r.text or "")
        assert r.ids == want and r.back == MODEL.decode(want)
    assert P.piece_report(odd_docs.where("false")).collect() == []
    other = made.selectExpr("CASE WHEN doc_id > 2 THEN ids END AS ids", "doc_id").collect()
    assert {len(r.ids or []) for r in other if r.doc_id == 1} == {0}


def test_decoding_any_ids(spark):
    draw = random.Random(5)
    ids = [[draw.randrange(MODEL.get_piece_size()) for _ in range(draw.randint(0, 20))] for _ in range(300)]
    ids += [[draw.randrange(3, 259) for _ in range(draw.randint(0, 9))] for _ in range(300)]
    table = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, ids array<int>")
    assert {r.i: r.text for r in P.decoded(table).collect()} == {i: MODEL.decode(x) for i, x in enumerate(ids)}
    with_nulls = spark.sql("SELECT array(264, null, 264) AS ids UNION ALL SELECT null")
    assert sorted(r.text for r in P.decoded(with_nulls).collect()) == ["", MODEL.decode([264, 264])]


@pytest.mark.parametrize("part", [1, 7, 50, 1 << 21])
def test_any_text_in_any_parts(monkeypatch, rows, part):
    draw = random.Random(part)
    alphabet = [*map(chr, range(32, 127)), "\n", "\t", "▁", "é", "中", "\U0001f600", "\u3000", "\x00", "\r", *"     \n\n"]
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 200))) for _ in range(400)]
    texts += [d["text"][:3000] for d in rows("documents")]
    texts += ["", " ", "  ", "\n", " \n", "\n ", "a" * 500, " " * 300, "\n" * 300, "<s></s><unk>", "<0x0A>", "▁ ▁", "\n\n a ", ""]
    monkeypatch.setattr(P, "PART", part)
    monkeypatch.setattr(P, "MAX_CHUNKS", 50)
    encoder = P.ChunkEncoder(PATH)
    assert encoded(encoder, texts) == MODEL.encode(texts)
    assert max(len(encoder.known), len(encoder.older)) <= 50
    assert all(len(chunk) <= P.LONG_CHUNK for chunk in encoder.known)
    assert encoded(encoder, []) == []


def test_each_chunk_is_segmented_once(rows, monkeypatch):
    encoder, asked = P.ChunkEncoder(PATH), []
    segment = encoder._segmented
    monkeypatch.setattr(encoder, "_segmented", lambda chunks: asked.extend(chunks) or segment(chunks))
    texts = [d["text"] for d in rows("documents")]
    for _ in range(2):
        assert encoded(encoder, texts) == MODEL.encode(texts)
    assert len(asked) == len(set(asked))
