from __future__ import annotations

import random
import time

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from definitions import sha

from lexmill.llm import bpe as B

PATH = public_tokenizers.path(B.RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def test_all_documents(docs, rows, library):
    found = {r.doc_id: r for r in B.round_trip(docs).drop("text").collect()}
    for d in rows("documents"):
        ids = library.encode_ordinary(d["text"])
        row = found[d["doc_id"]]
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == (len(ids), sha(packed(ids)), sha(d["text"]))


def test_odd_rows(odd_docs, library):
    found = B.encoded(odd_docs)
    for r in found.collect():
        assert r.ids == library.encode_ordinary(r.text or "")
    back = B.decoded(found, out="back")
    assert all(r.back == (r.text or "") for r in back.collect())
    assert set(back.columns) == {*odd_docs.columns, "back"}
    empty = odd_docs.where("false")
    assert B.round_trip(empty).collect() == B.decoded(B.encoded(empty)).collect() == []


def test_random_text(library):
    draw = random.Random(7)
    alphabet = [chr(c) for span in ((32, 127), (0xC0, 0x250), (0x400, 0x460), (0x4E00, 0x4E80)) for c in range(*span)]
    alphabet += ["\n", "\t", "\x1c", "\x85", " ", "　", "\U0001f600", "‍", "́"]
    codec = B.Codec(PATH)
    for _ in range(2000):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 40))) + draw.choice("a \n1é") * draw.randint(0, 60)
        assert codec.encode(text) == packed(library.encode_ordinary(text))
        assert "".join(codec.decode(codec.encode(text))) == text


def test_bounds_do_not_change_the_result(monkeypatch, rows, library):
    for name, value in (("MAX_STATES", 20), ("MAX_UNKEPT", 50), ("MAX_PAIRS", 30), ("MAX_PIECES", 5), ("LONG_TEXT", 10)):
        monkeypatch.setattr(B, name, value)
    codec = B.Codec(PATH)
    for d in rows("documents")[:40]:
        assert codec.encode(d["text"]) == packed(library.encode_ordinary(d["text"]))


def test_neighbours_by_spines_and_by_definition():
    machine = B.Codec(PATH).pieces.transducer
    draw = random.Random(3)
    for _ in range(20_000):
        a, b = draw.randrange(len(machine.ranks)), draw.randrange(len(machine.ranks))
        assert machine.may_follow(a, b) == (machine.merged(machine.bytes_of[a] + machine.bytes_of[b]) == [a, b])


def test_decoding_keeps_unfinished_characters(monkeypatch):
    monkeypatch.setattr(B, "DECODE_IDS", 1)
    codec = B.Codec(PATH)
    ids = codec.encode("a\U0001f600é")
    assert "".join(codec.decode(ids)) == "a\U0001f600é"
    lone = packed([codec.bytes_of.index(b"\xf0")])
    assert "".join(codec.decode(lone)) == "�"
    with pytest.raises(UnicodeDecodeError):
        list(codec.decode(lone, "strict"))


def test_a_piece_without_end(library):
    text = "ab" * 200_000
    assert len(B.Codec(PATH).encode(text)) // 4 > 0
    assert B.Codec(PATH).encode(text[:2000]) == packed(library.encode_ordinary(text[:2000]))


def test_idle_workers_forget(monkeypatch):
    monkeypatch.setattr(B, "IDLE_SECONDS", 0.05)
    with B.codec(PATH) as first:
        pass
    with B.codec(PATH) as second:
        time.sleep(0.2)
        assert second is first
    time.sleep(0.3)
    with B.codec(PATH) as third:
        assert third is not first
