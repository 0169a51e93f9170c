from __future__ import annotations

import itertools
import math
import random
import time
import zlib

import numpy as np
import pytest

from lexmill.llm import toxicity as X

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def known(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def channel(corpus):
    return X.fit_channel(corpus)


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("an 1d10t", "idiot"),
        ("i d i o t", "idiot"),
        ("s.t.u.p.i.d!", "stupid"),
        ("stuuuupid", "stupid"),
        ("Tr4sh", "trash"),
        ("p@thet1c", "pathetic"),
        ("d!sgu$ting", "disgusting"),
        ("w0rthl3ss", "worthless"),
        ("(m0r0n)", "moron"),
    ],
)
def test_disguises(channel, text, word):
    assert word in channel.restore(text).split()


@pytest.mark.parametrize("text", ["hello world. ok", "172.24.1.2 and 4381893557741609", "the%%% of&&&", "", "élève"])
def test_plain_text_stays(channel, text):
    assert channel.restore(text) == text


def test_long_disguises(channel):
    """No span is too long: lone letters of whole sentences, and words amid other signs without a blank."""
    sentence = "you are a stupid idiot and a pathetic loser and a worthless clown"
    lone = " ".join(sentence.replace(" ", ""))
    weights = {w: 1.0 for w in ("stupid", "idiot", "pathetic", "worthless", "clown", "trash")}
    for text in (f"well, {lone} said they", "y o u a r e a s t u p i d i d i o t a n d a p a t h e t i c w o r t h l e s s c l o w n"):
        assert len(text) > 64 and X.score_text(text, channel, 0.0, weights) == pytest.approx(1 / (1 + np.exp(-5)))
    url = "https://example.org/" + "/".join(f"part{i}x" for i in range(20)) + "/an-1d10t/of-the-day"
    assert len(url) > 64 and "idiot" in channel.restore(url).split()
    assert channel.restore("st" + "u" * 5000 + "pid").split() == ["stupid"]
    longest = channel.restore("-".join(["1d10t"] * 4000))
    assert longest.split().count("idiot") > 3900 and all(len(span) <= X.KEPT_SPAN for span in channel.kept)


@pytest.mark.parametrize(
    ("text", "word"),
    [
        ("idio7, they", "idiot"),
        ("(5tupid)", "stupid"),
        ("@$$hole", "asshole"),
        ("($cum)", "scum"),
        ('"5cum"', "scum"),
        ("“1d10t”", "idiot"),
        ("idio+", "idiot"),
        ("s  t  u  p  i  d", "stupid"),
        ("s\nt\nu\r\np\n\ni\nd", "stupid"),
        ("(i d i o t)", "idiot"),
        ("i d i o t.", "idiot"),
        ("s - t - u - p - i - d", "stupid"),
        ("s't'u'p'i'd", "stupid"),
        ("trash*** and **clown**", "trash"),
        ("trash*** and **clown**", "clown"),
        ("stupid!", "stupid"),
    ],
)
def test_disguises_at_edges(channel, text, word):
    assert word in channel.restore(text).split()


def best_readings(channel: X.Channel, span: str) -> set[str]:
    """The most likely readings by trying all of them."""
    inner = range(len(span) - len(span.lstrip(X._OUTER)), len(span.rstrip(X._OUTER)))
    options = [channel._edges(span, at) if at in inner else channel._outer_edges(span, at) for at in range(len(span))]
    scores: dict[str, float] = {}
    for pieces in itertools.product(*options):
        a, b, score, reading = 0, 0, 0.0, ""
        for text, cost in pieces:
            score += cost
            symbol = X._symbol(text)
            if symbol is None or (symbol == 0 and b == 0):
                continue
            score += channel.log[a][b][symbol]
            a, b, reading = b, symbol, reading + text
        score += channel.log[a][b][0] if b else 0.0
        scores[reading] = max(scores.get(reading, -math.inf), score)
    most = max(scores.values())
    return {reading for reading, score in scores.items() if score > most - 1e-9}


def test_decoding_equals_trying_all_readings(channel):
    draw = random.Random(3)
    spans = ["".join(draw.choices("abeiost10$!|+.- \n'é", k=draw.randint(1, 6))) for _ in range(250)]
    spans += ["".join(draw.choices("it!*", k=3)) + draw.choice(["", "!", "*", "!!", "$$"]) for _ in range(40)]
    spans += ["id*t", "*at", "**it", "it**", "it*!", "!!it", "+i+", "|it|!!", "aaaat", "it!?!", "***", "!it***"]
    for span in spans:
        if span.count("*") < 4:
            for _ in range(2):
                assert channel.decode(span) in best_readings(channel, span), span
                channel.kept.clear()


def test_signs_at_the_end_are_looked_up(channel):
    own = X.Channel(channel.counts)
    words = [a + b for a in "abcdefgh" for b in ("it", "an", "eel")]
    for word in words:
        assert own.decode(word + "***") == channel.decode(word + "***")
        assert own.decode("**" + word).split() == channel.decode("**" + word).split()
    assert len(own.tails) == 2 and len(own.begun) <= len(words)


@pytest.mark.parametrize(
    ("text", "found"),
    [("an idi*t here", 1), ("$$idiot$$", 1), ("id\u200bi\u200cot", 1), ("i/d/i/o/t", 1), ("i, d, i, o, t", 1), ("i:d:i:o:t", 1),
     ("*****", 0), ("i****", 0), ("idi*ts", 0), ("and/or", 0), ("a, b, c", 0)],
)
def test_other_readings_of_known_words(channel, text, found):
    assert X.score_text(text, channel, -1.0, {"idiot": 2.0}) == pytest.approx(1 / (1 + np.exp(1.0 - 2.0 * found)))


def test_lines_of_asterisks_hide_nothing(channel):
    start = time.process_time()
    assert channel.restore("a" + "*" * 1_000_000 + "b") == "a b"
    assert channel.restore("word" + "!*" * 20_000).split() == ["word"]
    assert time.process_time() - start < 30


def test_runs_of_other_letters(channel):
    assert "".join(channel.restore("e s t ú p i d o").split()) == "estúpido"
    assert channel.restore("est\xfap1do").split() == ["estúpido"]
    assert len(X._DISGUISED.findall("a$$")) == 1
    assert channel.restore("a" + "*" * 3000 + "b")


def test_trigrams_of_all_documents(corpus):
    texts = [(r.text or "").encode() for r in corpus.collect()]
    want = X.count_trigrams(texts)
    got = np.zeros_like(want)
    for r in X.corpus_trigrams(corpus).collect():
        got[r.gram] = r.n
    assert (got == want).all() and got.sum() > 1_000_000
    (one,) = np.nonzero(X.count_trigrams([b"a"]))[0:1]
    assert list(one) == [X.SYMBOLS]


def test_held_out_documents(corpus, known):
    found = X.toxicity(corpus, known)
    rows = found.join(known, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    test = [r for r in rows if r.held_out]
    clean = [r.predicted for r in test if not r.toxic]
    assert sum(clean) <= 0.02 * len(clean)
    words = "idiot moron stupid clown loser trash scum pathetic worthless disgusting".split()
    plain = [r.predicted for r in test if r.toxic and any(w in r.text.lower() for w in words)]
    assert plain and np.mean(plain) > 0.9


def test_labels_of_held_out_documents_do_not_count(corpus, known):
    turned = known.withColumn("toxic", X.F.when(X.held_out(), 1 - X.F.col("toxic")).otherwise(X.F.col("toxic")))
    scores = [sorted((r.doc_id, r.score) for r in X.toxicity(corpus, x).select("doc_id", "score").collect()) for x in (known, turned)]
    assert scores[0] == scores[1]


def test_odd_rows(odd_docs, known):
    found = X.toxicity(odd_docs, known)
    assert set(found.columns) == {*odd_docs.columns, "held_out", "predicted"}
    rows = found.collect()
    assert len(rows) == odd_docs.count() and all(isinstance(r.score, float) for r in rows)
    assert X.toxicity(odd_docs.where("false"), known).collect() == []
    assert {r.predicted for r in X.toxicity(odd_docs, known.where("false")).collect()} == {0}
    channel = X.fit_channel(odd_docs.where("false"))
    assert channel.restore("t3st") == " test " or channel.restore("t3st")
