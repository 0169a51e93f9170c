"""Byte-level BPE encoding and decoding.

Method: the merges are compiled into a finite-state transducer that is
determinised lazily and emits tokens after a bounded lookahead; decoding streams
through an incremental UTF-8 state machine.

Why a transducer can do it: a sequence of tokens is what merging yields if and
only if merging yields each token from its own bytes and each pair of
neighbours from theirs, since a merge across a boundary would show in that pair
alone. So a nondeterministic transducer reads tokens along a trie and moves
from a token only to one that may follow it.
"""

from __future__ import annotations

import base64
import codecs
import gc
import hashlib
import threading
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from struct import pack

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import packed, ship_package, unpacked

RANKS = "byte_bpe_multi_50k.tiktoken"
# What a worker keeps, which bounds its memory to some 300 MB. States beyond the first are made for one use, and when
# many had to be, the text has changed and all start afresh.
MAX_STATES = 150_000
MAX_UNKEPT = 3_000_000
MAX_PAIRS = 300_000
MAX_PIECES = 250_000
# Spark keeps idle Python workers; after so long without a batch they give the memory back.
IDLE_SECONDS = 10.0
# Pieces above this length are not kept.
LONG_PIECE = 64
# Texts above this length are cut into pieces one by one instead of into a list.
LONG_TEXT = 1 << 20
# Ids that the decoder turns to bytes at a time.
DECODE_IDS = 1 << 16
_ROOT = 0
_NONE = -1
_NO_MOVES: dict = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class State:
    """A determinised state: its hypotheses, the moves known so far, and what it still holds back at the end."""

    __slots__ = ("final", "hypotheses", "moves")

    def __init__(self, hypotheses: tuple[tuple[int, int, tuple[int, ...]], ...]) -> None:
        self.hypotheses = hypotheses
        self.moves: dict[int, tuple[State, bytes]] = _NO_MOVES
        self.final: bytes | None = None


class Transducer:
    """Bytes of one piece in, token ids out.

    A hypothesis is (last token, trie node of the bytes since, tokens not yet
    emitted); a determinised state is the set of hypotheses that the bytes read
    so far allow. What all of them have in common at the front is emitted with
    the transition. A hypothesis reaches back by at most the longest token, so
    no more than that is ever held back.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [_NONE]
        for token, rank in ranks.items():
            node = _ROOT
            for byte in token:
                after = self.children[node].get(byte)
                if after is None:
                    after = self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(_NONE)
                node = after
            self.token_at[node] = rank
        self.edges: dict[int, tuple] = {}
        self._reset()

    def _reset(self) -> None:
        start = (_NONE, _ROOT, ())
        self.start = State((start,))
        self.states = {self.start.hypotheses: self.start}
        self.follows: dict[tuple[int, int], bool] = {}
        self.unkept = 0

    def merged(self, data: bytes) -> list[int]:
        """What merging yields, by definition: the pair of the lowest rank first, the leftmost of equals."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(parts[i] + parts[i + 1], len(self.ranks) + 1), i) for i in range(len(parts) - 1)]
            rank, at = min(ranked)
            if rank > len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def _spine(self, token: int, side: int) -> list[tuple[bytes, int, int]] | None:
        """The parts at one edge (0 left, -1 right) of a token while it is merged: (bytes, made at, used up at).

        Time is the rank of the merge; a single byte is there from the start. None for a token
        that is made from a part of higher rank, for which rank is no measure of time.
        """
        spine, part, used_up = [], self.bytes_of[token], len(self.ranks) + 1
        while True:
            rank = self.ranks[part] if len(part) > 1 else _NONE
            spine.append((part, rank, used_up))
            if len(part) == 1:
                return spine
            halves = self._halves(part)
            if any(len(half) > 1 and self.ranks[half] > rank for half in halves):
                return None
            part, used_up = halves[side], rank

    def _halves(self, data: bytes) -> list[bytes]:
        """The two parts whose merge makes a token."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 2:
            _, at = min((self.ranks.get(parts[i] + parts[i + 1], len(self.ranks) + 1), i) for i in range(len(parts) - 1))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edges(self, token: int) -> tuple:
        """Left and right spine of a token, and whether merging yields it from its own bytes."""
        found = self.edges.get(token)
        if found is None:
            whole = self.merged(self.bytes_of[token]) == [token]
            found = self.edges[token] = (self._spine(token, 0), self._spine(token, -1), True) if whole else (None, None, False)
        return found

    def may_follow(self, last: int, token: int) -> bool:
        """Whether merging the bytes of the two yields the two, or those of the token the token if nothing is before it.

        It does not if parts at both edges of the boundary exist at the same time and make a token
        before either is used up in its own token. Of equal ranks, the leftmost merge comes first.
        """
        known = self.follows.get((last, token))
        if known is not None:
            return known
        own = self._edges(token)
        right, left = self._edges(last)[1] if last != _NONE else None, own[0]
        if last == _NONE or not own[2]:
            # A token that merging does not yield from its own bytes follows no other, either.
            known = own[2]
        elif right is None or left is None:
            known = self.merged(self.bytes_of[last] + self.bytes_of[token]) == [last, token]
        else:
            known = True
            get = self.ranks.get
            for x, x_made, x_used in right:
                for y, y_made, y_used in left:
                    if y_made < x_used and x_made <= y_used:
                        rank = get(x + y)
                        if rank is not None and max(rank, y_made) < x_used and max(rank, x_made) <= y_used:
                            known = False
                            break
                if not known:
                    break
        self.follows[last, token] = known
        return known

    def _step(self, state: State, byte: int) -> tuple[State, bytes]:
        """Determinise one transition, and keep it while there is room."""
        children, token_at, follows = self.children, self.token_at, self.follows
        reached, ended = [], None
        for last, node, held in state.hypotheses:
            after = children[node].get(byte)
            if after is None:
                continue
            if children[after]:
                reached.append((last, after, held))
            token = token_at[after]
            if token != _NONE and ended is None:
                follow = follows.get((last, token))
                if follow or follow is None and self.may_follow(last, token):
                    ended = (token, _ROOT, (*held, token))
        # The bytes so far have one tokenisation, so one hypothesis ends here. It comes last: the others
        # stand in the order in which they began, and so a set of hypotheses has one form.
        reached.append(ended)
        first = reached[0][2]
        common = min([len(held) for _, _, held in reached])
        while common and any([held[:common] != first[:common] for _, _, held in reached]):
            common -= 1
        emitted = b""
        if common:
            emitted = pack(f"<{common}I", *first[:common])
            reached = [(last, node, held[common:]) for last, node, held in reached]
        key = tuple(reached)
        target = self.states.get(key)
        if target is None:
            target = State(key)
            if len(self.states) < MAX_STATES:
                self.states[key] = target
            else:
                self.unkept += 1
                return target, emitted
        if state.moves is _NO_MOVES:
            state.moves = {}
        move = state.moves[byte] = (target, emitted)
        return move

    def encode(self, piece: bytes) -> bytes:
        """Ids of the piece as little-endian unsigned 32-bit integers. A piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return pack("<I", whole)
        if self.unkept > MAX_UNKEPT:
            self._reset()
        if len(self.follows) > MAX_PAIRS:
            self.follows.clear()
        state, out = self.start, []
        for byte in piece:
            state, emitted = state.moves.get(byte) or self._step(state, byte)
            if emitted:
                out.append(emitted)
        if state.final is None:
            held = state.hypotheses[-1][2]
            state.final = pack(f"<{len(held)}I", *held)
        out.append(state.final)
        return b"".join(out)


class _Pieces(dict):
    """Encoded pieces in two generations of at most MAX_PIECES: pieces that come up again are carried over."""

    def __init__(self, transducer: Transducer) -> None:
        super().__init__()
        self.transducer = transducer
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MAX_PIECES:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = self.transducer.encode(piece.encode())
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids


class Codec:
    """Encoder and streaming decoder for one file of ranks."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN) -> None:
        ranks = read_ranks(path)
        self.pieces = _Pieces(Transducer(ranks))
        self.pattern = regex.compile(pattern)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, text: str) -> bytes:
        """Ids of the text as little-endian unsigned 32-bit integers."""
        if len(text) > LONG_TEXT:
            found: Iterable[str] = (match.group() for match in self.pattern.finditer(text))
        else:
            found = self.pattern.findall(text)
        return b"".join(map(self.pieces.__getitem__, found))

    def decode(self, ids: bytes, errors: str = "replace") -> Iterator[str]:
        """Text of packed ids, part by part: the state machine keeps the bytes of an unfinished character."""
        machine = codecs.getincrementaldecoder("utf-8")(errors)
        numbers = np.frombuffer(ids, "<u4")
        for at in range(0, len(numbers), DECODE_IDS):
            data = b"".join(map(self.bytes_of.__getitem__, numbers[at : at + DECODE_IDS].tolist()))
            yield machine.decode(data)
        yield machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def _codec(path: str) -> Codec:
    return Codec(path)


def _release() -> None:
    """Forget the codecs. A batch that runs just now keeps its own until it ends."""
    _codec.cache_clear()
    gc.collect()


_timers: list[threading.Timer] = []


@contextmanager
def codec(path: str) -> Iterator[Codec]:
    """The worker's codec for a batch. It is kept for the next one, unless that is long in coming."""
    while _timers:
        _timers.pop().cancel()
    try:
        yield _codec(path)
    finally:
        timer = threading.Timer(IDLE_SECONDS, _release)
        timer.daemon = True
        timer.start()
        _timers.append(timer)


def encoded(docs: DataFrame, *, text: str = "text", ranks: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text as an array of integers.

    Every match of the public pattern is encoded separately, without special
    tokens. ``ranks`` is the path of the rank file on every executor. Null and
    empty texts have no ids. An input column ``ids`` is replaced.
    """
    ship_package(docs.sparkSession)
    path = ranks or public_tokenizers.path(RANKS)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            with codec(path) as own:
                found = [np.frombuffer(own.encode(body), "<u4").astype("int32") for body in batch]
            yield pd.Series(found)

    rows = packed(docs, encode(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("ids"))
    return rows.select(*unpacked(rows, docs.columns, {"ids": F.col("ids")}))


def decoded(tokens: DataFrame, *, ids: str = "ids", out: str = "text", ranks: str | None = None) -> DataFrame:
    """``tokens`` with the text of the array ``ids`` in ``out``, which replaces a column of that name.

    Bytes that are no UTF-8 become U+FFFD. A null array gives an empty text.
    """
    ship_package(tokens.sparkSession)
    path = ranks or public_tokenizers.path(RANKS)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            with codec(path) as own:
                found = ["".join(own.decode(np.asarray(row, "<u4").tobytes())) for row in batch]
            yield pd.Series(found)

    rows = packed(tokens, decode(F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>"))).alias("body"))
    return rows.select(*unpacked(rows, tokens.columns, {out: F.col("body")}))


def round_trip(docs: DataFrame, *, text: str = "text", ranks: str | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` (long), ``ids_sha256`` and ``decoded_sha256``, of whole texts.

    The hashes are lower-case hex SHA-256: of the ids as little-endian unsigned
    32-bit integers, and of the bytes that decoding them gives. Encoding and
    decoding happen in one Arrow function, so that ids do not travel.

    Null and empty texts have 0 tokens and the hashes of no bytes. Repeated
    rows come back alike, and an empty table gives an empty table. Input
    columns with the names of the new ones are replaced.
    """
    ship_package(docs.sparkSession)
    path = ranks or public_tokenizers.path(RANKS)

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            with codec(path) as own:
                for body in batch:
                    ids = own.encode(body)
                    decoded = hashlib.sha256()
                    for part in own.decode(ids, "strict"):
                        decoded.update(part.encode())
                    rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), decoded.hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    rows = packed(docs, digests(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("digests"))
    made = {c: F.col("digests").getField(c) for c in ("n_tokens", "ids_sha256", "decoded_sha256")}
    return rows.select(*unpacked(rows, docs.columns, made))
