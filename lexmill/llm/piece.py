"""Encoding with a piece model, and decoding.

Method: a distinct-chunk table. No piece of the model goes on across a white-space
marker (nor across a line end), so a text falls apart into marked words that are
segmented alone. Each distinct one is segmented once into a table, and ids are
joined back by position.

The table belongs to the Python worker that encodes: chunks that are in no table
yet are segmented in one call for each part of a batch, and the ids of all positions are
gathered from it. A single table for the corpus would have to be joined with every
position of every text; nothing is shuffled here.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count
from struct import pack

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import packed, ship_package, unpacked

MODEL = "piece_bpe_32k.model"
MARKER = "▁"
# Code points, about, that are cut into chunks at a time, whether of one text or of many.
PART = 1 << 21
# Chunks in each of the two generations of a worker's table; longer chunks are segmented each time they come.
MAX_CHUNKS = 1 << 17
LONG_CHUNK = 64
# Ids, about, that are decoded to texts before these leave the worker.
DECODED_IDS = 1 << 20


class _Codes(dict):
    """Numbers chunks in the order in which they come."""

    def __init__(self) -> None:
        super().__init__()
        self.next = count().__next__

    def __missing__(self, chunk: str) -> int:
        code = self[chunk] = self.next()
        return code


class ChunkEncoder:
    """Encodes texts with one model by way of the table of its distinct chunks.

    Markers are written as blanks here. A chunk begins with its markers, or
    with a line end, which no piece holds together with other characters.
    """

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        special = (self.model.is_control, self.model.is_byte, self.model.is_unknown)
        pieces = [self.model.id_to_piece(i) for i in ids if not any(kind(i) for kind in special)]
        if any(MARKER in piece.lstrip(MARKER) for piece in pieces):
            raise ValueError("a piece of this model goes on across a white-space marker")
        white = "  a \n\n b  "
        if any("\n" in piece for piece in pieces) or self.model.decode(self.model.encode(white)) != white:
            raise ValueError("this model changes white space, or has pieces with line ends")
        self.chunk = re.compile(" +[^ \n]*|\n[^ \n]*")
        self.start = re.compile("(?<! ) |\n")
        self.marker_id = pack("<i", self.model.piece_to_id(MARKER))
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _segmented(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of each chunk alone. The model puts a marker before what it encodes: in place of the chunk's first one."""
        found = self.model.encode([c[1:] if c[0] == " " else c for c in chunks], num_threads=1)
        out = []
        for chunk, ids in zip(chunks, found, strict=True):
            # Nothing is put before nothing, and what is put before a line end is no part of it.
            own = ids[1:] if chunk[0] == "\n" else ids
            out.append(self.marker_id if chunk == " " else pack(f"<{len(own)}i", *own))
        return out

    def _table(self, chunks: list[str]) -> list[bytes]:
        """Packed ids of distinct chunks, in order; those not met before are segmented."""
        found = list(map(self.known.get, chunks))
        new = [i for i, ids in enumerate(found) if ids is None]
        missing = []
        for i in new:
            found[i] = self.older.get(chunks[i])
            if found[i] is None:
                missing.append(i)
        for i, ids in zip(missing, self._segmented([chunks[i] for i in missing]), strict=True):
            found[i] = ids
        if len(self.known) + len(new) > MAX_CHUNKS:
            self.older, self.known = self.known, {}
        self.known.update((chunks[i], found[i]) for i in new[:MAX_CHUNKS] if len(chunks[i]) <= LONG_CHUNK)
        return found

    def _parts(self, text: str) -> Iterator[str]:
        """A text with its first marker, cut where chunks begin into parts of about PART code points."""
        text = " " + text.replace(MARKER, " ")
        start = 0
        while len(text) - start > PART and (cut := self.start.search(text, start + PART)):
            yield text[start : cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, list[int]]]:
        """Ids of whole texts end to end, and their number in each text, for some texts after the other."""
        codes, places, owners, size = _Codes(), [], [], 0
        begun, n_begun = [], 0
        for text in texts:
            owners.append(0)
            for part in self._parts(text) if text else ():
                found = self.chunk.findall(part)
                places.append(np.fromiter(map(codes.__getitem__, found), np.int64, len(found)))
                owners[-1] += len(found)
                size += len(part)
                if size < PART:
                    continue
                ids, numbers = self._gathered(codes, places, owners)
                # The last text may go on: its ids wait for the rest.
                done = len(ids) - numbers[-1]
                numbers[0] += n_begun
                if len(numbers) > 1:
                    yield np.concatenate([*begun, ids[:done]]), numbers[:-1]
                    begun = []
                begun.append(ids[done:] if len(numbers) > 1 else ids)
                n_begun = numbers[-1]
                codes, places, owners, size = _Codes(), [], [0], 0
        ids, numbers = self._gathered(codes, places, owners)
        if numbers:
            numbers[0] += n_begun
            yield np.concatenate([*begun, ids]), numbers

    def _gathered(self, codes: dict[str, int], places: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, list[int]]:
        """The ids of all positions, from the table's ids end to end, and their number in each text."""
        if not places:
            return np.zeros(0, np.int32), [0] * len(owners)
        table = self._table(list(codes))
        lengths = np.fromiter(map(len, table), np.int64, len(table)) // 4
        starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
        at = np.concatenate(places)
        long = lengths[at]
        ends = np.cumsum(long)
        index = np.repeat(starts[at] - (ends - long), long) + np.arange(ends[-1])
        upto = np.concatenate(([0], ends))[np.cumsum(owners)]
        return np.frombuffer(b"".join(table), np.int32)[index], np.diff(upto, prepend=0).tolist()

    def decode(self, rows: Iterable[np.ndarray]) -> Iterator[list[str]]:
        """The texts of arrays of ids, for some arrays after the other."""
        some, size = [], 0
        for row in rows:
            some.append(row.tolist())
            size += len(row)
            if size >= DECODED_IDS:
                yield self.model.decode(some)
                some, size = [], 0
        if some:
            yield self.model.decode(some)


@lru_cache(maxsize=2)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def encoded(docs: DataFrame, *, text: str = "text", model: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the ids of the whole text as the model's library gives them, as an array of integers.

    There are no begin and end ids, and strings that look like marks are
    ordinary text. ``model`` is the path of the model file on every executor;
    it must have no pieces across white-space markers or line ends.

    Null and empty texts have no ids. Texts of any length are encoded whole,
    part by part. Repeated rows come back alike, and an empty table gives an
    empty table. An input column ``ids`` is replaced.
    """
    ship_package(docs.sparkSession)
    path = model or public_tokenizers.path(MODEL)

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for ids, numbers in _encoder(path).encode(value.as_py() for value in batch):
                offsets = pa.array(np.concatenate(([0], np.cumsum(numbers))), pa.int32())
                yield pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))

    rows = packed(docs, encode(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("ids"))
    return rows.select(*unpacked(rows, docs.columns, {"ids": F.col("ids")}))


def decoded(tokens: DataFrame, *, ids: str = "ids", out: str = "text", model: str | None = None) -> DataFrame:
    """``tokens`` with the text of the array ``ids`` in ``out``, as the model's library decodes it.

    A null array gives an empty text, and null ids in it are left out. An input
    column of the name ``out`` is replaced.
    """
    ship_package(tokens.sparkSession)
    path = model or public_tokenizers.path(MODEL)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = (row.values.drop_null().to_numpy(zero_copy_only=False) for row in batch)
            for texts in _encoder(path).decode(rows):
                yield pa.array(texts, pa.string())

    rows = packed(tokens, decode(F.coalesce(F.col(f"`{ids}`"), F.array().cast("array<int>"))).alias("body"))
    return rows.select(*unpacked(rows, tokens.columns, {out: F.col("body")}))


def piece_report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document: hashes of the decimal ids and of the decoded text."""
    found = decoded(encoded(docs.select("doc_id", "text")))
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )
