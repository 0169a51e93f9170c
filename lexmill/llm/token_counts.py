"""Token counts by a piece model, for every whole text.

Method: batch encoding in Arrow functions that return lengths only. Batches are
balanced by bytes, and long texts are split at boundaries that no piece crosses.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from lexmill.llm.common import packed, ship_package, unpacked

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
# Code points of a segment before a safe boundary is looked for.
SEGMENT = 1 << 14
# UTF-8 bytes, about, of the segments that are encoded in one call.
BATCH_BYTES = 1 << 20
# Stands before every segment but the first, in the place of the text that was cut off.
GUARD = "\n"


class PieceCounter:
    """Counts the pieces of texts with one model.

    Merging joins neighbouring pieces into a piece of the vocabulary. Where two
    neighbouring characters stand in no piece side by side, no merge can cross,
    so the parts on both sides can be encoded alone. The guard makes up for the
    space that the model puts before a text: it is in no piece itself, so it
    adds a fixed number of tokens.
    """

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [
            self.model.id_to_piece(i).replace("▁", " ")
            for i in range(self.model.get_piece_size())
            if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))
        ]
        self.joined = {piece[i : i + 2] for piece in pieces for i in range(len(piece) - 1)}
        self.can_split = not any(GUARD in piece for piece in pieces)
        self.guard_tokens = len(self.model.encode(GUARD))

    def segments(self, text: str) -> Iterator[str]:
        """The text in parts of about SEGMENT code points; longer where no boundary is safe."""
        start, end = 0, SEGMENT
        while self.can_split and end < len(text):
            if text[end - 1 : end + 1].replace("▁", " ") in self.joined:
                end += 1
                continue
            yield text[start:end]
            start, end = end, end + SEGMENT
        yield text[start:]

    def counts(self, texts: Iterator[str]) -> list[int]:
        found: list[int] = []
        parts: list[str] = []
        owners: list[tuple[int, int]] = []
        size = 0

        def flush() -> None:
            for (owner, extra), ids in zip(owners, self.model.encode(parts, num_threads=1), strict=True):
                found[owner] += len(ids) - extra
            parts.clear()
            owners.clear()

        for n, text in enumerate(texts):
            found.append(0)
            for k, part in enumerate(self.segments(text)):
                parts.append(GUARD + part if k else part)
                owners.append((n, self.guard_tokens if k else 0))
                size += len(part.encode())
                if size >= BATCH_BYTES:
                    flush()
                    size = 0
        flush()
        return found


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def token_counts(docs: DataFrame, *, text: str = "text", model: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``n_tokens`` (long) and ``over_limit`` (boolean: over ``limit`` tokens).

    Tokens are those of the model as its library encodes the whole text,
    without begin and end marks; strings that look like marks are ordinary
    text. ``model`` is the path of the model file on every executor.

    Null and empty texts have 0 bytes and 0 tokens. Texts of any length are
    counted whole. Repeated rows count alike, and an empty table gives an empty
    table. Input columns with the names of the new ones are replaced.
    """
    ship_package(docs.sparkSession)
    path = model or public_tokenizers.path(MODEL)

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(_counter(path).counts(batch), dtype="int64")

    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = packed(docs, F.octet_length(body).cast("bigint").alias("n_bytes"), count(body).alias("n_tokens"))
    made = {c: F.col(c) for c in ("n_bytes", "n_tokens")} | {"over_limit": F.col("n_tokens") > limit}
    return rows.select(*unpacked(rows, docs.columns, made))
