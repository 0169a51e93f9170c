"""Tables of words that travel in the plan and are looked up inside a row.

They are literals: constant folding parses them once, and expressions in lambdas
can use them, where a join cannot go. Their sizes are bounded by their callers.
"""

from __future__ import annotations

import itertools
import json
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter per word, and 64-bit blocks of a filter, at least and at most. More words than the largest filter is
# meant for only make it let more other words through.
BITS_PER_WORD = 16
MIN_BLOCKS = 1 << 6
MAX_BLOCKS = 1 << 15


def word_map(values: Mapping[str, object], kind: str = "string") -> Callable[[Column], Column]:
    """A function from a word to its value, null for words without one.

    Spark searches a map from end to end, so the words are dealt over many
    short maps by their checksum.
    """
    n = 1 << max(0, len(values) - 1).bit_length()
    buckets: list[dict[str, object]] = [{} for _ in range(n)]
    for word, value in values.items():
        buckets[zlib.crc32(word.encode()) % n][word] = value
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<map<string,{kind}>>")

    def find(word: Column) -> Column:
        return F.element_at(F.get(table, (F.crc32(word.cast("binary")) % n).cast("int")), word)

    return find


def _murmur3(data: bytes) -> int:
    """What ``hash`` gives for a text of these bytes: Murmur3 of 32 bits, with what is left of the last four byte by byte."""

    def rotated(x: int, by: int) -> int:
        return (x << by | x >> (32 - by)) & 0xFFFFFFFF

    whole, h = len(data) - len(data) % 4, 42
    parts = [int.from_bytes(data[k : k + 4], "little") for k in range(0, whole, 4)]
    # Bytes are signed there.
    for part in [*parts, *((x - 256 if x > 127 else x) & 0xFFFFFFFF for x in data[whole:])]:
        h ^= rotated(part * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (rotated(h, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def word_table(values: Mapping[str, str]) -> Callable[[Column], Column]:
    """As ``word_map``, for the sides of a join that should be one shuffle.

    Spark does a shuffle once for equal plans only, and literals are equal if
    they are arrays, but never if they are maps. So there is one table of the words
    and one of their values.
    """
    n = 1 << max(0, len(values) - 1).bit_length()
    words: list[list[str]] = [[] for _ in range(n)]
    # Nothing stands in the place 0, which a word has that is not there.
    found: list[list[str | None]] = [[None] for _ in range(n)]
    for word, value in values.items():
        bucket = _murmur3(word.encode()) % n
        words[bucket].append(word)
        found[bucket].append(value)
    all_words, all_found = (F.from_json(F.lit(json.dumps(x)), "array<array<string>>") for x in (words, found))

    def find(word: Column) -> Column:
        bucket = F.hash(word).bitwiseAND(F.lit(n - 1))
        return F.get(F.get(all_found, bucket), F.array_position(F.get(all_words, bucket), word))

    return find


def short_codes(words: Sequence[str], *, without: str) -> dict[str, str]:
    """A code of a few ASCII characters for each word, the shorter the earlier; no code holds a character of ``without``."""
    signs = [chr(k) for k in range(33, 127) if chr(k) not in without]
    codes, size = (), 1
    while len(words) > len(codes):
        codes, size = [*codes, *map("".join, itertools.islice(itertools.product(signs, repeat=size), len(words)))], size + 1
    return dict(zip(words, codes, strict=False))


def word_set(words: Sequence[str]) -> Callable[[Column], Column]:
    """A function that tells whether a word is one of ``words``."""
    if not words:
        return lambda word: F.lit(False)
    find = word_map(dict.fromkeys(words, 1), "int")
    return lambda word: find(word).isNotNull()


def _block_and_mask(word: Column, blocks: int) -> tuple[Column, Column]:
    """The block of a word, and its four bits in there."""
    first, second = F.xxhash64(word), F.xxhash64(word, F.lit(1))
    block = F.pmod(first, F.lit(blocks)).cast("int")
    mask = F.lit(0).cast("bigint")
    for k in range(4):
        place = F.shiftright(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), place))
    return block, mask


def bloom_filter(words: DataFrame, n_words: int, column: str = "word") -> Callable[[Column], Column]:
    """A function that is true for all words of a column and false for most others: a Bloom filter of 64-bit blocks.

    The blocks are filled by an aggregation; at most MAX_BLOCKS numbers reach the driver.
    """
    blocks = MIN_BLOCKS
    while blocks < MAX_BLOCKS and 64 * blocks < BITS_PER_WORD * n_words:
        blocks *= 2
    block, mask = _block_and_mask(F.col(column), blocks)
    filled = words.select(block.alias("block"), mask.alias("mask")).groupBy("block").agg(F.bit_or("mask").alias("mask"))
    masks = [0] * blocks
    for row in filled.collect():
        masks[row["block"]] = row["mask"]
    table = F.from_json(F.lit(json.dumps(masks)), "array<bigint>")

    def may_hold(word: Column) -> Column:
        block, mask = _block_and_mask(word, blocks)
        return F.get(table, block).bitwiseAND(mask) == mask

    return may_hold
