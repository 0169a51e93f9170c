"""The operators on lists of Python rows, by their definitions."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK = (1 << 64) - 1


def signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def hash_text(text: str, seed: int = 42) -> int:
    return signed(xxhash.xxh64_intdigest(text.encode(), seed))


def hash_longs(*values: int) -> int:
    """Spark chains: the hash of one column seeds that of the next."""
    seed = 42
    for value in values:
        seed = xxhash.xxh64_intdigest((value & MASK).to_bytes(8, "little"), seed)
    return signed(seed)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def line_dedup(docs: list[dict]) -> list[tuple[str, int, int]]:
    """Kept text, lines and dropped lines of each row."""
    ids = [d["doc_id"] if d["doc_id"] is not None else math.inf for d in docs]
    holders = defaultdict(set)
    keys = [[lower(line.strip(" \t\n\x0b\f\r")) for line in (d["text"] or "").split("\n")] for d in docs]
    for i, own in zip(ids, keys, strict=True):
        for key in own:
            holders[key].add(i)
    out = []
    for d, i, own in zip(docs, ids, keys, strict=True):
        lines = (d["text"] or "").split("\n")
        kept = [
            line
            for line, key in zip(lines, own, strict=True)
            if len(key) < 10 or len(holders[key]) < 2 or min(holders[key]) == i
        ]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def quality_base(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": dup,
        "n_repeat_words": len(covered),
        "base_failed": len(words) < 10 or 100 * len(covered) > 20 * len(words),
    }


def grams(text: str | None, buckets: int) -> list[int]:
    hashes = [hash_text(w) for w in WORD.findall(text or "")]
    return [h % buckets for h in hashes] + [hash_longs(a, b) % buckets for a, b in zip(hashes, hashes[1:], strict=False)]


def quality_llr(docs: list[dict], trusted: set[int], buckets: int, smoothing: float) -> list[float]:
    raw, target = Counter(), Counter()
    for d in docs:
        own = grams(d["text"], buckets)
        raw.update(own)
        if d["doc_id"] in trusted:
            target.update(own)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    weight = {
        b: round(math.log((target[b] + smoothing) / (n * n_target / n_raw + smoothing)), 4) for b, n in raw.items()
    }
    found = []
    for d in docs:
        own = grams(d["text"], buckets)
        found.append(sum(weight[b] for b in own) / max(1, len(own)))
    return found


def simhash(text: str | None) -> int:
    words = lower(text or "").encode().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints: list[int], bits: int = 4) -> list[int]:
    """For each fingerprint, the number of its component: that of its first member in the list."""
    parent = list(range(len(prints)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]


def simhash_rows(docs: list[dict]) -> list[tuple]:
    """Id, fingerprint and component of each row."""
    ids = [d["doc_id"] if d["doc_id"] is not None else math.inf for d in docs]
    prints = [simhash(d["text"]) for d in docs]
    groups = near_components(prints)
    least = {g: min(i for i, h in zip(ids, groups, strict=True) if h == g) for g in set(groups)}
    return [
        (d["doc_id"], f"{p:016x}", None if least[g] == math.inf else least[g])
        for d, p, g in zip(docs, prints, groups, strict=True)
    ]


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Shares by weight, the excess over the limit shared again until there is none."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    given = dict.fromkeys(order, 0.0)
    open_, left = set(order), 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * left / total >= 2 * sizes[s]}
        for s in over or open_:
            given[s] = 2 * sizes[s] if over else weight[s] * left / total
        if not over:
            break
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    return given


def warc(pages: list[dict]) -> list[tuple]:
    """Page id, bytes, digest, type and reference of each row."""
    bodies = [(p["html"] or "").encode() for p in pages]
    ids = [p["page_id"] if p["page_id"] is not None else math.inf for p in pages]
    first = {}
    for i, body in zip(ids, bodies, strict=True):
        first[body] = min(first.get(body, math.inf), i)
    out = []
    for p, i, body in zip(pages, ids, bodies, strict=True):
        again = len(body) >= 100 and first[body] != i
        kind = "revisit" if again else "response"
        out.append((p["page_id"], len(body), sha(body), kind, first[body] if again else None))
    return out


def order_minhash(text: str | None, k: int = 3, bins: int = 64, size: int = 2) -> dict[int, int]:
    """Slot and 16-bit hash of its tuple."""
    words = [hash_text(w) for w in WORD.findall(text or "")]
    if not words:
        return {}
    if len(words) < k:
        state = 0
        for w in words:
            state = hash_longs(state, w)
        mers = [state]
    else:
        mers = [hash_longs(*words[i : i + k]) for i in range(len(words) - k + 1)]
    seen: Counter = Counter()
    slots = defaultdict(list)
    for place, mer in enumerate(mers):
        mixed = hash_longs(mer, seen[mer]) & ((1 << 63) - (1 << 31))
        seen[mer] += 1
        slots[mixed >> 57].append(mixed + place)
    selected = [m for slot in sorted(slots) for m in sorted(slots[slot])[:size]]
    out = {}
    for slot, members in slots.items():
        first = selected.index(min(members))
        tuple_ = [selected[(first + i) % len(selected)] for i in range(min(size, len(selected)))]
        chosen = sorted(tuple_, key=lambda m: m & ((1 << 31) - 1))
        state = 0
        for m in chosen:
            state = hash_longs(state, m >> 31)
        out[slot] = state & 0xFFFF
    return out


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    filled = a.keys() | b.keys()
    return sum(a.get(s) == b.get(s) for s in filled) / len(filled) if filled else 1.0
