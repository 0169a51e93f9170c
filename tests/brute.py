"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter


def window_pairs(lines, vocabulary, distance, separator=r"[^a-zA-Z]+"):
    found = Counter()
    for line in lines:
        tokens = re.split(separator, line.lower())
        for i, w in enumerate(tokens):
            for j in range(max(0, i - distance), min(len(tokens), i + distance + 1)):
                u = tokens[j]
                if i != j and w and u and w in vocabulary and u in vocabulary:
                    found[w, u] += 1
    return dict(found)


def porter(word):
    """Porter's rules with an explicit consonant test, after the published description."""
    if len(word) <= 2:
        return word

    def consonant(s, i):
        if s[i] in "aeiou":
            return False
        return i == 0 or not consonant(s, i - 1) if s[i] == "y" else True

    def measure(s):
        shape = "".join("c" if consonant(s, i) else "v" for i in range(len(s)))
        return len(re.findall("v+c+", shape))

    def vowel(s):
        return any(not consonant(s, i) for i in range(len(s)))

    def double(s):
        return len(s) > 1 and s[-1] == s[-2] and consonant(s, len(s) - 1)

    def cvc(s):
        n = len(s)
        return (
            n > 2
            and consonant(s, n - 3)
            and not consonant(s, n - 2)
            and consonant(s, n - 1)
            and s[-1] not in "wxy"
        )

    w = word
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        if measure(w[:-3]) > 0:
            w = w[:-1]
    else:
        cut = next((w[: -len(e)] for e in ("ed", "ing") if w.endswith(e) and vowel(w[: -len(e)])), None)
        if cut is not None:
            w = cut
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif double(w):
                w = w if w[-1] in "lsz" else w[:-1]
            elif measure(w) == 1 and cvc(w):
                w += "e"
    if w.endswith("y") and vowel(w[:-1]):
        w = w[:-1] + "i"
    step2 = (
        "ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e ousli:ous "
        "ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al iviti:ive "
        "biliti:ble logi:log"
    )
    step3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
    for step in (step2, step3):
        for rule in step.split(" "):
            old, new = rule.split(":")
            if w.endswith(old):
                if measure(w[: -len(old)]) > 0:
                    w = w[: -len(old)] + new
                break
    step4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
    for old in step4.split(" "):
        if w.endswith(old):
            stem = w[: -len(old)]
            if measure(stem) > 1 and (old != "ion" or stem.endswith(("s", "t"))):
                w = stem
            break
    if w.endswith("e"):
        stem = w[:-1]
        if measure(stem) > 1 or measure(stem) == 1 and not cvc(stem):
            w = stem
    if w.endswith("ll") and measure(w) > 1:
        w = w[:-1]
    return w
