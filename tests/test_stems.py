import itertools
import random

from brute import porter as brute_porter

from pyspark.sql import functions as F

from lexmill.functions import porter as P
from lexmill.functions.text import DF
from lexmill.operators.stems import attach_stems, stem_vocabulary


def stems(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "term string")
    return {r.term: r.stem for r in df.select("term", P.porter("term").alias("stem")).collect()}


# Examples published with the algorithm, and stems that the recorded results hold.
EXAMPLES = """caresses:caress ponies:poni ties:ti caress:caress cats:cat feed:feed agreed:agre plastered:plaster
bled:bled motoring:motor sing:sing conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan
falling:fall hissing:hiss fizzed:fizz failing:fail filing:file happy:happi sky:sky relational:relat
conditional:condit rational:ration valenci:valenc hesitanci:hesit digitizer:digit radicalli:radic
differentli:differ vileli:vile analogousli:analog vietnamization:vietnam predication:predic operator:oper
feudalism:feudal decisiveness:decis hopefulness:hope callousness:callous formaliti:formal sensitiviti:sensit
sensibiliti:sensibl triplicate:triplic formative:form formalize:formal electriciti:electr electrical:electr
hopeful:hope goodness:good revival:reviv allowance:allow inference:infer airliner:airlin gyroscopic:gyroscop
adjustable:adjust defensible:defens irritant:irrit replacement:replac adjustment:adjust dependent:depend
adoption:adopt homologou:homolog communism:commun activate:activ angulariti:angular homologous:homolog
effective:effect bowdlerize:bowdler probate:probat rate:rate cease:ceas controll:control roll:roll
apos:apo categories:categori this:thi used:us day:dai age:ag is:is as:as""".split()


def test_published_examples(spark):
    expected = dict(pair.split(":") for pair in EXAMPLES)
    assert stems(spark, expected) == expected


def test_equals_brute_force_on_every_short_ending(spark):
    heads = ["", "b", "ab", "tr", "cont", "relat", "yay", "sy", "b2", "hopp", "fall"]
    tails = [s for s, _ in P.STEP_2 + P.STEP_3] + P.STEP_4
    tails += ["s", "es", "ies", "sses", "ss", "eed", "ed", "ing", "at", "bl", "iz", "y", "yy", "e", "ll", "lle"]
    words = {h + t for h, t in itertools.product(heads, tails)}
    words |= {h + t + e for h, t, e in itertools.product(heads[:6], tails, ("s", "ed", "ing", "ness"))}
    words.discard("")
    found = stems(spark, sorted(words))
    assert {w: s for w, s in found.items() if s != brute_porter(w)} == {}


def test_equals_brute_force_on_random_words(spark):
    rnd = random.Random(3)
    words = {"".join(rnd.choices("aeiouybcdlnrstz2", k=rnd.randint(1, 9))) for _ in range(4000)}
    words |= {"".join(rnd.choices("ayys", k=rnd.randint(1, 7))) for _ in range(500)}
    words |= {w + e for w in list(words)[:1500] for e in ("ing", "ed", "ation", "eli", "y", "ive")}
    found = stems(spark, sorted(words))
    assert {w: s for w, s in found.items() if s != brute_porter(w)} == {}


def test_stem_vocabulary_has_one_row_per_token(spark):
    df = spark.createDataFrame([("Days of days, day",), ("day x_1",)], ["text"])
    rows = sorted(map(tuple, stem_vocabulary(df, profile=DF).collect()))
    assert rows == [("day", "dai"), ("days", "dai"), ("of", "of")]


def test_attach_stems_needs_only_a_part_of_the_vocabulary(spark):
    tokens = spark.createDataFrame([(1, "cats"), (1, "dogs"), (2, "cats")], "doc int, term string")
    part = spark.createDataFrame([("cats", "cat")], "term string, stem string")
    rows = attach_stems(tokens, part, "term").collect()
    assert sorted(map(tuple, rows)) == [(1, "cat"), (1, "dog"), (2, "cat")]


def test_first_letters_rule_out_no_stem(spark):
    """Every word passes the look at its first letters for its own stem: corpus words, and all endings on short roots."""
    endings = (
        "ational tional enci anci izer bli alli entli eli ousli ization ation ator alism iveness fulness ousness aliti "
        "iviti biliti logi icate ative alize iciti ical ful ness al ance ence er ic able ible ant ement ment ent ion ou "
        "ism ate iti ous ive ize e y s es ed ing ly ity ency ancy ability ably ies ied eed ying tional"
    ).split()
    roots = "b ab on th fil hop sens poss relat trad agre cry tan run fall fizz lik ol pa pos op".split()
    words = [r + a + b for r in roots for a in ["", *endings] for b in ["", "s", "ed", "ing", "ness", "ly", "ity", "y"]]
    for word in words:
        stem = brute_porter(word)
        assert word.startswith(stem[:-1] if stem[-1:] in ("i", "e", "l") else stem), (word, stem)
    df = spark.createDataFrame([(w,) for w in ("ability", "ponies", "filing", "cats", "dog")], "w string")
    kept = df.where(P.may_stem_to(F.col("w"), ["abl", "poni", "file", "cat"]))
    assert sorted(r.w for r in kept.collect()) == ["ability", "cats", "filing", "ponies"]
