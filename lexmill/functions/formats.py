"""Scores, and the text forms of records: pairs, stripes, term-frequency stripes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import trim_blanks, whole_number

# Fixed value: the collection size the TF-IDF formula assumes, whatever the real corpus size.
COLLECTION_SIZE = 10000.0


def tf_idf(tf: Column, df: Column, n_docs: float = COLLECTION_SIZE) -> Column:
    """``tf * ln(n_docs / df + 1)``, rounded to six places."""
    return F.round(tf * F.log(F.lit(float(n_docs)) / df + F.lit(1.0)), 6)


def score_text(score: Column) -> Column:
    return F.format_string("%.6f", score)


def pair_key(w: Column, u: Column) -> Column:
    return F.concat_ws(",", w, u)


def stripe_text(stripe: Column) -> Column:
    """``{a=1, b=2}`` with the neighbours in order; a map by itself has none."""
    entries = F.sort_array(F.map_entries(stripe))
    cells = F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return F.concat(F.lit("{"), F.array_join(cells, ", "), F.lit("}"))


def tf_stripe_text(stripe: Column) -> Column:
    """``a:1,b:2`` with the terms in order."""
    entries = F.sort_array(F.map_entries(stripe))
    return F.array_join(
        F.transform(entries, lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), ","
    )


def tf_stripe_entries(text: Column) -> Column:
    """Decode ``a:1,b:2`` into ``array<struct<term, tf>>``; malformed cells are dropped, colons at their end ignored."""
    cells = F.transform(F.split(text, ","), lambda cell: F.split(F.regexp_replace(cell, ":+$", ""), ":"))
    cells = F.transform(
        F.filter(cells, lambda parts: F.size(parts) == 2),
        lambda parts: F.struct(
            trim_blanks(F.get(parts, F.lit(0))).alias("term"), whole_number(F.get(parts, F.lit(1))).alias("tf")
        ),
    )
    return F.filter(cells, lambda cell: cell["tf"].isNotNull())
