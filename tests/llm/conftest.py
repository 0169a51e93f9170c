from __future__ import annotations

import duckdb
import pytest


@pytest.fixture(scope="session")
def rows(sf_dir):
    """The rows of a table as dicts."""

    def read(name: str) -> list[dict]:
        found = duckdb.sql(f"SELECT * FROM '{sf_dir}/{name}.parquet'")
        return [dict(zip(found.columns, row, strict=True)) for row in found.fetchall()]

    return read


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty, blank and long texts, ties, repeated rows, and columns named as the operators name theirs."""
    texts = [
        (1, "Same line here, long enough\nother words of the first", "a"),
        (2, "same LINE here, long enough  \nother words of the second", "a"),
        (2, "same LINE here, long enough  \nother words of the second", "a"),
        (3, None, None),
        (4, "", "b"),
        (5, " \t\n ", "b"),
        (None, "A text without an id, and without a source", None),
        (6, "one two three four five " * 5000, "c"),
        (7, "x" * 50_000, "c"),
        (8, "Ünïcode \U0001f600 wörds é è", "c"),
        (9, "\n\n\n", "c"),
        (9, "equal id, different text, some more words to be long enough", "c"),
    ]
    names = "d t p row body key dropped size copies position score kept ids words salt".split()
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    return spark.createDataFrame([(*row, *[f"my {n}" for n in names]) for row in texts], schema)
