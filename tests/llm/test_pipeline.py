from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from definitions import WORD, line_dedup, quality_base, quality_llr, sha, simhash_rows

import corpus_pipeline as P
from lexmill.llm import bpe
from lexmill.llm import quality as Q
from lexmill.llm.mixing import mix_report


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What goes into each stage and what comes out, as rows."""
    top = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [[r.asDict() for r in docs.collect()]]
    for name, stage in P.STAGES:
        stage(spark, docs, sf_dir).write.parquet(str(top / name))
        docs = spark.read.parquet(str(top / name))
        seen.append([r.asDict() for r in docs.collect()])
    return seen


def test_names():
    assert [name for name, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mixing", "bpe"]


def test_columns(stages):
    assert all(list(rows[0]) == P.COLUMNS for rows in stages[:-1])


def test_quality(stages, rows):
    before, after = stages[0], stages[1]
    trusted = {r["doc_id"] for r in rows("labels") if r["quality"] == 1}
    ratios = quality_llr(before, trusted, Q.BUCKETS, Q.SMOOTHING)
    kept = [
        d for d, llr in zip(before, ratios, strict=True) if llr >= Q.THRESHOLD and not quality_base(d["text"])["base_failed"]
    ]
    assert sorted(after, key=lambda d: d["doc_id"]) == sorted(kept, key=lambda d: d["doc_id"])


def test_lines(stages):
    before, after = stages[1], stages[2]
    want = {d["doc_id"]: text for d, (text, _, _) in zip(before, line_dedup(before), strict=True)}
    assert {d["doc_id"]: d["text"] for d in after} == want
    assert all(d["n_chars"] == len(d["text"]) for d in after)


def test_near_duplicates(stages):
    before, after = stages[2], stages[3]
    want = {i for i, _, component in simhash_rows(before) if i == component}
    assert {d["doc_id"] for d in after} == want and len(after) == len(want)


def test_mixture(spark, stages):
    before, after = stages[3], stages[4]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    report = mix_report(spark.createDataFrame([tuple(d[c] for c in P.COLUMNS) for d in before], schema)).collect()
    taken = Counter()
    for d in after:
        taken[d["doc_id"]] += len(WORD.findall(d["text"]))
    assert all(taken[r.doc_id] == r.taken for r in report)


def test_tokens(stages):
    library = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path(bpe.RANKS)),
        special_tokens={},
    )
    want = Counter((d["doc_id"], len(library.encode_ordinary(d["text"])), sha(d["text"])) for d in stages[4])
    assert Counter((d["doc_id"], d["n_tokens"], d["decoded_sha256"]) for d in stages[5]) == want


def test_run(spark, sf_dir, stages):
    found = P.run(spark, sf_dir)
    assert Counter(map(tuple, found.collect())) == Counter(tuple(d[c] for c in found.columns) for d in stages[5])


def _odd(spark, odd_docs, tmp_path, rows: str = "true") -> str:
    """A data folder with nulls in every column, repeated rows and ids, blank and long texts, and extra columns."""
    docs = odd_docs.withColumns({"lang": odd_docs["source"], "n_chars": odd_docs["doc_id"]}).where(rows)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(1, 1, 0), (None, 1, None), (2, 0, 1), (7, None, 0)], "doc_id bigint, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_odd_rows(spark, odd_docs, tmp_path):
    """Every stage goes over rows that an earlier stage would have dropped, too."""
    folder = _odd(spark, odd_docs, tmp_path)
    given = spark.read.parquet(f"{folder}/documents.parquet")
    docs = given
    for name, stage in P.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(str(tmp_path / name))
        # The rules reject nearly all of these rows, so the stage after them goes over the given ones again.
        docs = given if name == "quality_rules" else spark.read.parquet(str(tmp_path / name))
        if name != "bpe":
            assert out.columns == P.COLUMNS
    ids = {r.doc_id for r in given.collect()}
    for name, _ in P.STAGES:
        assert {r.doc_id for r in spark.read.parquet(str(tmp_path / name)).collect()} <= ids
    # One document of each group stays, and rows of one id are one document.
    before, after = ([r.asDict() for r in spark.read.parquet(str(tmp_path / x)).collect()] for x in ("line_dedup", "simhash_near_dedup"))
    want = {i for i, _, component in simhash_rows(before) if i == component}
    assert {d["doc_id"] for d in after} == want < {d["doc_id"] for d in before}
    # What the base rules reject is short or repeats itself.
    kept = {r.doc_id for r in spark.read.parquet(str(tmp_path / "quality_rules")).collect()}
    assert kept <= {d["doc_id"] for d in map(lambda r: r.asDict(), given.collect()) if not quality_base(d["text"])["base_failed"]}
    found = P.run(spark, folder).collect()
    assert {r.doc_id for r in found} <= ids


def test_empty_table(spark, odd_docs, tmp_path):
    folder = _odd(spark, odd_docs, tmp_path, "false")
    assert P.run(spark, folder).collect() == []
