import math
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lexmill.plans import pipelines, registry
from lexmill.session import session
from lexmill.sources import corpus, sinks, wordlists


def words(df):
    return sorted(r.word for r in df.collect())


def test_all_line_ends(spark, text_file):
    for end in ("\n", "\r\n", "\r"):
        path = text_file(f"lines{ord(end[0])}{len(end)}.txt", "one", "", "two", end=end)
        assert [r.line for r in corpus.read_lines(spark, path).collect()] == ["one", "", "two"]
        table = spark.createDataFrame([(end.join(["one", "", "two"]),)], ["text"])
        assert [r.line for r in corpus.lines_of(table).collect()] == ["one", "", "two"]


def test_documents_are_named_by_file(spark, text_file, tmp_path):
    text_file("a/x 1.txt", "first", "second")
    text_file("b/x 1.txt", "third")
    text_file("b/y.txt", "fourth")
    folders = [str(tmp_path / "a"), str(tmp_path / "b")]
    by_name = corpus.read_documents(spark, folders).groupBy("doc_id").count().collect()
    assert sorted(r["count"] for r in by_name) == [1, 3]
    assert corpus.read_documents(spark, folders, full_path=True).select("doc_id").distinct().count() == 3
    whole = corpus.read_documents(spark, folders, whole=True).where("text LIKE '%second%'").first()
    assert whole.text == "first\nsecond"


def test_stop_words(spark, text_file):
    a = text_file("stop1.txt", " The\t", "", "of", "OF")
    b = text_file("stop2.txt", "and")
    assert words(wordlists.read_stop_words(spark, [a, b])) == ["and", "of", "the"]
    with pytest.raises(AnalysisException):
        wordlists.read_stop_words(spark, a + ".missing")


def test_vocabulary_formats(spark, text_file):
    path = text_file("top.txt", "The\t10", "  of 9 ", "", "The\t3")
    assert words(wordlists.read_vocabulary(spark, path, fmt="first_field")) == ["The", "of"]
    assert words(wordlists.read_vocabulary(spark, path, fmt="line")) == ["of 9", "the\t10", "the\t3"]
    with pytest.raises(ValueError):
        wordlists.read_vocabulary(spark, path, fmt="other")


def test_tolerant_df_table(spark, text_file):
    path = text_file(
        "df.tsv", "a\t1", "", "b", "c\t1\t2", "d\tx", "e\t1.0", "f\t99999999999999999999", "big\t3000000000", " g \t +5 ", "h\t-3", "a\t7", "i\t"
    )
    rows = sorted(map(tuple, wordlists.read_counts(spark, path).collect()))
    assert rows == [("a", 1), ("a", 7), ("big", 3_000_000_000), ("g", 5), ("h", -3)]
    rows = sorted(map(tuple, wordlists.read_df_table(spark, path).collect()))
    assert rows == [("a", 7), ("big", 3_000_000_000), ("g", 5), ("h", -3)]


def test_last_duplicate_wins_across_splits(spark, text_file):
    path = text_file("big.tsv", *[f"t{i % 50}\t{i}" for i in range(20_000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 1
        rows = {r.term: r.df for r in wordlists.read_df_table(spark, path).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert rows == {f"t{i}": 19_950 + i for i in range(50)}


def test_tsv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ('b "q"', 2)], "word string, n bigint")
    path = str(tmp_path / "out")
    sinks.write_tsv(df, path)
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a\t1", 'b "q"\t2']
    with pytest.raises(AnalysisException):
        sinks.write_tsv(df, path)
    sinks.write_tsv(df.limit(1), path, "n", F.upper("word"), mode="overwrite")
    assert [r.value for r in spark.read.text(path).collect()] == ["1\tA"]


def test_top_sink_is_one_ordered_file(spark, tmp_path):
    df = spark.range(100).orderBy(F.desc("id")).limit(5)
    sinks.write_top_tsv(df, str(tmp_path / "top"), "id")
    files = list((tmp_path / "top").glob("part-*"))
    assert len(files) == 1 and files[0].read_text().split() == ["99", "98", "97", "96", "95"]


def fake_session(master, **settings):
    context = SimpleNamespace(master=master, getConf=lambda: settings)
    return SimpleNamespace(sparkContext=context, conf=settings)


def test_scratch_folder_follows_the_session(spark):
    shared = fake_session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://shared/tmp/"})
    assert sinks.scratch_path(shared, "x").startswith("hdfs://shared/tmp/x-")
    with pytest.raises(ValueError):
        sinks.scratch_path(fake_session("spark://host:7077"), "x")
    assert sinks.scratch_path(spark, "x") != sinks.scratch_path(spark, "x")


@pytest.mark.parametrize(("have", "after"), [(1, 4), (2, 4), (4, 4), (8, 8)])
def test_small_scans_are_spread_over_idle_cores(spark, have, after):
    found = corpus.spread(spark.range(100, numPartitions=have))
    assert found.rdd.getNumPartitions() == after
    assert ("Exchange" in found._jdf.queryExecution().executedPlan().toString()) == (have < 4)


def test_large_scans_are_never_spread(spark):
    """More than a split of bytes, on fewer partitions than cores."""
    large = spark.range(1 << 30, numPartitions=2)
    assert corpus.spread(large) is large


def test_spread_runs_no_job_and_leaves_shuffled_data(spark):
    shuffled = spark.range(100, numPartitions=3).groupBy((F.col("id") % 3).alias("k")).count()
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    assert corpus.spread(shuffled) is shuffled
    assert len(tracker.getJobIdsForGroup()) == before


def test_large_counts_survive_files(spark, tmp_path):
    counts = spark.createDataFrame([("the", 3_000_000_000), ("cat", 5)], "term string, df bigint")
    path = str(tmp_path / "counts")
    sinks.write_tsv(counts, path, "term", "df")
    for read in (wordlists.read_counts, wordlists.read_df_table):
        assert sorted(map(tuple, read(spark, path).collect())) == [("cat", 5), ("the", 3_000_000_000)]
    assert list(map(tuple, pipelines.top_terms_from_counts(spark, path, 1).collect())) == [(1, "the", 3_000_000_000)]


def test_single_file_sink_refuses_many_rows(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_top_tsv(spark.range(11), str(tmp_path / "many"), "id", k=10)


def test_literals_are_bounded(spark):
    assert wordlists.as_literals(None) == []
    assert wordlists.as_literals(["b", "a", "b"]) == ["a", "b"]
    frame = wordlists.word_frame(spark, ["x", "y", "z"])
    assert wordlists.as_literals(frame, 3) == ["x", "y", "z"]
    assert wordlists.as_literals(frame, 2) is None


def test_chained_run_over_files(spark, text_file, tmp_path):
    """Stop list, corpus, DF table and scores all by file, documents named by base name."""
    stop = wordlists.read_stop_words(spark, text_file("stop.txt", "THE"))
    text_file("corpus/1.txt", "The cats ran", "cat")
    text_file("corpus/2.txt", "the dog")
    corpus_dir = str(tmp_path / "corpus")
    lines = corpus.read_lines(spark, corpus_dir)
    table = str(tmp_path / "top100")
    sinks.write_top_tsv(
        pipelines.top_document_frequency(lines, text="line", stop=stop, k=2), table, "term", "df"
    )
    docs = corpus.read_documents(spark, corpus_dir)
    found = pipelines.tf_idf_scores(docs, wordlists.read_df_table(spark, table), text="line", stop=stop)
    assert sorted(map(tuple, found.collect())) == [
        ("1.txt", "cat", round(2 * math.log(10000 / 2 + 1), 6)),
        ("2.txt", "dog", round(math.log(10000 / 1 + 1), 6)),
    ]
    whole = corpus.read_documents(spark, corpus_dir, whole=True)
    again = pipelines.tf_idf_scores(whole, wordlists.read_df_table(spark, table), stop=stop, row_is_document=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))


def test_document_files_are_bounded(spark, tmp_path, monkeypatch):
    """A folder with nearly all of the text is dealt over files of bounded size, without a change of the results."""
    line = "some words of a line, some more"
    rows = [(i, f"{line} {i}\nsecond", "en", "web") for i in range(2000)] + [(1, "one", "de", "web"), (None, None, None, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    queries = (registry.src_docs_whole, registry.src_docs_by_name)
    want = [sorted(map(tuple, q(spark, str(tmp_path)).collect())) for q in queries]
    assert ("web", "en", 4000, sum(len(f"{line} {i}second") for i in range(2000))) in want[0]
    monkeypatch.setattr(registry, "FILE_BYTES", 10_000)
    path = registry._document_files(spark, str(tmp_path))
    whole = corpus.read_documents(spark, path, full_path=True, whole=True).select("doc_id", F.length("text").alias("n")).collect()
    in_hot = [r.n for r in whole if "source=web/lang=en/" in r.doc_id]
    assert len(in_hot) >= 8 and max(in_hot) < 20_000
    assert [sorted(map(tuple, q(spark, str(tmp_path)).collect())) for q in queries] == want


def test_line_files_are_as_many_as_their_bytes_ask_for(spark, tmp_path, monkeypatch):
    rows = [(i, f"some words of line {i}\nsecond {i}") for i in range(2000)] + [(None, None), (2001, "")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted(map(tuple, registry.src_numbered_lines(spark, str(tmp_path)).collect()))
    monkeypatch.setattr(registry, "FILE_BYTES", 4_000)
    files = corpus.read_lines(spark, registry._line_files(spark, str(tmp_path))).select("_metadata.file_path").distinct().count()
    assert files >= 10
    assert sorted(map(tuple, registry.src_numbered_lines(spark, str(tmp_path)).collect())) == want
    assert [line for _, line in want][:3] == ["some words of line 0", "second 0", "some words of line 1"]


@pytest.fixture
def small_splits(spark):
    """Splits of 2 KB, and no packing of files beyond that."""
    settings = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "100"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_split_size(spark, text_file, small_splits):
    """The setting that ``session(split_bytes=)`` makes decides on the partitions of a scan."""
    path = text_file("long.txt", *["some words"] * 1000)
    assert corpus.read_lines(spark, path).rdd.getNumPartitions() >= 5
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert corpus.read_lines(spark, path).rdd.getNumPartitions() == 1
        assert session(split_bytes="3000").conf.get("spark.sql.files.maxPartitionBytes") == "3000"
        assert corpus.read_lines(spark, path).rdd.getNumPartitions() == 4
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_lines_are_numbered_across_splits_and_files(spark, text_file, tmp_path, small_splits):
    lengths = {"b.txt": 700, "a.txt": 3, "c.txt": 400, "d.txt": 0}
    for name, n in lengths.items():
        text_file(f"in/{name}", *[f"{name} {i} {'x' * (i % 40)}" for i in range(n)], "")
    folder = str(tmp_path / "in")
    found = corpus.read_numbered_lines(spark, folder, full_path=False).collect()
    assert sorted((r.file, r.line_no) for r in found) == sorted((f, i) for f, n in lengths.items() for i in range(n))
    assert all(r.line.split()[:2] == [r.file, str(r.line_no)] for r in found)
    assert corpus.read_numbered_lines(spark, folder).rdd.getNumPartitions() > 5
    whole = sorted(corpus.read_numbered_lines(spark, folder, across=True).collect(), key=lambda r: r.line_no)
    assert [r.line_no for r in whole] == list(range(1103))
    assert [r.line.split()[0] for r in whole] == ["a.txt"] * 3 + ["b.txt"] * 700 + ["c.txt"] * 400


def test_sorted_sink(spark, tmp_path):
    df = spark.range(1000).selectExpr("cast(id * 7919 % 1000 AS string) AS word", "id AS n")
    sinks.write_sorted_tsv(df, str(tmp_path / "out"), "word", "n", key=["word"], files=5)
    files = sorted((tmp_path / "out").glob("part-*"))
    lines = [line.split("\t")[0] for f in files for line in f.read_text().splitlines()]
    assert 1 < len(files) <= 5 and lines == sorted(map(str, range(1000)))
    with pytest.raises(AnalysisException):
        sinks.write_sorted_tsv(df, str(tmp_path / "out"), key=["word"])
