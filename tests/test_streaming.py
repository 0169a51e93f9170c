from lexmill.operators.counts import word_counts


def test_word_counts_of_a_corpus_that_arrives_in_parts(spark, text_file, tmp_path):
    text_file("in/1.txt", "the cat", "cat")
    text_file("in/2.txt", "the dog")
    parts = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    counts = word_counts(parts, text="value", stop=["the"])
    query = (
        counts.writeStream.outputMode("complete")
        .format("memory")
        .queryName("arriving")
        .option("checkpointLocation", str(tmp_path / "state"))
        .start()
    )
    try:
        query.processAllAvailable()
        assert dict(map(tuple, spark.table("arriving").collect())) == {"cat": 2, "dog": 1}
    finally:
        query.stop()
