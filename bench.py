"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores,
BENCH_QUERIES an optional comma-separated choice of queries, and BENCH_RUNS how
often each is run: the median counts. The vocabulary that co-occurrence
queries share is computed once and timed apart, as ``vocabulary``.
"""

from __future__ import annotations

import json
import os
import time
from functools import lru_cache
from statistics import median

from lexmill.plans import registry
from lexmill.plans.registry import QUERIES
from lexmill.session import session

HEADLINE = [
    "vocabulary",
    "top_words",
    "word_counts",
    "cooc_pairs_d1",
    "cooc_pairs_d4",
    "cooc_pairs_line_preagg_d2",
    "cooc_pairs_band_d2",
    "cooc_pairs_large_vocabulary_d1",
    "cooc_pairs_large_vocabulary_d4",
    "cooc_stripes_d1",
    "cooc_stripes_d4",
    "doc_freq_line",
    "doc_freq_doc",
    "doc_freq_stemmed",
    "df_top100_stemmed",
    "term_freq",
    "tfidf",
    "tfidf_stemmed",
    "term_freq_long_stop_list",
    "vocab_stems",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(
        f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's compilers outside the timings.
    QUERIES["top_words"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    words = registry.vocabulary
    registry.vocabulary = lru_cache(words)
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            if name == "vocabulary":
                words(spark, sf_dir)
            else:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(median(times), 3)
    print(
        json.dumps(
            {
                "metric": "corpus_statistics_total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
