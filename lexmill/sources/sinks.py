"""Tab-separated text output, and the scratch folder for intermediate files."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def write_tsv(df: DataFrame, path: str, *columns: str | Column, mode: str = "errorifexists") -> None:
    """One text line per row, fields joined with tabs. By default an existing output fails the write."""
    fields = [F.col(c) if isinstance(c, str) else c for c in (columns or df.columns)]
    line = F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("")) for c in fields])
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_top_tsv(df: DataFrame, path: str, *columns: str | Column, mode: str = "errorifexists", k: int = 10_000) -> None:
    """As ``write_tsv`` into a single file, in order. More than ``k`` rows raise: they belong in many files.

    At most ``k`` + 1 rows pass through the driver, and what computes them keeps its tasks.
    """
    rows = df.take(k + 1)
    if len(rows) > k:
        raise ValueError(f"more than {k} rows for a single file")
    write_tsv(df.sparkSession.createDataFrame(rows, df.schema).coalesce(1), path, *columns, mode=mode)


def write_sorted_tsv(
    df: DataFrame,
    path: str,
    *columns: str | Column,
    key: Sequence[str | Column],
    files: int | None = None,
    mode: str = "errorifexists",
) -> None:
    """As ``write_tsv`` in the order of ``key``, within files and, by their names, across them.

    Rows are dealt by ranges of sampled bounds, so no task gets more than its
    share but for rows of one key. ``files`` bounds the number of files, by
    default ``spark.sql.shuffle.partitions``.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in key]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    write_tsv(dealt.sortWithinPartitions(*order), path, *columns, mode=mode)


RUN = "run"


def write_run(df: DataFrame, path: str, run: str) -> None:
    """The partial result of one run, say over some of the input's splits, as part ``run`` of the table at ``path``.

    A run that is repeated replaces its part and leaves those of the others, so
    what is merged from the table counts no split twice.
    """
    tagged = df.withColumn(RUN, F.lit(run))
    tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).parquet(path)


def read_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows of all runs written to ``path`` so far, as one table of the given schema."""
    # Without a schema Spark would guess the type of the runs' names.
    tagged = spark.read.schema(StructType([*schema.fields, StructField(RUN, StringType())])).parquet(path)
    return tagged.drop(RUN)


_own_folders: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh path under ``root``, by default the cluster's shared folder (``spark.checkpoint.dir``).

    Only a local session may do without either. It then gets a folder of its
    own for the application, which is removed when Python ends.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _own_folders:
            own = _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="lexmill-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        root = _own_folders[context.applicationId]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


# With this setting Spark removes what a query shuffled when the query ends, not when the driver's garbage is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` to a fresh table in the scratch folder and read it back: what follows does not compute it again.

    Nothing that was shuffled to compute it is left on the executors' disks.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, name, root), spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
