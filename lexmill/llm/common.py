"""Helpers shared by the operators of this package.

Operators keep the caller's row in one struct column while they work, so that
its columns cannot clash with theirs. On the way out, a column that an operator
produces replaces an input column of the same name.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that separates words in all contracts.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = "[ \\t-\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Takes the place of a missing id, so that it sorts after all others.
LAST_ID = 2**63 - 1


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """The whole row as the struct ``row``, and working columns beside it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *columns)


def unpacked(df: DataFrame, names: Sequence[str], made: dict[str, Column]) -> list[Column]:
    """The columns ``names`` of ``row`` with those of ``made`` in place of equal names, then the rest of ``made``."""
    kept = [made[c].alias(c) if c in made else F.col("row").getField(c).alias(c) for c in names]
    return kept + [column.alias(c) for c, column in made.items() if c not in names]


def fenced(df: DataFrame, keep: Sequence[str], made: dict[str, Column]) -> DataFrame:
    """The columns ``keep`` and ``made``, with a generator in between that no filter is pushed through.

    A filter on what an expensive expression made would otherwise be evaluated
    below it, with the expression copied into it, and into its lambdas.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[column.alias(name) for name, column in made.items()]))))


def doc_key(doc: str) -> Column:
    """An integer id that is never null: a missing id counts as the largest."""
    return F.coalesce(F.col(f"`{doc}`").cast("bigint"), F.lit(LAST_ID))


def _folder_for_now(prefix: str) -> str:
    folder = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session may leave it unset; the application then gets a folder
    of its own, which is removed when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = _folder_for_now("llm-shared-")
    return _own_folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, *, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back.

    That cuts the lineage: what follows survives lost executors, and the plan
    above it is computed once.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(_folder_for_now("llm-package-")) / f"{top.name}.zip"
    with zipfile.ZipFile(archive, "w") as whole:
        for module in sorted(top.rglob("*.py")):
            whole.write(module, module.relative_to(top.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
