"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Python tasks get Arrow batches of at most so many rows and bytes, so that one batch of long texts fits beside the heap.
BATCH_ROWS, BATCH_BYTES = 512, 8 * 1024 * 1024

#: White space of all word rules here: space and the controls U+0009 to U+000D.
SPACE = r"[ \t-\r]"
NOT_SPACE = r"[^ \t-\r]"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SHIPPED: set[str] = set()


def ready_workers(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, and hand this package to workers that cannot import it.

    The batch settings are read when a plan with Python in it starts. The package (some hundred kilobytes) is served by
    Spark itself, once for each application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        package = Path(__file__).parent.parent
        target = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}.zip"
        with zipfile.ZipFile(target, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(target))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The runs of other than white space, as an array; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def shingle_hashes(word_array: Column, width: int) -> Column:
    """Sorted distinct 64-bit hashes of all runs of `width` words; the whole sequence is one shingle if it is shorter.

    No words: empty array.
    """
    none = F.array().cast("array<bigint>")

    def hashes(w: Column) -> Column:
        n = F.size(w)
        runs = F.transform(
            F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(width)))
        )
        return F.when(n >= width, runs).when(n > 0, F.array(F.xxhash64(F.concat_ws("\n", w)))).otherwise(none)

    # The lambda binds the array of words, which is then built once and not once for every use.
    return F.sort_array(F.array_distinct(F.get(F.transform(F.array(word_array), hashes), 0)))
