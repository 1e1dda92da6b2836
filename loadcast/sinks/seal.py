"""Seals: a folder of tables counts only when it is complete and unaltered.

The seal is written after everything else and holds a digest of every table that does not depend on the order of rows or
files. A folder that is being written over carries an open seal, so that a run that dies half-way leaves nothing to trust.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEAL = "seal"


class BrokenSeal(ValueError):
    """A folder is incomplete, was altered, or never was finished."""


def table_digest(df: DataFrame) -> dict[str, Any]:
    """Columns, number of rows, and sum and exclusive or of the row hashes: one aggregate with map-side parts.

    Columns count by name, whatever their order. NULLs are told by a mask, because hashes pass over them; the sum tells
    repeated rows, which an exclusive or alone would cancel. An empty table has zero for both.
    """
    fields = sorted(df.schema.fields, key=lambda f: f.name)
    columns = [df[f"`{f.name}`"] for f in fields]
    row = F.xxhash64(F.array(*[c.isNull() for c in columns]), *columns) if columns else F.lit(0).cast("long")
    found = df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.col("h").cast("decimal(20,0)")), F.lit(0)).cast("string").alias("total"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("mixed"),
    ).first()
    return {
        "columns": [f"{f.name} {f.dataType.simpleString()}" for f in fields],
        "rows": found.n,
        "sum": found.total,
        "xor": found.mixed,
    }


def _write(spark: SparkSession, root: str, content: dict[str, Any]) -> None:
    line = spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1)
    line.write.mode("overwrite").text(f"{root.rstrip('/')}/{SEAL}")


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A table below a sealed folder: text where the name says so, else Parquet."""
    return spark.read.text(path) if path.endswith(".txt") or path.endswith("/about") else spark.read.parquet(path)


def open_seal(spark: SparkSession, root: str) -> None:
    """Mark a folder as being written."""
    _write(spark, root, {"state": "open"})


def close_seal(spark: SparkSession, root: str, names: list[str]) -> dict[str, Any]:
    """Digest the tables `names` as they lie below `root` and seal the folder; the last thing that a writer does."""
    base = root.rstrip("/")
    digests = {name: table_digest(_read(spark, f"{base}/{name}")) for name in sorted(names)}
    _write(spark, base, {"state": "closed", "tables": digests})
    return digests


def check_seal(spark: SparkSession, root: str) -> None:
    """Raise `BrokenSeal` unless every sealed table is there with the same rows."""
    base = root.rstrip("/")
    try:
        lines = [r.value for r in spark.read.text(f"{base}/{SEAL}").limit(2).collect()]
        content = json.loads(lines[0]) if len(lines) == 1 else {}
    except (AnalysisException, json.JSONDecodeError):
        content = {}
    if content.get("state") != "closed":
        raise BrokenSeal(f"{base} was never finished: it has no closed seal")
    wrong = []
    for name, want in content["tables"].items():
        try:
            same = table_digest(_read(spark, f"{base}/{name}")) == want
        except AnalysisException:
            same = False
        if not same:
            wrong.append(name)
    if wrong:
        raise BrokenSeal(f"{base} differs from its seal in {', '.join(wrong)}")
