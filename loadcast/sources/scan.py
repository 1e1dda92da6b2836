"""File scans: energy parts, weather exports, the branch mapping."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions.text import py_token, token
from loadcast.session import materialize
from loadcast.sources.limits import part_order
from loadcast.sources.records import cut_records, may_break, parse_records, text_lines

PART_REGEX = r"^Dane_\d+$"
_SEPARATORS = [";", ",", "\t", "|"]


def _stem(path: str) -> str:
    return re.sub(r"\.[A-Za-z0-9]+$", "", path.rstrip("/").split("/")[-1])


def _stem_column(file_name: Column) -> Column:
    return F.regexp_replace(F.url_decode(file_name), r"\.[A-Za-z0-9]+$", "")


def _kind(paths: list[str], fmt: str | None) -> str:
    if fmt:
        return fmt
    suffix = paths[0].rstrip("/").split(".")[-1].lower()
    return "csv" if suffix in ("csv", "txt") else "parquet"


def _separator(line: str) -> str:
    return max(_SEPARATORS, key=line.count)


def _first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """One row per file: its first line and whether a line of it may open a quoted cell that goes on in the next."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), place.alias("place"), "value", may_break(F.col("value"), _SEPARATORS).alias("b")
    )
    first = F.regexp_replace(F.coalesce(F.min_by("value", "place"), F.lit("")), "^\ufeff|\r$", "").alias("line")
    return lines.groupBy("file").agg(first, F.max("b").alias("breaks"))


def _header_groups(spark: SparkSession, paths: list[str]) -> list[tuple[str, bool, list[str]]]:
    """(first line, whether cells go over lines, files) of the files that share both.

    Files are grouped in the cluster and only distinct first lines reach the driver. Where all files agree, which is the
    rule, they are read by the paths as given and no file name is collected.
    """
    first = materialize(_first_lines(spark, paths), "headers")
    kinds = first.groupBy("line", "breaks").agg(F.min("file").alias("least")).orderBy("least").collect()
    if len(kinds) == 1:
        return [(kinds[0].line, kinds[0].breaks, paths)]
    groups = []
    for k in kinds:
        same = first.where((F.col("line") == k.line) & (F.col("breaks") == k.breaks))
        groups.append((k.line, k.breaks, [r.file for r in same.select("file").orderBy("file").collect()]))
    return groups


def _numbered(spark: SparkSession, paths: list[str], kind: str, sep: str | None) -> list[DataFrame]:
    """Frames with provenance, one per set of files with the same header; of other formats one frame."""
    if kind != "csv":
        return [_with_row_number(spark.read.format(kind).load(paths), kind)]
    out = []
    for line, breaks, files in _header_groups(spark, paths):
        s = sep or _separator(line)
        if breaks:
            out += _cut(spark, files, s)
            continue
        df = spark.read.options(header=True, sep=s, encoding="UTF-8", escape='"').csv(files)
        out.append(_with_row_number(df.toDF(*[c.lstrip("\ufeff") for c in df.columns]), kind))
    return out or [_with_row_number(spark.read.options(header=True, sep=sep or ";").csv(paths), kind)]


def _cut(spark: SparkSession, files: list[str], sep: str) -> list[DataFrame]:
    """The same for files with cells over several lines; their headers may be such records too."""
    records = cut_records(text_lines(spark, files), sep)
    headers = records.where("record = 1").groupBy("value").agg(F.min("_file").alias("least")).orderBy("least").collect()
    own = records.where("record = 1").select("_file", F.col("value").alias("header"))
    out = []
    for h in headers:
        some = records if len(headers) == 1 else records.join(own.where(F.col("header") == h.value), "_file", "left_semi")
        rows = parse_records(some, h.value, sep)
        sheet = _stem_column(F.col("_name")).alias("source_sheet")
        out.append(rows.select(sheet, F.col("record").alias("source_row"), *[F.col(f"`{c}`") for c in rows.columns[2:]]))
    return out


def _with_row_number(df: DataFrame, kind: str) -> DataFrame:
    """Adds source_sheet (file stem) and source_row (first data row is 2).

    Parquet knows its row index. Text splits do not, so the rows of every split are counted first and a row's number
    is its split's offset plus its place in the split: two narrow scans, no global sort, no single task.
    """
    tagged = df.select(
        _stem_column(F.col("_metadata.file_name")).alias("source_sheet"),
        F.col("_metadata.file_path").alias("_file"),
        (F.col("_metadata.row_index") if kind == "parquet" else F.monotonically_increasing_id()).alias("_pos"),
        F.col("_metadata.file_block_start").alias("_block"),
        *[F.col(f"`{c}`") for c in df.columns],
    )
    if kind == "parquet":
        return tagged.withColumn("source_row", F.col("_pos") + 2).drop("_file", "_pos", "_block")
    splits = tagged.groupBy("_file", "_block").agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.select(
        "_file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        tagged.join(splits, ["_file", "_block"])
        .withColumn("source_row", F.col("_offset") + F.col("_pos") - F.col("_first") + 2)
        .drop("_file", "_pos", "_block", "_first", "_offset")
    )


def pick_energy_columns(df: DataFrame) -> DataFrame:
    """Nine energy columns as text: by name when all nine exist, else the first nine by position."""
    extra = [c for c in ("source_sheet", "source_row") if c in df.columns]
    body = [c for c in df.columns if c not in extra]
    for known in (N.ENERGY_COLUMNS, N.SOURCE_ENERGY_COLUMNS):
        if set(known) <= set(body):
            chosen = known
            break
    else:
        if len(body) < len(N.ENERGY_COLUMNS):
            raise ValueError(f"energy source has {len(body)} columns, at least {len(N.ENERGY_COLUMNS)} are needed")
        chosen = body[: len(N.ENERGY_COLUMNS)]
    return df.select(
        *extra, *[F.col(f"`{old}`").cast("string").alias(new) for old, new in zip(chosen, N.ENERGY_COLUMNS)]
    )


def drop_blank_rows(df: DataFrame) -> DataFrame:
    filled = F.lit(False)
    for name in N.ENERGY_COLUMNS:
        filled = filled | (F.coalesce(F.trim(F.col(name)), F.lit("")) != "")
    return df.filter(filled)


def scan_energy(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    sep: str | None = None,
    part_regex: str | None = None,
) -> DataFrame:
    """Energy rows as text with provenance. With `part_regex` only files whose stem matches are read (all appended)
    and blank rows are dropped; no matching part is an error."""
    paths = [path] if isinstance(path, str) else list(path)
    kind = _kind(paths, fmt)
    if part_regex:
        reader = spark.read.text if kind == "csv" else spark.read.format(kind).load
        found = sorted(reader(paths).inputFiles())
        pattern = re.compile(part_regex, re.IGNORECASE)
        paths = [f for f in found if pattern.search(_stem(f))]
        if not paths:
            raise ValueError(f"no part matches {part_regex!r}; found {[_stem(f) for f in found]}")
    energy = append_parts(*[pick_energy_columns(df) for df in _numbered(spark, paths, kind, sep)])
    return drop_blank_rows(energy) if part_regex else energy


def scan_weather(
    spark: SparkSession, path: str | list[str], fmt: str | None = None, sep: str | None = None
) -> DataFrame:
    """Weather export with `src_order`, the place of a row in its source (breaks issue-time ties)."""
    paths = [path] if isinstance(path, str) else list(path)
    kind = _kind(paths, fmt)
    return append_parts(*[_with_order(df) for df in _numbered(spark, paths, kind, sep)])


def _with_order(rows: DataFrame) -> DataFrame:
    """`src_order` in place of the provenance: parts in natural order, then rows."""
    a, b, c = part_order()
    order = F.struct(a.alias("part"), b.alias("part_no"), c.alias("name"), F.col("source_row").alias("row")).alias("src_order")
    return rows.select(order, *[F.col(f"`{c}`") for c in rows.columns if c not in ("source_sheet", "source_row")])


def rename_by_alias(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Rename headers to canonical names; the first alias that occurs wins."""
    by_token = {py_token(c): c for c in df.columns}
    renames = {}
    for canonical, choices in aliases.items():
        source = next((by_token[py_token(a)] for a in choices if py_token(a) in by_token), None)
        if source is not None:
            renames[source] = canonical
    return df.withColumnsRenamed(renames)


def append_parts(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def mapping_conflicts(mapping: DataFrame) -> DataFrame:
    """Active branch keys with more than one point (a missing point counts as a value of its own)."""
    return (
        _active(mapping)
        .groupBy("branch_key")
        .agg(
            (
                F.countDistinct("point") + F.max(F.col("point").isNull().cast("int"))
            ).alias("n_points")
        )
        .filter("n_points > 1")
    )


def _active(mapping: DataFrame) -> DataFrame:
    return mapping.filter(F.lower("status") == "active").withColumn("branch_key", token(F.col("branch_code")))


def resolve_mapping(mapping: DataFrame, order: str | None = None) -> DataFrame:
    """branch_key → point for active rows; the first row of a key wins.

    `order` names the file-order column (`src_order` of a scanned mapping). Without one the smallest point wins, so that
    the result does not depend on how rows lie in partitions.
    """
    order = order or ("src_order" if "src_order" in mapping.columns else None)
    place = F.col(order) if order else F.struct(F.col("point").isNull(), "point")
    return _active(mapping).groupBy("branch_key").agg(F.min_by(F.struct("point"), place).alias("_p")).select(
        "branch_key", F.col("_p.point").alias("point")
    )


def scan_mapping(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A mapping file with `src_order`, the place of a row in it."""
    parts = [_with_order(df) for df in _numbered(spark, [path], "csv", sep)]
    return checked_mapping(append_parts(*[rename_by_alias(df, N.MAPPING_ALIASES) for df in parts]))


def checked_mapping(mapping: DataFrame) -> DataFrame:
    """Required columns and no contradictory active rows, else ValueError."""
    missing = {"branch_code", "point", "status"} - set(mapping.columns)
    if missing:
        raise ValueError(f"mapping lacks columns {sorted(missing)}")
    conflicts = [r.branch_key for r in mapping_conflicts(mapping).select("branch_key").collect()]
    if conflicts:
        raise ValueError(f"contradictory active branch mappings: {sorted(conflicts)}")
    return mapping
