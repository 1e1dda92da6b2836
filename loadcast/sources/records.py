"""Records of text files whose quoted cells hold line breaks, cut in parallel over any number of splits.

A line does not know whether it begins inside a quoted cell, but it can be read under both assumptions: it maps the state
before it (outside or inside a cell) to the state after it. Such maps compose, so the map of a split follows from its
lines, the state at a split's begin from the maps of the splits before it in the file, and with that every line's state.
A record begins at a line that starts outside. Lines that are a record by themselves stay where they are; only the lines of
longer records move, to be put together. A record's number is its place in the file, so no second pass numbers the rows.

One file may have any size: no task holds more than a split, and what is carried over splits is one row for each. Lines are
searched for quotes and put in order once, and written with what was found under both assumptions.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loadcast.session import materialize

#: A cell opens with a quote at its begin; two quotes inside are one; after the closing quote text goes on to the separator.
_CLOSE = r'[^"]*+(?:""[^"]*+)*+"(?!")'


def _outside_pattern(sep: str) -> str:
    """Lines that end inside a cell if they begin outside."""
    s = f"\\x{ord(sep):02x}"
    return rf'^(?:(?:"{_CLOSE}[^{s}]*+|[^"{s}][^{s}]*+)?+{s})*+"[^"]*+(?:""[^"]*+)*+$'


def ends_inside(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends inside a quoted cell if it begins outside one, and if it begins inside one."""
    quoted = F.contains(line, F.lit('"'))
    s = f"\\x{ord(sep):02x}"
    closes = line.rlike(f"^{_CLOSE}")
    rest = F.regexp_extract(line, rf"^{_CLOSE}[^{s}]*+{s}?+((?s:.*))$", 1)
    outside = F.when(quoted, line.rlike(_outside_pattern(sep))).otherwise(F.lit(False))
    inside = F.when(quoted & closes, rest.rlike(_outside_pattern(sep))).otherwise(F.lit(True))
    return outside, inside


def may_break(line: Column, seps: list[str]) -> Column:
    """Whether a line opens a cell that it does not close, under any of the separators."""
    found = F.lit(False)
    for s in seps:
        found = found | line.rlike(_outside_pattern(s))
    return F.contains(line, F.lit('"')) & found


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """_stem, _file, _block, _at and `line`: lines with their place; carriage returns stay, a byte order mark goes."""
    return spark.read.text(paths, lineSep="\n").select(
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
        F.regexp_replace("value", "^\ufeff", "").alias("line"),
    )


def cut_records(lines: DataFrame, sep: str) -> DataFrame:
    """_name, _file, `record` (its place in the file, from 1) and `value`, its text without the last line break.

    Blank lines between records are none. A cell that is still open where its file ends is an error.
    """
    outside, inside = ends_inside(F.col("line"), sep)
    split = ["_file", "_block"]
    coded = lines.withColumns({"_o": outside, "_i": inside, "_blank": F.trim(F.col("line")).isin("", "\r")})
    # What is known at a line from the lines before it in its split: the result of the last line that gives the same
    # state either way, and how many lines since then turn the state around.
    order = W.partitionBy(*split).orderBy("_at")
    before, upto = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(W.unboundedPreceding, 0)
    fixed = F.col("_o") == F.col("_i")
    turned = F.sum((F.col("_o") & ~F.col("_i")).cast("long"))
    coded = coded.withColumns(
        {
            "_known": F.last(F.when(fixed, F.col("_o")), ignorenulls=True).over(before),
            "_turns": F.coalesce(turned.over(before), F.lit(0)),
            "_all_turns": turned.over(upto),
        }
    )
    coded = coded.withColumn(
        "_since", F.coalesce(F.last(F.when(fixed, F.col("_all_turns")), ignorenulls=True).over(before), F.lit(0))
    )
    turn = (F.col("_turns") - F.col("_since")) % 2 == 1

    def state(start: Column) -> Column:
        """Whether a line begins inside a cell, given the state at the begin of its split."""
        return F.coalesce(F.col("_known"), start) != turn

    coded = coded.withColumns({"_s0": state(F.lit(False)), "_s1": state(F.lit(True))}).drop("_known", "_turns", "_all_turns", "_since")

    def after(s: str) -> Column:
        return F.when(F.col(s), F.col("_i")).otherwise(F.col("_o"))

    def begun(s: str) -> Column:
        """Records that begin in the split up to a line."""
        return F.sum((~F.col(s) & ~F.col("_blank")).cast("long")).over(upto)

    coded = materialize(coded.withColumns({"_n0": begun("_s0"), "_n1": begun("_s1")}), "lines")
    splits = coded.groupBy(*split).agg(
        F.max_by(F.struct(after("_s0").alias("e0"), after("_s1").alias("e1")), "_at").alias("end"),
        F.max("_n0").alias("n0"),
        F.max("_n1").alias("n1"),
    )
    # The same composition over the splits of a file, one row each.
    in_file = W.partitionBy("_file").orderBy("_block")
    prior = in_file.rowsBetween(W.unboundedPreceding, -1)
    same = F.col("end.e0") == F.col("end.e1")
    flips = F.sum((F.col("end.e0") & ~F.col("end.e1")).cast("long"))
    splits = splits.withColumns(
        {
            "_known": F.last(F.when(same, F.col("end.e0")), ignorenulls=True).over(prior),
            "_flips": F.coalesce(flips.over(prior), F.lit(0)),
            "_all": flips.over(in_file.rowsBetween(W.unboundedPreceding, 0)),
        }
    )
    splits = splits.withColumn(
        "_since", F.coalesce(F.last(F.when(same, F.col("_all")), ignorenulls=True).over(prior), F.lit(0))
    )
    start = F.coalesce(F.col("_known"), F.lit(False)) != ((F.col("_flips") - F.col("_since")) % 2 == 1)
    splits = splits.withColumn("_start", start).withColumn("_n", F.when(F.col("_start"), F.col("n1")).otherwise(F.col("n0")))
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(prior), F.lit(0)))
    last = F.row_number().over(W.partitionBy("_file").orderBy(F.col("_block").desc())) == 1
    end = F.when(F.col("_start"), F.col("end.e1")).otherwise(F.col("end.e0"))
    splits = splits.withColumn("_open", last & end).withColumn("_open", F.max("_open").over(W.partitionBy("_file")))
    # One row for each split, found once; its size on disk lets Spark send it to the lines instead of shuffling them.
    placed = coded.join(materialize(splits.select(*split, "_start", "_before", "_open"), "splits"), split)
    placed = placed.withColumn("_s", F.when(F.col("_start"), F.col("_s1")).otherwise(F.col("_s0")))
    # Blank lines between records go here.
    placed = placed.where(F.col("_s") | ~F.col("_blank")).withColumn("_e", after("_s"))
    placed = placed.withColumn("record", F.col("_before") + F.when(F.col("_start"), F.col("_n1")).otherwise(F.col("_n0")))
    whole = F.regexp_replace("line", "\r$", "")
    single = placed.where(~F.col("_s") & ~F.col("_e")).select("_name", "_file", "record", whole.alias("value"))
    refuse = F.raise_error(F.concat(F.lit("a quoted cell has no end in "), F.col("_file")))
    several = (
        placed.where(F.col("_s") | F.col("_e"))
        .withColumn("line", F.when(F.col("_open"), refuse).otherwise(F.col("line")))
        .groupBy("_name", "_file", "record")
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_at", "line"))).alias("l"))
        .select("_name", "_file", "record", F.regexp_replace(F.array_join("l.line", "\n"), "\r$", "").alias("value"))
    )
    return single.unionByName(several)


def column_names(header: str, sep: str) -> list[str]:
    """Cells of a header; equal ones get their place as Spark's reader does it, empty ones a name."""
    cells = next(csv.reader(io.StringIO(header, newline=""), delimiter=sep), [])
    lower = [c.lower() for c in cells]
    return [f"_c{k}" if not c else f"{c}{k}" if lower.count(c.lower()) > 1 else c for k, c in enumerate(cells)]


def parse_records(records: DataFrame, header: str, sep: str) -> DataFrame:
    """The records after each file's first as text under the header's names, with _name and `record`."""
    names = column_names(header, sep)
    schema = ", ".join(f"c{k} string" for k in range(len(names)))
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    cells = records.where("record > 1").select("_name", "record", F.from_csv("value", schema, options).alias("_cells"))
    return cells.select("_name", "record", *[F.col(f"_cells.c{k}").alias(c) for k, c in enumerate(names)])
