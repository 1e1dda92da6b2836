"""Exact "first n in this order" for any n and any type of column, and the input-limit report."""

from __future__ import annotations

import math
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A range of values is narrowed to one of so many parts in a pass, until it holds no more rows than are put in order at once.
_PARTS, _ROWS = 65_536, 10_000


def first_n(df: DataFrame, n: int, order: list[tuple[Column, bool]]) -> DataFrame:
    """First `n` rows by `order`, a coarse-to-fine list of (column, descending); NULL comes last, NaN is the largest number.

    The range of the first column is cut into parts by a function that never turns two values around, rows are counted
    by part, and the part in which row n falls is cut again, until it holds few rows. Better parts are kept by a plain
    filter; only the few rows of the last part are put in order. If one value holds too many rows, the next column goes
    on among them. Only (part, count, least, largest) move, never rows, and the steps are the same for every n. Rows equal
    in all of `order` are taken by a hash of all their columns. Times are compared as whole numbers, so that no zone
    touches them.
    """
    if n <= 0:
        return df.limit(0)
    types = [f.dataType.typeName() for f in df.schema.fields]
    if not any(t in ("map", "variant") for t in types):
        order = [*order, (F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), False)]
    return _first(df, n, [_plain(df, c, descending) for c, descending in order])


def _plain(df: DataFrame, column: Column, descending: bool) -> tuple[Column, str, bool]:
    """The column as a number, text or bytes of the same order, and its kind."""
    kind = df.select(column.alias("v")).schema["v"].dataType.typeName()
    if kind == "timestamp":
        return F.unix_micros(column), "whole", descending
    if kind == "date":
        return F.unix_date(column).cast("long"), "whole", descending
    if kind == "timestamp_ntz":
        return F.unix_micros(column.cast("timestamp")), "whole", descending
    if kind in ("byte", "short", "integer", "long", "boolean"):
        return column.cast("int").cast("long") if kind == "boolean" else column.cast("long"), "whole", descending
    if kind in ("float", "double"):
        # Negative zero equals zero.
        return column.cast("double") + F.lit(0.0), "double", descending
    if kind in ("string", "char", "varchar"):
        return F.encode(column, "UTF-8"), "bytes", descending
    if kind in ("binary", "decimal"):
        return column, {"binary": "bytes"}.get(kind, kind), descending
    raise TypeError(f"rows cannot be limited by a column of type {kind}")


def _first(df: DataFrame, n: int, order: list[tuple[Column, str, bool]]) -> DataFrame:
    if not order:
        return df.limit(n)
    (v, kind, descending), rest = order[0], order[1:]
    low, high, size, total = df.agg(F.min(v), F.max(v), F.count(v), F.count(F.lit(1))).first()
    if total <= n:
        return df
    if size < n:
        return df.filter(v.isNotNull()).unionByName(_among(df.filter(v.isNull()), n - size, total - size, rest))
    need = n
    while size > _ROWS and not _equal(low, high):
        part = _part(v, kind, low, high)
        inside = df.filter(v.between(F.lit(low), F.lit(high)))
        found = inside.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"))
        for r in sorted(found.collect(), key=lambda r: r.p, reverse=descending):
            if r.n >= need:
                low, high, size = r.low, r.high, r.n
                break
            need -= r.n
    better = (v > F.lit(high)) if descending else (v < F.lit(low))
    edge = df.filter(v.between(F.lit(low), F.lit(high)))
    left = _among(edge, need, size, rest) if _equal(low, high) else _sorted(edge, need, order)
    return df.filter(better).unionByName(left)


def _among(df: DataFrame, need: int, size: int, rest: list[tuple[Column, str, bool]]) -> DataFrame:
    """The first rows of some that agree so far."""
    if need >= size:
        return df
    return _sorted(df, need, rest) if size <= _ROWS else _first(df, need, rest)


def _sorted(df: DataFrame, need: int, order: list[tuple[Column, str, bool]]) -> DataFrame:
    keys = [v.desc_nulls_last() if descending else v.asc_nulls_last() for v, _, descending in order]
    return df.orderBy(*keys).limit(need) if keys else df.limit(need)


def _equal(low: Any, high: Any) -> bool:
    return low == high or (isinstance(low, float) and math.isnan(low) and math.isnan(high))


def _part(v: Column, kind: str, low: Any, high: Any) -> Column:
    """A number from no more than about `_PARTS`, never smaller for a larger value between `low` and `high`."""
    if kind == "whole":
        shift = 0
        while (high >> shift) - (low >> shift) >= _PARTS:
            shift += 1
        return F.shiftright(v, shift)
    if kind == "bytes":
        low, high = bytes(low), bytes(high)
        same = next((k for k, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        # All values in between share the bytes before; the next two are a number, missing ones being 0.
        return F.conv(F.rpad(F.hex(F.substring(v, same + 1, 2)), 4, "0"), 16, 10).cast("int") + F.when(
            F.octet_length(v) > same, F.lit(1)
        ).otherwise(F.lit(0))
    if kind == "decimal":
        low, high = Decimal(low), Decimal(high)
        a, b = float(low), float(high)
        x = v.cast("double")
    else:
        a, b, x = low, high, v
    if math.isinf(a) or math.isinf(b) or math.isnan(b):
        size = F.abs(x)
        power = F.when(size > 0, F.floor(F.log2(size))).otherwise(F.lit(-1100)).cast("int") + 1101
        finite = F.when(x > 0, power).when(x < 0, -power).otherwise(F.lit(0))
        return F.when(F.isnan(x), F.lit(5000)).when(x == float("inf"), F.lit(4000)).when(x == float("-inf"), F.lit(-4000)).otherwise(finite)
    span = b / 2 - a / 2
    if not span or math.isinf(_PARTS / span):
        return (v > F.lit(low)).cast("int")
    return F.greatest(
        F.floor((x / 2 - F.lit(a / 2)) / F.lit(span) * (_PARTS - 1)).cast("int"),
        # The least value alone, where rounding leaves one part.
        (v > F.lit(low)).cast("int"),
    )


def part_order(part: str = "source_sheet") -> list[Column]:
    """Natural order of parts: by name up to its last digits, then by these as a number, so that part 9 precedes 10."""
    name = F.col(part)
    number = F.coalesce(F.expr(f"try_cast(regexp_extract({part}, '([0-9]+)$', 1) as bigint)"), F.lit(-1).cast("long"))
    return [F.regexp_replace(name, "[0-9]+$", ""), number, name]


def limit_input(df: DataFrame, max_rows: int | None, selection: str = "head") -> DataFrame:
    """Head or tail of the source: parts in natural order, then source_row."""
    if selection not in ("head", "tail"):
        raise ValueError("selection must be 'head' or 'tail'")
    if max_rows is None:
        return df
    last = selection == "tail"
    return first_n(df, max_rows, [(c, last) for c in [*part_order(), F.col("source_row")]])


def newest_rows(df: DataFrame, max_rows: int | None, ties: list[str]) -> DataFrame:
    """Newest `max_rows` by model_utc (all when None); ties broken by provenance."""
    if max_rows is None:
        return df
    order = [(F.col("model_utc"), True)]
    for name in ties:
        order += [(c, True) for c in (part_order() if name == "source_sheet" else [F.col(name)])]
    return first_n(df, max_rows, order)


def input_limit_report(total_rows: int | Column, used: DataFrame, selection: str) -> DataFrame:
    """Check/count/details rows on what the input limit left out and which dates remain."""
    total = F.lit(total_rows).cast("long") if isinstance(total_rows, int) else total_rows
    stats = used.agg(
        F.count(F.lit(1)).alias("used"), F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi")
    ).withColumn("total", total)
    none = F.lit("none")
    return stats.select(
        F.stack(
            F.lit(5),
            F.lit("source_rows_total"), F.col("total"), F.lit(""),
            F.lit("rows_used"), F.col("used"), F.lit(selection),
            F.lit("rows_skipped_by_limit"), F.greatest(F.col("total") - F.col("used"), F.lit(0)), F.lit(""),
            F.lit("range_from"), F.lit(0).cast("long"), F.coalesce(F.col("lo").cast("string"), none),
            F.lit("range_to"), F.lit(0).cast("long"), F.coalesce(F.col("hi").cast("string"), none),
        ).alias("check", "count", "details")
    )
