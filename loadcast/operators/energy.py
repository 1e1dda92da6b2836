"""Energy rows: typing, direction, branch lookup, quality counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast import names as N
from loadcast.functions import text as T
from loadcast.functions.times import valid_time
from loadcast.session import bounded_broadcast
from loadcast.sources.scan import resolve_mapping


def direction_from_token(key: Column) -> Column:
    """EXPORT is tested first: a text naming both directions counts as EXPORT."""
    return F.when(key.contains(N.EXPORT_TOKEN), N.EXPORT).when(key.contains(N.IMPORT_TOKEN), N.IMPORT)


def direction_from_sign(sign: Column) -> Column:
    return F.when(sign > 0, N.IMPORT).when(sign < 0, N.EXPORT)


def direction_mismatch(direction: Column, sign: Column) -> Column:
    clash = ((direction == N.IMPORT) & (sign < 0)) | ((direction == N.EXPORT) & (sign > 0))
    return F.coalesce(clash, F.lit(False))


def classify_direction(df: DataFrame) -> DataFrame:
    """`direction` from the text, else from the sign of the code; `direction_source` says which."""
    # One column per step: the planner keeps them apart, so the text is tokenised once per row.
    df = df.withColumn("_key", T.token(F.col("direction_text"))).withColumns(
        {"_text": direction_from_token(F.col("_key")), "_sign": direction_from_sign(F.col("direction_code"))}
    )
    source = (
        F.when(F.col("_text").isNotNull(), N.SRC_TEXT)
        .when(F.col("_sign").isNotNull(), N.SRC_SIGN)
        .otherwise(N.SRC_NONE)
    )
    return df.withColumns({"direction": F.coalesce("_text", "_sign"), "direction_source": source}).drop(
        "_key", "_text", "_sign"
    )


def lookup_point(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Weather point of a branch; `mapping` holds branch_key → point. Unknown branches keep NULL."""
    keyed = df.withColumn("branch_key", T.token(F.col("branch_code")))
    joined = keyed.join(bounded_broadcast(mapping), "branch_key", "left")
    return joined.withColumn("point_key", T.token(F.col("point"))).drop("branch_key")


def type_energy(raw: DataFrame) -> DataFrame:
    types = dict(raw.dtypes)
    return raw.withColumns(
        {
            **{c: T.clean_text(F.col(c)) for c in ("branch_code", "group_name", "client", "direction_text", "kind")},
            "actual": T.number(F.col("actual"), types["actual"]),
            "direction_code": T.number(F.col("direction_code"), types["direction_code"]),
            "trade_hour": T.first_int(F.col("trade_hour"), types["trade_hour"]),
            "trade_date": T.to_day(F.col("trade_date"), types["trade_date"]),
        }
    )


def normalize_energy(raw: DataFrame, mapping: DataFrame) -> DataFrame:
    """Typed energy rows with direction, weather point and delivery hour. No row is dropped."""
    df = lookup_point(classify_direction(type_energy(raw)), resolve_mapping(mapping))
    return df.withColumn("valid_local", valid_time(F.col("trade_date"), F.col("trade_hour")))


def unknown_branches(df: DataFrame) -> DataFrame:
    """Branch codes without a weather point and their rows, however many there are."""
    unknown = df.filter(F.col("branch_code").isNotNull() & F.col("point").isNull())
    return unknown.groupBy("branch_code").agg(F.count(F.lit(1)).alias("n_rows"))


def energy_quality(df: DataFrame) -> DataFrame:
    """Check/count/details rows over normalised energy, in one pass."""
    unknown = F.col("branch_code").isNotNull() & F.col("point").isNull()
    stats = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("branch_code").isNull()).alias("no_branch"),
        F.count_if(unknown).alias("unknown_branch"),
        F.count_if(F.col("direction").isNull()).alias("no_direction"),
        F.count_if(direction_mismatch(F.col("direction"), F.col("direction_code"))).alias("mismatch"),
        F.count_if(~F.coalesce(F.col("trade_hour").between(1, 24), F.lit(False))).alias("bad_hour"),
        F.count_if(F.col("actual").isNull()).alias("no_actual"),
        F.count_if(F.col("actual") < 0).alias("negative"),
    )
    return stats.select(
        F.stack(
            F.lit(8),
            F.lit("energy_rows"), F.col("rows"), F.lit(""),
            F.lit("missing_branch"), F.col("no_branch"), F.lit(""),
            F.lit("unknown_branch"), F.col("unknown_branch"), F.lit("codes in unknown_branches"),
            F.lit("missing_direction"), F.col("no_direction"), F.lit(""),
            F.lit("direction_mismatch"), F.col("mismatch"), F.lit("the direction text wins"),
            F.lit("hour_25_or_invalid"), F.col("bad_hour"), F.lit("needs the trade key of the weather source"),
            F.lit("missing_actual"), F.col("no_actual"), F.lit("may be future rows"),
            F.lit("negative_actual"), F.col("negative"), F.lit("kept as they are"),
        ).alias("check", "count", "details")
    )
