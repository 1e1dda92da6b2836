"""Scans, typing, mapping, limits, quality counts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import query, r6, table
from loadcast.functions import text as T
from loadcast.functions.rowwise import series_key
from loadcast.functions.times import strict_to_utc, valid_time
from loadcast.operators import energy as EN
from loadcast.operators.quality import append_quality
from loadcast.session import scratch_folder
from loadcast.sinks.tables import exported_rows, in_one_partition, locale_text, output_columns, safe_part, write_predictions
from loadcast.sources import scan
from loadcast.sources.limits import first_n, input_limit_report, limit_input
from loadcast.sources.warehouse import infer_date_range

_STRIP = r"[\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]+"
_CLEAN_SQL = f"trim(regexp_replace(text, '{_STRIP}', ' ', 'g'))"


@query(
    "token_text",
    """SELECT doc_id, lower(regexp_replace(strip_accents(translate(text, 'Łł', 'Ll')), '[^a-zA-Z0-9]+', '', 'g')) AS key
       FROM documents""",
)
def token_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.token(F.col("text")).alias("key"))


@query(
    "clean_text",
    f"""SELECT doc_id, CASE WHEN {_CLEAN_SQL} NOT IN ('', 'nan', 'None', '<NA>') THEN {_CLEAN_SQL} END AS clean
        FROM documents""",
)
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean_text(F.col("text")).alias("clean"))


_PRICE_TEXT_SQL = """CASE o_orderkey % 5 WHEN 0 THEN replace(CAST(o_totalprice AS VARCHAR), '.', ',')
         WHEN 1 THEN ' ' || CAST(o_totalprice AS VARCHAR) || ' '
         WHEN 2 THEN '-1 ' || replace(CAST(o_totalprice AS VARCHAR), '.', ',')
         WHEN 3 THEN CAST(o_totalprice AS VARCHAR) || 'd'
         ELSE o_orderpriority END"""


@query(
    "number_parse",
    f"""WITH t AS (SELECT o_orderkey, {_PRICE_TEXT_SQL} AS txt FROM orders)
        SELECT o_orderkey, round(CASE WHEN regexp_full_match(replace(replace(txt, ' ', ''), ',', '.'),
                 '[+-]?[0-9]+[.]?[0-9]*') THEN CAST(replace(replace(txt, ' ', ''), ',', '.') AS DOUBLE) END + 3.3e-8, 6) AS parsed
        FROM t""",
)
def number_parse(spark, sf):
    key, price = F.col("o_orderkey") % 5, F.col("o_totalprice").cast("string")
    comma = F.regexp_replace(price, r"\.", ",")
    text = (
        F.when(key == 0, comma)
        .when(key == 1, F.concat(F.lit(" "), price, F.lit(" ")))
        .when(key == 2, F.concat(F.lit("-1 "), comma))
        .when(key == 3, F.concat(price, F.lit("d")))
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf, "orders").select("o_orderkey", r6(T.number(text)).alias("parsed"))


@query(
    "int_extract",
    """SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '([0-9]+)', 1), '') AS INTEGER) AS first_number
       FROM events""",
)
def int_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", T.first_int(F.col("props")).alias("first_number"))


@query(
    "date_parse",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day FROM orders""",
)
def date_parse(spark, sf):
    key = F.col("o_orderkey") % 3
    text = (
        F.when(key == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(key == 1, F.date_format("o_orderdate", "dd.MM.yyyy"))
        .otherwise(F.date_format("o_orderdate", "'day' D 'of' yyyy"))
    )
    return table(spark, sf, "orders").select("o_orderkey", T.to_day(text).cast("string").alias("day"))


_DIRECTION_SQL = """
  SELECT event_id, CASE event_type WHEN 'purchase' THEN 'Czynne POBRANIE' WHEN 'signup' THEN 'energia czynna - oddanie'
           WHEN 'click' THEN 'pobrano i oddaniem' END AS direction_text,
         CAST(CASE WHEN user_id % 3 = 0 THEN -1 WHEN user_id % 3 = 1 THEN 1 END AS DOUBLE) AS direction_code
  FROM events"""


@query(
    "direction_classify",
    f"""WITH t AS (SELECT *, CASE WHEN lower(direction_text) LIKE '%oddani%' THEN 'EXPORT'
                        WHEN lower(direction_text) LIKE '%pobran%' THEN 'IMPORT' END AS by_text,
                   CASE WHEN direction_code > 0 THEN 'IMPORT' WHEN direction_code < 0 THEN 'EXPORT' END AS by_sign
                   FROM ({_DIRECTION_SQL}))
        SELECT event_id, coalesce(by_text, by_sign) AS direction,
          CASE WHEN by_text IS NOT NULL THEN 'TEXT' WHEN by_sign IS NOT NULL THEN 'SIGN' ELSE 'NONE' END AS direction_source,
          coalesce((coalesce(by_text, by_sign) = 'IMPORT' AND direction_code < 0)
                OR (coalesce(by_text, by_sign) = 'EXPORT' AND direction_code > 0), FALSE) AS mismatch
        FROM t""",
)
def direction_classify(spark, sf):
    u, kind = F.col("user_id") % 3, F.col("event_type")
    df = table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "purchase", "Czynne POBRANIE")
        .when(kind == "signup", "energia czynna - oddanie")
        .when(kind == "click", "pobrano i oddaniem")
        .alias("direction_text"),
        F.when(u == 0, -1.0).when(u == 1, 1.0).alias("direction_code"),
    )
    out = EN.classify_direction(df)
    return out.select(
        "event_id",
        "direction",
        "direction_source",
        EN.direction_mismatch(F.col("direction"), F.col("direction_code")).alias("mismatch"),
    )


@query(
    "branch_lookup",
    """WITH m AS (SELECT replace(lower(n_name), '_', '') AS branch_key, r_name AS point
                  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 4)
       SELECT c_custkey, m.point FROM customer LEFT JOIN m ON m.branch_key = 'nation' || c_nationkey""",
)
def branch_lookup(spark, sf):
    regions = table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("point"))
    nations = table(spark, sf, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    mapping = nations.select(
        F.col("n_name").alias("branch_code"),
        "point",
        F.when(F.col("n_nationkey") % 5 != 4, "Active").otherwise("inactive").alias("status"),
    )
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit(" Nation-"), F.col("c_nationkey").cast("string")).alias("branch_code")
    )
    resolved = scan.resolve_mapping(scan.checked_mapping(mapping))
    return EN.lookup_point(rows, resolved).select("c_custkey", "point")


@query(
    "mapping_conflicts",
    """SELECT lower(c_mktsegment) || c_nationkey AS branch_key,
              count(DISTINCT point) + max(CAST(point IS NULL AS INTEGER)) AS n_points
       FROM (SELECT *, CASE WHEN c_custkey % 9 <> 0 THEN 'P' || (c_custkey % 3) END AS point FROM customer)
       GROUP BY 1 HAVING count(DISTINCT point) + max(CAST(point IS NULL AS INTEGER)) > 1""",
)
def mapping_conflicts(spark, sf):
    key = F.col("c_custkey")
    mapping = table(spark, sf, "customer").select(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("branch_code"),
        F.when(key % 9 != 0, F.concat(F.lit("P"), (key % 3).cast("string"))).alias("point"),
        F.lit("active").alias("status"),
    )
    return scan.mapping_conflicts(mapping)


@query(
    "mapping_first_wins",
    """SELECT lower(c_mktsegment) || c_nationkey AS branch_key, arg_min('P' || (c_custkey % 3), c_custkey) AS point
       FROM customer GROUP BY 1""",
)
def mapping_first_wins(spark, sf):
    mapping = table(spark, sf, "customer").select(
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("branch_code"),
        F.concat(F.lit("P"), (F.col("c_custkey") % 3).cast("string")).alias("point"),
        F.lit("active").alias("status"),
        "c_custkey",
    )
    return scan.resolve_mapping(mapping, order="c_custkey")


_RAW_SQL = """
  SELECT event_id, user_id, event_type, value, hour(ts) AS h,
    CASE WHEN user_id % 11 = 0 THEN NULL ELSE 'BR' || (user_id % 6) END AS branch_code,
    CASE WHEN user_id % 6 < 4 AND user_id % 11 <> 0 THEN 'P' || (user_id % 6) END AS point,
    CASE WHEN event_type IN ('purchase', 'view') THEN 'IMPORT' WHEN event_type = 'signup' THEN 'EXPORT'
         WHEN user_id % 3 = 0 THEN 'EXPORT' WHEN user_id % 3 = 1 THEN 'IMPORT' END AS direction,
    CASE WHEN user_id % 3 = 0 THEN -1 WHEN user_id % 3 = 1 THEN 1 END AS sgn,
    CASE WHEN event_id % 23 = 0 THEN 25 ELSE hour(ts) + 1 END AS trade_hour,
    CASE WHEN event_id % 10 = 3 THEN NULL WHEN event_id % 17 = 5 THEN -value ELSE value END AS actual
  FROM events"""


def _raw_text(spark, sf):
    """Energy rows as source text, with gaps, unknown branches, missing directions and hour 25."""
    e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    value = F.col("value").cast("string")
    return table(spark, sf, "events").select(
        kind.alias("source_sheet"),
        e.alias("source_row"),
        F.when(u % 11 != 0, F.concat(F.lit(" BR"), (u % 6).cast("string"))).alias("branch_code"),
        F.when(u % 3 == 0, "-1").when(u % 3 == 1, "1").alias("direction_code"),
        F.lit("G").alias("group_name"),
        F.concat(F.lit("C"), (u % 4).cast("string")).alias("client"),
        F.when(kind.isin("purchase", "view"), "czynne  pobranie").when(kind == "signup", "oddanie").alias("direction_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("trade_date"),
        F.lit("4").alias("kind"),
        F.when(e % 23 == 0, "H25").otherwise((F.hour("ts") + 1).cast("string")).alias("trade_hour"),
        F.when(e % 10 == 3, "").when(e % 17 == 5, F.concat(F.lit("-"), value)).otherwise(
            F.regexp_replace(value, r"\.", ",")
        ).alias("actual"),
    )


def _branch_mapping(spark, sf):
    """Codes BR0..BR3, derived from the users present in the data."""
    n = (F.col("user_id") % 6).cast("string")
    return (
        table(spark, sf, "events")
        .filter(F.col("user_id") % 6 < 4)
        .select(F.concat(F.lit("BR"), n).alias("branch_code"), F.concat(F.lit("P"), n).alias("point"))
        .distinct()
        .withColumn("status", F.lit("active"))
    )


@query(
    "normalize_energy",
    f"""SELECT event_id AS source_row, branch_code, point, direction, CAST(trade_hour AS INTEGER) AS trade_hour,
          round(actual + 3.3e-8, 6) AS actual,
          CASE WHEN trade_hour <= 24 THEN CAST((SELECT date_trunc('hour', x.ts) FROM events x WHERE x.event_id = r.event_id) AS TIMESTAMP) END AS valid_local
        FROM ({_RAW_SQL}) r""",
)
def normalize_energy(spark, sf):
    out = EN.normalize_energy(_raw_text(spark, sf), _branch_mapping(spark, sf))
    return out.select("source_row", "branch_code", "point", "direction", "trade_hour", r6("actual").alias("actual"), "valid_local")


@query(
    "quality_energy",
    f"""WITH r AS ({_RAW_SQL}), q AS (
          SELECT count(*) AS a, count(*) FILTER (branch_code IS NULL) AS b,
            count(*) FILTER (branch_code IS NOT NULL AND point IS NULL) AS c,
            count(*) FILTER (direction IS NULL) AS d,
            count(*) FILTER ((direction = 'IMPORT' AND sgn < 0) OR (direction = 'EXPORT' AND sgn > 0)) AS e,
            count(*) FILTER (trade_hour NOT BETWEEN 1 AND 24) AS f,
            count(*) FILTER (actual IS NULL) AS g, count(*) FILTER (actual < 0) AS h FROM r)
        SELECT 'energy_rows' AS "check", a AS "count", '' AS details FROM q
        UNION ALL SELECT 'missing_branch', b, '' FROM q
        UNION ALL SELECT 'unknown_branch', c, 'codes in unknown_branches' FROM q
        UNION ALL SELECT 'missing_direction', d, '' FROM q
        UNION ALL SELECT 'direction_mismatch', e, 'the direction text wins' FROM q
        UNION ALL SELECT 'hour_25_or_invalid', f, 'needs the trade key of the weather source' FROM q
        UNION ALL SELECT 'missing_actual', g, 'may be future rows' FROM q
        UNION ALL SELECT 'negative_actual', h, 'kept as they are' FROM q""",
)
def quality_energy(spark, sf):
    return EN.energy_quality(EN.normalize_energy(_raw_text(spark, sf), _branch_mapping(spark, sf)))


@query(
    "unknown_branches",
    f"""SELECT branch_code, count(*) AS n_rows FROM ({_RAW_SQL})
        WHERE branch_code IS NOT NULL AND point IS NULL GROUP BY branch_code""",
)
def unknown_branches(spark, sf):
    return EN.unknown_branches(EN.normalize_energy(_raw_text(spark, sf), _branch_mapping(spark, sf)))


@query(
    "date_range_clamp",
    """SELECT greatest(CAST(min(CAST(ts AS DATE)) AS TIMESTAMP), TIMESTAMP '2024-01-10') AS valid_from,
              CAST(max(CAST(ts AS DATE)) + 1 AS TIMESTAMP) AS valid_to FROM events""",
)
def date_range_clamp(spark, sf):
    low, high = infer_date_range(V.energy(spark, sf), weather_start="2024-01-10")
    return spark.createDataFrame([(low, high)], "valid_from timestamp_ntz, valid_to timestamp_ntz")


@query(
    "head_limit",
    f"""SELECT source_sheet, source_row, actual FROM ({V.ENERGY_SQL}) ORDER BY source_sheet, source_row LIMIT 500""",
)
def head_limit(spark, sf):
    return limit_input(V.energy(spark, sf), 500, "head").select("source_sheet", "source_row", "actual")


@query(
    "tail_limit",
    f"""SELECT source_sheet, source_row, actual FROM ({V.ENERGY_SQL})
        ORDER BY source_sheet DESC, source_row DESC LIMIT 500""",
)
def tail_limit(spark, sf):
    return limit_input(V.energy(spark, sf), 500, "tail").select("source_sheet", "source_row", "actual")


@query(
    "tail_limit_wide",
    """SELECT o_orderpriority AS source_sheet, o_orderkey AS source_row FROM orders
       ORDER BY source_sheet DESC, source_row DESC LIMIT 12000""",
)
def tail_limit_wide(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("source_sheet"), F.col("o_orderkey").alias("source_row")
    )
    return limit_input(rows, 12_000, "tail")


@query(
    "input_limit_report",
    f"""WITH t AS (SELECT count(*) AS n FROM events),
          u AS (SELECT count(*) AS n, min(trade_date) AS lo, max(trade_date) AS hi FROM
                (SELECT trade_date FROM ({V.ENERGY_SQL}) ORDER BY source_sheet DESC, source_row DESC LIMIT 300))
        SELECT 'source_rows_total' AS "check", t.n AS "count", '' AS details FROM t
        UNION ALL SELECT 'rows_used', u.n, 'tail' FROM u
        UNION ALL SELECT 'rows_skipped_by_limit', greatest(t.n - u.n, 0), '' FROM t, u
        UNION ALL SELECT 'range_from', 0, CAST(lo AS VARCHAR) FROM u
        UNION ALL SELECT 'range_to', 0, CAST(hi AS VARCHAR) FROM u""",
)
def input_limit(spark, sf):
    rows = V.energy(spark, sf)
    return input_limit_report(rows.count(), limit_input(rows, 300, "tail"), "tail")


@query(
    "series_key",
    """SELECT c_custkey, coalesce(trim(CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END), '__MISSING__') || '|' ||
              c_name || '|' || c_nationkey AS series_id FROM customer""",
)
def series_key_query(spark, sf):
    df = table(spark, sf, "customer").withColumn(
        "segment", F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit(" "), "c_mktsegment"))
    )
    return df.select("c_custkey", series_key(["segment", "c_name", "c_nationkey"]).alias("series_id"))


@query(
    "valid_time",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_quantity BETWEEN 1 AND 24
              THEN CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) + to_hours(CAST(l_quantity AS INTEGER) - 1) END AS valid_local
       FROM lineitem""",
)
def valid_time_query(spark, sf):
    day, hour = F.col("l_shipdate").cast("date"), F.col("l_quantity").cast("int")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, sf, "lineitem").select(*keys, valid_time(day, hour).alias("valid_local"))


@query(
    "utc_strict",
    """WITH t AS (SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS loc FROM orders),
         u AS (SELECT o_orderkey, loc, timezone('Europe/Warsaw', loc) AS utc FROM t)
       SELECT o_orderkey, CASE WHEN timezone('Europe/Warsaw', utc) = loc
           AND timezone('Europe/Warsaw', utc + INTERVAL 1 HOUR) <> loc AND timezone('Europe/Warsaw', utc - INTERVAL 1 HOUR) <> loc
         THEN timezone('UTC', utc) END AS model_utc FROM u""",
)
def utc_strict(spark, sf):
    local = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), (F.col("o_orderkey") % 24).cast("int")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", strict_to_utc(local, "Europe/Warsaw").cast("timestamp_ntz").alias("model_utc")
    )


@query(
    "positional_columns",
    """SELECT CAST(l_orderkey AS VARCHAR) AS branch_code, CAST(l_partkey AS VARCHAR) AS direction_code,
         CAST(l_suppkey AS VARCHAR) AS group_name, CAST(l_linenumber AS VARCHAR) AS client,
         l_returnflag AS direction_text, l_linestatus AS trade_date, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS kind,
         l_returnflag AS trade_hour, l_linestatus AS actual FROM lineitem
       UNION ALL
       SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority, o_orderstatus,
         o_orderpriority, o_orderstatus, CAST(o_orderkey AS VARCHAR), NULL FROM orders""",
)
def positional_columns(spark, sf):
    """First nine columns by position, and two parts appended."""
    one = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.col("l_quantity").cast("int").alias("q"), F.col("l_returnflag").alias("f2"), F.col("l_linestatus").alias("s2"),
        "l_shipdate",
    )
    two = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderstatus").alias("s1"), F.col("o_orderpriority").alias("p1"),
        F.col("o_orderstatus").alias("s2"), F.col("o_orderpriority").alias("p2"), F.col("o_orderstatus").alias("s3"),
        F.col("o_orderkey").alias("k2"), F.lit(None).cast("string").alias("none"),
    )
    return scan.append_parts(scan.pick_energy_columns(one), scan.pick_energy_columns(two))


@query(
    "blank_rows_dropped",
    """SELECT count(*) AS rows_kept FROM customer WHERE c_custkey % 3 <> 0""",
)
def blank_rows_dropped(spark, sf):
    """A third of the rows is blanked in all nine columns and must disappear."""
    blank = F.col("c_custkey") % 3 == 0
    cells = [
        F.when(~blank, F.col("c_name")).otherwise(F.lit(" ") if i % 2 else F.lit(None)).alias(f"c{i}") for i in range(9)
    ]
    rows = scan.drop_blank_rows(scan.pick_energy_columns(table(spark, sf, "customer").select(*cells)))
    return rows.agg(F.count(F.lit(1)).alias("rows_kept"))


@query(
    "alias_rename",
    """SELECT o_orderkey AS exec_id, o_orderpriority AS point, o_orderdate AS w_valid_local, o_totalprice AS temperature
       FROM orders""",
)
def alias_rename(spark, sf):
    from loadcast import names as N

    raw = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Exec-ID"),
        F.col("o_orderpriority").alias("MIASTO"),
        F.col("o_orderdate").alias("data godzina CET"),
        F.col("o_totalprice").alias("Temperatura "),
    )
    return scan.rename_by_alias(raw, N.WEATHER_ALIASES)


@query(
    "locale_csv_text",
    """SELECT c_custkey, replace(CAST(c_acctbal AS VARCHAR), '.', ',') AS c_acctbal,
              regexp_replace(c_mktsegment || ' ' || c_name, '[^a-zA-Z0-9_-]', '_', 'g') AS part FROM customer""",
)
def locale_csv_text(spark, sf):
    df = table(spark, sf, "customer").withColumn("sheet", F.concat_ws(" ", "c_mktsegment", "c_name"))
    return locale_text(df).select("c_custkey", "c_acctbal", safe_part("sheet").alias("part"))


@query(
    "compact_export",
    f"""SELECT source_sheet, source_row, branch_code, point, group_name, client, direction, trade_date, trade_hour, actual,
          CASE WHEN source_row % 2 = 0 THEN 'OOF' ELSE 'FUTURE' END AS prediction_status
        FROM ({V.ENERGY_SQL}) WHERE source_row % 3 <> 0""",
)
def compact_export(spark, sf):
    """Every third row has another status and is not exported."""
    row = F.col("source_row")
    status = F.when(row % 3 == 0, "WARMUP").when(row % 2 == 0, "OOF").otherwise("FUTURE")
    df = V.energy(spark, sf).withColumn("prediction_status", status)
    out = exported_rows(df, oof_only=True)
    return out.select(*output_columns(out, compact=True))


@query(
    "quality_append",
    f"""SELECT 'a' AS "check", count(*) AS "count", 'x' AS details FROM orders
        UNION ALL SELECT 'b', count(*), 'y' FROM customer""",
)
def quality_append(spark, sf):
    def block(name, check, details):
        return table(spark, sf, name).agg(F.count(F.lit(1)).alias("count")).select(
            F.lit(check).alias("check"), "count", F.lit(details).alias("details")
        )

    return append_quality(block("orders", "a", "x"), block("customer", "b", "y"))


@query(
    "limit_by_number_and_text",
    """SELECT o_orderkey FROM orders ORDER BY CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice / (o_custkey % 5) END DESC NULLS LAST,
              encode('c' || o_custkey), o_orderkey LIMIT 4000""",
)
def limit_by_number_and_text(spark, sf):
    """The first rows by a double with infinities and nulls, then a text, then a key."""
    share = (F.col("o_custkey") % 5).cast("double")
    number = F.when(share == 0, F.lit(float("inf"))).otherwise(F.col("o_totalprice").cast("double") / share)
    number = F.when(F.col("o_orderkey") % 11 != 0, number)
    customer = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    rows = first_n(table(spark, sf, "orders"), 4_000, [(number, True), (customer, False), (F.col("o_orderkey"), False)])
    return rows.select("o_orderkey")


@query(
    "tail_over_parts",
    """SELECT 'Dane_' || (o_orderkey % 12 + 1) AS source_sheet, o_orderkey AS source_row FROM orders
       ORDER BY o_orderkey % 12 + 1 DESC, o_orderkey DESC LIMIT 3000""",
)
def tail_over_parts(spark, sf):
    """Parts 1 to 12 in natural order: 12 is last, not 9."""
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(F.concat(F.lit("Dane_"), (key % 12 + 1).cast("string")).alias("source_sheet"), key.alias("source_row"))
    return limit_input(rows, 3_000, "tail")


def _nine(spark, sf):
    """Nine text columns of `orders` under the names of an energy source."""
    from loadcast import names as N

    orders = table(spark, sf, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_clerk", "o_orderdate", "o_shippriority", "o_orderkey", "o_totalprice"]
    have = [c if c in orders.columns else "o_orderkey" for c in columns]
    return orders.select(*[F.col(c).cast("string").alias(n) for c, n in zip(have, N.ENERGY_COLUMNS, strict=True)])


@query(
    "multi_part_scan",
    """SELECT CAST(o_orderkey AS VARCHAR) AS first_column, CAST(o_custkey AS VARCHAR) AS second_column FROM orders""",
)
def multi_part_scan(spark, sf):
    """`orders` written as CSV parts with two headers and two separators, and scanned back by name."""
    from loadcast import names as N

    rows, root = _nine(spark, sf), f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    odd = F.col(N.ENERGY_COLUMNS[0]).cast("long") % 2 == 1
    rows.filter(odd).repartition(3).write.options(header=True, sep=";").csv(f"{root}/a")
    rows.filter(~odd).select(*reversed(N.ENERGY_COLUMNS)).repartition(2).write.options(header=True, sep=",").csv(f"{root}/b")
    back = scan.scan_energy(spark, [f"{root}/a", f"{root}/b"], fmt="csv")
    return back.select(F.col(N.ENERGY_COLUMNS[0]).alias("first_column"), F.col(N.ENERGY_COLUMNS[1]).alias("second_column"))


#: A text with a line break, a separator, quotes and, in some rows, a line that looks like a record of its own.
_AWKWARD_SQL = """CASE o_orderkey % 5 WHEN 0 THEN 'two' || chr(10) || 'lines; "' || o_custkey || '"'
    WHEN 1 THEN '"' || o_orderkey || '";x' || chr(10) || '"' WHEN 2 THEN chr(10) || 'a;b;c' || chr(10) || chr(10) || 'd'
    WHEN 3 THEN '' || o_custkey ELSE '5" of ' || o_orderkey END"""


@query(
    "quoted_records",
    f"""SELECT row_number() OVER (PARTITION BY o_orderkey % 7 ORDER BY o_orderkey) + 1 AS source_row,
               CAST(o_orderkey AS VARCHAR) AS first_column, {_AWKWARD_SQL} AS awkward, '' || o_custkey AS last_column FROM orders""",
)
def quoted_records(spark, sf):
    """Cells with line breaks, separators and quotes, written as seven CSV parts and scanned back with their row numbers."""
    from loadcast import names as N

    root = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    number, key, customer = F.col("o_orderkey"), F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    awkward = (
        F.when(number % 5 == 0, F.concat(F.lit('two\nlines; "'), customer, F.lit('"')))
        .when(number % 5 == 1, F.concat(F.lit('"'), key, F.lit('";x\n"')))
        .when(number % 5 == 2, F.lit("\na;b;c\n\nd"))
        .when(number % 5 == 3, customer)
        .otherwise(F.concat(F.lit('5" of '), key))
    )
    cells = [c.alias(n) for c, n in zip([key, awkward, *[customer] * 7], N.ENERGY_COLUMNS, strict=True)]
    rows = table(spark, sf, "orders").select(*cells, (number % 7).alias("k"), number.alias("place"))
    # Ranges finer than the parts, so that no task writes two of them.
    rows = rows.repartitionByRange(28, "k").sortWithinPartitions("k", "place").drop("place")
    options = {"header": True, "sep": ";", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows.write.partitionBy("k").options(**options).csv(root)
    back = scan.scan_energy(spark, root, fmt="csv")
    first, second, last = N.ENERGY_COLUMNS[0], N.ENERGY_COLUMNS[1], N.ENERGY_COLUMNS[-1]
    return back.select("source_row", F.col(first).alias("first_column"), F.col(second).alias("awkward"), F.col(last).alias("last_column"))


@query(
    "provenance_rows",
    """SELECT i + 2 AS source_row, CAST(o_orderkey AS VARCHAR) AS first_column
       FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)""",
)
def provenance_rows(spark, sf):
    """One CSV file in key order: a row's number is its place in the file, header included."""
    from loadcast import names as N

    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}/one"
    rows = in_one_partition(_nine(spark, sf), F.col(N.ENERGY_COLUMNS[0]).cast("long"))
    rows.write.options(header=True, sep=";").csv(path)
    return scan.scan_energy(spark, path, fmt="csv").select("source_row", F.col(N.ENERGY_COLUMNS[0]).alias("first_column"))


@query(
    "predictions_by_part",
    f"""SELECT source_row, actual, regexp_replace(source_sheet, '[^a-zA-Z0-9_-]', '_', 'g') AS part
        FROM ({V.ENERGY_SQL}) WHERE source_row % 3 <> 0""",
)
def predictions_by_part(spark, sf):
    """The sink writes a folder per part; what comes back is what was exported."""
    row = F.col("source_row")
    status = F.when(row % 3 == 0, "WARMUP").when(row % 2 == 0, "OOF").otherwise("FUTURE")
    path = f"{scratch_folder(spark)}/{uuid.uuid4().hex}/predictions"
    write_predictions(V.energy(spark, sf).withColumn("prediction_status", status), path, compact=True, oof_only=True)
    return spark.read.parquet(path).select("source_row", "actual", F.col("part").cast("string").alias("part"))
