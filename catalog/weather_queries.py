"""As-of vintages, the energy-weather join, status and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import query, r6, table
from loadcast.functions.times import lead_hours
from loadcast.operators import enrich as J
from loadcast.operators import vintage as VT
from loadcast.sources.warehouse import query_sql, warehouse_extract


@query(
    "vintage_latest",
    f"""SELECT point, w_valid_local, issue_local, exec_id, round(temperature + 3.3e-8, 6) AS temperature,
               round(lead_hours + 3.3e-8, 6) AS lead_hours FROM ({V.LATEST_SQL})""",
)
def vintage_latest(spark, sf):
    out = VT.normalize_weather(V.forecasts(spark, sf), min_lead_hours=24)
    return out.select(
        "point", "w_valid_local", "issue_local", "exec_id", r6("temperature").alias("temperature"),
        r6("lead_hours").alias("lead_hours"),
    )


@query(
    "vintage_already_picked",
    f"""SELECT point, w_valid_local, max(issue_local) AS issue_local, arg_max(exec_id, (issue_local, exec_id)) AS exec_id
        FROM ({V.FORECAST_SQL}) GROUP BY 1, 2""",
)
def vintage_already_picked(spark, sf):
    """Without the lead rule only the newest row per key is kept."""
    out = VT.normalize_weather(V.forecasts(spark, sf), already_vintaged=True)
    return out.select("point", "w_valid_local", "issue_local", "exec_id")


_WAREHOUSE_SQL = """
  SELECT 'P' || (user_id % 4) AS point, CAST(ts AS DATE) AS w_trade_date, CAST(hour(ts) + 1 AS INTEGER) AS w_trade_hour,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS w_valid_local,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS w_valid_utc, ts - to_hours(event_id % 48) AS issue_utc,
         event_id AS exec_id, value AS temperature FROM events"""


def _warehouse(spark, sf):
    """`events` as the warehouse view of issued forecasts."""
    e = F.col("event_id")
    hour = F.date_trunc("hour", "ts")
    return table(spark, sf, "events").select(
        F.concat(F.lit("P"), (F.col("user_id") % 4).cast("string")).alias("punkt"),
        F.col("ts").cast("date").alias("dataCET"),
        (F.hour("ts") + 1).alias("godzinaHandlowa25"),
        (hour + F.expr("interval 1 hour")).cast("timestamp_ntz").alias("dataGodzinaCET"),
        hour.alias("dataGodzinaUTC"),
        (F.col("ts").cast("timestamp") - F.make_dt_interval(F.lit(0), (e % 48).cast("int"))).alias("czasDanychZrodlaUTC"),
        e.alias("execId"),
        F.lit("owner").alias("wlasciciel"),
        F.lit("kind").alias("typ"),
        F.lit(1).alias("czyOstatniNaCzasDanych"),
        F.col("value").alias("temperatura"),
    )


def _extract_columns(out):
    return out.select(
        "point", "w_trade_date", "w_trade_hour", "exec_id", F.col("issue_utc").cast("timestamp_ntz").alias("issue_utc"),
        "temperature", F.col("lead_hours_sql").cast("double").alias("lead_hours_sql"),
    )


@query(
    "vintage_exec_tiebreak",
    f"""SELECT point, w_trade_date, w_trade_hour, exec_id, issue_utc, temperature,
          CAST(CAST(date_diff('minute', issue_utc, w_valid_utc) / 60.0 AS DECIMAL(10, 2)) AS DOUBLE) AS lead_hours_sql
        FROM (SELECT *, row_number() OVER (PARTITION BY point, w_trade_date, w_trade_hour
                                           ORDER BY issue_utc DESC, exec_id DESC) AS rn
              FROM ({_WAREHOUSE_SQL}) WHERE issue_utc <= w_valid_utc - INTERVAL 24 HOUR) WHERE rn = 1""",
)
def vintage_exec_tiebreak(spark, sf):
    out = warehouse_extract(
        _warehouse(spark, sf), "2023-01-01", "2030-01-01", 24, "owner", "kind", points=["P0", "P1", "P2", "P3"]
    )
    return _extract_columns(out)


@query(
    "extract_filters",
    f"""SELECT point, w_trade_date, w_trade_hour, exec_id, issue_utc, temperature,
          CAST(CAST(date_diff('minute', issue_utc, w_valid_utc) / 60.0 AS DECIMAL(10, 2)) AS DOUBLE) AS lead_hours_sql
        FROM (SELECT *, row_number() OVER (PARTITION BY point, w_trade_date, w_trade_hour
                                           ORDER BY issue_utc DESC, exec_id DESC) AS rn
              FROM ({_WAREHOUSE_SQL}) WHERE issue_utc <= w_valid_utc - INTERVAL 6 HOUR
                AND exec_id % 3 = 1 AND exec_id % 2 = 1 AND exec_id % 5 <> 0 AND point IN ('P1', 'P2')
                AND w_valid_utc + INTERVAL 1 HOUR >= TIMESTAMP '2024-01-05' AND w_valid_utc + INTERVAL 1 HOUR < TIMESTAMP '2024-01-20')
        WHERE rn = 1""",
)
def extract_filters(spark, sf):
    """Owner, type, batch flag, points and window each leave rows out."""
    e = F.col("execId")
    view = _warehouse(spark, sf).withColumns(
        {
            "wlasciciel": F.concat(F.lit("own"), (e % 3).cast("string")),
            "typ": F.concat(F.lit("k"), (e % 2).cast("string")),
            "czyOstatniNaCzasDanych": (e % 5 != 0).cast("int"),
        }
    )
    return _extract_columns(warehouse_extract(view, "2024-01-05", "2024-01-20", 6, "own1", "k1", points=["P1", "P2"]))


@query(
    "sql_named_parameters",
    """SELECT event_type, count(*) AS n, min(ts) AS first_ts FROM events
       WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2025-01-01' GROUP BY event_type""",
)
def sql_named_parameters(spark, sf):
    table(spark, sf, "events").createOrReplaceTempView("weather_view")
    return query_sql(
        spark,
        """SELECT event_type, count(*) AS ` n `, min(ts) AS first_ts FROM weather_view
           WHERE ts >= cast(:low AS timestamp_ntz) AND ts < cast(:high AS timestamp_ntz) GROUP BY event_type""",
        {"low": "2024-01-01", "high": "2025-01-01"},
    )


@query(
    "lead_hours",
    """SELECT event_id, round(CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) - epoch_us(date_trunc('hour', ts) - to_hours(event_id % 48))
             WHEN event_id % 3 = 1 THEN epoch_us(ts) - epoch_us(date_trunc('day', ts)) END / 3.6e9 + 3.3e-8, 6) AS lead_hours
       FROM events""",
)
def lead_hours_query(spark, sf):
    e = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    issue_utc = F.when(e % 3 == 0, F.date_trunc("hour", ts) - F.make_dt_interval(F.lit(0), (e % 48).cast("int")))
    issue_local = F.when(e % 3 != 2, F.date_trunc("day", ts).cast("timestamp_ntz"))
    lead = lead_hours(ts, issue_utc, F.col("ts"), issue_local)
    return table(spark, sf, "events").select("event_id", r6(lead).alias("lead_hours"))


_JOIN_OUT = "source_row, weather_matched, feature_count, round(temperature + 3.3e-8, 6) AS temperature, round(lead_hours + 3.3e-8, 6) AS lead_hours"


def _joined_columns(df):
    return df.select(
        "source_row", "weather_matched", "feature_count", r6("temperature").alias("temperature"),
        r6("lead_hours").alias("lead_hours"),
    )


@query("enrich_valid_time", f"SELECT {_JOIN_OUT} FROM ({V.JOINED_SQL})")
def enrich_valid_time(spark, sf):
    weather = VT.normalize_weather(V.forecasts(spark, sf))
    return _joined_columns(J.join_weather(V.energy(spark, sf), weather, J.VALID_TIME))


@query("enrich_trade_key", f"SELECT {_JOIN_OUT} FROM ({V.JOINED_SQL})")
def enrich_trade_key(spark, sf):
    raw = V.forecasts_with_trade_key(spark, sf)
    energy = V.energy(spark, sf)
    typed, explicit = VT.type_weather(raw)
    mode = J.choose_join_mode(energy, typed, explicit)
    return _joined_columns(J.join_weather(energy, VT.normalize_weather(raw), mode))


def enriched(spark, sf):
    """Energy with weather where some rows have no mapping and some no wall-clock hour."""
    e = V.energy(spark, sf)
    no_map, no_hour = F.col("source_row") % 13 == 0, F.col("source_row") % 19 == 0
    e = e.withColumns(
        {
            "point": F.when(~no_map, F.col("point")),
            "point_key": F.when(~no_map, F.col("point_key")),
            "valid_local": F.when(~no_hour, F.col("valid_local")),
        }
    )
    return J.enrich(e, VT.normalize_weather(V.forecasts(spark, sf)), J.VALID_TIME, weather_start="2024-01-10")


ENRICHED_SQL = f"""
  SELECT e.* EXCLUDE (point), e.mpoint AS point, (w.point IS NOT NULL) AS weather_matched, {V.COUNT_SQL} AS feature_count,
         {', '.join('w.' + f for f in V.FEATURES)},
         CASE WHEN e.mpoint IS NULL THEN 'NO_MAPPING' WHEN e.valid IS NULL THEN 'NO_TIME_KEY'
              WHEN e.trade_date < DATE '2024-01-10' THEN 'BEFORE_START' WHEN w.point IS NOT NULL THEN 'MATCHED'
              ELSE 'MISSING_IN_RANGE' END AS weather_status,
         e.valid - INTERVAL 1 HOUR AS model_utc
  FROM (SELECT *, CASE WHEN source_row % 13 <> 0 THEN point END AS mpoint,
               CASE WHEN source_row % 19 <> 0 THEN valid_local END AS valid FROM ({V.ENERGY_SQL})) e
  LEFT JOIN ({V.LATEST_SQL}) w ON e.mpoint = w.point AND e.valid = w.w_valid_local"""


@query(
    "weather_status",
    f"SELECT source_row, weather_status, model_utc FROM ({ENRICHED_SQL})",
)
def weather_status(spark, sf):
    out = enriched(spark, sf)
    return out.select("source_row", "weather_status", F.col("model_utc").cast("timestamp_ntz").alias("model_utc"))


def _status_count(name: str, code: str, details: str) -> str:
    return f"UNION ALL SELECT '{name}', count(*) FILTER (weather_status = '{code}'), '{details}' FROM j"


@query(
    "quality_join",
    f"""WITH j AS ({ENRICHED_SQL})
        SELECT 'join_mode' AS "check", count(*) AS "count", 'valid_time' AS details FROM j
        UNION ALL SELECT 'weather_matched', count(*) FILTER (weather_matched), '' FROM j
        {_status_count('weather_before_start', 'BEFORE_START', '2024-01-10')}
        {_status_count('weather_missing_in_range', 'MISSING_IN_RANGE', 'no record for a valid point and time')}
        {_status_count('weather_no_mapping', 'NO_MAPPING', 'branch has no weather point')}
        {_status_count('weather_no_time_key', 'NO_TIME_KEY', 'invalid or ambiguous date or hour')}
        UNION ALL SELECT 'weather_partial_record', count(*) FILTER (weather_matched AND feature_count < 10),
                         'matched, at least one feature is NULL' FROM j
        UNION ALL SELECT 'weather_empty_record', count(*) FILTER (weather_matched AND feature_count = 0),
                         'matched, all features are NULL' FROM j
        """
    + "\n".join(
        f"UNION ALL SELECT 'weather_null_{f}', count(*) FILTER (weather_matched AND {f} IS NULL), "
        f"'NULL kept; row neither dropped nor zeroed' FROM j"
        for f in V.FEATURES
    ),
)
def quality_join(spark, sf):
    return J.join_quality(enriched(spark, sf), J.VALID_TIME, "2024-01-10")


@query(
    "vintage_duplicates",
    f"""SELECT point AS point_key, w_valid_local, count(*) AS "rows" FROM ({V.FORECAST_SQL}) GROUP BY 1, 2 HAVING count(*) > 1""",
)
def vintage_duplicates(spark, sf):
    """Keys that are not unique before a vintage is picked."""
    raw = V.forecasts(spark, sf).withColumnRenamed("point", "point_key")
    return J.duplicate_keys(raw, ["point_key", "w_valid_local"])


@query(
    "hour_25_fill",
    f"""SELECT e.source_row, coalesce(e.valid, w.w_valid_local) AS valid_local
        FROM (SELECT *, CASE WHEN source_row % 19 <> 0 THEN valid_local END AS valid FROM ({V.ENERGY_SQL})) e
        LEFT JOIN ({V.LATEST_SQL}) w ON e.point = w.point AND e.trade_date = w.w_trade_date AND e.trade_hour = w.w_trade_hour""",
)
def hour_25_fill(spark, sf):
    """Rows without a wall-clock hour take it from the weather row found by the trade key."""
    e = V.energy(spark, sf).withColumn("valid_local", F.when(F.col("source_row") % 19 != 0, F.col("valid_local")))
    weather = VT.normalize_weather(V.forecasts_with_trade_key(spark, sf))
    out = J.fill_times(J.join_weather(e, weather, J.TRADE_KEY), "Europe/Warsaw")
    return out.select("source_row", "valid_local")
