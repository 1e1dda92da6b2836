"""`events` read as metered energy and as issued weather forecasts, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.registry import table

ENERGY_SQL = """
  SELECT event_type AS source_sheet, event_id AS source_row,
         'BR' || (user_id % 2) AS branch_code, event_type AS group_name, 'C' || (user_id % 4) AS client,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'EXPORT' ELSE 'IMPORT' END AS direction,
         '4' AS kind, 'P' || (user_id % 4) AS point, 'p' || (user_id % 4) AS point_key,
         CAST(ts AS DATE) AS trade_date, CAST(hour(ts) + 1 AS INTEGER) AS trade_hour,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) AS valid_local, value AS actual
  FROM events"""

FORECAST_SQL = """
  SELECT 'P' || (user_id % 4) AS point, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS w_valid_local,
         CAST(date_trunc('hour', ts) AS TIMESTAMP) - to_hours(event_id % 48) AS issue_local, event_id AS exec_id,
         CASE WHEN event_id % 7 <> 0 THEN value % 40 - 5 END AS temperature,
         value % 50 AS wind_speed,
         (value * 3) % 720 - 90 AS wind_dir,
         CASE WHEN event_id % 2 = 0 THEN (value % 150) / 100 ELSE value % 101 END AS cloud,
         value % 9 - 1 AS precip,
         CASE WHEN event_id % 11 <> 0 THEN value * 40 END AS visibility,
         value * 2 AS rad_total, value * 1.5 AS rad_direct, CAST(0.2 AS DOUBLE) AS albedo,
         CASE WHEN event_id % 5 = 0 THEN value % 3 END AS snow
  FROM events"""

LATEST_SQL = f"""
  SELECT * EXCLUDE (rn) FROM (
    SELECT f.*, CAST(w_valid_local AS DATE) AS w_trade_date, CAST(hour(w_valid_local) + 1 AS INTEGER) AS w_trade_hour,
           date_diff('second', issue_local, w_valid_local) / CAST(3600 AS DOUBLE) AS lead_hours,
           row_number() OVER (PARTITION BY point, w_valid_local ORDER BY issue_local DESC, exec_id DESC) AS rn
    FROM ({FORECAST_SQL}) f WHERE issue_local <= w_valid_local - INTERVAL 24 HOUR)
  WHERE rn = 1"""

FEATURES = [
    "temperature", "wind_speed", "wind_dir", "cloud", "precip", "visibility", "rad_total", "rad_direct", "albedo", "snow",
]
COUNT_SQL = " + ".join(f"CAST(w.{f} IS NOT NULL AS INTEGER)" for f in FEATURES)

JOINED_SQL = f"""
  SELECT e.*, (w.point IS NOT NULL) AS weather_matched, {COUNT_SQL} AS feature_count,
         {', '.join('w.' + f for f in FEATURES)}, w.lead_hours
  FROM ({ENERGY_SQL}) e LEFT JOIN ({LATEST_SQL}) w ON e.point = w.point AND e.valid_local = w.w_valid_local"""


def energy(spark: SparkSession, folder: str) -> DataFrame:
    u = F.col("user_id")
    local = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    point = (u % 4).cast("string")
    return table(spark, folder, "events").select(
        F.col("event_type").alias("source_sheet"),
        F.col("event_id").alias("source_row"),
        F.concat(F.lit("BR"), (u % 2).cast("string")).alias("branch_code"),
        F.col("event_type").alias("group_name"),
        F.concat(F.lit("C"), point).alias("client"),
        F.when(F.col("event_type").isin("purchase", "signup"), "EXPORT").otherwise("IMPORT").alias("direction"),
        F.lit("4").alias("kind"),
        F.concat(F.lit("P"), point).alias("point"),
        F.concat(F.lit("p"), point).alias("point_key"),
        F.col("ts").cast("date").alias("trade_date"),
        (F.hour("ts") + 1).alias("trade_hour"),
        local.alias("valid_local"),
        F.col("value").alias("actual"),
    )


def forecasts(spark: SparkSession, folder: str) -> DataFrame:
    e, v = F.col("event_id"), F.col("value")
    local = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return table(spark, folder, "events").select(
        F.concat(F.lit("P"), (F.col("user_id") % 4).cast("string")).alias("point"),
        local.alias("w_valid_local"),
        (local - F.make_dt_interval(F.lit(0), (e % 48).cast("int"))).alias("issue_local"),
        e.alias("exec_id"),
        e.alias("src_order"),
        F.when(e % 7 != 0, v % 40 - 5).alias("temperature"),
        (v % 50).alias("wind_speed"),
        ((v * 3) % 720 - 90).alias("wind_dir"),
        F.when(e % 2 == 0, (v % 150) / 100).otherwise(v % 101).alias("cloud"),
        (v % 9 - 1).alias("precip"),
        F.when(e % 11 != 0, v * 40).alias("visibility"),
        (v * 2).alias("rad_total"),
        (v * 1.5).alias("rad_direct"),
        F.lit(0.2).alias("albedo"),
        F.when(e % 5 == 0, v % 3).alias("snow"),
    )


def forecasts_with_trade_key(spark: SparkSession, folder: str) -> DataFrame:
    return forecasts(spark, folder).withColumns(
        {"w_trade_date": F.col("w_valid_local").cast("date"), "w_trade_hour": F.hour("w_valid_local") + 1}
    )
