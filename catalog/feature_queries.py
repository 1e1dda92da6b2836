"""Lags, calendar, weather shapes, encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog import views as V
from catalog.registry import query, r6, table
from catalog.weather_queries import ENRICHED_SQL, enriched
from loadcast import names as N
from loadcast.functions import rowwise as R
from loadcast.operators import calendar_dim as C
from loadcast.operators import encode as E
from loadcast.operators.features import add_row_features, build_features, fill_availability, fill_categories
from loadcast.operators.lags import add_lag_statistics, add_lags

_DAYS = range(3, 15)

LAG_SQL = f"""
  SELECT k.*, {', '.join(f'h{d}.m AS lag_{24 * d}h' for d in _DAYS)}
  FROM (SELECT *, branch_code || '|' || group_name || '|' || client || '|' || direction || '|' || kind AS series_id
        FROM ({V.ENERGY_SQL})) k
  {' '.join(f'''LEFT JOIN hist h{d} ON h{d}.series_id = k.series_id AND h{d}.trade_hour = k.trade_hour
                 AND h{d}.trade_date = k.trade_date - {d}''' for d in _DAYS)}"""

HIST_SQL = f"""hist AS (
  SELECT branch_code || '|' || group_name || '|' || client || '|' || direction || '|' || kind AS series_id,
         trade_date, trade_hour, avg(actual) AS m FROM ({V.ENERGY_SQL}) GROUP BY ALL)"""

_LIST = "[" + ", ".join(f"lag_{24 * d}h" for d in _DAYS) + "]"


def _list(days) -> str:
    return "[" + ", ".join(f"lag_{24 * d}h" for d in days) + "]"


STATS_SQL = f"""
  SELECT l.*, list_avg(list_filter({_LIST}, lambda x: x IS NOT NULL)) AS baseline,
    CAST(len(list_filter({_LIST}, lambda x: x IS NOT NULL)) AS DOUBLE) AS lag_count,
    list_stddev_samp(list_filter({_LIST}, lambda x: x IS NOT NULL)) AS lag_std_3_14d,
    list_avg(list_filter({_list(range(3, 7))}, lambda x: x IS NOT NULL))
      - list_avg(list_filter({_list(range(10, 15))}, lambda x: x IS NOT NULL)) AS lag_trend
  FROM ({LAG_SQL}) l"""


def lagged(spark, sf):
    return add_lag_statistics(add_lags(V.energy(spark, sf)))


@query(
    "lag_features",
    f"WITH {HIST_SQL} SELECT source_row, series_id, {', '.join(f'round(lag_{24 * d}h + 3.3e-8, 6) AS lag_{24 * d}h' for d in _DAYS)} FROM ({LAG_SQL})",
)
def lag_features(spark, sf):
    out = add_lags(V.energy(spark, sf))
    return out.select("source_row", "series_id", *[r6(f"lag_{24 * d}h").alias(f"lag_{24 * d}h") for d in _DAYS])


@query(
    "lag_stats",
    f"""WITH {HIST_SQL} SELECT source_row, round(baseline + 3.3e-8, 6) AS baseline, lag_count, round(lag_std_3_14d + 3.3e-8, 6) AS lag_std_3_14d,
          round(lag_trend + 3.3e-8, 6) AS lag_trend, round(lag_168h - baseline + 3.3e-8, 6) AS lag_7d_vs_mean FROM ({STATS_SQL})""",
)
def lag_stats(spark, sf):
    columns = ["baseline", "lag_std_3_14d", "lag_trend", "lag_7d_vs_mean"]
    return lagged(spark, sf).select("source_row", "lag_count", *[r6(c).alias(c) for c in columns])


@query(
    "calendar",
    """SELECT o_orderkey, CAST(hour(t) AS INTEGER) AS "hour", CAST(isodow(t) - 1 AS INTEGER) AS weekday,
         CAST(month(t) AS INTEGER) AS "month", CAST(dayofyear(t) AS INTEGER) AS day_of_year,
         CAST(isodow(t) >= 6 AS DOUBLE) AS weekend
       FROM (SELECT o_orderkey, o_orderdate + to_hours(o_orderkey % 24) AS t FROM orders)""",
)
def calendar(spark, sf):
    t = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 24).cast("int"))
    df = table(spark, sf, "orders").select("o_orderkey", t.alias("t"))
    return df.withColumns(R.calendar_features(F.col("t"))).drop("t")


@query(
    "cyclic",
    """SELECT event_id, round(sin(2 * pi() * h / 24) + 3.3e-8, 6) AS hour_sin, round(cos(2 * pi() * h / 24) + 3.3e-8, 6) AS hour_cos,
         round(sin(2 * pi() * w / 7) + 3.3e-8, 6) AS weekday_sin, round(cos(2 * pi() * w / 7) + 3.3e-8, 6) AS weekday_cos,
         round(sin(2 * pi() * d / 365.25) + 3.3e-8, 6) AS year_sin, round(cos(2 * pi() * d / 365.25) + 3.3e-8, 6) AS year_cos
       FROM (SELECT event_id, hour(ts) AS h, isodow(ts) - 1 AS w, dayofyear(ts) AS d FROM events)""",
)
def cyclic(spark, sf):
    made = R.cyclic_features(F.hour("ts"), F.weekday("ts"), F.dayofyear("ts"))
    return table(spark, sf, "events").select("event_id", *[r6(c).alias(k) for k, c in made.items()])


_EASTER_SQL = """
  years AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders),
  e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
  e2 AS (SELECT *, (19 * a + b - b // 4 - ((b - (b + 8) // 25 + 1) // 3) + 15) % 30 AS h FROM e1),
  e3 AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - (c % 4)) % 7 AS l FROM e2),
  e4 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM e3),
  easter AS (SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, ((h + l - 7 * m + 114) % 31) + 1) AS d FROM e4),
  holidays AS (SELECT CAST(d + k AS DATE) AS day FROM easter, (VALUES (0), (1), (49), (60)) o(k)
    UNION SELECT make_date(y, mo, dd) FROM years, (VALUES (1, 1), (1, 6), (5, 1), (5, 3), (8, 15), (11, 1), (11, 11),
      (12, 25), (12, 26)) f(mo, dd)),
  month_ends AS (SELECT last_day(make_date(y, mo, 1)) AS x FROM years, (VALUES (3), (10)) f(mo)),
  clock AS (SELECT CAST(x - CAST(isodow(x) % 7 AS INTEGER) AS DATE) AS day FROM month_ends)"""


@query("holidays", f"WITH {_EASTER_SQL} SELECT day FROM holidays")
def holidays(spark, sf):
    return C.calendar_dimension(table(spark, sf, "orders"), "o_orderdate").filter("is_holiday = 1").select("day")


@query("dst_days", f"WITH {_EASTER_SQL} SELECT day FROM clock")
def dst_days(spark, sf):
    return C.calendar_dimension(table(spark, sf, "orders"), "o_orderdate").filter("is_clock_change = 1").select("day")


@query(
    "special_day_flags",
    f"""WITH {_EASTER_SQL}
        SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) IN (SELECT day FROM holidays) AS DOUBLE) AS is_holiday,
               CAST(CAST(o_orderdate AS DATE) IN (SELECT day FROM clock) AS DOUBLE) AS is_clock_change FROM orders""",
)
def special_day_flags(spark, sf):
    out = C.add_special_days(table(spark, sf, "orders"), "o_orderdate")
    return out.select("o_orderkey", "is_holiday", "is_clock_change")


@query(
    "weather_features",
    f"""WITH f AS (SELECT *, CASE WHEN abs(cloud) <= 1.5 THEN cloud ELSE cloud / 100 END AS frac,
                    CASE WHEN wind_speed < 0 THEN 0 WHEN wind_speed > 40 THEN 40 ELSE wind_speed END AS calm,
                    ((wind_dir % 360) + 360) % 360 AS deg FROM ({V.FORECAST_SQL}))
        SELECT exec_id, round(CASE WHEN 18 - temperature < 0 THEN 0 ELSE 18 - temperature END + 3.3e-8, 6) AS heating_degrees,
          round(CASE WHEN temperature - 22 < 0 THEN 0 ELSE temperature - 22 END + 3.3e-8, 6) AS cooling_degrees,
          round(sin(radians(deg)) + 3.3e-8, 6) AS wind_dir_sin, round(cos(radians(deg)) + 3.3e-8, 6) AS wind_dir_cos,
          round(calm * calm + 3.3e-8, 6) AS wind_speed_2, round(calm * calm * calm + 3.3e-8, 6) AS wind_speed_3,
          round(frac + 3.3e-8, 6) AS cloud_fraction,
          round(rad_total * (1 - CASE WHEN frac < 0 THEN 0 WHEN frac > 1 THEN 1 ELSE frac END) + 3.3e-8, 6) AS rad_after_cloud,
          round(ln(1 + CASE WHEN precip < 0 THEN 0 ELSE precip END) + 3.3e-8, 6) AS precip_log1p
        FROM f""",
)
def weather_features(spark, sf):
    made = R.weather_features()
    return V.forecasts(spark, sf).select(
        "exec_id", *[r6(c).alias(k) for k, c in made.items()]
    )


@query(
    "availability_fill",
    f"""SELECT source_row, CAST(coalesce(matched, FALSE) AS DOUBLE) AS weather_available FROM
        (SELECT source_row, CASE WHEN source_row % 5 <> 0 THEN source_row % 2 = 0 END AS matched FROM ({V.ENERGY_SQL}))""",
)
def availability_fill(spark, sf):
    row = F.col("source_row")
    df = V.energy(spark, sf).withColumn("weather_matched", F.when(row % 5 != 0, row % 2 == 0))
    return fill_availability(df).select("source_row", "weather_available")


@query(
    "category_fill",
    f"""SELECT source_row, CASE WHEN source_row % 6 = 0 THEN '__MISSING__' ELSE client END AS client,
          CASE WHEN source_row % 7 = 0 THEN '__MISSING__' ELSE point END AS point, direction FROM ({V.ENERGY_SQL})""",
)
def category_fill(spark, sf):
    row = F.col("source_row")
    df = V.energy(spark, sf).withColumns(
        {"client": F.when(row % 6 != 0, F.col("client")), "point": F.when(row % 7 != 0, F.col("point"))}
    )
    return fill_categories(df).select("source_row", "client", "point", "direction")


@query(
    "crossfit_encode",
    f"""WITH t AS (SELECT source_row, client, source_row % 5 AS fold, actual AS y FROM ({V.ENERGY_SQL})),
          allv AS (SELECT client, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM t GROUP BY 1),
          part AS (SELECT client, fold, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM t GROUP BY 1, 2),
          tot AS (SELECT count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM t),
          ptot AS (SELECT fold, count(*) AS n, sum(y) AS s, sum(y * y) AS q FROM t GROUP BY 1),
          o AS (SELECT p.client, p.fold, a.n - p.n AS n, a.s - p.s AS s, a.q - p.q AS q,
                  tot.n - pt.n AS gn, tot.s - pt.s AS gs, tot.q - pt.q AS gq
                FROM part p JOIN allv a USING (client) JOIN ptot pt USING (fold), tot),
          w AS (SELECT *, gs / gn AS g, gq / gn - (gs / gn) * (gs / gn) AS gv FROM o),
          e AS (SELECT *, gv * n / (gv * n + (q - s * s / n) / n) AS lam FROM w)
        SELECT source_row, round(lam * s / n + (1 - lam) * g + 3.3e-8, 6) AS encoded FROM t JOIN e USING (client, fold)""",
)
def crossfit_encode(spark, sf):
    fold = (F.col("source_row") % 5).cast("int")
    out = E.crossfit_encode(V.energy(spark, sf), "client", "actual", fold)
    return out.select("source_row", r6("encoded").alias("encoded"))


@query(
    "impute_indicator",
    f"""SELECT exec_id, coalesce(temperature, 0) AS temperature, coalesce(visibility, 0) AS visibility,
          CAST(temperature IS NULL AS DOUBLE) AS temperature_missing, CAST(visibility IS NULL AS DOUBLE) AS visibility_missing
        FROM ({V.FORECAST_SQL})""",
)
def impute_indicator(spark, sf):
    out = E.impute_with_indicator(V.forecasts(spark, sf), ["temperature", "visibility"])
    return out.select("exec_id", "temperature", "visibility", "temperature_missing", "visibility_missing")


_HOLIDAY_SQL = _EASTER_SQL.replace("year(o_orderdate)", "year(ts)").replace("FROM orders", "FROM events")


def _six(name: str, sql: str) -> str:
    return f"round(CAST({sql} AS DOUBLE) + 3.3e-8, 6) AS {name}"


def _turn(c: str, period: str) -> str:
    return f"2 * pi() * {c} / {period}"


#: Every numeric input by its formula over j (enriched rows), s (lag statistics) and f (bounded weather).
_INPUT_SQL = {
    **{f: f"j.{f}" for f in N.WEATHER_FEATURES if f in V.FEATURES},
    **{f: "NULL" for f in N.WEATHER_FEATURES if f not in V.FEATURES},
    "weather_available": "coalesce(CAST(j.weather_matched AS DOUBLE), 0)",
    "lead_hours": "w.lead_hours",
    "hour": "hour(j.valid)",
    "weekday": "isodow(j.valid) - 1",
    "month": "month(j.valid)",
    "weekend": "coalesce(CAST(isodow(j.valid) >= 6 AS DOUBLE), 0)",
    "is_holiday": "coalesce(CAST(CAST(j.valid AS DATE) IN (SELECT day FROM holidays) AS DOUBLE), 0)",
    "is_clock_change": "coalesce(CAST(CAST(j.valid AS DATE) IN (SELECT day FROM clock) AS DOUBLE), 0)",
    **{f"hour_{g}": f"{g}({_turn('hour(j.valid)', '24')})" for g in ("sin", "cos")},
    **{f"weekday_{g}": f"{g}({_turn('(isodow(j.valid) - 1)', '7')})" for g in ("sin", "cos")},
    **{f"year_{g}": f"{g}({_turn('dayofyear(j.valid)', '365.25')})" for g in ("sin", "cos")},
    "heating_degrees": "greatest(18 - j.temperature, CASE WHEN j.temperature IS NOT NULL THEN 0 END)",
    "cooling_degrees": "greatest(j.temperature - 22, CASE WHEN j.temperature IS NOT NULL THEN 0 END)",
    **{f"wind_dir_{g}": f"{g}(radians(((j.wind_dir % 360) + 360) % 360))" for g in ("sin", "cos")},
    "wind_speed_2": "j.calm * j.calm",
    "wind_speed_3": "j.calm * j.calm * j.calm",
    "cloud_fraction": "j.frac",
    "rad_after_cloud": "j.rad_total * (1 - CASE WHEN j.frac < 0 THEN 0 WHEN j.frac > 1 THEN 1 ELSE j.frac END)",
    "precip_log1p": "ln(1 + CASE WHEN j.precip < 0 THEN 0 ELSE j.precip END)",
    **{f"lag_{24 * d}h": f"s.lag_{24 * d}h" for d in _DAYS},
    "lag_mean_3_14d": "s.baseline",
    "lag_count": "s.lag_count",
    "lag_std_3_14d": "s.lag_std_3_14d",
    "lag_trend": "s.lag_trend",
    "lag_7d_vs_mean": "s.lag_168h - s.baseline",
}


@query(
    "feature_table",
    f"""WITH {HIST_SQL}, {_HOLIDAY_SQL},
        j AS (SELECT *, CASE WHEN abs(cloud) <= 1.5 THEN cloud ELSE cloud / 100 END AS frac,
                CASE WHEN wind_speed < 0 THEN 0 WHEN wind_speed > 40 THEN 40 ELSE wind_speed END AS calm FROM ({ENRICHED_SQL})),
        s AS ({STATS_SQL})
        SELECT j.source_row, {', '.join(f"coalesce(j.{c}, '__MISSING__') AS {c}" for c in N.CATEGORICAL)},
          {', '.join(_six(name, sql) for name, sql in _INPUT_SQL.items())}
        FROM j JOIN s ON s.source_row = j.source_row
        LEFT JOIN ({V.LATEST_SQL}) w ON j.point = w.point AND j.valid = w.w_valid_local""",
)
def feature_table(spark, sf):
    """Every model input for every row."""
    features, spec = build_features(enriched(spark, sf), history=V.energy(spark, sf))
    return features.select("source_row", *N.CATEGORICAL, *[r6(F.col(c).cast("double")).alias(c) for c in spec.numeric])


@query(
    "row_features",
    f"""SELECT exec_id, CAST(hour(w_valid_local) AS INTEGER) AS "hour", CAST(month(w_valid_local) AS INTEGER) AS "month",
          CAST(CAST(w_valid_local AS DATE) IN (DATE '2024-01-01', DATE '2024-01-06') AS DOUBLE) AS is_holiday
        FROM ({V.FORECAST_SQL})""",
)
def row_features(spark, sf):
    df = V.forecasts(spark, sf).withColumn("valid_local", F.col("w_valid_local"))
    return add_row_features(df).select("exec_id", "hour", "month", "is_holiday")
