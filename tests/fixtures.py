"""Small deterministic inputs, built as Spark expressions."""

from pyspark.sql import functions as F

MAPPING = [("BIA", "Białystok", "active"), ("LUB", "Lublin", "active"), ("ŁZE", "Łódź", "active"), ("RZE", "Rzeszów", "active")]


def mapping(spark):
    return spark.createDataFrame(MAPPING, "branch_code string, point string, status string")


def energy_raw(spark, rows):
    """(sheet, row, branch, sign, client, text, date, hour, value) with the constant group and kind filled in."""
    full = [(s, r, b, str(c), "G", k, t, d, "4", str(h), str(v)) for s, r, b, c, k, t, d, h, v in rows]
    names = (
        "source_sheet string, source_row long, branch_code string, direction_code string, group_name string, "
        "client string, direction_text string, trade_date string, kind string, trade_hour string, actual string"
    )
    return spark.createDataFrame(full, names)


def _hours(spark, days):
    return spark.range(days * 24).select(
        F.expr("timestamp_ntz'2025-01-01 00:00:00' + make_dt_interval(0, cast(id as int))").alias("valid"), "id"
    )


def plant(spark, days):
    """Energy (4 branches x 2 clients x 2 directions x hours, as text) and weather with vintages 30 h and 12 h ahead."""
    branches = F.array(*[F.struct(F.lit(i).alias("b"), F.lit(c).alias("code"), F.lit(p).alias("city")) for i, (c, p, _) in enumerate(MAPPING)])
    grid = _hours(spark, days).select("valid", "id", F.inline(branches))
    hour, doy = F.hour("valid"), F.dayofyear("valid")
    wobble = (F.pmod(F.xxhash64("id", "b"), F.lit(1000)) / 1000.0 - 0.5)
    temperature = 4 + 3 * F.sin(2 * F.pi() * (hour - 8) / 24) + F.sin(doy / 3.0) * 4 + F.col("b") * 0.7
    radiation = F.greatest(F.lit(0.0), 500 * F.sin(F.pi() * (hour - 6) / 12.0))
    w = grid.select(
        F.col("city").alias("punkt"),
        "valid",
        F.explode(F.array(F.lit(30), F.lit(12))).alias("lead"),
        temperature.alias("temperatura"),
        radiation.alias("calkowitePromieniowanieSloneczneGodzinowe"),
        (4.5 + wobble).alias("predkoscWiatru"),
        F.pmod(F.lit(180.0) + 80 * F.sin(doy / 5.0), F.lit(360.0)).alias("kierunekWiatru"),
        (55 + 30 * F.sin(doy / 2.0)).alias("zachmurzenie"),
        F.lit(0.2).alias("albedoPrognozowane"),
    )
    weather = w.select(
        "punkt",
        F.col("valid").alias("dataGodzinaCET"),
        F.expr("convert_timezone('Europe/Warsaw', 'UTC', valid)").cast("timestamp").alias("dataGodzinaUTC"),
        F.expr("valid - make_dt_interval(0, lead)").alias("czasDanychZrodlaCET"),
        F.expr("convert_timezone('Europe/Warsaw', 'UTC', valid) - make_dt_interval(0, lead)").cast("timestamp").alias("czasDanychZrodlaUTC"),
        F.to_date("valid").alias("dataCET"),
        (F.hour("valid") + 1).alias("godzinaHandlowa25"),
        *[c for c in w.columns if c not in ("punkt", "valid", "lead")],
    )
    load = 600 + 200 * F.exp(-F.pow((hour - 19) / 3.0, 2)) + (17 - temperature) * 8 + wobble * 40
    feed = F.greatest(F.lit(0.0), radiation * 0.8 + wobble * 20)
    sides = F.array(
        F.struct(F.lit("1").alias("code_b"), F.lit("czynne pobranie").alias("text"), load.alias("v")),
        F.struct(F.lit("-1").alias("code_b"), F.lit("czynne oddanie").alias("text"), feed.alias("v")),
    )
    clients = F.array(F.lit(1), F.lit(2))
    e = grid.select("valid", "id", "b", "code", F.explode(clients).alias("k"))
    e = e.select("valid", "id", "b", "code", "k", F.inline(sides))
    energy = e.select(
        F.lit("Dane_01").alias("source_sheet"),
        (F.col("id") * 16 + F.col("b") * 4 + F.col("k") * 2 + (F.col("code_b") == "1").cast("int")).alias("source_row"),
        F.col("code").alias("branch_code"),
        F.col("code_b").alias("direction_code"),
        F.lit("DEMO").alias("group_name"),
        F.concat(F.lit("CLIENT_"), F.col("b"), F.lit("_"), F.col("k")).alias("client"),
        F.col("text").alias("direction_text"),
        F.to_date("valid").cast("string").alias("trade_date"),
        F.lit("4").alias("kind"),
        (F.hour("valid") + 1).cast("string").alias("trade_hour"),
        F.round(F.col("v") * F.col("k"), 3).cast("string").alias("actual"),
    )
    return energy, weather
