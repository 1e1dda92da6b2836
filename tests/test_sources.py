"""Scans, limits, mapping, warehouse extract, sinks."""

import csv
import datetime as dt
import io
import os
import random
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import mapping, plant
from loadcast import names as N
from loadcast.config import ForecastConfig
from loadcast.plans.run import run_from_files
from loadcast.session import tune
from loadcast.sinks import tables as OUT
from loadcast.sinks.vocabulary import to_source_vocabulary
from loadcast.sources import limits as L
from loadcast.sources import records as R
from loadcast.sources import scan as S
from loadcast.sources import warehouse as WH

HEADER = "Nazwa;Kierunek;Grupa;Nazwa;Kierunek;Doba;Rodzaj;Godzina;Wartość;extra"


def put(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write("\n".join(lines) + "\n")


def parts(folder):
    put(f"{folder}/in/Dane_01.csv", [HEADER, *[f"BIA;1;G;K;czynne pobranie;2024-01-0{d};4;1;{d},5;z" for d in (1, 2, 3)]])
    put(f"{folder}/in/Dane_02.csv", [HEADER, *[f"LUB;-1;G;K;czynne oddanie;2025-02-0{d};4;1;{d};z" for d in (1, 2, 3, 4)], ";;;;;;; ;;z"])
    put(f"{folder}/in/Opis.csv", [HEADER, "x;1;G;K;a;2024-01-01;4;1;1;z"])
    return f"{folder}/in"


def test_positional_scan_of_matching_parts(spark, folder):
    df = S.scan_energy(spark, parts(folder), fmt="csv", part_regex=S.PART_REGEX)
    rows = df.orderBy("source_sheet", "source_row").collect()
    assert [(r.source_sheet, r.source_row) for r in rows] == [("Dane_01", i) for i in (2, 3, 4)] + [("Dane_02", i) for i in (2, 3, 4, 5)]
    assert rows[0].branch_code == "BIA" and rows[0].actual == "1,5" and rows[0].client == "K"
    assert df.columns == ["source_sheet", "source_row", *N.ENERGY_COLUMNS]
    with pytest.raises(ValueError):
        S.scan_energy(spark, f"{folder}/in", fmt="csv", part_regex="^Nic_")


def test_named_scan_and_short_files(spark, folder):
    names = ["uwaga", *reversed(N.SOURCE_ENERGY_COLUMNS)]
    put(f"{folder}/named.csv", [",".join(names), "n,1,2,3,2025-01-01,e,k,g,1,BIA"])
    row = S.scan_energy(spark, f"{folder}/named.csv").first()
    assert (row.branch_code, row.actual, row.source_sheet, row.source_row) == ("BIA", "1", "named", 2)
    put(f"{folder}/short.csv", ["a,b,c", "1,2,3"])
    with pytest.raises(ValueError):
        S.scan_energy(spark, f"{folder}/short.csv")


def test_row_numbers_across_many_splits(spark, folder):
    path = f"{folder}/long.csv"
    put(path, [",".join(N.ENERGY_COLUMNS), *[f"{i},1,g,k,e,2025-01-01,4,1,{i}" for i in range(20_000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = S.scan_energy(spark, path)
        assert df.rdd.getNumPartitions() >= 1
        assert df.filter(F.col("source_row") != F.col("branch_code").cast("long") + 2).count() == 0
        assert df.select("source_row").distinct().count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def csv_cell(rng):
    kind = rng.randrange(8)
    text = "".join(rng.choice(["a", "b", ";", "\n", "\r\n", '"', '""', " ", "x y", ","]) for _ in range(rng.randrange(9)))
    return '5" p' if kind == 0 else text if kind < 5 else rng.choice(["plain", "1,5", "2024-01-01"])


@pytest.mark.parametrize("split", [40, 300, 10_000_000])
def test_records_over_line_breaks_and_splits(spark, folder, split):
    """Cells with breaks, separators and quotes, some fully quoted, against Python's reader; files begin and end oddly."""
    rng, want = random.Random(split), {}
    os.makedirs(f"{folder}/in")
    for part in range(4):
        rows = [[csv_cell(rng) for _ in range(9)] for _ in range(60)]
        out = io.StringIO(newline="")
        style = [csv.QUOTE_MINIMAL, csv.QUOTE_ALL][part % 2]
        writer = csv.writer(out, delimiter=";", quoting=style, lineterminator=["\n", "\r\n"][part // 2])
        header = [*N.SOURCE_ENERGY_COLUMNS[:8], N.SOURCE_ENERGY_COLUMNS[8]]
        writer.writerow(header)
        for k, r in enumerate(rows):
            writer.writerow(r)
            out.write("\n" if k % 9 == 0 else "")
        text = out.getvalue()
        with open(f"{folder}/in/Dane_{part}.csv", "w", encoding="utf-8-sig" if part else "utf-8", newline="") as f:
            f.write(text if part != 3 else text.rstrip("\r\n"))
        read = [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=";") if r]
        want |= {(f"Dane_{part}", k + 1): r for k, r in enumerate(read) if k}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = S.scan_energy(spark, f"{folder}/in", fmt="csv").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    found = {(r.source_sheet, r.source_row): [c or "" for c in tuple(r)[2:]] for r in got}
    assert len(found) == len(got) and found.keys() == want.keys()
    for key, cells in want.items():
        assert found[key] == cells, key


def test_lines_are_read_once_to_be_cut(spark, folder):
    put(f"{folder}/in/Dane_01.csv", ["a;b", *[f'{k};"x\n\n;{k}"' for k in range(50)]])
    records = R.cut_records(R.text_lines(spark, [f"{folder}/in"]), ";")
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.split("Join")[0] and f"{folder}/in" not in " ".join(records.inputFiles())
    assert sorted((r.record, r.value) for r in records.collect())[:2] == [(1, "a;b"), (2, '0;"x\n\n;0"')] and records.count() == 51


def test_headers_over_lines_and_open_cells(spark, folder):
    for part, name in enumerate(["last", "last\none"]):
        with open(f"{folder}/p{part}.csv", "w", newline="") as f:
            f.write(";".join(["a"] * 8 + [f'"{name}"']) + "\n" + ";".join(["1"] * 8 + ['"x\ny"']) + "\n")
    rows = S.scan_energy(spark, f"{folder}/p*.csv", sep=";").collect()
    assert sorted((r.source_sheet, r.source_row, r.actual) for r in rows) == [("p0", 2, "x\ny"), ("p1", 2, "x\ny")]
    with open(f"{folder}/open.csv", "w") as f:
        f.write(";".join("abcdefghi") + "\n" + ";".join(["1"] * 8) + ';"never\nclosed\n')
    with pytest.raises(Exception, match="no end"):
        S.scan_energy(spark, f"{folder}/open.csv").collect()


def test_files_with_one_header_are_not_listed(spark, folder):
    for part in range(30):
        put(f"{folder}/in/Dane_{part}.csv", [HEADER, "BIA;1;G;K;e;2024-01-01;4;1;1;z"])
    assert S._header_groups(spark, [f"{folder}/in"]) == [(HEADER, False, [f"{folder}/in"])]


def test_every_part_has_its_own_header_and_separator(spark, folder):
    names = list(N.SOURCE_ENERGY_COLUMNS)
    value = {c: f"v{i}" for i, c in enumerate(names)}
    for part, (order, sep) in enumerate([(names, ";"), (names[::-1], ";"), (names, ","), (["more", *names[4:], *names[:4]], "\t")], 1):
        put(f"{folder}/in/Dane_{part}.csv", [sep.join(order), sep.join(value.get(c, "x") for c in order)])
    rows = S.scan_energy(spark, f"{folder}/in", fmt="csv", part_regex=S.PART_REGEX).collect()
    assert len(rows) == 4 and {r.source_sheet for r in rows} == {f"Dane_{p}" for p in (1, 2, 3, 4)}
    assert {tuple(r[c] for c in N.ENERGY_COLUMNS) for r in rows} == {tuple(f"v{i}" for i in range(len(names)))}
    put(f"{folder}/w/a.csv", ["punkt;temperatura", "Lublin;1,5"])
    put(f"{folder}/w/b.csv", ["temperatura,punkt", "2.5,Kielce"])
    w = {r.punkt: r.temperatura for r in S.scan_weather(spark, f"{folder}/w/*.csv").collect()}
    assert w == {"Lublin": "1,5", "Kielce": "2.5"}


def test_one_file_in_order_from_many_ranges(spark, folder):
    keys = [(k * 7919) % 5003 for k in range(5003)] + [None, 17, 17]
    df = spark.createDataFrame([(k, str(k)) for k in keys], "k long, t string").repartition(5)
    one = OUT.in_one_partition(df, F.col("k"), sort_rows=250)
    assert one.rdd.getNumPartitions() == 1 and "Sort" not in one._jdf.queryExecution().executedPlan().toString()
    one.write.options(header=True, sep=";").csv(f"{folder}/one")
    assert len(os.listdir(f"{folder}/one")) == 4  # the file, _SUCCESS and their checksums
    back = S._numbered(spark, [f"{folder}/one"], "csv", ";")[0].orderBy("source_row").collect()
    assert [r.source_row for r in back] == list(range(2, len(keys) + 2))
    assert [r.t for r in back] == [str(k) for k in sorted(keys, key=lambda k: -1 if k is None else k)]
    assert OUT.in_one_partition(df.where("k < 0"), F.col("k")).count() == 0


def test_parquet_scan_has_row_index(spark, folder):
    spark.range(100).coalesce(1).select(*[F.col("id").cast("string").alias(c) for c in N.ENERGY_COLUMNS]).write.parquet(f"{folder}/e")
    df = S.scan_energy(spark, f"{folder}/e", fmt="parquet")
    assert df.filter(F.col("source_row") != F.col("actual").cast("long") + 2).count() == 0


def test_limits(spark, folder):
    df = S.scan_energy(spark, parts(folder), fmt="csv", part_regex=S.PART_REGEX)
    tail = L.limit_input(df, 3, "tail")
    assert sorted(r.trade_date for r in tail.collect()) == ["2025-02-02", "2025-02-03", "2025-02-04"]
    head = L.limit_input(df, 5, "head").orderBy("source_sheet", "source_row").collect()
    assert [(r.source_sheet, r.source_row) for r in head] == [("Dane_01", 2), ("Dane_01", 3), ("Dane_01", 4), ("Dane_02", 2), ("Dane_02", 3)]
    assert L.limit_input(df, None).count() == L.limit_input(df, 99, "tail").count() == 7
    report = {r.check: (r["count"], r.details) for r in L.input_limit_report(7, tail, "tail").collect()}
    assert report["rows_skipped_by_limit"][0] == 4 and report["range_to"][1] == "2025-02-04"


@pytest.mark.parametrize("n", [1, 400, 1000, 1400, 2000, 5000])
def test_large_limit_equals_sorted_limit(spark, n, monkeypatch):
    """A third of the rows shares one time and some have none; numbers take several digits."""
    monkeypatch.setattr(L, "_PARTS", 8)
    monkeypatch.setattr(L, "_ROWS", 20)
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, F.lit(50)).when(F.col("id") % 20 != 1, F.pmod(F.xxhash64("id"), F.lit(100)).cast("int")).alias("t"),
        (F.col("id") % 7).alias("s"),
        "id",
    )
    got = {r.id for r in L.first_n(df, n, [(F.col("t"), True), (F.col("s"), False), (F.col("id"), True)]).collect()}
    want = df.orderBy(F.desc_nulls_last("t"), F.asc_nulls_last("s"), F.desc("id")).limit(n).collect()
    assert got == {r.id for r in want}


_TOP = (1 << 63) - 1
ODD = {
    "long": [_TOP, -_TOP - 1, 0, -1, 1, _TOP - 1, None, *range(-5, 6)],
    "int": [2**31 - 1, -(2**31), 0, None, *range(9)],
    "boolean": [True, False, None],
    "double": [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, None, 0.1, 0.1 + 1e-16, 1.0, 1e9],
    "float": [float("nan"), float("inf"), 3.25, -3.25, 1e-45, None, 16777216.0],
    "decimal(38,4)": [Decimal("9" * 34), Decimal("-" + "9" * 34), Decimal("0.0001"), Decimal("0.0002"), Decimal(0), None, Decimal("9" * 34 + ".9999")],
    "string": ["", "\0", "\0\0", "a", "a\0", "a\0\0b", "ab", "abc", "abcd" * 50, "abcd" * 50 + "e", "ż", "🙂", "\uffff", None, "Z", "z"],
    "binary": [b"", b"\0", b"\xff" * 9, b"\xff" * 8, b"a", None],
    "date": [dt.date(1, 1, 1), dt.date(9999, 12, 31), dt.date(1970, 1, 1), dt.date(1969, 12, 31), None],
}


@pytest.mark.parametrize("kind", ODD)
def test_limits_of_any_type(spark, monkeypatch, kind):
    """Extremes, ties and nulls: the first rows are those that an ordinary sort puts first."""
    monkeypatch.setattr(L, "_PARTS", 16)
    monkeypatch.setattr(L, "_ROWS", 3)
    rng = random.Random(kind)
    rows = [(v, rng.randrange(3), k) for k, v in enumerate(ODD[kind] * 2 + [rng.choice(ODD[kind][:4]) for _ in range(20)])]
    df = spark.createDataFrame(rows, f"v {kind}, t int, id int").repartition(3).cache()
    for descending in (False, True):
        first = F.desc_nulls_last("v") if descending else F.asc_nulls_last("v")
        want = [r.id for r in df.orderBy(first, F.desc_nulls_last("t"), "id").collect()]
        for n in {1, len(rows) // 3, len(rows) - 2} | ({7, len(rows) - 9, len(rows) + 1} if kind in ("long", "double", "string") else set()):
            got = L.first_n(df, n, [(F.col("v"), descending), (F.col("t"), True), (F.col("id"), False)])
            assert {r.id for r in got.collect()} == set(want[:n]), (kind, descending, n)
    df.unpersist()


def test_limit_of_equal_rows_and_of_many_strings(spark, monkeypatch):
    same = spark.range(500).select(F.lit(7).alias("a"), F.lit("x").alias("b"))
    monkeypatch.setattr(L, "_ROWS", 10)
    assert L.first_n(same, 123, [(F.col("a"), False)]).count() == 123
    names = spark.range(3000).select(F.concat(F.lit("a common beginning "), F.sha2(F.col("id").cast("string"), 256)).alias("name"), "id")
    want = [r.id for r in names.orderBy("name").limit(1234).collect()]
    assert {r.id for r in L.first_n(names, 1234, [(F.col("name"), False)]).collect()} == set(want)
    with pytest.raises(TypeError):
        L.first_n(spark.createDataFrame([([1],)], "a array<int>"), 1, [(F.col("a"), False)])


def test_parts_are_in_natural_order(spark):
    df = spark.createDataFrame([(f"Dane_{p}", r) for p in range(1, 13) for r in (2, 3)], "source_sheet string, source_row long")
    tail = {(r.source_sheet, r.source_row) for r in L.limit_input(df, 5, "tail").collect()}
    assert tail == {("Dane_12", 2), ("Dane_12", 3), ("Dane_11", 2), ("Dane_11", 3), ("Dane_10", 3)}
    assert {r.source_sheet for r in L.limit_input(df, 18, "head").collect()} == {f"Dane_{p}" for p in range(1, 10)}


def test_newest_rows_survive_the_repeated_hour(spark):
    """The driver's zone must not matter: the limit falls into the hour that an autumn clock shows twice."""
    zone, old = os.environ.get("TZ"), time.tzname
    os.environ["TZ"] = "Europe/Warsaw"
    time.tzset()
    try:
        rows = spark.range(400).select(
            F.timestamp_seconds(F.lit(1_761_436_800) + F.floor(F.col("id") / 40) * 3600).alias("model_utc"), F.col("id").alias("source_row")
        )
        for n in range(20, 400, 40):
            got = {r.source_row for r in L.newest_rows(rows, n, ["source_row"]).select("source_row").collect()}
            assert got == set(range(400 - n, 400))
        view = spark.range(72).select(
            F.col("id").alias("exec_id"),
            F.lit("Lublin").alias("punkt"),
            F.expr("timestamp_ntz'2025-06-30 00:00:00' + make_dt_interval(0, int(id))").alias("dataGodzinaCET"),
            F.timestamp_seconds(F.lit(1_751_234_400) + F.col("id") * 3600).alias("dataGodzinaUTC"),
            F.timestamp_seconds(F.lit(1_700_000_000)).alias("czasDanychZrodlaUTC"),
            F.expr("to_date(timestamp_ntz'2025-06-30 00:00:00' + make_dt_interval(0, int(id)))").alias("dataCET"),
            (F.col("id") % 24 + 1).cast("int").alias("godzinaHandlowa25"),
            F.lit("o").alias("wlasciciel"), F.lit("t").alias("typ"), F.lit(1).alias("czyOstatniNaCzasDanych"), F.lit(1.0).alias("temperatura"),
        )
        got = WH.warehouse_extract(view, "2025-07-01", "2025-07-02", 0, "o", "t")
        assert WH.ordered_extract(got).columns == got.columns
        got = got.select(F.col("w_valid_local").cast("string")).collect()
        assert sorted(r[0] for r in got) == [f"2025-07-01 {h:02d}:00:00" for h in range(24)]
    finally:
        if zone is None:
            del os.environ["TZ"]
        else:
            os.environ["TZ"] = zone
        time.tzset()
        assert time.tzname == old


def test_no_training_cap_keeps_everything(spark):
    df = spark.range(5)
    assert L.newest_rows(df, None, []) is df


def test_mapping(spark, folder):
    put(f"{folder}/m.csv", ["oddzial_code,punkt,status,uwaga", "ŁZE,Łódź,active,a", "LZE,Łódź,ACTIVE,b", "ZAM,Zamość,inactive,c", "zam,Inne,inactive,d"])
    m = S.scan_mapping(spark, f"{folder}/m.csv")
    assert {r.branch_key: r.point for r in S.resolve_mapping(m).collect()} == {"lze": "Łódź"}
    put(f"{folder}/bad.csv", ["oddzial_code,punkt,status", "A,X,active", "a.,Y,active"])
    with pytest.raises(ValueError, match="contradictory"):
        S.scan_mapping(spark, f"{folder}/bad.csv")
    put(f"{folder}/less.csv", ["oddzial_code,status", "A,active"])
    with pytest.raises(ValueError, match="lacks"):
        S.scan_mapping(spark, f"{folder}/less.csv")


def dates(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "trade_date string")


def test_date_range(spark):
    assert WH.infer_date_range(dates(spark, "2025-01-05", "2025-01-07", None)) == (dt.datetime(2025, 1, 5), dt.datetime(2025, 1, 8))
    clamped = WH.infer_date_range(dates(spark, "2023-07-29", "2024-11-15", None), weather_start="2024-10-01")
    assert clamped == (dt.datetime(2024, 10, 1), dt.datetime(2024, 11, 16))
    skipped = WH.infer_date_range(dates(spark, "2023-07-29", "2024-09-30", None), weather_start="2024-10-01")
    assert skipped == (None, dt.datetime(2024, 10, 1))
    with pytest.raises(ValueError):
        WH.infer_date_range(dates(spark, None))
    with pytest.raises(ValueError):
        WH.infer_date_range(dates(spark, "2025-01-05"), "2025-02-01", "2025-01-01")


def test_query_parameters():
    p = WH.query_parameters("2025-01-01", "2025-02-01", 24, " own ", "kind")
    assert len(p) == 5 and p["min_lead_hours"] == 24 and p["owner"] == "own"
    for bad in (("2025-02-01", "2025-01-01", 24, "o", "k"), ("2025-01-01", "2025-02-01", 721, "o", "k"), ("2025-01-01", "2025-02-01", 24, " ", "k"), (None, "2025-02-01", 24, "o", "k")):
        with pytest.raises(ValueError):
            WH.query_parameters(*bad)


def test_warehouse_filters(spark):
    view = spark.sql(
        """select i execId, p punkt, date'2025-01-03' dataCET, 13 godzinaHandlowa25, v dataGodzinaCET, timestamp'2025-01-03 11:00:00' dataGodzinaUTC,
           cast(u as timestamp) czasDanychZrodlaUTC, o wlasciciel, t typ, l czyOstatniNaCzasDanych, double(i) temperatura from values
           (1, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-01 11:00:00', 'own', 'k', 1),
           (2, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:00', 'own', 'k', 1),
           (3, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:00', 'own', 'k', 1),
           (4, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:01', 'own', 'k', 1),
           (5, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:00', 'other', 'k', 1),
           (6, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:00', 'own', 'z', 1),
           (7, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:00', 'own', 'k', 0),
           (8, 'Kielce', timestamp_ntz'2025-01-03 12:00:00', '2025-01-02 11:00:00', 'own', 'k', 1),
           (9, 'Lublin', timestamp_ntz'2025-01-04 00:00:00', '2025-01-02 11:00:00', 'own', 'k', 1),
           (10, 'Lublin', timestamp_ntz'2025-01-03 12:00:00', null, 'own', 'k', 1) x(i, p, v, u, o, t, l)"""
    )
    rows = WH.warehouse_extract(view, "2025-01-03", "2025-01-04", 24, "own", "k").collect()
    assert [(r.exec_id, float(r.lead_hours_sql)) for r in rows] == [(3, 24.0)]
    assert WH.empty_weather(spark).count() == 0


def test_locale_csv(spark, folder):
    df = spark.sql("select 1.5D a, timestamp_ntz'2025-01-01 02:00:00' t, date'2025-01-01' d, 'Dane 1/ą' source_sheet")
    OUT.write_csv(df, f"{folder}/out")
    name = next(f for f in os.listdir(f"{folder}/out") if f.endswith(".csv"))
    assert open(f"{folder}/out/{name}", encoding="utf-8").read().splitlines() == ["a;t;d;source_sheet", "1,5;2025-01-01 02:00:00;2025-01-01;Dane 1/ą"]
    assert df.select(OUT.safe_part("source_sheet")).first()[0] == "Dane_1_ą"


def test_output_columns(spark):
    audit = ["correction", "raw_candidate", "blend_alpha", "strategy", "calibration_n", "calibration_improvement", "calibration_reason"]
    df = spark.createDataFrame([], ", ".join(f"{c} string" for c in ["other", "forecast", *audit]))
    assert set(OUT.output_columns(df, compact=True)) == {"forecast", *audit}


def test_source_vocabulary(spark):
    df = spark.sql("select 'IMPORT' direction, 'OOF' prediction_status, 'MATCHED' weather_status, 'x' other, 1.0D actual")
    out = to_source_vocabulary(df)
    assert out.columns == ["kierunek_energii_norm", "status_predykcji", "weather_status", "other", "wartosc_rzeczywista"]
    assert tuple(out.first())[:4] == ("POBRANIE", "OOF_BACKTEST", "DOPASOWANA", "x")


def test_shuffle_partitions_follow_the_input(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        tune(spark, 128 * 1024 * 1024 * 50 + 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "51"
        tune(spark, 1)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "51"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_whole_run_from_files(spark, folder):
    energy, weather = plant(spark, 20)
    energy.orderBy("source_row").drop("source_sheet", "source_row").coalesce(1).write.options(header=True, sep=";").csv(f"{folder}/e")
    weather.coalesce(1).write.options(header=True, sep=";", timestampFormat="yyyy-MM-dd HH:mm:ss").csv(f"{folder}/w")
    mapping(spark).coalesce(1).write.options(header=True).csv(f"{folder}/m")
    config = ForecastConfig(
        validation_days=3, n_splits=1, min_train_rows=100, max_iter=2, compute_importance=False, score_full_history=False,
        row_selection="tail", max_input_rows=7000, compact_output=True, oof_output_only=True,
    )
    out = run_from_files(spark, f"{folder}/e/*.csv", f"{folder}/w/*.csv", f"{folder}/m", f"{folder}/out", config)
    assert out.result.predictions.count() == 7000
    quality = {r.check: r["count"] for r in spark.read.parquet(f"{folder}/out/quality").collect()}
    assert quality["source_rows_total"] == 7680 and quality["rows_skipped_by_limit"] == 680 and quality["weather_matched"] == 7000
    kpi = {r.indicator: r.value for r in spark.read.parquet(f"{folder}/out/kpi").collect()}
    assert len(kpi) == 15 and kpi["all_rows"] == "7000" and float(kpi["match_share_all_rows"]) == 1.0
    saved = spark.read.parquet(f"{folder}/out/predictions")
    assert {r[0] for r in saved.select("prediction_status").distinct().collect()} <= {N.P_OOF, N.P_FUTURE}
    assert set(OUT.COMPACT) | {"part"} == set(saved.columns)
    assert '"schema_version": 1' in spark.read.text(f"{folder}/out/manifest").first()[0]
