"""Polish public holidays and clock-change days as date expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (month, day) of the public holidays with a fixed date.
FIXED_HOLIDAYS = [(1, 1), (1, 6), (5, 1), (5, 3), (8, 15), (11, 1), (11, 11), (12, 25), (12, 26)]
# Days after Easter Sunday of the moving ones.
EASTER_OFFSETS = [0, 1, 49, 60]


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b)).cast("int")


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter from the golden number, the epact and the weekday of the full moon (Gauss's rule with the
    Clavius correction)."""
    golden = year % 19
    century = _div(year, 100)
    solar = century - _div(century, 4)
    lunar = _div(8 * century + 13, 25)
    epact = (solar - lunar + 19 * golden + 15) % 30
    # Full moons on epact 29, and on 28 with a late golden number, move one day earlier.
    moon = epact - F.when((epact == 29) | ((epact == 28) & (golden > 10)), 1).otherwise(0)
    march_21 = F.make_date(year, F.lit(3), F.lit(21))
    full_moon = F.date_add(march_21, moon)
    return F.next_day(full_moon, "SUN")


def last_sunday(year: Column, month: int) -> Column:
    end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(end, 7), "SUN")


def is_holiday(day: Column) -> Column:
    fixed = F.lit(False)
    for month, number in FIXED_HOLIDAYS:
        fixed = fixed | ((F.month(day) == month) & (F.dayofmonth(day) == number))
    moving = F.date_diff(day, easter_sunday(F.year(day))).isin(EASTER_OFFSETS)
    return F.coalesce((fixed | moving).cast("double"), F.lit(0.0))


def is_clock_change(day: Column) -> Column:
    year = F.year(day)
    return F.coalesce(day.isin(last_sunday(year, 3), last_sunday(year, 10)).cast("double"), F.lit(0.0))


def add_special_days(df: DataFrame, local: str = "valid_local") -> DataFrame:
    """0/1 flags by local date. Both are functions of the date alone, so no dimension has to be joined."""
    day = F.col(local).cast("date")
    return df.withColumns({"is_holiday": is_holiday(day), "is_clock_change": is_clock_change(day)})


def calendar_dimension(dates: DataFrame, column: str) -> DataFrame:
    """The special days of every year that occurs in `column`: `day`, `is_holiday`, `is_clock_change`."""
    years = dates.select(F.year(column).alias("year")).filter("year is not null").distinct()
    year = F.col("year")
    days = [F.make_date(year, F.lit(m), F.lit(d)) for m, d in FIXED_HOLIDAYS]
    days += [F.date_add(easter_sunday(year), k) for k in EASTER_OFFSETS]
    days += [last_sunday(year, m) for m in (3, 10)]
    listed = years.select(F.explode(F.array_distinct(F.array(*days))).alias("day"))
    return listed.withColumns(
        {"is_holiday": is_holiday(F.col("day")), "is_clock_change": is_clock_change(F.col("day"))}
    )
