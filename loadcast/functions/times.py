"""Time expressions: valid hour, strict zone conversion, forecast lead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HOUR_US = 3_600_000_000


def hours(n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(F.lit(0), n.cast("int"))


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(int(n)))


def valid_time(trade_date: Column, trade_hour: Column) -> Column:
    """Start of the delivery hour for hours 1..24; hour 25 has no wall clock of its own and stays NULL."""
    return F.when(
        trade_hour.between(1, 24), trade_date.cast("timestamp_ntz") + hours(trade_hour - 1)
    ).cast("timestamp_ntz")


# Unlike convert_timezone, these look the zone up once and not twice a row. The session's zone is UTC (`require_utc`).
def _to_utc(c: Column, zone: str) -> Column:
    return F.to_utc_timestamp(c.cast("timestamp"), zone).cast("timestamp_ntz")


def _from_utc(c: Column, zone: str) -> Column:
    return F.from_utc_timestamp(c.cast("timestamp"), zone).cast("timestamp_ntz")


def strict_to_utc(local: Column, zone: str) -> Column:
    """Wall clock to UTC; NULL for hours the clock skips and for hours it shows twice."""
    utc = _to_utc(local, zone)
    skipped = _from_utc(utc, zone) != local
    later = _from_utc(utc + hours(1), zone) == local
    earlier = _from_utc(utc - hours(1), zone) == local
    return F.when(~skipped & ~later & ~earlier, utc).cast("timestamp")


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def lead_hours(valid_utc: Column, issue_utc: Column, valid_local: Column, issue_local: Column) -> Column:
    """Exact hours between issue and valid time, in UTC when both instants are known, else on the wall clock."""
    has_utc = valid_utc.isNotNull() & issue_utc.isNotNull()
    return F.when(has_utc, (_micros(valid_utc) - _micros(issue_utc)) / F.lit(_HOUR_US)).when(
        issue_local.isNotNull(), (_micros(valid_local) - _micros(issue_local)) / F.lit(_HOUR_US)
    )


def lead_hours_by_minute(valid_utc: Column, issue_utc: Column) -> Column:
    """Minute boundaries crossed / 60 as decimal(10,2), the warehouse form of the lead."""
    minutes = F.floor(_micros(valid_utc) / F.lit(60_000_000)) - F.floor(_micros(issue_utc) / F.lit(60_000_000))
    return (minutes.cast("decimal(12,0)") / F.lit(60).cast("decimal(4,0)")).cast("decimal(10,2)")


def eligible_vintage(
    valid_utc: Column, issue_utc: Column, valid_local: Column, issue_local: Column, lead: int
) -> Column:
    """Issued at least `lead` hours before the valid hour (inclusive); FALSE when no issue time is known."""
    has_utc = valid_utc.isNotNull() & issue_utc.isNotNull()
    by_utc = issue_utc <= valid_utc - hours(lead)
    by_local = issue_local <= valid_local - hours(lead)
    return F.when(has_utc, by_utc).when(issue_local.isNotNull(), by_local).otherwise(F.lit(False))
