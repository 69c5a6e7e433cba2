"""Calendar floors, additions and differences on timestamps without a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_number(ts: Column | str) -> Column:
    return F.unix_date(F.to_date(_col(ts))).cast("long")


def micros_of_day(ts: Column | str) -> Column:
    ts = _col(ts)
    seconds = F.hour(ts).cast("long") * 3600 + F.minute(ts) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def epoch_us(ts: Column | str) -> Column:
    """Microseconds since 1970 of the clock reading; independent of the session's time zone."""
    return day_number(ts) * 86_400_000_000 + micros_of_day(ts)


def instant(ts: Column | str) -> Column:
    """The clock reading taken as UTC; event time of a stream must be an instant."""
    return F.timestamp_micros(epoch_us(ts))


def floor_us(ts: Column | str, unit: str, steps: int = 1, first_day: int = 0) -> Column:
    """Start of the bucket, in microseconds since 1970.

    Minute buckets restart every hour and hour buckets every day.  ``first_day`` is the first day
    of a week, 0 for Sunday.
    """
    ts = _col(ts)
    day = day_number(ts)
    per_day = 86_400_000_000
    if unit == "day":
        return day * per_day
    if unit == "week":
        weekday = F.dayofweek(ts) - 1
        return (day - F.pmod(weekday - first_day, F.lit(7))) * per_day
    if unit == "month":
        return (day - F.dayofmonth(ts) + 1) * per_day
    hour = F.hour(ts).cast("long")
    if unit == "hour":
        return day * per_day + F.floor(hour / steps) * steps * 3_600_000_000
    if unit == "minute":
        minute = F.floor(F.minute(ts) / steps) * steps
        return day * per_day + hour * 3_600_000_000 + minute * 60_000_000
    raise ValueError(f"unknown unit {unit}")


def date_add(ts: Column | str, unit: str, amount: int) -> Column:
    """Add to a timestamp; months and years stay inside the target month, weekdays skip weekends."""
    ts = _col(ts)
    months = {"month": 1, "quarter": 3, "year": 12}
    if unit in months:
        return ts + F.make_ym_interval(F.lit(0), F.lit(amount * months[unit]))
    seconds = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400,
               "week": 7 * 86400}
    if unit in seconds:
        if unit == "millisecond":
            return ts + F.make_dt_interval(secs=F.lit(amount).cast("decimal(18,6)") / 1000)
        whole = amount * int(seconds[unit])
        return ts + F.make_dt_interval(secs=F.lit(whole))
    if unit != "weekday":
        raise ValueError(f"unknown unit {unit}")
    if amount == 0:
        return ts
    # A weekend start counts as the working day before it (going forward) or after it (going back).
    weekday = F.dayofweek(ts) - 1
    if amount > 0:
        back = F.when(weekday == 6, 1).when(weekday == 0, 2).otherwise(0)
        monday_based = F.when(weekday.isin(0, 6), F.lit(4)).otherwise(weekday - 1)
        days = F.floor((monday_based + amount) / 5) * 7 + F.pmod(monday_based + amount, F.lit(5)) \
            - monday_based - back
    else:
        ahead = F.when(weekday == 6, 2).when(weekday == 0, 1).otherwise(0)
        monday_based = F.when(weekday.isin(0, 6), F.lit(0)).otherwise(weekday - 1)
        days = F.floor((monday_based + amount) / 5) * 7 + F.pmod(monday_based + amount, F.lit(5)) \
            - monday_based + ahead
    return ts + F.make_dt_interval(days=days.cast("int"))


def _working_day_index(day: Column) -> Column:
    """Working days up to and including ``day`` (days since 1970-01-01, a Thursday)."""
    monday_based = day + 3
    return F.floor(monday_based / 7) * 5 + F.least(F.pmod(monday_based, F.lit(7)) + 1, F.lit(5))


def date_diff(start: Column | str, end: Column | str, unit: str = "day") -> Column:
    """Whole units from start to end.

    Years, quarters and months compare calendar fields; weeks cut towards zero; smaller units round
    half up; weekdays count the working days after the start up to the end.
    """
    start, end = _col(start), _col(end)
    years = F.year(end) - F.year(start)
    if unit == "year":
        return years.cast("long")
    if unit == "quarter":
        return (F.quarter(end) - F.quarter(start) + years * 4).cast("long")
    if unit == "month":
        return (F.month(end) - F.month(start) + years * 12).cast("long")
    micros = epoch_us(end) - epoch_us(start)
    sizes = {"millisecond": 1000, "second": 10 ** 6, "minute": 60 * 10 ** 6,
             "hour": 3600 * 10 ** 6, "day": 86400 * 10 ** 6}
    if unit in sizes:
        return F.floor(micros / sizes[unit] + 0.5)
    days = F.floor(micros / sizes["day"] + 0.5)
    if unit == "week":
        weeks = days / 7
        return F.when(weeks < 0, F.ceil(weeks)).otherwise(F.floor(weeks))
    if unit == "weekday":
        # Forward counts working days in (start, end], backward those in [end, start).
        first = day_number(start)
        last = first + days
        ahead = _working_day_index(last) - _working_day_index(first)
        behind = _working_day_index(last - 1) - _working_day_index(first - 1)
        return F.when(days >= 0, ahead).otherwise(behind)
    raise ValueError(f"unknown unit {unit}")
