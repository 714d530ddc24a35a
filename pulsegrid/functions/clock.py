"""Wall-clock arithmetic on TIMESTAMP_NTZ.

Everything here is independent of ``spark.sql.session.timeZone``: Spark's ``date_trunc`` and
``timestampdiff`` turn a zone-less timestamp into an instant first, so days, hours and minutes
are taken from the calendar fields instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_wall_clock(text: Column) -> Column:
    """Parse timestamp text as UTC; unreadable text gives NULL. A trailing offset is applied; it is looked for
    where the text has a sign behind a blank only, which the times of samples never have."""
    local = F.substring_index(F.substring_index(text, " +", 1), " -", 1).try_cast("timestamp_ntz")
    part = lambda group: F.regexp_extract(text, r" ([+-])(\d\d):?(\d\d)", group)
    minutes = part(2).try_cast("int") * 60 + part(3).try_cast("int")
    ahead = F.coalesce(F.when(part(1) == "-", -minutes).otherwise(minutes), F.lit(0))
    moved = local - F.make_dt_interval(F.lit(0), F.lit(0), ahead)
    return F.when(text.contains(" +") | text.contains(" -"), moved).otherwise(text.try_cast("timestamp_ntz"))


def utc_to_zone(ts: Column, zone: str) -> Column:
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts)


def day(ts: Column) -> Column:
    return ts.cast("date")


def hour_start(ts: Column) -> Column:
    return day(ts).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.hour(ts))


def minute_start(ts: Column) -> Column:
    return day(ts).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour(ts), F.minute(ts)
    )


def second_start(ts: Column) -> Column:
    return minute_start(ts) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), F.floor(F.second(ts)).cast("decimal(18,6)")
    )


def shift_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(F.lit(0), F.lit(hours))


def at_hour(date: Column, hour: Column) -> Column:
    return date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)


def hours_of(date: Column) -> Column:
    """The 24 wall-clock hours of a date, as an array."""
    midnight = date.cast("timestamp_ntz")
    return F.sequence(midnight, shift_hours(midnight, 23), F.expr("interval 1 hour"))


def minutes_crossed(start: Column, end: Column) -> Column:
    """Number of minute boundaries between two times: 03:59:50 to 04:00:10 is 1."""
    minute_of_day = lambda ts: F.hour(ts) * 60 + F.minute(ts)
    return F.datediff(day(end), day(start)) * 1440 + minute_of_day(end) - minute_of_day(start)


def month_day(date: Column) -> Column:
    return F.date_format(date, "MMM dd")


_TWO_DIGITS = [f"{n:02d}" for n in range(60)]


def time_of_day(ts: Column) -> Column:
    two_digits = F.array(*[F.lit(t) for t in _TWO_DIGITS])  # folded to one literal; padding costs more in a lambda
    part = lambda value: F.get(two_digits, value)
    return F.concat_ws(":", part(F.hour(ts)), part(F.minute(ts)), part(F.second(ts)))


def stamp(ts: Column) -> Column:
    """A zone-less time as text to the second; NULL for NULL."""
    return F.concat(day(ts).cast("string"), F.lit(" "), time_of_day(ts))


def hour_stamps(date: Column) -> Column:
    """``stamp`` of ``hours_of``: the day is put into words once."""
    day_text = date.cast("string")
    return F.array(*[F.concat(day_text, F.lit(f" {t}:00:00")) for t in _TWO_DIGITS[:24]])


def age_on(birth: Column, as_of: Column) -> Column:
    """Completed calendar years."""
    month_day_number = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return (
        F.year(as_of)
        - F.year(birth)
        - F.when(month_day_number(as_of) < month_day_number(birth), 1).otherwise(0)
    )
