"""Date and timestamp expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MICROS_PER_DAY = 86_400_000_000.0


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


# Every timestamp expression here is independent of the session and JVM
# time zones: wall-clock values are TIMESTAMP_NTZ, instants are turned into
# UTC wall clock through their epoch microseconds, and literals are built
# from ISO text.
_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO text."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat()
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def _epoch() -> Column:
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz")


def parse_iso_timestamp(c: Column) -> Column:
    """ISO-8601 text (``2021-05-04T13:00:00Z``) to its UTC wall clock
    (TIMESTAMP_NTZ); junk -> NULL."""
    return instant_to_utc(F.try_to_timestamp(c))


def instant_to_utc(c: Column) -> Column:
    """An instant (TIMESTAMP) as UTC wall clock (TIMESTAMP_NTZ)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), _epoch())


def round_to_day(c: Column) -> Column:
    """Round a wall-clock timestamp (TIMESTAMP_NTZ) to the nearest midnight,
    ties to the even day.

    Noon on an even epoch day rounds down and on an odd one up, exactly as
    a half-even rounding of ``epoch_micros / micros_per_day``.
    """
    micros = F.timestamp_diff("MICROSECOND", _epoch(), c.cast("timestamp_ntz"))
    days = F.bround(micros / F.lit(_MICROS_PER_DAY), 0).cast("long")
    return F.timestamp_add("DAY", days, _epoch())


def day_start(c: Column) -> Column:
    return F.to_date(c).cast("timestamp_ntz")


def days_since(c: Column, as_of) -> Column:
    """Whole days from ``c`` to ``as_of`` (may be -1 for a date rounded into
    the future)."""
    return F.datediff(F.lit(as_date(as_of)), c.cast("date")).cast("long")


def month_start(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month").cast("timestamp_ntz")


def year_of(c: Column) -> Column:
    return F.year(c).cast("int")


def shift_date(as_of, shift: int = 0) -> dt.date:
    """``as_of - shift`` days (argument-level helper)."""
    return as_date(as_of) - dt.timedelta(days=shift)


def check_date_range(start, end=None) -> tuple[dt.date, dt.date]:
    start_d = as_date(start)
    end_d = as_date(end) if end is not None else start_d
    if end_d < start_d:
        raise ValueError(f"the window ends ({end_d}) before it starts ({start_d})")
    return start_d, end_d


def date_range(spark: SparkSession, start, end=None, name: str = "date") -> DataFrame:
    """Inclusive daily date range as a one-column DataFrame."""
    start_d, end_d = check_date_range(start, end)
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start_d), F.lit(end_d), F.expr("INTERVAL 1 DAY"))).alias(name)
    )


def _month_add(d: dt.date, months: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) + months, 12)
    return dt.date(y, m + 1, 1)


PERIODS = ("All date range", "Last 12 months", "Current year", "Last month", "Current month")


def period_range(name: str, as_of) -> tuple[dt.datetime, dt.datetime] | None:
    """Named period -> inclusive [start, as_of] range.

    ``as_of`` is the moment the report is run for (never ``now()``).
    "Last month" starts on day 1 of the previous calendar month, with the
    year corrected in January.
    """
    now = as_of if isinstance(as_of, dt.datetime) else dt.datetime.combine(as_date(as_of), dt.time())
    today = now.date()
    if name == "All date range":
        return None
    if name == "Last 12 months":
        start = dt.date(today.year - 1, today.month, 1)
    elif name == "Current year":
        start = dt.date(today.year, 1, 1)
    elif name == "Last month":
        start = _month_add(today.replace(day=1), -1)
    elif name == "Current month":
        start = today.replace(day=1)
    else:
        raise ValueError(f"unknown period {name!r}; expected one of {PERIODS}")
    return dt.datetime.combine(start, dt.time()), now
