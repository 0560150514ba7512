"""Time bounds and time text.  All instants are UTC; a naive datetime is read as UTC."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_utc(value: datetime | str) -> datetime:
    """The naive UTC datetime of a datetime (naive = UTC) or ISO text."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def utc_now() -> datetime:
    return as_utc(datetime.now(timezone.utc))


def window_start(last: datetime | str, lookback: timedelta) -> datetime:
    """Lower end of a change window: the last refresh minus the lookback."""
    return as_utc(last) - lookback


def sql_time(value: datetime | str, time_type: str = "timestamp") -> str:
    """A SQL literal; it does not depend on the time zone of the Python process."""
    text = as_utc(value).isoformat(sep=" ")
    return f"TIMESTAMP_NTZ '{text}'" if time_type == "timestamp_ntz" else f"TIMESTAMP '{text}Z'"


def time_literal(value: datetime | str, data_type: T.DataType | str = "timestamp") -> Column:
    """A literal of the column's own type, so that comparing needs no cast and can be pushed down."""
    if isinstance(data_type, T.DataType):
        data_type = "timestamp_ntz" if isinstance(data_type, T.TimestampNTZType) else "timestamp"
    return F.expr(sql_time(value, data_type))


def utc_text(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` in UTC, whatever the time zone of the session.

    An instant is counted from the epoch; times without a zone, dates and text are taken as they
    are. ``date_format`` would write instants in the session's zone.
    """
    c = F.col(c) if isinstance(c, str) else c
    micros = F.unix_micros(c.cast("timestamp"))
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    counted = F.timestamp_add("MICROSECOND", micros, epoch)
    naive = F.when(F.typeof(c) == "timestamp", counted).otherwise(c.cast("timestamp_ntz"))
    return naive.cast("string")


def strict_date_time(c) -> Column:
    """Milliseconds, 24-hour clock."""
    text = utc_text(c)
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."),
                    millis, F.lit("Z"))


def second_date_time(c) -> Column:
    """As strict_date_time, with the milliseconds written as .000."""
    text = utc_text(c)
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit(".000Z"))


def iso_date(c) -> Column:
    return F.substring(utc_text(c), 1, 10)
