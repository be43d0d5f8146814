"""Calendar columns in UTC by arithmetic on the instant, whatever zone the session has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY, _HOUR = 86_400, 3_600
# A time of day, and one followed by its offset: Z, +02:00, UTC, GMT+1, Europe/Paris.
_CLOCK = r"\d{1,2}:\d{1,2}"
_OFFSET = r"(?:[Zz]|[+-]\d{1,2}(?::?\d{2}){0,2}|[A-Za-z]{3,}[A-Za-z_/]*(?:[+-]\d{1,2}(?::?\d{2})?)?)"
_PLACED = _CLOCK + r"(?::\d{1,2}(?:\.\d*)?)?\s*" + _OFFSET + r"\s*$"


def utc_date(moment: Column) -> Column:
    seconds = F.unix_seconds(moment)
    return F.date_from_unix_date(((seconds - F.pmod(seconds, F.lit(_DAY))) / _DAY).cast("int"))


def utc_hour(moment: Column) -> Column:
    return (F.pmod(F.unix_seconds(moment), F.lit(_DAY)) / _HOUR).cast("int")


def utc_weekday(moment: Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(utc_date(moment))


def utc_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp; without an offset it is UTC. Null if unreadable."""
    midnight = F.timestamp_seconds(F.unix_date(text.try_cast("date")) * _DAY)
    return (
        F.when(text.rlike(_PLACED), text.try_cast("timestamp"))
        .when(text.rlike(_CLOCK), F.concat(F.trim(text), F.lit("Z")).try_cast("timestamp"))
        .when(text.try_cast("timestamp").isNotNull(), midnight)
    )
