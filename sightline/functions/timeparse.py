"""Clock times as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finish_seconds(text: Column) -> Column:
    """Seconds of day of ``H:M[:S[.f]] [AM|PM]``; fractions are kept, hours are not bounded; null if it can't be read."""
    t = F.upper(F.trim(text))
    clock = F.regexp_extract(t, r"^(.*?)\s*(AM|PM)?$", 1)
    half = F.regexp_extract(t, r"(AM|PM)$", 1)
    parts = F.split(clock, ":")
    hour, minute = F.get(parts, 0).try_cast("int"), F.get(parts, 1).try_cast("int")
    second = F.when(F.size(parts) > 2, F.get(parts, 2).try_cast("double")).otherwise(F.lit(0.0))
    shifted = F.when((half == "PM") & (hour != 12), hour + 12).when((half == "AM") & (hour == 12), F.lit(0)).otherwise(hour)
    return F.when(text.isNotNull() & (F.size(parts) >= 2) & (F.size(parts) <= 3), (shifted * 3600 + minute * 60).cast("double") + second)


def whole_seconds(text: Column) -> Column:
    """As finish_seconds, but with whole seconds, and null beyond hour 23, minute 59 or second 59."""
    s = finish_seconds(text)
    parts = F.split(F.regexp_extract(F.upper(F.trim(text)), r"^(.*?)\s*(AM|PM)?$", 1), ":")
    minute = F.get(parts, 1).try_cast("int")
    second = F.coalesce(F.get(parts, 2).try_cast("double"), F.lit(0.0))
    return F.when((s < 86400) & (minute < 60) & (second < 60) & (minute >= 0) & (second >= 0), F.floor(s).cast("long"))


def seconds_of_day(ts: Column) -> Column:
    """Wall-clock seconds of day with microseconds, as a double."""
    return (F.hour(ts) * 3600 + F.minute(ts) * 60).cast("double") + F.date_part(F.lit("SECOND"), ts).cast("double")


def epoch_or_time(text: Column) -> Column:
    """Epoch seconds of a number, a numeric string, ``Y-M-D h:m:s[.f]`` or ``Y:M:D h:m:s``; null otherwise."""
    t = F.trim(text.cast("string"))
    iso = F.try_to_timestamp(F.regexp_replace(t, "^(\\d{4}):(\\d{2}):(\\d{2})", "$1-$2-$3"))
    dated = F.when(t.rlike(r"^\d{4}[-:]\d{2}[-:]\d{2}[ T]\d{2}:\d{2}"), F.unix_micros(iso) / 1e6)
    return F.coalesce(t.try_cast("double"), dated)


def wall_clock(text: Column) -> Column:
    """An ISO time with its zone dropped, not converted."""
    return F.try_to_timestamp(F.regexp_replace(text, r"(Z|[+-]\d{2}:?\d{2})$", "")).cast("timestamp_ntz")
