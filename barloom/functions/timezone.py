"""Conversions between zoned instants and the stored naive local time."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IST = "Asia/Kolkata"


def to_ist(ts_utc: Column) -> Column:
    """Naive-UTC wall clock -> naive IST wall clock."""
    return F.convert_timezone(F.lit("UTC"), F.lit(IST), ts_utc.cast("timestamp_ntz"))


def ist_to_utc(ts_ist: Column) -> Column:
    """Naive IST wall clock -> naive UTC wall clock."""
    return F.convert_timezone(F.lit(IST), F.lit("UTC"), ts_ist.cast("timestamp_ntz"))


def to_iso_ist(ts_ist: Column) -> Column:
    """ISO-8601 text with the fixed +05:30 offset; IST has no daylight saving."""
    local = ts_ist.cast("timestamp_ntz")
    seconds = F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(local, "SSSSSS")
    fraction = F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))
    return F.concat(seconds, fraction, F.lit("+05:30"))


def iso_to_ist(text: Column) -> Column:
    """ISO-8601 text -> naive IST.

    Text with an offset (or Z) is converted to IST; text without one already is IST.
    Unparseable text gives NULL.
    """
    zone = r"(?:[zZ]|[+-]\d{2}:?\d{2})$"
    has_zone = text.contains("T") & text.rlike(zone)
    sign = F.when(F.regexp_extract(text, r"([+-])\d{2}:?\d{2}$", 1) == "-", -1).otherwise(1)
    hh = F.regexp_extract(text, r"[+-](\d{2}):?\d{2}$", 1).try_cast("int")
    mm = F.regexp_extract(text, r"[+-]\d{2}:?(\d{2})$", 1).try_cast("int")
    offset_min = F.coalesce(sign * (hh * 60 + mm), F.lit(0))
    naive = F.regexp_replace(text, zone, "").try_cast("timestamp_ntz")
    shifted = naive + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(330) - offset_min, F.lit(0))
    return F.when(has_zone, shifted).otherwise(text.try_cast("timestamp_ntz"))
