"""Partition arithmetic on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook.schemas import GRAIN_FORMATS

# Longest suffix first, so an hour is not read as a day.
_SUFFIX = r"^(.*?)(\d{8}T\d{2}|\d{10}|\d{8}|\d{6})$"
# How a table name spells its grain.
FORMAT_NAMES = {
    "day": "YYYYMMDD",
    "month": "YYYYMM",
    "hour": "YYYYMMDDHH",
    "hour_t": "YYYYMMDDTHH",
}
_EPOCH = "1970-01-01 00:00:00"


def _check(grain: str) -> str:
    if grain not in GRAIN_FORMATS:
        raise ValueError(f"grain must be one of {sorted(GRAIN_FORMATS)}, not {grain!r}")
    return GRAIN_FORMATS[grain]


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def _micros(c: Column) -> Column:
    epoch = F.lit(_EPOCH).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, _ntz(c))


def shift(ts: Column, offset: Column, grain: str) -> Column:
    """``ts`` moved by ``offset`` days, months or hours (a month end is clamped)."""
    _check(grain)
    if grain == "month":
        return _ntz(F.add_months(ts.cast("date"), offset))
    if grain == "day":
        return _ntz(ts) + F.make_dt_interval(days=offset)
    return _ntz(ts) + F.make_dt_interval(hours=offset)


def partition_offset(ts: Column, offset: Column, grain: str) -> Column:
    """Suffix of the partition ``offset`` steps away from ``ts``."""
    return F.date_format(shift(ts, offset, grain), _check(grain))


def partition_id(template: Column, ts: Column, offset: Column) -> Column:
    """``events_YYYYMMDD`` with the format replaced by the suffix ``offset`` steps from ``ts``.

    A name that ends in no format is left as it is.
    """
    out = template
    for grain, name in reversed(FORMAT_NAMES.items()):
        stem = F.regexp_replace(template, f"{name}$", "")
        out = F.when(template.endswith(name), F.concat(stem, partition_offset(ts, offset, grain))).otherwise(out)
    return out


def offset_of(part: Column, now: Column, grain: str) -> Column:
    """Steps from ``now`` to ``part``; days and hours floor, months truncate."""
    _check(grain)
    if grain == "month":
        return F.months_between(_ntz(part), _ntz(now), roundOff=False).cast("int")
    unit = 86_400_000_000 if grain == "day" else 3_600_000_000
    gap = _micros(part) - _micros(now)
    return ((gap - F.pmod(gap, F.lit(unit))) / F.lit(unit)).cast("int")


def split_suffix(table_id: Column) -> Column:
    """``events_20240105`` as struct(prefix, grain, suffix); no suffix gives NULLs."""
    suffix = F.when(table_id.rlike(_SUFFIX), F.regexp_extract(table_id, _SUFFIX, 2))
    size = F.length(suffix)
    grain = (
        F.when(size == 11, F.lit("hour_t"))
        .when(size == 10, F.lit("hour"))
        .when(size == 8, F.lit("day"))
        .when(size == 6, F.lit("month"))
    )
    prefix = F.when(suffix.isNull(), table_id).otherwise(
        F.regexp_extract(table_id, _SUFFIX, 1)
    )
    return F.struct(prefix.alias("prefix"), grain.alias("grain"), suffix.alias("suffix"))


def parse_suffix(suffix: Column, grain: str) -> Column:
    """Suffix as DATE (day, first of month) or TIMESTAMP_NTZ (hour)."""
    fmt = _check(grain)
    if grain in ("day", "month"):
        return F.to_date(suffix, fmt)
    return F.to_timestamp_ntz(suffix, F.lit(fmt))
