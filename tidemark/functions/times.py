"""Date and time expressions. Timestamps are UTC; the reader's clock is a fixed offset."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(text: Column) -> Column:
    """ISO-8601 with a zone, else null (a naive timestamp is not accepted)."""
    zoned = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, text.try_cast("timestamp"))


def fmt_ts(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def local_date(ts: Column, utc_offset_hours: int = 8) -> Column:
    return F.to_date(ts + F.make_dt_interval(hours=F.lit(utc_offset_hours)))


def week_id(day: Column) -> Column:
    """ISO week, e.g. 2026-W53 for 2027-01-01."""
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"),
        F.lit("-W"),
        F.lpad(F.weekofyear(day).cast("string"), 2, "0"),
    )


def week_start(day: Column) -> Column:
    return F.to_date(F.date_trunc("week", day))


def week_bounds(week: Column) -> tuple[Column, Column]:
    """Monday and Sunday of a week id: 4 January always lies in week 1."""
    first = week_start(F.make_date(F.substring(week, 1, 4).cast("int"), F.lit(1), F.lit(4)))
    monday = F.date_add(first, (F.substring(week, 7, 2).cast("int") - 1) * 7)
    return monday, F.date_add(monday, 6)


def days_between(start: Column, end: Column) -> Column:
    """All dates from start to end, both included."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def event_sort_key(date_text: Column) -> Column:
    """A month-only date sorts after every day of its month."""
    return F.when(F.length(date_text) == 10, date_text).otherwise(F.concat(date_text, F.lit("-32")))


def parse_feed_date(text: Column) -> Column:
    """RFC 822 date, else ISO-8601; without a zone it is read as UTC; otherwise null."""
    bare = F.trim(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},?\s+", ""))
    short_zone = F.regexp_replace(bare, r"\s+(GMT|UTC|UT|Z)$", " +0000")
    for zone, offset in US_ZONES.items():
        short_zone = F.regexp_replace(short_zone, rf"\s+{zone}$", f" {offset}")
    iso = F.trim(text)
    return F.coalesce(
        F.try_to_timestamp(short_zone, F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(short_zone, F.lit("d MMM yyyy HH:mm Z")),
        F.try_to_timestamp(short_zone, F.lit("d MMM yyyy HH:mm:ss")),
        F.when(iso.rlike(r"^\d{4}-\d{2}-\d{2}"), iso.try_cast("timestamp")),
    )


# --- fixed values: zone names of RFC 822 -------------------------------------------
US_ZONES = {
    "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_seconds(end) - F.unix_seconds(start)) / F.lit(3600.0)


def in_window(ts: Column, start: Column, end: Column, grace_hours: int) -> tuple[Column, Column]:
    """(inside, inside when the grace period before the start also counts); both ends included."""
    graced = ts.between(start - F.make_dt_interval(hours=F.lit(grace_hours)), end)
    return ts.between(start, end), graced
