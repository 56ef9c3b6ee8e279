"""Instants: epoch microseconds inside, ISO strings at the edges, and the three parsers that inputs need.

All functions take and return Columns and none depends on the session's time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "America/Los_Angeles"
#: Seconds from 1970-01-01 to 2001-01-01, both UTC: fixed.
EPOCH_2001 = 978_307_200
#: First instant that ingestion keeps, in microseconds: 2026-04-06 00:00 in the local zone.
CUTOVER_US = 1_775_458_800_000_000
ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?)?(?:Z|[+-]\d{2}:?\d{2})?$"
ISO_ANYWHERE = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?"
ZONED = r"(?:Z|[+-]\d{2}:?\d{2})$"


def micros(ntz: Column) -> Column:
    """Epoch microseconds of a wall-clock timestamp that is in UTC."""
    since = ntz - F.expr("timestamp_ntz'1970-01-01 00:00:00'")
    return (F.lit(1_000_000) * since.cast("interval second").cast("decimal(20,6)")).cast("long")


def wall(us: Column, zone: str = "UTC") -> Column:
    """The wall clock of a zone at an instant, as a timestamp without zone."""
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (us / F.lit(1_000_000).cast("decimal(20,0)")).cast("decimal(18,6)"))
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def offset_seconds(us: Column, zone: str = LOCAL_ZONE) -> Column:
    """Seconds that the zone is ahead of UTC at an instant."""
    return ((micros(wall(us, zone)) - us) / 1_000_000).cast("int")


def offset_text(us: Column, zone: str = LOCAL_ZONE, separator: str = ":") -> Column:
    """The zone's offset as +HH:MM, or with another separator."""
    s = offset_seconds(us, zone)
    m = F.abs(s)
    return F.concat(F.when(s < 0, "-").otherwise("+"), F.lpad((m / 3600).cast("int").cast("string"), 2, "0"), F.lit(separator), F.lpad(((m % 3600) / 60).cast("int").cast("string"), 2, "0"))


def iso_millis(us: Column) -> Column:
    """UTC as ISO with milliseconds (cut off, not rounded) and Z."""
    return F.date_format(wall(us), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_short(us: Column) -> Column:
    """UTC as ISO with microseconds where there are any."""
    return F.when(us % 1_000_000 == 0, F.date_format(wall(us), "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(wall(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def iso_local(us: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.concat(F.date_format(wall(us, zone), "yyyy-MM-dd'T'HH:mm:ss.SSS"), offset_text(us, zone))


def local_day(us: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.date_format(wall(us, zone), "yyyy-MM-dd")


def label(us: Column, zone: str = LOCAL_ZONE) -> Column:
    """As Mon Apr 6, 3:05 PM; a missing instant says so."""
    return F.coalesce(F.date_format(wall(us, zone), "EEE MMM d, h:mm a"), F.lit("Missing timestamp"))


def duration_label(seconds: Column) -> Column:
    """Whole seconds as 1h02m03s, 2m03s or 3s."""
    s = F.floor(seconds).cast("long")
    h, m, r = (s / 3600).cast("long"), ((s % 3600) / 60).cast("long"), s % 60
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.when(h > 0, F.concat(h.cast("string"), F.lit("h"), two(m), F.lit("m"), two(r), F.lit("s"))).when(m > 0, F.concat(m.cast("string"), F.lit("m"), two(r), F.lit("s"))).otherwise(F.concat(r.cast("string"), F.lit("s")))


def _instant(text: Column, zone: str = "UTC") -> Column:
    """Microseconds of an ISO text; without an offset it is in the zone; null where it is no ISO text."""
    t = F.when(text.rlike(ISO), F.regexp_replace(text, ",", "."))
    zoned = F.unix_micros(F.try_to_timestamp(t))
    naive = micros(F.convert_timezone(F.lit(zone), F.lit("UTC"), _try_ntz(t))) if zone != "UTC" else micros(_try_ntz(t))
    return F.when(t.rlike(ZONED), zoned).otherwise(naive)


def _try_ntz(text: Column) -> Column:
    return text.try_cast("timestamp_ntz")


def seconds_to_micros(seconds: Column) -> Column:
    return F.round(seconds * 1_000_000).cast("long")


def parse_event(number: Column, text: Column, zone: str = "UTC") -> Column:
    """The number of seconds if there is one, else the ISO text; without an offset the text is in zone."""
    return F.coalesce(seconds_to_micros(number), _instant(text, zone))


def parse_window_end(number: Column, text: Column) -> Column:
    """As parse_event, and a window start/end (or startZ-end) counts as its end."""
    end = F.when(text.contains("/"), F.trim(F.substring_index(text, "/", -1))).when(text.contains("Z-"), F.substring_index(text, "Z-", -1)).otherwise(text)
    return F.coalesce(seconds_to_micros(number), _instant(end))


def parse_first(text: Column) -> Column:
    """The first ISO instant anywhere in the text: the start of a window."""
    return _instant(F.nullif(F.regexp_extract(text, f"({ISO_ANYWHERE})", 1), F.lit("")))


def parse_mail_date(text: Column) -> Column:
    """An RFC 2822 date as UTC ISO seconds; null where it can't be read."""
    t = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", ""), r"\s*\([^)]*\)\s*$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r" (GMT|UT|UTC|Z)$", " +0000")
    t = F.when(t.rlike(r"[+-]\d{4}$"), t).otherwise(F.concat(t, F.lit(" +0000")))
    t = F.when(t.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2} "), F.regexp_replace(t, r"^(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}) ", "$1:00 ")).otherwise(t)
    ok = t.rlike(r"^\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} [+-]\d{4}$")
    us = F.unix_micros(F.try_to_timestamp(F.when(ok, t), F.lit("d MMM yyyy HH:mm:ss Z")))
    return F.date_format(wall(us), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def day_key(start_local: Column, start_utc: Column, start_us: Column) -> Column:
    """The day of an interval: of its local start, else its UTC start, else its start instant."""
    head = lambda c: F.when(F.length(c) >= 10, F.substring(c, 1, 10))
    return F.coalesce(head(start_local), head(start_utc), F.date_format(wall(start_us), "yyyy-MM-dd"))
