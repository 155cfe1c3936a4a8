"""Date and time expressions, and the driver-side calendar arithmetic for scalar bounds."""

from __future__ import annotations

import calendar
import re
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "America/Toronto"

# The shapes a stored date text can have.
STRICT_MDY = r"^\d{2}/\d{2}/\d{4}$"
LOOSE_MDY = r"^\s*\d{1,2}/\s*\d{1,2}/\d{4}\s*$"
MDY_MONTH = r"^\s*(\d{1,2})/"
MDY_DAY = r"/\s*(\d{1,2})/"
MDY_YEAR = r"/(\d{4})\s*$"
MDY_PARTS = r"(?s)^=\s*(\d{1,2})(?=/).*?/\s*(\d{1,2})/(?:.*/)?(\d{4})\s*$"
YMD_PARTS = r"(?s)^(?:([^-]+)-([^-]+)-([^-]+)(?:-.*)?(/)|.*)$"
ISO_DAY = r"^\d{4}-\d{2}-\d{2}\z"
ISO_PREFIX = r"^\d{4}-\d{2}-\d{2}"
ZONE_OFFSETS = {"UTC": "+00:00", "GMT": "+00:00", "EST": "-05:00", "EDT": "-04:00"}
FRENCH_MONTHS = (
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
)


def _part(c: Column, pattern: str, group: int = 1) -> Column:
    """A regex group, null when there is no match (the built-in gives an empty text)."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


# --- writing -------------------------------------------------------------------------------------------------------


def to_mdy(c: Column) -> Column:
    """``2026-07-21T15:05:02Z`` or ``2026-07-21`` -> ``07/21/2026``; empty when a part is missing.

    The text is looked at once, since a filter works out anew whatever it names twice. It gets a slash at its end, which is
    put between the parts where there are three and goes with the rest of the text where there are not.
    """
    marked = F.concat(F.substring(c.cast("string"), 1, 10), F.lit("/"))
    return F.coalesce(F.regexp_replace(marked, YMD_PARTS, "$2$4$3$4$1"), F.lit(""))


def to_time12h(c: Column) -> Column:
    """``13:05:00`` -> ``1:05 PM``; empty for null or text without a leading hour."""
    parts = F.split(c.cast("string"), ":")
    hour = _part(F.get(parts, F.lit(0)), r"^\s*(\d+)").cast("int")
    minute = F.coalesce(F.nullif(F.get(parts, F.lit(1)), F.lit("")), F.lit("00"))
    minute = F.when(F.length(minute) < 2, F.lpad(minute, 2, "0")).otherwise(minute)
    twelve = F.when(hour % 12 == 0, 12).otherwise(hour % 12).cast("string")
    half = F.when(hour >= 12, " PM").otherwise(" AM")
    return F.coalesce(F.concat(twelve, F.lit(":"), minute, half), F.lit(""))


def date_only(c: Column) -> Column:
    """The day in the first ten characters of an ISO text."""
    return iso_day(F.substring(c.cast("string"), 1, 10))


def long_date(c: Column, lang: str = "en") -> Column:
    """``July 1, 2026`` or ``1 juillet 2026``."""
    if lang == "en":
        return F.date_format(c, "MMMM d, yyyy")
    if lang == "fr":
        month = F.get(F.array(*[F.lit(m) for m in FRENCH_MONTHS]), F.month(c) - 1)
        day = F.when(F.dayofmonth(c) == 1, F.lit("1")).otherwise(F.dayofmonth(c).cast("string"))
        return F.concat_ws(" ", day, month, F.year(c).cast("string"))
    raise ValueError(f"no month names for language: {lang}")


# --- reading messy text --------------------------------------------------------------------------------------------


def strict_mdy(c: Column) -> Column:
    return c.rlike(STRICT_MDY)


def loose_mdy(c: Column) -> Column:
    return c.rlike(LOOSE_MDY)


def iso_like(c: Column) -> Column:
    return c.rlike(ISO_PREFIX)


def normalize_mdy(c: Column) -> Column:
    """Padded, unpadded and space-padded US dates -> ``MM/DD/YYYY``; null for every other shape."""
    month, day, year = _part(c, MDY_MONTH), _part(c, MDY_DAY), _part(c, MDY_YEAR)
    return F.concat(F.lpad(month, 2, "0"), F.lit("/"), F.lpad(day, 2, "0"), F.lit("/"), year)


def iso_to_mdy(c: Column) -> Column:
    return F.date_format(F.try_to_date(c, "yyyy-MM-dd"), "MM/dd/yyyy")


def normalize_any(c: Column) -> Column:
    return F.coalesce(normalize_mdy(c), iso_to_mdy(c))


def tolerant_date(c: Column) -> Column:
    """The day behind any of the US variants; null for text that is not a date.

    The text is looked at once: it gets a mark that no day has, values of the right shape lose it on the way to an ISO
    text, and whatever keeps it cannot be read. A cast reads days without a date pattern, which throws for each failure.
    """
    return F.regexp_replace(F.concat(F.lit("="), c), MDY_PARTS, "$3-$1-$2").try_cast("date")


def iso_day(c: Column) -> Column:
    """The day of a text ``YYYY-MM-DD``, null for every other shape. A cast alone would take more of them."""
    return F.when(c.rlike(ISO_DAY), c.try_cast("date"))


def tolerant_date_any(c: Column) -> Column:
    """US variants first, then ISO, where a sign may stand before the year."""
    return F.coalesce(tolerant_date(c), iso_day(c), F.when(c.rlike("^[-+]"), F.try_to_date(c, "yyyy-MM-dd")))


def repaired_text(c: Column) -> Column:
    """The strict text of a repairable date; anything else is left as it is, also what looks like one and is none.

    An ISO date-time keeps its time, which the strict text could not hold.
    """
    return F.coalesce(F.when(loose_mdy(c), normalize_mdy(c)).when(iso_like(c), iso_to_mdy(c)), c)


def repairable(c: Column) -> Column:
    """A known variant that is not strict yet and that a repair would rewrite."""
    known = loose_mdy(c) | iso_like(c)
    return F.coalesce(known & ~strict_mdy(c) & (repaired_text(c) != c), F.lit(False))


def day_within(day: Column, start: date, end: date) -> Column:
    """True when ``day`` lies in the closed range. One comparison, so that a costly ``day`` is computed once."""
    last = (end - start).days
    # 0 <= x <= last, written as one distance from the middle
    return F.abs(F.datediff(day, F.lit(start)) * 2 - last) <= last


def parse_date_any(c: Column, formats: tuple[str, ...] = ("yyyy-MM-dd", "M/d/yyyy", "MMM d, yyyy")) -> Column:
    """The first of the given patterns that reads the trimmed text; ISO date-times count by their UTC day."""
    raw = F.trim(c)
    stamp = F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}T"), F.to_date(F.try_to_timestamp(raw)))
    return F.coalesce(stamp, *[F.try_to_date(raw, f) for f in formats])


def local_text_to_utc(c: Column, default_offset: str = "-05:00") -> Column:
    """ISO text, epoch milliseconds, or ``M/D/YYYY h:mm am ZONE`` -> UTC timestamp; null when unreadable.

    The local form is rewritten step by step until a date pattern can read it, each step taking the text once: one
    blank between parts, the zone as an offset (the default one when there is none), and hours that are not on a
    12-hour clock without their am or pm.
    """
    raw = F.trim(c)
    local = F.regexp_replace(raw, r"\s+", " ")
    for zone, offset in {**ZONE_OFFSETS, "ET": default_offset}.items():
        local = F.regexp_replace(local, f"(?i) ?{zone}$", f" {offset}")
    local = F.regexp_replace(local, r"(?<![-+]\d\d:\d\d)$", f" {default_offset}")
    local = F.regexp_replace(local, r"(?i) (0?0|1[3-9]|2[0-3]):(\d\d) ?am ", " $1:$2 ")
    local = F.regexp_replace(local, r"(?i) 0?0:(\d\d) ?pm ", " 12:$1 pm ")
    return F.coalesce(
        F.try_to_timestamp(local, F.lit("M/d/yyyy h:mm[ ]a xxx")),
        F.try_to_timestamp(local, F.lit("M/d/yyyy H:mm xxx")),
        F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}T"), F.try_to_timestamp(raw)),
        F.when(raw.rlike(r"^\d{10,15}$"), F.timestamp_millis(raw.try_cast("bigint"))),
    )


def utc_to_local_text(c: Column, tz: str = LOCAL_TZ) -> Column:
    """Wall-clock text of a UTC timestamp in ``tz``."""
    return F.date_format(F.from_utc_timestamp(c, tz), "yyyy-MM-dd'T'HH:mm:ss")


def utc_to_local_date(c: Column, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(F.from_utc_timestamp(c, tz))


def event_time(day: Column, time: Column) -> Column:
    """UTC epoch seconds of a date text and a time text; a missing time is midnight, an unreadable stamp null."""
    clock = F.coalesce(F.nullif(time, F.lit("")), F.lit("00:00:00"))
    return F.unix_timestamp(F.try_to_timestamp(F.concat(day, F.lit("T"), clock, F.lit("Z"))))


def month_cycle(d: Column) -> tuple[Column, Column]:
    """Sine and cosine of the month on a yearly circle."""
    angle = 2 * F.acos(F.lit(-1.0)) * F.month(d) / 12
    return F.sin(angle), F.cos(angle)


# --- scalar calendar bounds (arguments of a job, not data) ---------------------------------------------------------


def month_range(year: int, month: int) -> tuple[date, date]:
    return date(year, month, 1), date(year, month, calendar.monthrange(year, month)[1])


def previous_month(today: date) -> tuple[date, date]:
    last = today.replace(day=1) - timedelta(days=1)
    return month_range(last.year, last.month)


def audit_month(text: str, today: date) -> tuple[date, date]:
    """Bounds of ``YYYY-MM``; refuses malformed text and a month that is not over yet."""
    found = re.fullmatch(r"\s*(\d{4})-(\d{2})\s*", text)
    if not found:
        raise ValueError(f"month must look like YYYY-MM, got {text!r}")
    year, month = int(found[1]), int(found[2])
    if not 1 <= month <= 12:
        raise ValueError(f"no such month: {text!r}")
    start, end = month_range(year, month)
    if end >= today:
        raise ValueError(f"{text} ends {end}, which is not before {today}: an unfinished month is not audited")
    return start, end


def local_today(now_utc: datetime, tz: str = LOCAL_TZ) -> date:
    return now_utc.replace(tzinfo=ZoneInfo("UTC")).astimezone(ZoneInfo(tz)).date()


def last_finished_day(today: date) -> date:
    return today - timedelta(days=1)
