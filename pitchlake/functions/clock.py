"""Match dates and session times (local clock -> UTC) as Column expressions.

An instant is made from date, wall-clock time and the ground's zone in one step,
so the session's own zone plays no part. Sessions that run past midnight keep
the match date (no roll-over), and an unknown ground defaults to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pitchlake import constants as K


def match_date(match_days: Column) -> Column:
    """Leading "d Month yyyy" of the free-text match days; NULL when absent or invalid."""
    return F.try_to_date(F.trim(F.regexp_extract(match_days, K.MATCH_DATE_PATTERN, 1)), K.MATCH_DATE_FORMAT)


def session_utc(hours_text: Column, date: Column, zone: Column, pattern: str) -> Column:
    """Instant of the "H.mm" wall-clock time captured by ``pattern`` on ``date`` in ``zone``."""
    hhmm = F.trim(F.regexp_extract(hours_text, pattern, 1))
    hour = F.regexp_extract(hhmm, K.SESSION_TIME_PATTERN, 1).try_cast("int")
    minute = F.regexp_extract(hhmm, K.SESSION_TIME_PATTERN, 2).try_cast("int")
    return F.try_make_timestamp(F.year(date), F.month(date), F.day(date), hour, minute, F.lit(0).cast("decimal(16,6)"), zone)


def session_columns(hours_text: Column, date: Column, zone: Column) -> dict[str, Column]:
    """The five UTC session columns keyed by output name."""
    return {name: session_utc(hours_text, date, zone, pattern) for name, pattern in K.SESSION_PATTERNS}
