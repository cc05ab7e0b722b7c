"""Tolerant date parsing with a fixed output format."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rankloom.functions.text import _col, collapse_ends

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_ZONE = r"(?:Z|[+-]\d{2}(?::?\d{2})?)?"
_EXTENDED = rf"^\d{{4}}-\d{{2}}-\d{{2}}(?:[T ]\d{{2}}(?::\d{{2}}(?::\d{{2}}(?:[.,]\d+)?)?)?{_ZONE})?$"
_BASIC = rf"^\d{{8}}(?:T\d{{6}}{_ZONE})?$"


def parse_modified(text) -> Column:
    """ISO-8601 text as a timestamp, or null when it is not of a known form.

    Values without a zone are taken as UTC, which is the session time zone set
    by :func:`rankloom.session.prepare`. The shape test keeps forms out that a
    plain cast would accept, such as a bare year.
    """
    value = collapse_ends(text)
    # 20260131T101500Z -> 2026-01-31T10:15:00Z
    spread = F.regexp_replace(value, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    spread = F.regexp_replace(spread, r"T(\d{2})(\d{2})(\d{2})", "T$1:$2:$3")
    basic = F.when(value.rlike(_BASIC), spread)
    full = F.coalesce(F.when(value.rlike(_EXTENDED), value), basic)
    full = F.replace(F.replace(full, F.lit(" "), F.lit("T")), F.lit(","), F.lit("."))
    # A lone hour gets its minutes; +0100 and +01 get the long form.
    full = F.regexp_replace(full, r"T(\d{2})(?=$|Z|[+-])", "T$1:00")
    full = F.regexp_replace(full, r"(T.*[+-]\d{2}):?(\d{2})$", "$1:$2")
    full = F.regexp_replace(full, r"(T[^+-]*[+-]\d{2})$", "$1:00")
    # Microseconds are the finest unit kept.
    full = F.regexp_replace(full, r"(\.\d{6})\d+", "$1")
    return full.try_cast("timestamp")


def normalise_modified(text, as_of: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` in UTC; missing or unreadable values become ``as_of``."""
    moment = F.coalesce(parse_modified(_col(text)), as_of)
    return F.date_format(moment, ISO_SECONDS)


def age_days(modified, as_of: Column) -> Column:
    """Whole days from ``modified`` to ``as_of``."""
    return F.timestamp_diff("DAY", _col(modified), as_of)
