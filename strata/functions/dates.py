"""Date helpers: month names, robust text dates, month starts."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names in calendar order (month number = position + 1).
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

# Substrings that mark a shipment date cell as "no date".
NON_DATE_MARKERS = ["Process", "Captured", "Insufficient"]

SHIPMENT_DATE_FORMAT = "d-MMM-yy"


def _month_map() -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*((m, i + 1) for i, m in enumerate(MONTH_NAMES)))])


def month_number(c: Column | str) -> Column:
    """Month name -> 1..12; an unknown name gives NULL (map lookup)."""
    c = F.col(c) if isinstance(c, str) else c
    return _month_map()[c]


def month_number_or_january(c: Column | str) -> Column:
    """Month name -> 1..12; an unknown name falls back to 1."""
    return F.coalesce(month_number(c), F.lit(1))


def month_name(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(ts, "MMMM")


def month_start(year: Column | str, month: Column | str) -> Column:
    """First day of (year, month) as a DATE."""
    year = F.col(year) if isinstance(year, str) else year
    month = F.col(month) if isinstance(month, str) else month
    return F.make_date(year.cast("int"), month.cast("int"), F.lit(1))


def is_non_date(c: Column | str) -> Column:
    """True when a text cell holds a sentinel, is NULL or blank."""
    c = F.col(c) if isinstance(c, str) else c
    cond = c.isNull() | (F.trim(c) == "")
    for marker in NON_DATE_MARKERS:
        cond = cond | c.contains(marker)
    return cond


def parse_date_robust(c: Column | str, fmt: str = SHIPMENT_DATE_FORMAT) -> Column:
    """Sentinel / NULL / blank -> NULL, otherwise parse with ``fmt``; unparsable -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(is_non_date(c), F.lit(None).cast("date")).otherwise(
        F.try_to_date(c, fmt)
    )


def parse_iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ; bad text -> NULL (no session time zone involved)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("timestamp_ntz")
