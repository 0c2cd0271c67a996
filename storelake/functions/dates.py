"""Calendar and time expressions (F1-F7, F13, F19, F25, A6 week key)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelake.config import WIRE_TS_FORMAT


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def calendar_columns(ts) -> dict[str, Column]:
    """Purchase date parts added to the fact table.

    ``purchase_weekday`` is 1 = Sunday ... 7 = Saturday; weekend is 1/7.
    """
    t = _c(ts)
    return {
        "order_purchase_date": F.to_date(t),
        "purchase_year": F.year(t),
        "purchase_month": F.month(t),
        "purchase_day": F.dayofmonth(t),
        "purchase_weekday": F.dayofweek(t),
        "purchase_hour": F.hour(t),
        "is_weekend_order": F.when(F.dayofweek(t).isin(1, 7), 1).otherwise(0),
    }


def days_between(end, start) -> Column:
    """Whole days from ``start`` to ``end`` (``datediff``; positive when end is later)."""
    return F.datediff(_c(end), _c(start))


def week_ending_sunday(d) -> Column:
    """The Sunday closing the week of ``d`` (a Sunday maps to itself)."""
    return F.next_day(F.date_sub(_c(d), 1), "Sun")


def parse_wire_ts(s) -> Column:
    """Parse a wire time ``dd-MM-yyyy HH:mm``; unparsable or empty gives null."""
    return F.try_to_timestamp(_c(s), F.lit(WIRE_TS_FORMAT)).cast("timestamp_ntz")


def seconds_between(later, earlier) -> Column:
    """Signed whole seconds ``later - earlier`` for timestamp_ntz columns
    (wall-clock difference, independent of the session time zone)."""
    return F.timestamp_diff("SECOND", _c(earlier), _c(later))
