"""Alert detail texts and key/value helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole(x) -> Column:
    """A number rounded half-up to a whole and printed without decimals."""
    return F.round(_c(x), 0).cast("bigint").cast("string")


def tenths_of_hours(seconds) -> Column:
    """Non-negative seconds printed as hours with one decimal, half-up.

    Integer arithmetic, so the text does not depend on float formatting.
    """
    tenths = F.floor((F.abs(_c(seconds)) + 180) / 360).cast("bigint")
    return F.concat((tenths / 10).cast("bigint").cast("string"), F.lit("."),
                    (tenths % 10).cast("string"))


def geo_detail(prev_state, state, seconds) -> Column:
    return F.concat(F.lit("State jump "), _c(prev_state), F.lit("->"), _c(state),
                    F.lit(" in "), tenths_of_hours(seconds), F.lit("h"))


def first_order_detail(total, limit) -> Column:
    return F.concat(F.lit("First order "), whole(total), F.lit(f" exceeds {limit:g}"))


def velocity_detail(count) -> Column:
    return F.concat(_c(count).cast("string"), F.lit(" orders in 1 hour"))


def freight_detail(freight) -> Column:
    return F.concat(F.lit("Freight "), whole(freight), F.lit(" unusually high"))


def amount_detail(total, limit) -> Column:
    return F.concat(F.lit("Value "), whole(total), F.lit(f" exceeds {limit:g}"))


def off_hours_detail(hour, total) -> Column:
    return F.concat(F.lit("Order at "), _c(hour).cast("string"), F.lit("h value "), whole(total))


def key_suffix(key) -> Column:
    """Text after the first ``:`` of a key (``revenue:2024-01-02`` -> the date)."""
    return F.get(F.split(_c(key), ":", 2), 1)


def key_prefix(key) -> Column:
    return F.get(F.split(_c(key), ":", 2), 0)
