"""Numeric expressions: guarded ratios and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is summed as DECIMAL(18,2): exact, so the total does not depend on the
# order rows arrive in (partitioning, retries, engine). The sum widens to
# DECIMAL(28,2) and is returned as DOUBLE.
MONEY = "decimal(18,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num, den, digits: int = 4) -> Column:
    """``round(num / den, digits)``; a zero or null denominator gives null."""
    return F.round(F.try_divide(_c(num), _c(den)), digits)


def money(c) -> Column:
    """A currency amount of two decimals, exact. Finer amounts are rounded half-up
    to cents one by one: sum 0.125 and 0.124 and you get 0.13 + 0.12."""
    return _c(c).cast(MONEY)


def zero_if_null(c) -> Column:
    return F.coalesce(_c(c), F.lit(0.0))
