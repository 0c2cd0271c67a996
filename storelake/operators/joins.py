"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame:
    """Broadcast ``df`` only after checking it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (a bounded job). Past the
    bound the frame is returned unhinted and the planner / AQE pick the join
    from measured sizes. Meant for reference tables with a fixed domain
    (nations, regions), where a shuffled join would hash every fact row onto
    a handful of keys.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def grows(df: DataFrame) -> DataFrame:
    """``df`` as the side of a sort-merge join. The planner goes by file sizes: a few MB of a well compressed table are millions
    of rows, and a broadcast collects them in the driver. Meant for tables that grow with the orders."""
    return df.hint("merge")
