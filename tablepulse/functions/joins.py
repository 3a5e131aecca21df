"""Join helpers that broadcast only sides whose size is bounded and known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# a side is broadcast when its rows, at this many bytes each, stay below this size
MAX_BROADCAST_BYTES = 64 << 20
ROW_BYTES = 200


def bounded_broadcast(df: DataFrame, max_rows: int | None, row_bytes: int = ROW_BYTES) -> DataFrame:
    """Hint a broadcast when ``max_rows`` (a bound proven by construction) and the rows' size is small.

    ``None`` means "no proven bound": the side is left to the planner, which
    picks a broadcast only from its size statistics and AQE only from measured
    shuffle sizes at run time; otherwise a shuffled join is used.
    """
    if max_rows is not None and max_rows * row_bytes <= MAX_BROADCAST_BYTES:
        return F.broadcast(df)
    return df
