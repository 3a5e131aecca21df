"""Scans restricted to partitions, written so filters reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tablepulse.functions.partitioning import Partitioning, as_partitioning


def scan_partitions(df: DataFrame, partitioning: Partitioning | str | None, partitions: Sequence[str] = ()) -> DataFrame:
    """Rows whose partition value is in ``partitions``; the whole table without a key or list."""
    p = as_partitioning(partitioning)
    if p is None or not partitions:
        return df
    return df.where(p.where_in(df, partitions))


def scan_partition(df: DataFrame, partitioning: Partitioning | str | None, value: str) -> DataFrame:
    """One partition (``key = value``); the whole table when there is no key. Errors surface."""
    return scan_partitions(df, partitioning, [value])
