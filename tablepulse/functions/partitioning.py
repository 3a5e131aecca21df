"""How a table is cut into partitions.

A partition value is always a string. For tables physically partitioned by a
column the value is that column; for plain tables it can be derived from a
timestamp (day or month grain). Filters on partition values are rewritten to
range predicates on the raw column so that they reach the Parquet scan as
``PushedFilters`` (and partition pruning for partitioned layouts).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_GRAINS = {"value": None, "day": "yyyy-MM-dd", "month": "yyyy-MM"}


@dataclass(frozen=True)
class Partitioning:
    """``column`` plus a grain: ``value`` (as is), ``day`` or ``month`` of a timestamp/date."""

    column: str
    grain: str = "value"

    def __post_init__(self) -> None:
        if self.grain not in _GRAINS:
            raise ValueError(f"unknown grain {self.grain!r}; use one of {sorted(_GRAINS)}")

    def value(self) -> Column:
        """The partition value as a string column."""
        c = F.col(self.column)
        fmt = _GRAINS[self.grain]
        return c.cast("string") if fmt is None else F.date_format(c, fmt)

    def key(self) -> Column:
        """What to group rows by: the partition as a date, or the value as it is. Cheaper for each row than its text."""
        c = F.col(self.column)
        if self.grain == "value":
            return c
        return F.to_date(c) if self.grain == "day" else F.trunc(F.to_date(c), "month")

    def text_of(self, key: Column) -> Column:
        """The partition value of a grouping key."""
        fmt = _GRAINS[self.grain]
        return key.cast("string") if fmt is None else F.date_format(key, fmt)

    def where_in(self, df: DataFrame, values: Sequence[str | None]) -> Column:
        """Predicate selecting rows whose partition value is in ``values`` (``None``: rows without a value).

        Day and month grains become ``col >= start AND col < end`` ranges typed
        like the column, so Catalyst pushes them into the scan. Adjacent
        partitions are one range; separate ranges are a balanced tree of ORs,
        so that thousands of them still plan.
        """
        values = list(values)
        if not values:
            return F.lit(False)
        if None in values:
            rest = [v for v in values if v is not None]
            empty = F.col(self.column).isNull()
            return empty | self.where_in(df, rest) if rest else empty
        if self.grain == "value":
            return F.col(self.column).isin(values)
        dtype = df.schema[self.column].dataType
        c = F.col(self.column)
        terms = [
            (c >= F.lit(start.isoformat()).cast(dtype)) & (c < F.lit(end.isoformat()).cast(dtype))
            for start, end in _merged(_bounds(v, self.grain) for v in values)
        ]
        return _any(terms)


def _bounds(v: str, grain: str) -> tuple[date, date]:
    if grain == "day":
        d = date.fromisoformat(v)
        return d, d + timedelta(days=1)
    y, m = (int(x) for x in v.split("-")[:2])
    return date(y, m, 1), (date(y + 1, 1, 1) if m == 12 else date(y, m + 1, 1))


def _merged(bounds: Iterable[tuple[date, date]]) -> list[tuple[date, date]]:
    out: list[tuple[date, date]] = []
    for start, end in sorted(set(bounds)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _any(terms: list[Column]) -> Column:
    if len(terms) == 1:
        return terms[0]
    half = len(terms) // 2
    return _any(terms[:half]) | _any(terms[half:])


def as_partitioning(p: Partitioning | str | None) -> Partitioning | None:
    if p is None or isinstance(p, Partitioning):
        return p
    return Partitioning(p)
