"""C10 over combinations: the smallest set of dimensions that explains high null rates.

A segment fixes the values of some dimensions (``lang=en``, or ``lang=en, source=web``).
Level by level, from the whole table to all dimensions, a segment is looked at only
if each of its parents (one value less) is neither failing nor hopeless: a failing
parent explains it, and a parent without nulls or with too few rows has no
failing child. What fails is then a smallest failing segment: no part of it fails.

The rows are counted once per combination of all dimensions; the levels work on
these counts. Each combination carries which of its parts are still alive, so a
level counts no segment that is ruled out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepulse import schemas as S
from tablepulse.session import checkpointed

#: 2**MAX_DIMS parts of a combination are worked out in one expression
MAX_DIMS = 12


@dataclass
class FailingSegments:
    segments: DataFrame  # level, segment, rows, null_rows, null_rate
    levels: DataFrame  # level, candidates, failing, alive


def _bits(mask: int, n: int) -> list[int]:
    return [i for i in range(n) if mask >> i & 1]


def smallest_failing_segments(
    df: DataFrame, column: str, dims: Sequence[str], threshold: float = S.NULL_RATE_THRESHOLD, min_rows: int = 1, max_level: int | None = None
) -> FailingSegments:
    """Segments of at least ``min_rows`` rows whose null rate of ``column`` is above ``threshold`` and that have no failing part.

    ``segment`` is text, ``dim=value`` joined by ", " in the order of ``dims`` (``<null>`` for a null; empty for the
    whole table, level 0). Dims not in the frame are skipped. ``max_level`` stops after so many dimensions.
    """
    present = [d for d in dims if d in df.columns]
    n = len(present)
    if n > MAX_DIMS:
        raise ValueError(f"at most {MAX_DIMS} dimensions")
    names = [f"_d{i}" for i in range(n)]
    # a value is marked, so that a null and the text of one differ
    marked = [F.coalesce(F.concat(F.lit("="), F.col(d).cast("string")), F.lit("~")).alias(c) for d, c in zip(present, names, strict=True)]
    counted = df.select(*marked, F.col(column).isNull().alias("_null")).groupBy(*names).agg(F.count(F.lit(1)).alias("rows"), F.count_if("_null").alias("null_rows"))
    base = checkpointed(counted.withColumn("_alive", F.array(F.lit(0)) if n else F.array().cast("array<int>")))

    def judged(segments: DataFrame) -> DataFrame:
        rate = F.col("null_rows") / F.col("rows")
        fails = (rate > F.lit(threshold)) & (F.col("rows") >= F.lit(min_rows))
        return segments.withColumn("null_rate", rate).withColumn("fails", fails).withColumn(
            "alive", ~fails & (F.col("rows") >= F.lit(min_rows)) & (F.col("null_rows") > 0)
        )

    def text_of(mask: int) -> Column:
        parts = [F.when(F.col(names[i]) == "~", F.lit(f"{present[i]}={S.NULL_SEGMENT}")).otherwise(F.concat(F.lit(present[i]), F.col(names[i]))) for i in _bits(mask, n)]
        return F.concat_ws(", ", *parts)

    root = checkpointed(judged(base.agg(F.sum("rows").alias("rows"), F.sum("null_rows").alias("null_rows")).where("rows > 0")))
    found = [root.where("fails").select(F.lit(0).alias("level"), F.lit("").alias("segment"), "rows", "null_rows", "null_rate")]
    counts = [_level_counts(root, 0)]
    top = root.select("alive").first()
    level = 1
    while top is not None and top["alive"] and level <= min(n, n if max_level is None else max_level):
        masks = [m for m in range(1, 1 << n) if len(_bits(m, n)) == level]

        def if_alive(mask: int) -> Column:
            parents = [F.array_contains("_alive", mask & ~(1 << i)) for i in _bits(mask, n)]
            every = parents[0]
            for p in parents[1:]:
                every = every & p
            return F.when(every, F.lit(mask))

        spread = base.select(*names, "rows", "null_rows", F.explode(F.array_compact(F.array(*map(if_alive, masks)))).alias("_mask"))
        # the values of the dimensions that a segment leaves open are blank
        key = [F.when(F.col("_mask").bitwiseAND(1 << i) != 0, F.col(c)).otherwise(F.lit("")).alias(f"_k{i}") for i, c in enumerate(names)]
        keys = ["_mask", *[f"_k{i}" for i in range(n)]]
        segments = spread.select("_mask", *key, "rows", "null_rows").groupBy(*keys).agg(F.sum("rows").alias("rows"), F.sum("null_rows").alias("null_rows"))
        segments = checkpointed(judged(segments))
        counts.append(_level_counts(segments, level))
        failing = segments.where("fails").select("_mask", *[F.col(f"_k{i}").alias(c) for i, c in enumerate(names)], "rows", "null_rows", "null_rate")
        text = F.lit(None).cast("string")
        for m in masks:
            text = F.when(F.col("_mask") == m, text_of(m)).otherwise(text)
        found.append(failing.select(F.lit(level).alias("level"), text.alias("segment"), "rows", "null_rows", "null_rate"))
        alive = segments.where("alive").select(*keys)
        if not alive.take(1):
            break
        still = spread.select(*names, "_mask", *key).join(alive, keys, "left_semi").groupBy(*names).agg(F.collect_set("_mask").alias("_alive"))
        # combinations without an alive part can hold no candidate of the next level
        base = checkpointed(base.drop("_alive").join(still, names))
        level += 1
    out, levels = found[0], counts[0]
    for f, c in zip(found[1:], counts[1:], strict=True):
        out, levels = out.unionByName(f), levels.unionByName(c)
    return FailingSegments(out, levels)


def _level_counts(segments: DataFrame, level: int) -> DataFrame:
    return segments.agg(F.count(F.lit(1)).alias("candidates"), F.count_if("fails").alias("failing"), F.count_if("alive").alias("alive")).select(F.lit(level).alias("level"), "*")
