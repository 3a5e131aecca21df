"""Key duplicates.

Exact by default: rows are counted per key (partial counts are combined
map-side, so a hot key costs one shuffled row per task), then one global
aggregate gives total rows, distinct keys and the duplicate rate.
``method="approx"`` uses HyperLogLog (``approx_count_distinct``) and a
tolerance, with the rate clamped at 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.functions.exprs import composite_key, key_text
from tablepulse.operators.results import pass_severity, rule_rows


def key_counts(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """One row per distinct key (nulls are values, not wildcards) with its row count ``n``."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, key_cols: Sequence[str], table_name: str | None = None) -> DataFrame:
    """Every key that occurs more than once, with ``key_text`` and ``occurrences``."""
    out = key_counts(df, key_cols).where(F.col("n") > 1)
    cols = [F.lit(table_name).alias("table_name")] if table_name is not None else []
    return out.select(*cols, *key_cols, key_text(key_cols).alias("key_text"), F.col("n").alias("occurrences"))


def pk_duplicates(
    df: DataFrame,
    key_cols: Sequence[str],
    table_name: str,
    partition: str | None = None,
    method: str = "exact",
    rsd: float = 0.05,
    tolerance: float = 0.0,
    examples: int = 5,
    ts: datetime | str | None = None,
) -> DataFrame:
    """One ``pk_duplicates`` rule row: dupRate = 1 - distinct/total, passing when dupRate <= tolerance."""
    if method not in ("exact", "approx"):
        raise ValueError("method must be 'exact' or 'approx'")
    spark = df.sparkSession
    if not key_cols:
        base = spark.range(1)
        return rule_rows(
            base, F.lit(table_name), F.lit(partition), F.lit("pk_duplicates"), F.lit(True), F.lit(0.0), F.lit(0),
            F.lit("medium"), F.lit("no_pk_cols"), F.lit("unique"), ts=ts,
        )
    if method == "exact":
        per_key = key_counts(df, key_cols)
        summary = per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count(F.lit(1)).alias("distinct_keys")
        )
        # the k most repeated keys (ties by key text): k rows that join the summary row by a union. They go through an
        # exchange of their own: else the count of all keys is planned into the stage of the union, where one task
        # may get a whole table
        top = (
            per_key.where(F.col("n") > 1)
            .select(F.struct((-F.col("n")).alias("neg_n"), key_text(key_cols).alias("k")).alias("ex"))
            .orderBy("ex")
            .limit(examples)
            .repartition(1)
        )
        summary = summary.unionByName(top, allowMissingColumns=True).agg(
            F.max("total").alias("total"),
            F.max("distinct_keys").alias("distinct_keys"),
            F.transform(F.array_sort(F.collect_list("ex")), lambda e: e["k"]).alias("examples"),
        )
    else:
        summary = df.agg(
            F.count(F.lit(1)).alias("total"), F.approx_count_distinct(composite_key(key_cols), rsd).alias("distinct_keys")
        ).withColumn("examples", F.array().cast("array<string>"))
    summary = summary.withColumn("table_name", F.lit(table_name))
    total = F.col("total").cast("double")
    rate = F.when(F.col("total") == 0, 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - F.col("distinct_keys") / total))
    x = summary.withColumn("dup_rate", rate).withColumn(
        "ok", (F.col("total") == 0) | (F.col("dup_rate") <= F.lit(tolerance))
    )
    observed = F.when(F.col("total") == 0, F.lit(None)).otherwise(
        F.format_string("dupRate=%.5f acd=%d total=%d", F.col("dup_rate"), F.col("distinct_keys"), F.col("total"))
    )
    return rule_rows(
        x,
        F.col("table_name"),
        F.lit(partition),
        F.lit("pk_duplicates"),
        F.col("ok"),
        F.when(F.col("ok"), 0.0).otherwise(F.col("dup_rate")),
        F.col("total"),
        pass_severity(F.col("ok")),
        observed,
        F.when(F.col("total") == 0, F.lit(None)).otherwise(F.lit("dupRate==0" if tolerance == 0 else f"dupRate<={tolerance}")),
        F.when(F.col("ok"), F.array().cast("array<string>")).otherwise(F.coalesce("examples", F.array().cast("array<string>"))),
        ts=ts,
    )
