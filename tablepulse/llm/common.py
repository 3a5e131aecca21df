"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: one ASCII white-space run, as the corpus contracts define it
SPACE_RUN = r"[\x20\x09-\x0D]+"
#: one word
WORD = r"[^\x20\x09-\x0D]+"
#: documents whose ``crc32(doc_id as text) mod HOLD_OUT_FOLDS`` is 0 are never learned from
HOLD_OUT_FOLDS = 5


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from the driver's folder, where they see it. On a cluster where
    they don't, the package has to be installed or passed with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def filled(column: Column | str) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def held_out(doc_id: Column) -> Column:
    """True for the documents that no classifier may learn from (a null id is one of them)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HOLD_OUT_FOLDS == 0, F.lit(True))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, for choosing numbers of partitions and buckets."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by the bytes of one variable-length column, so that a task's memory does not
    depend on how many long texts meet in a batch. Rows stay whole; a longer text is a batch of its own."""
    for batch in batches:
        start, held = 0, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for i, n in enumerate(lengths):
            if held and held + n > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        if start < batch.num_rows:
            yield batch.slice(start)


@contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int) -> Iterator[None]:
    """Meanwhile, an Arrow batch that Python is sent ends once it has so many bytes, so that a task's memory does
    not depend on the rows of its partition. A job has to run inside: the setting is read when it starts."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def class_sample(rows: DataFrame, label: str, key: Column, per_class: int) -> DataFrame:
    """At most ``per_class`` rows of each label, with their ``rank``: those of smallest hash of the key.

    A first cut by hash leaves about three times as many rows of each label, so that ranking them
    never gathers a large class. A fixed function of the rows: it does not depend on partitions.
    """
    share = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / float(1 << 30)
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    rates = counts.select(F.col(label).alias("_label"), (F.lit(3.0 * per_class + 50) / F.col("_n")).alias("_rate"))
    # a row per label: labels are few, as the models that learn them hold them all
    some = rows.join(F.broadcast(rates), F.col(label) == F.col("_label")).withColumn("_share", share).where("_share < _rate")
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy(label).orderBy("_share", key)))
    return ranked.where(F.col("rank") <= per_class).drop("_label", "_rate", "_share")
