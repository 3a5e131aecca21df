"""Which files of a table are new, changed or gone since the last run, and which partitions they hold.

The listing of a folder (:func:`list_files`) reads no file. The manifest keeps, for every file
of the last run, its size, its time and the partition values in it, so a file
that is gone still names the partitions that it took rows from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepulse.functions.partitioning import Partitioning

MANIFEST = "table_name string, path string, length long, modified_at timestamp, partitions array<string>"
#: more changed files than this are found by a join on the file's name rather than read by their names
MOST_NAMED_FILES = 10_000


def list_files(spark: SparkSession, table_name: str, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """``table_name, path, length, modified_at`` of a folder's data files, without opening them."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return found.select(F.lit(table_name).alias("table_name"), "path", "length", F.col("modificationTime").alias("modified_at"))


def file_path() -> Column:
    """The file of a row, written as in a listing (the hidden column has it percent-encoded)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def changed_files(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """``table_name, path, status (new | changed | removed | same), length, modified_at, partitions`` (those of the manifest)."""
    old = manifest.select("table_name", "path", F.col("length").alias("_length"), F.col("modified_at").alias("_at"), "partitions")
    both = listing.join(old, ["table_name", "path"], "full")
    same = (F.col("length") == F.col("_length")) & (F.col("modified_at") == F.col("_at"))
    status = F.when(F.col("_length").isNull(), "new").when(F.col("length").isNull(), "removed").when(same, "same").otherwise("changed")
    return both.select("table_name", "path", status.alias("status"), "length", "modified_at", "partitions")


def partitions_of_files(df: DataFrame, base: str | None, partitioning: Partitioning, files: DataFrame, n_files: int) -> DataFrame:
    """``path, partitions`` (an array; null for rows without a value) of some files of a table; only the partition column is read.

    ``df`` reads the whole table; ``files`` (path) are the ones to look into; ``base`` is the root of folders that are
    named after partition columns.
    """
    spark = df.sparkSession
    if n_files <= MOST_NAMED_FILES:
        # a list of names that the driver's own file listing holds anyway
        names = [r["path"] for r in files.select("path").collect()]
        if not names:
            return spark.createDataFrame([], "path string, partitions array<string>")
        reader = spark.read.schema(df.schema)
        rows = (reader.option("basePath", base) if base else reader).parquet(*names)
    else:
        rows = df
    values = rows.select(file_path().alias("path"), partitioning.key().alias("_key")).distinct()
    if n_files > MOST_NAMED_FILES:
        values = values.join(files.select("path"), "path", "left_semi")
    text = partitioning.text_of(F.col("_key"))
    # a null is kept as an element: collect_set would leave it out
    found = F.flatten(F.collect_set(F.array(text)))
    return values.groupBy("path").agg(found.alias("partitions"))
