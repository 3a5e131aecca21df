"""Query sources.

``jdbc`` pushes the whole query to the database as a ``( query ) q``
subquery; ``sql`` runs Spark SQL over registered views (the catalog
reader). :func:`read_source` dispatches on ``config['reader']``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SECRET_KEYS = ("password", "secret", "token")


def safe_config(config: Mapping[str, str]) -> dict[str, str]:
    """The config without secrets, safe to log."""
    return {k: v for k, v in config.items() if not any(s in k.lower() for s in SECRET_KEYS)}


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    query: str,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A query read through JDBC. Give ``partition_column`` + bounds to read in parallel."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", f"( {query} ) q")
    r = r.option("fetchsize", str(fetch_size))
    if user is not None:
        r = r.option("user", user)
    if password is not None:
        r = r.option("password", password)
    if driver is not None:
        r = r.option("driver", driver)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        r = (
            r.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return r.load()


def read_sql(spark: SparkSession, query: str, views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Spark SQL over temp views (``views`` are registered first)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)


def read_source(
    spark: SparkSession, config: Mapping[str, str], query: str, views: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Pick the reader by ``config['reader']`` (case-insensitive): ``jdbc``/``presto`` or ``sql``/``catalog``."""
    kind = config.get("reader", "jdbc").lower()
    if kind in ("jdbc", "presto"):
        return read_jdbc_query(
            spark,
            url=config["jdbc.url"],
            query=query,
            user=config.get("jdbc.user"),
            password=config.get("jdbc.password"),
            driver=config.get("jdbc.driver"),
        )
    if kind in ("sql", "catalog"):
        return read_sql(spark, query, views)
    raise ValueError(f"Unsupported reader: {kind}")


def source_check(df: DataFrame) -> DataFrame:
    """One row: rows returned by the source and ``ok`` (true when the read worked)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(True).alias("ok"), "rows")
