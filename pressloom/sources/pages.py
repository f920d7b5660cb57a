"""Captured pages, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_SCHEMA = "page_id BIGINT, url STRING, html STRING"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Captured pages.

    A page is parsed in the task that reads it and never moves before.  How
    many tasks read is up to ``spark.sql.files.maxPartitionBytes`` and to the
    row groups the pages were written in.
    """
    return spark.read.parquet(path)


def stream_pages(spark: SparkSession, folder: str, schema: str = PAGE_SCHEMA, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).parquet(folder)


def _host(url: Column) -> Column:
    """The host of an address, null where it cannot be read."""
    return F.try_parse_url(url, F.lit("HOST"))


def with_site(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pages of known sites, recognised by the host of their address; ``unplaced`` has the others."""
    hosts = profiles.select("site", _host(F.col("base_url")).alias("_host"))
    return pages.withColumn("_host", _host(F.col("url"))).join(hosts, "_host").drop("_host")


def unplaced(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pages of no known site, with the reason: ``no address``, ``malformed`` or ``unknown host``."""
    hosts = profiles.select(_host(F.col("base_url")).alias("_known")).distinct()
    lost = pages.withColumn("_host", _host(F.col("url"))).join(hosts, F.col("_host") == F.col("_known"), "left_anti")
    reason = (
        F.when(F.col("url").isNull(), "no address").when(F.col("_host").isNull(), "malformed").otherwise("unknown host")
    )
    return lost.withColumn("reason", reason).drop("_host")
