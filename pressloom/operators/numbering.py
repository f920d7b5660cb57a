"""Row numbers and totals for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.session import cut_lineage


def number_rows(df: DataFrame, group: str, order: str) -> DataFrame:
    """``row_no`` from 1 within ``group`` by ``order``, and ``total``.

    A window over the group alone would put a hot group into one task.  Rows
    are cut into ranges of group and order instead, whose bounds Spark draws
    from a sample, whatever the values.  The ranges are saved (a job runs
    here), rows are numbered within them, and each starts after the counts
    before it.  Only those counts, one row per range, meet in a group-wide
    window.
    """
    ranged = cut_lineage(df.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    by_group = Window.partitionBy(group)
    before = by_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"), F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.sum("_n").over(by_group).alias("total"),
    )
    within = Window.partitionBy(group, "_range").orderBy(order)
    numbered = ranged.withColumn("_no", F.row_number().over(within))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    return numbered.join(offsets, same).select(
        *df.columns, (F.col("_offset") + F.col("_no")).alias("row_no"), "total"
    )


def chunk_no(numbered: DataFrame, size: int = 1000) -> DataFrame:
    """Number of the flush each row belongs to, from 0."""
    return numbered.withColumn("chunk_no", F.floor((F.col("row_no") - 1) / size))
