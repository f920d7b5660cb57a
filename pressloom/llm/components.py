"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.session import cut_lineage

#: Rounds after which links that still change are taken for a fault.
MOST_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``links`` (``a``, ``b``).

    Each round links all larger neighbours of a node to the smallest one, then
    all smaller ones; long chains halve, so rounds grow with the logarithm of
    the longest.  Groups are only ever reduced to their minimum, never
    collected.  Every round is saved.
    """
    state = cut_lineage(
        links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low").distinct()
    )
    for _ in range(MOST_ROUNDS):
        both = state.select(F.col("high").alias("n"), F.col("low").alias("m")).union(state.select("low", "high"))
        least = both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"))
        large = both.join(least, "n").where("m > n").select(F.col("m").alias("high"), F.col("least").alias("low")).distinct()
        lower = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(lower, "high").select(
            F.explode(F.array(F.col("low"), F.col("high"))).alias("high"), F.col("least").alias("low")
        ).where("high > low").distinct()
        after = cut_lineage(small)
        if after.exceptAll(state).isEmpty() and state.exceptAll(after).isEmpty():
            break
        state = after
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        state.select("low", "low").distinct()
    )
