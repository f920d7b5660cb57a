"""What several corpus operators share: words, saved tables, positions within groups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.session import cut_lineage

#: A word is a run of anything but ASCII white space, as ``bytes.split()`` has it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that a window orders at once, in a small table; in a large one as many
#: as there are ranges, so that neither a range nor their list becomes long.
RANGE_ROWS = 20_000


def words(text: Column) -> Column:
    """Words of a text; no text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(columns: list[str]) -> list[Column]:
    """Columns by their names, whatever letters these have."""
    return [F.col("`{}`".format(c.replace("`", "``"))) for c in columns]


def dice(seed: int, *key: Column) -> Column:
    """Hexadecimal digits that look random and are fixed by seed and key."""
    return F.md5(F.concat_ws("/", F.lit(str(seed)), *(F.coalesce(k.cast("string"), F.lit("")) for k in key)))


def share(digits: Column) -> Column:
    """The first eight of those digits as a number from 0 up to 1."""
    return F.conv(F.substring(digits, 1, 8), 16, 10).cast("bigint") / F.lit(float(2**32))


def ranges(n_rows: int) -> int:
    """How many ranges so many rows are cut into."""
    return max(1, -(-n_rows // max(RANGE_ROWS, math.isqrt(n_rows))))


def running(rows: DataFrame, group: list[str], part: str, order: list[Column], amounts: dict[str, Column]) -> DataFrame:
    """Adds, by name, the sum of an amount over all rows before this one in its group, as a long.

    ``part`` is the number of the range a row is in; ranges follow the order.
    A window sees one range of one group, and the ranges are shifted by the
    sums before them, so no task needs to hold a group.  The sums are saved
    first (a job runs here), so Catalyst knows their size and moves the rows
    for this join only if they are too many to broadcast.
    """
    spread = rows.withColumns({f"{name}_own": amount.cast("bigint") for name, amount in amounts.items()})
    sums = spread.groupBy(*group, part).agg(*(F.sum(f"{name}_own").alias(f"{name}_sum") for name in amounts))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shift = sums.select(
        *(F.col(g).alias(f"{g}_of") for g in group), F.col(part).alias("part_of"),
        *(F.coalesce(F.sum(f"{name}_sum").over(before), F.lit(0)).alias(f"{name}_shift") for name in amounts),
    )
    shift = cut_lineage(shift)
    same = F.col(part) == F.col("part_of")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{g}_of"))
    within = Window.partitionBy(*group, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = {f"{name}_in": F.coalesce(F.sum(f"{name}_own").over(within), F.lit(0)) for name in amounts}
    met = spread.withColumns(inner).join(shift, same)
    return met.withColumns({name: F.col(f"{name}_shift") + F.col(f"{name}_in") for name in amounts}).drop(
        "part_of", *(f"{g}_of" for g in group), *(f"{name}_{end}" for name in amounts for end in ("own", "in", "shift")))
