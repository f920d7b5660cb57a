"""Sharding by proportional stratified interleaving.

Within each source rows are ranked in a seeded random order.  The fractional
rank ``(rank + offset) / rows of the source``, ranks from 0, spreads every
source evenly over 0 to 1; the offset within a step is seeded by the source, so
sources of equal sizes do not meet at the same fractions.  All rows sorted by
it are cut into shards of equal row counts, so each shard has each source in
the proportion of the whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import dice, named, ranges, running, share, table
from pressloom.session import cut_lineage

SHARDS = 16
SEED = 20


def interleave(
    docs: DataFrame, n_shards: int = SHARDS, key: str = "doc_id", stratum: str = "source", seed: int = SEED
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot`` (from 0, without gaps, in each shard).

    Shards differ by one row at most.  A null source is a source of its own.
    A null key is the same as an empty one; rows with equal keys follow each
    other by their other columns, repeated rows take neighbouring ranks of
    their source.  Columns of ``docs`` named ``shard`` or ``slot`` are replaced;
    others keep their names.  No rows give no rows.

    Ranks are found in ranges of the random order, which are of even size
    whatever the source, and likewise positions in ranges of the fraction.
    """
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    digits = dice(seed, F.col(key))
    packed = docs.select(
        F.col(stratum).alias("stratum_"), digits.alias("digits_"),
        F.xxhash64(*named(kept)).alias("tie_"), F.struct(*named(kept)).alias("row_"),
    )
    n_rows = docs.count()
    n_parts = ranges(n_rows)
    ranked = running(
        packed.withColumn("part_", F.floor(share(F.col("digits_")) * n_parts)),
        ["stratum_"], "part_", [F.col("digits_"), F.col("tie_")], {"rank_": F.lit(1)},
    )
    sizes = cut_lineage(packed.groupBy("stratum_").agg(F.count(F.lit(1)).alias("rows_")))
    fraction = (F.col("rank_") + share(dice(seed, F.col("stratum_")))) / F.col("rows_")
    placed = (
        ranked
        .join(sizes.withColumnRenamed("stratum_", "sized_"), F.col("stratum_").eqNullSafe(F.col("sized_")))
        .withColumn("fraction_", fraction)
        .withColumn("range_", F.floor(F.col("fraction_") * n_parts))
        .drop("sized_", "rows_", "rank_", "part_")
    )
    order: list[Column] = [
        F.col("fraction_"), F.col("stratum_").asc_nulls_last(), F.col("digits_"), F.col("tie_"),
    ]
    at = running(placed, [], "range_", order, {"at_": F.lit(1)})
    shard = F.expr(f"(at_ * {n_shards}L) DIV {max(1, n_rows)}L")
    first = F.expr(f"((at_ * {n_shards}L) DIV {max(1, n_rows)}L * {n_rows}L + {n_shards - 1}L) DIV {n_shards}L")
    return at.select("row_.*", shard.cast("int").alias("shard"), (F.col("at_") - first).alias("slot"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in the order of their slots within each file."""
    (
        sharded.repartition("shard", F.floor(F.col("slot") / 100_000))
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard").parquet(path)
    )


def op1_stratified_interleaving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards; a null text has no bytes and the sum of none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return interleave(slim).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


#: The checksum is worked out byte by byte from its table.
OP1_SQL = r"""
WITH byte AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::UBIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[]),
            lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
), d AS (
    SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS x, md5('20/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digits
    FROM documents
), r AS (
    SELECT *, (row_number() OVER (PARTITION BY source ORDER BY digits) - 1
               + ('0x' || substr(md5('20/' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296::DOUBLE)
              / count(*) OVER (PARTITION BY source) AS fraction, count(*) OVER () AS n
    FROM d
), a AS (
    SELECT *, row_number() OVER (ORDER BY fraction, source NULLS LAST, digits) - 1 AS place FROM r
)
SELECT doc_id, length(x) // 2 + 1 AS size,
       xor(list_reduce(list_prepend(4294967295::UBIGINT,
               list_transform(range(1, length(x) // 2 + 1), lambda i: ('0x' || substr(x, 2 * i - 1, 2))::UBIGINT)),
           lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT)::BIGINT AS text_crc32,
       'rows' AS law, CAST(place * 16 // n AS INT) AS shard,
       CAST(place - ((place * 16 // n) * n + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INT) AS grown_shard, source
FROM a, byte
"""
