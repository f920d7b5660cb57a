"""A Bloom filter as a table: rows that cannot meet a join leave before they move.

A key has one bucket and some bits in it.  Buckets are bitmaps of a fixed size
and there are at most so many, so all of them can go to every task whatever
the number of keys; a row whose bits are not all set has no such key.  With
more keys than the buckets are made for more rows pass in vain, and the exact
join behind the filter still decides.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.session import cut_lineage

#: Bits of a bucket, as the bitmap functions have them.
BUCKET_BITS = 32_768
#: Bits for each key, and how many of them it sets: about one row in 250 passes in vain.
KEY_BITS, PROBES = 12, 4
#: 128 MB of buckets, enough for ninety million keys.
MOST_BUCKETS = 32_768


def _bucket(key: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), key), F.lit(n_buckets))


def _bit(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(probe), key), F.lit(BUCKET_BITS))


def may_meet(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose value of the column may be among the keys'; all that are, and few others.

    Null meets nothing.  The buckets are saved here.
    """
    n_buckets = min(MOST_BUCKETS, max(1, -(-keys.count() * KEY_BITS // BUCKET_BITS)))
    key = F.col(column)
    bits = keys.select(
        _bucket(key, n_buckets).alias("_bucket"), F.explode(F.array(*(_bit(key, p + 1) for p in range(PROBES)))).alias("_bit"))
    buckets = cut_lineage(bits.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits")))

    def is_set(probe: int) -> Column:
        at = _bit(key, probe + 1)
        byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, (at % 8).cast("int")) == 1

    met = rows.where(key.isNotNull()).withColumn("_bucket", _bucket(key, n_buckets)).join(F.broadcast(buckets), "_bucket")
    return met.where(functools.reduce(lambda a, b: a & b, map(is_set, range(PROBES)))).drop("_bucket", "_bits")
