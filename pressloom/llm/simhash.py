"""SimHash near duplicates with pigeonring filtering.

A fingerprint is cut into eight segments of eight bits that stand in a ring.
If two fingerprints differ in at most three bits, some chain of consecutive
segments has, for each of its lengths, no more differing bits than its share
of the three: none in the first two segments, one at most in the first five,
two in the first seven.  The key of a start takes the two segments that must
agree and, of the next three, the two that hold no difference: 32 exact bits,
24 keys a fingerprint.  Fingerprints that share a key are checked against the
budgets of the whole chain, then by their Hamming distance.

Only different fingerprints are compared, so copies cost nothing, and a bucket
gives a spanning forest of its links instead of all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.common import named, table
from pressloom.llm.components import components
from pressloom.session import cut_lineage

SHINGLE = 3
DISTANCE = 3
SEED = 42
SEGMENTS = 8
BITS = 64 // SEGMENTS
#: A bucket with more fingerprints is cut again by 40 further exact bits of its
#: 64; twelve bits are then free, so it cannot hold more than 4,096.
BUCKET = 4_096
#: Words hashed at once.
BATCH = 200_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """Bit majority over the XXH64 of all shingles, in batches of a bounded number."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    total = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for first in range(0, total, BATCH):
        last = min(total, first + BATCH)
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in range(first, last)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(width: int = SHINGLE):
    """A function of a binary column; the rest of the row stays in the JVM."""

    @F.pandas_udf("bigint")
    def run(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint(t or b"", width) for t in texts], np.uint64)
        return pd.Series(prints.view(np.int64))

    return run


def _rotated(bits: Column, start: int) -> Column:
    """The ring read from a segment on."""
    shift = start * BITS
    if not shift:
        return bits
    return F.shiftleft(bits, shift).bitwiseOR(F.shiftrightunsigned(bits, 64 - shift))


def _mask(*segments: int) -> int:
    """Ones in these segments, counted from the high end, as a signed long."""
    value = sum(0xFF << (64 - BITS * (s + 1)) for s in segments)
    return value - 2**64 if value >= 2**63 else value


def keys(prints: DataFrame) -> DataFrame:
    """``key_`` (start, freed segment and the 32 exact bits) of each fingerprint: 24 rows."""
    made = []
    for start in range(SEGMENTS):
        for free in (2, 3, 4):
            exact = [0, 1, *(s for s in (2, 3, 4) if s != free)]
            made.append(F.struct(
                F.lit(start * 8 + free).cast("int").alias("kind_"),
                _rotated(F.col("print_"), start).bitwiseAND(F.lit(_mask(*exact))).alias("key_"),
            ))
    return prints.select("node_", "print_", F.explode(F.array(*made)).alias("k_")).select("node_", "print_", "k_.*")


#: Differing bits allowed in the first one to eight segments of a chain.
BUDGETS = tuple(length * DISTANCE // SEGMENTS for length in range(1, SEGMENTS + 1))


def forest(prints: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Pairs of places that span the link graph of a bucket whose chain starts there."""
    shift = np.uint64(start * BITS)
    ring = prints if not shift else (prints << shift) | (prints >> np.uint64(64 - start * BITS))
    left, found = np.arange(len(ring)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            apart = ring[left] ^ ring[at]
            # Differing bits of whole chains, shortest first, then the Hamming distance, the longest.
            near = np.ones(len(left), bool)
            for length, budget in enumerate(BUDGETS, 1):
                near[near] = np.bitwise_count(apart[near] >> np.uint64(64 - BITS * length)) <= budget
            found += [(at, int(b)) for b in left[near]]
            queue += left[near].tolist()
            left = left[~near]
    return found


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forests of buckets; rows come sorted by kind and key, a bucket is held at a time."""

    def pairs(nodes: list[np.ndarray], prints: list[np.ndarray], start: int) -> pa.RecordBatch:
        at, values = np.concatenate(nodes), np.concatenate(prints).view(np.uint64)
        ends = forest(values, start)
        a, b = (np.array([at[p[i]] for p in ends], np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    nodes, prints, now = [], [], None
    for batch in batches:
        kind, key, node, bits = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind_", "key_", "node_", "print_"))
        if not len(key):
            continue
        cuts = np.flatnonzero((key[1:] != key[:-1]) | (kind[1:] != kind[:-1])) + 1
        for i, j in zip([0, *cuts], [*cuts, len(key)]):
            if now != (here := (kind[i], key[i])):
                if nodes and sum(map(len, nodes)) > 1:
                    yield pairs(nodes, prints, int(now[0]) // 8 % SEGMENTS)
                nodes, prints, now = [], [], here
            nodes.append(node[i:j])
            prints.append(bits[i:j])
    if nodes and sum(map(len, nodes)) > 1:
        yield pairs(nodes, prints, int(now[0]) // 8 % SEGMENTS)


def _again(crowded: DataFrame) -> DataFrame:
    """Rows of large buckets under finer keys.

    Of the 32 bits that are free, cut into eight blocks of four, three blocks
    hold all differences; each choice of three gives a key of the other bits.
    """
    made = []
    for a in range(SEGMENTS):
        for b in range(a):
            for c in range(b):
                made.append((a, b, c))
    choices = F.array(*(F.lit(i) for i in range(len(made))))
    rows = crowded.withColumn("choice_", F.explode(choices))
    cases = None
    for start in range(SEGMENTS):
        for free in (2, 3, 4):
            where = F.col("kind_") == start * 8 + free
            opened = [s for s in range(SEGMENTS) if s in (free, 5, 6, 7)]
            nibbles = [(s, half) for s in opened for half in (0, 1)]
            masks = []
            for choice in made:
                hidden = sum(0xF << (64 - BITS * nibbles[n][0] - 4 * (nibbles[n][1] + 1)) for n in choice)
                kept = (2**64 - 1) ^ hidden
                masks.append(kept - 2**64 if kept >= 2**63 else kept)
            value = _rotated(F.col("print_"), start).bitwiseAND(F.get(F.array(*(F.lit(m) for m in masks)), F.col("choice_")))
            cases = F.when(where, value) if cases is None else cases.when(where, value)
    return rows.select(
        "node_", "print_", (F.col("kind_") + 64 * (F.col("choice_") + 1)).cast("int").alias("kind_"), cases.alias("key_")
    )


def links(prints: DataFrame) -> DataFrame:
    """``a``, ``b``: nodes of fingerprints that span all links of three bits and fewer.

    ``prints`` has one row a different fingerprint: ``node_`` and ``print_``.
    Keys are counted first (that is saved), so only fingerprints that share
    one travel to a bucket.
    """
    every = keys(prints)
    counts = cut_lineage(every.groupBy("kind_", "key_").agg(F.count(F.lit(1)).alias("held_")).where("held_ > 1"))
    shared = cut_lineage(every.join(counts, ["kind_", "key_"]))
    rows = shared.where(F.col("held_") <= BUCKET).drop("held_").unionByName(
        _again(shared.where(F.col("held_") > BUCKET).drop("held_")))
    sorted_rows = rows.repartition("kind_", "key_").sortWithinPartitions("kind_", "key_")
    return sorted_rows.mapInArrow(_linked, "a bigint, b bigint")


def classed(
    docs: DataFrame, keep: list[str] | None = None, text: str = "text", key: str = "doc_id", width: int = SHINGLE
) -> DataFrame:
    """``row_`` (columns to keep), ``print_`` and ``component_``: the smallest key reachable by links.

    No text and texts without words have fingerprint zero and link like any
    other.  Keys are whole numbers.  Rows with a null key take part; a group of
    none but such has a null component.  Repeated rows are copies.  The
    fingerprints, the different ones and their links are saved here.
    """
    kept = docs.columns if keep is None else keep
    rows = cut_lineage(docs.select(
        F.col(key).cast("bigint").alias("node_"), F.struct(*named(kept)).alias("row_"),
        fingerprints(width)(F.col(text).cast("binary")).alias("print_"),
    ))
    # The fingerprint itself is the node; components by its value, then the least key of each.
    prints = cut_lineage(rows.groupBy("print_").agg(F.min("node_").alias("least_")))
    found = components(links(prints.select(F.col("print_").alias("node_"), "print_")))
    grouped = prints.join(found, prints.print_ == found.node, "left").withColumn(
        "group_", F.coalesce("component", "print_"))
    least = grouped.groupBy("group_").agg(F.min("least_").alias("component_"))
    grouped = cut_lineage(grouped.join(least, "group_").select(F.col("print_").alias("print_of_"), "group_", "component_"))
    met = rows.join(grouped, F.col("print_") == F.col("print_of_"))
    return met.select("row_", "node_", "print_", "group_", "component_")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE) -> DataFrame:
    """One row of each group: that with the smallest key; of rows that share this key one.

    Only keys and two hashes of whole rows are grouped; the rows themselves move
    once, to meet those that stay.
    """
    hashes = {"h1_": F.xxhash64(*docs.columns), "h2_": F.xxhash64(F.lit(1), *docs.columns)}
    marked = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), *(h.alias(n) for n, h in hashes.items()))
    slim = classed(marked, ["h1_", "h2_"], width=width)
    smallest = slim.where(F.col("node_").eqNullSafe(F.col("component_")))
    staying = cut_lineage(smallest.groupBy("group_").agg(F.min("row_").alias("one_")).select(
        F.col("one_.h1_").alias("h1_of_"), F.col("one_.h2_").alias("h2_of_")))
    met = docs.select(F.struct(*named(docs.columns)).alias("row_"), *(h.alias(n) for n, h in hashes.items())).join(
        staying, (F.col("h1_") == F.col("h1_of_")) & (F.col("h2_") == F.col("h2_of_")))
    # Repeated rows stay once; they already share a partition.
    repeated = Window.partitionBy("h1_", "h2_").orderBy("h1_")
    return met.withColumn("n_", F.row_number().over(repeated)).where("n_ = 1").select("row_.*")


def op8_pigeonring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    rows = classed(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "row_.doc_id", F.lower(F.lpad(F.hex("print_"), 16, "0")).alias("fingerprint"), F.col("component_").alias("component_id"))
