"""Benchmark decontamination with spaced seeds.

A seed hashes six of the tokens under a fixed mask and ignores the others.
Three masks are enough for every way to change any three of fifteen tokens:
one of them fits somewhere between the changes.  Equal seeds of a document and
a benchmark item are a hit; around it fifteen aligned tokens must agree in
twelve, and the document is contaminated.

Shorter items must occur whole, one token in five being changed at most: their
masks are the parts of the item, of which one more is made than tokens may
change.  An item of a few tokens is found where it is all of a text.

Tokens are lower-case letters, digits and whatever is not ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from pressloom.llm import rolling
from pressloom.llm.common import named, table
from pressloom.session import cut_lineage

# Found by search, proven by a test that tries every change.
MASKS = ("1101111", "11100010011", "10001101011")
WINDOW = 15
MATCHES = 12
#: Of a shorter item one token in so many may be changed.
CHANGED = 5
#: Items of fewer tokens than this are too common within texts to tell
#: anything; they are found as whole texts, unchanged.
LEAST_PART = 8
#: Masks of short items are numbered from here, four for each length.
SHORT_MASKS = 100
#: Up to so many different seeds of the benchmark (32 MB), every task gets them
#: and keeps only those of the documents that are among them.  Beyond it all
#: seeds of the documents are joined.
MOST_SEEDS = 4_000_000
#: The same seeds by their leading bits, so that few are looked up.
LEADING_BITS = 24

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of a batch, and for each text its first token and the one after its last."""
    buffer, starts, ends = rolling.joined(texts)
    first, last = rolling.bounds(_INSIDE[buffer])
    hashes = rolling.Runs(rolling.byte_units(buffer)).hash(first, last)
    return hashes, np.searchsorted(first, starts), np.searchsorted(first, ends)


def _seeds(tokens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each mask its hash at every token where it fits."""
    for number, mask in enumerate(MASKS):
        n = len(tokens) - len(mask) + 1
        if n > 0:
            total = np.zeros(n, np.uint64)
            for at, bit in enumerate(mask):
                if bit == "1":
                    total = total * np.uint64(0x9E3779B97F4A7C15) + tokens[at : at + n]
            yield number, rolling.mixed(total)


def _about(tokens: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, missing: int) -> list[bytes]:
    """The tokens from a window before a place to one after it, with a mark beyond the text."""
    places = at[:, None] + np.arange(-WINDOW, 2 * WINDOW)
    around = tokens[np.clip(places, 0, len(tokens) - 1)]
    around[(places < low[:, None]) | (places >= high[:, None])] = missing
    return [row.tobytes() for row in around]


#: Places around a hit: a window before it, the hit's own window and one after.
AROUND = 3 * WINDOW

HIT = pa.schema([("k_", pa.string()), ("mask_", pa.int32()), ("seed_", pa.int64()), ("around_", pa.binary())])
HIT_DDL = "k_ string, mask_ int, seed_ bigint, around_ binary"


def parts_of(length: int) -> list[tuple[int, int]]:
    """The parts of a short item: however its tokens change, one part stays."""
    n = length // CHANGED + 1 if length >= LEAST_PART else 1
    return [(length * i // n, length * (i + 1) // n) for i in range(n)]


def _short_seeds(tokens: np.ndarray, lengths: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, int]]:
    """For each part of items of those lengths its hash wherever such an item fits, with the item's length."""
    runs = rolling.Runs(tokens, 1)
    for length in lengths:
        n = len(tokens) - length + 1
        if n > 0:
            for number, (start, end) in enumerate(parts_of(length)):
                yield SHORT_MASKS + 4 * length + number, runs.hash(slice(start, start + n), slice(end, end + n)), length


def _find(rows: Iterator[pa.RecordBatch], known, lengths: tuple[int, ...], items: bool) -> Iterator[pa.RecordBatch]:
    """Seeds of each row (``k_``, ``text_``), those among the known if these are given."""
    wanted = known.value if known is not None else None
    shift = np.uint64(64 - LEADING_BITS)
    if wanted is not None:
        leading = np.zeros(1 << LEADING_BITS, bool)
        leading[wanted >> shift] = True

    def passed(seeds: np.ndarray) -> np.ndarray:
        if wanted is None:
            return np.arange(len(seeds))
        at = np.flatnonzero(leading[seeds >> shift])
        places = np.minimum(np.searchsorted(wanted, seeds[at]), len(wanted) - 1)
        return at[wanted[places] == seeds[at]]

    if wanted is not None and not len(wanted):
        return
    for batch in rows:
        keys = batch.column(0)
        texts = [(t or "").lower().encode() for t in batch.column(1).to_pylist()]
        for base, part in rolling.batches(texts):
            tokens, low, high = _token_hashes(part)
            owner = np.repeat(np.arange(len(part)), high - low)
            found = [(number, seeds, len(MASKS[number])) for number, seeds in _seeds(tokens)]
            found += _short_seeds(tokens, lengths)
            for number, seeds, span in found:
                at = passed(seeds)
                own = owner[at]
                inside = at + span <= high[own]
                size = (high - low)[own]
                if number >= SHORT_MASKS and (items or span < LEAST_PART):
                    inside &= size == span
                elif items:
                    inside &= size >= WINDOW
                at, own = at[inside], own[inside]
                around = _about(tokens, low[own], high[own], at, 1 if items else 2)
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(base + own)), pa.array(np.full(len(at), number, np.int32)),
                    pa.array(seeds[at].view(np.int64)), pa.array(around, pa.binary()),
                ], schema=HIT)


@F.pandas_udf(BooleanType())
def overlaps(ours: pd.Series, theirs: pd.Series, masks: pd.Series) -> pd.Series:
    """Whether some window around a hit agrees in enough tokens, or the whole of a short item."""
    if not len(ours):
        return pd.Series([], dtype=bool)
    a, b = (np.frombuffer(b"".join(s), np.uint64).reshape(-1, AROUND) for s in (ours, theirs))
    sums = np.cumsum(np.pad(a == b, ((0, 0), (1, 0))), axis=1)
    masks = masks.to_numpy()
    lengths = np.where(masks >= SHORT_MASKS, (masks - SHORT_MASKS) // 4, 0)
    changed = np.where(lengths >= LEAST_PART, lengths // CHANGED, 0)
    agree = sums[np.arange(len(sums)), WINDOW + lengths] - sums[:, WINDOW]
    window = (sums[:, WINDOW:] - sums[:, :-WINDOW]).max(1) >= MATCHES
    return pd.Series(np.where(lengths > 0, agree >= lengths - changed, window))


def _short_lengths(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in rows:
        texts = [(t or "").lower().encode() for t in part["text_"]]
        if texts:
            _, low, high = _token_hashes(texts)
            n = high - low
            yield pd.DataFrame({"length_": n[(n > 0) & (n < WINDOW)]})


def matches(
    docs: DataFrame, benchmark: DataFrame, key: str = "k_", text: str = "text_", item: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``k_`` and ``item_``: each document's key with each item it contains, once.

    ``key`` is a string, ``item`` a whole number.  Null texts, empty ones and
    those without a token match nothing and are no items.  Repeated rows give
    one pair.  The items' seeds are saved here and counted.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).cast("string").alias("k_"), F.col(item_text).alias("text_"))
    lengths = items.mapInPandas(_short_lengths, "length_ bigint").distinct().orderBy("length_").collect()
    lengths = tuple(int(r.length_) for r in lengths)  # at most fourteen numbers
    # What many items share, such as an instruction, is compared once.
    place = F.md5(F.concat_ws("/", "mask_", "seed_", F.hex("around_")))
    seeds = cut_lineage(
        items.mapInArrow(lambda rows: _find(rows, None, lengths, True), HIT_DDL).distinct().withColumn("place_", place)
    )
    different = seeds.select("seed_").distinct()
    known = None
    if different.count() <= MOST_SEEDS:
        values = different.toPandas()["seed_"].to_numpy(np.int64).view(np.uint64)
        known = spark.sparkContext.broadcast(np.sort(values))
    hits = docs.select(F.col(key).alias("k_"), F.col(text).alias("text_")).mapInArrow(
        lambda rows: _find(rows, known, lengths, False), HIT_DDL)
    theirs = seeds.select(
        "place_", F.col("mask_").alias("mask_of_"), F.col("seed_").alias("seed_of_"), F.col("around_").alias("theirs_")).distinct()
    met = hits.join(theirs, (F.col("seed_") == F.col("seed_of_")) & (F.col("mask_") == F.col("mask_of_")))
    sure = met.where(overlaps("around_", "theirs_", "mask_")).select("k_", "place_").distinct()
    placed = seeds.select(F.col("place_").alias("at_"), F.col("k_").cast("bigint").alias("item_"))
    return sure.join(placed, F.col("place_") == F.col("at_")).select("k_", "item_").distinct()


def found_items(docs: DataFrame, benchmark: DataFrame, keep: list[str] | None = None, text: str = "text", **options) -> DataFrame:
    """``row_`` (columns to keep) and ``items_``: sorted ids of the items in it, null if none."""
    kept = docs.columns if keep is None else keep
    quoted = named(kept)
    keyed = docs.select(F.md5(F.coalesce(F.col(text), F.lit(""))).alias("k_"), F.col(text).alias("text_"), F.struct(*quoted).alias("row_"))
    pairs = matches(keyed, benchmark, **options)
    items = cut_lineage(pairs.groupBy("k_").agg(F.array_sort(F.collect_set("item_")).alias("items_")))
    return keyed.join(items.withColumnRenamed("k_", "of_"), F.col("k_") == F.col("of_"), "left").select("row_", "items_")


def decontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated."""
    return found_items(docs, benchmark, text=text, **options).where("items_ IS NULL").select("row_.*")


def op2_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that each document contains."""
    rows = found_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return rows.select(
        "row_.doc_id", F.col("items_").isNotNull().alias("contaminated"),
        F.coalesce(F.size("items_"), F.lit(0)).alias("n_items"),
        F.coalesce("items_", F.array().cast("array<bigint>")).alias("item_ids"),
    )
