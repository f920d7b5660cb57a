"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

The documents of a source follow each other in a seeded random order and form a
stream of words; epochs repeat it.  A source's target says how many words of
the stream the mix takes.  The stream is cut into blocks, a document belonging
to the block its first word lies in.  A binary tree over the output shards
splits the block counts of all sources: each node draws how many blocks of
each source go left, given the number that goes left in all.  A leaf's counts
are exact quotas; its blocks are a run of the source's permuted blocks, so no
two shards share one, and its rows are shuffled locally.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.common import WORD, dice, named, ranges, running, share, table, words
from pressloom.session import cut_lineage

#: Weights of the sources in the order of their code points, repeating; null comes last.
WEIGHTS = (5, 2, 1)
#: No source is repeated more often than that.
MOST_EPOCHS = 3
BLOCK_WORDS = 4_096
#: Rounds of the permutation, and the prime its bits come from; squares of less fit a long.
ROUNDS = 32
PRIME = 2**31 - 1
SHARDS = 16
SEED = 9


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Adds ``target`` to one row a source with ``source_`` and ``source_size``.

    The sum of all sizes is shared by weight.  A source whose share is above
    ``most`` times its size gets that, and what is left is shared by the
    others.  Sources are met in the order of limit over weight: the first
    whose limit is not below its share of what is left fixes the share of all
    after it.  One row a source goes through a window.
    """
    ordered = Window.orderBy(F.col("source_").asc_nulls_last())
    cyclic = F.array(*(F.lit(w) for w in weights))
    weighed = sizes.withColumn("weight_", cyclic[F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))])
    weighed = weighed.withColumn("limit_", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("limit_") / F.col("weight_"), F.col("source_").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit_").over(before), F.lit(0))
    weight_left = F.sum("weight_").over(every) - F.coalesce(F.sum("weight_").over(before), F.lit(0))
    level = weighed.withColumn("level_", left / weight_left)
    free = F.when(F.col("level_") * F.col("weight_") <= F.col("limit_"), F.col("level_"))
    level = level.withColumn("free_", F.max(free).over(every))
    # The level falls no further once it is below a limit, so the first such one is the largest.
    return level.withColumn(
        "target",
        F.least(F.col("limit_").cast("double"), F.coalesce(F.col("free_") * F.col("weight_"), F.col("limit_").cast("double"))),
    ).select("source_", "source_size", "target")


def _share(*key: int) -> float:
    """A number from 0 up to 1, fixed by its key."""
    return int(hashlib.md5("/".join(map(str, key)).encode()).hexdigest()[:13], 16) / 2**52


def drawn_of(have: int, rest: int, n: int, at: float) -> int:
    """How many of ``have`` blocks are among ``n`` drawn from them and ``rest`` others: the quantile at ``at``.

    The chances are walked from the most likely number both ways.  What lies
    more than forty deviations off has none that a double can hold.
    """
    low, high = max(0, n - rest), min(have, n)
    mode = max(low, min(high, (n + 1) * (have + 1) // (have + rest + 2)))
    reach = 64 + 40 * math.isqrt(min(n, have, rest, have + rest - n))
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(mode, high, dtype=np.float64)
    up = np.cumprod(np.append(1.0, (have - k) / (k + 1) * ((n - k) / (rest - n + k + 1))))
    k = np.arange(mode, low, -1, dtype=np.float64)
    down = np.cumprod(k / (have - k + 1) * ((rest - n + k) / (n - k + 1)))
    total = np.cumsum(np.append(down[::-1], up))
    return min(high, low + int(np.count_nonzero(total <= at * total[-1])))


def _left_draws(counts: np.ndarray, n_left: int, *node: int) -> np.ndarray:
    """How many of each source's blocks are among ``n_left`` drawn without putting back."""
    drawn = np.zeros_like(counts)
    rest = int(counts.sum())
    for i, have in enumerate(counts.tolist()):
        rest -= have
        if n_left and have:
            drawn[i] = drawn_of(have, rest, n_left, _share(*node, i))
            n_left -= int(drawn[i])
    return drawn


def leaf_quotas(counts: np.ndarray, leaf: int, n_leaves: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of each source that a leaf gets, and how many go to leaves before it.

    Walks from the root; a node's draw is fixed by seed and node, so every
    leaf sees the same tree without the others.
    """
    first, size, before = 0, n_leaves, np.zeros_like(counts)
    while size > 1:
        half = size // 2
        left = _left_draws(counts, int(counts.sum()) * half // size, seed, first, size)
        if leaf < first + half:
            counts, size = left, half
        else:
            before, counts = before + left, counts - left
            first, size = first + half, size - half
    return counts, before


def _split(n_leaves: int, seed: int):
    def split(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place_")
        leaf = int(group["shard"].iloc[0])
        quota, before = leaf_quotas(group["blocks_"].to_numpy(np.int64), leaf, n_leaves, seed)
        return pd.DataFrame({
            "place_": group["place_"], "shard": group["shard"], "from_": before, "to_": before + quota,
        })

    return split


def quotas(sources: DataFrame, n_shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``place_ shard from_ to_``: the run of permuted blocks of each source that a shard draws.

    ``sources`` has ``place_`` and ``blocks_``.  A task handles one shard and
    holds one number a source.
    """
    leaves = sources.select(
        "place_", "blocks_", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard")
    )
    return leaves.groupBy("shard").applyInPandas(
        _split(n_shards, seed), "place_ bigint, shard int, from_ bigint, to_ bigint"
    )


def permuted(block: Column, n_blocks: Column, seed: int) -> Column:
    """A permutation of 0 to n - 1, for any n, by rounds of swap-or-not.

    A round pairs each number with the one as far from the other end of a
    turned ring, and swaps a pair by a bit that both agree on.
    """
    keys = [[int(hashlib.md5(f"{seed}/{which}/{r}".encode()).hexdigest()[:13], 16) for which in "ab"] for r in range(ROUNDS)]
    rounds = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in keys))

    def swapped(x: Column, key: Column) -> Column:
        other = F.pmod(key["a"] - x, n_blocks)
        mark = F.pmod(F.greatest(x, other) + key["b"], F.lit(PRIME))
        return F.when(F.pmod(F.pmod(mark * mark, F.lit(PRIME)) * mark, F.lit(PRIME)) * 2 < PRIME, other).otherwise(x)

    return F.aggregate(rounds, block.cast("bigint"), swapped)


def drawn(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS, n_shards: int = SHARDS, block_words: int = BLOCK_WORDS, seed: int = SEED,
) -> DataFrame:
    """One row a document, with what the mix draws of it.

    Columns: ``row_`` (struct of the columns to keep), ``size`` (words),
    ``source_size``, ``target``, and ``draws``: for each epoch the document is
    drawn in, the words taken (all, but for the one document where its source
    reaches the target), the shard, the place of its block in the permuted
    order, and a number to shuffle the shard by.

    A null text has no words.  Documents without words are never drawn.  A
    null source is one source, the last.  Rows with the same key follow each
    other by their text; repeated rows count as often as they stand there.
    Tables without rows give none.  Two small tables are saved here: one row a
    source, and one row a source and shard.
    """
    kept = docs.columns if keep is None else keep
    n_rows = docs.count()
    rows = docs.select(
        F.col(source).alias("source_"), dice(seed, F.col(key)).alias("digits_"), F.xxhash64(text).alias("tie_"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size_"),
        F.struct(*named(kept)).alias("row_") if kept else F.lit(None).alias("row_"),
    ).withColumn("part_", F.floor(share(F.col("digits_")) * ranges(n_rows)))

    sizes = cut_lineage(rows.groupBy("source_").agg(F.sum("size_").alias("source_size")))
    numbered = Window.orderBy(F.col("source_").asc_nulls_last())
    sources = (
        targets(sizes, weights)
        .withColumn("words_", F.round("target").cast("bigint"))
        .withColumn("blocks_", F.ceil(F.col("words_") / block_words))
        .withColumn("place_", F.row_number().over(numbered).cast("bigint"))
    )
    sources = cut_lineage(sources)
    ends = cut_lineage(
        quotas(sources.select("place_", "blocks_"), n_shards, seed)
        .groupBy("place_").agg(F.array_sort(F.collect_list("to_")).alias("ends_"))
    )
    known = cut_lineage(sources.join(ends, "place_").drop("place_").withColumnRenamed("source_", "of_"))

    placed = running(rows, ["source_"], "part_", [F.col("digits_"), F.col("tie_")], {"start_": F.col("size_")})
    placed = placed.join(known, F.col("source_").eqNullSafe(F.col("of_")))
    # The document is met in each epoch that begins before the target is reached.
    last = F.floor((F.col("words_") - F.col("start_") - 1) / F.col("source_size")).cast("int")
    steps = [2**i for i in reversed(range(n_shards.bit_length()))]

    def draw(epoch: Column) -> Column:
        at = epoch * F.col("source_size") + F.col("start_")
        slot = permuted(F.floor(at / block_words), F.col("blocks_"), seed)
        # The shard is the number of runs that end before the slot, found by halving.
        shard = F.aggregate(
            F.array(*(F.lit(s) for s in steps)), F.lit(0),
            lambda low, step: F.when(
                (low + step <= n_shards) & (F.get("ends_", low + step - 1) <= slot), low + step
            ).otherwise(low),
        )
        return F.struct(
            epoch.alias("epoch"), F.least(F.col("size_"), F.col("words_") - at).alias("taken"),
            shard.alias("shard"), slot.alias("block"), F.xxhash64(F.lit(seed), "digits_", "start_", epoch).alias("order"),
        )

    draws = F.when(
        (F.col("size_") > 0) & (F.col("start_") < F.col("words_")), F.transform(F.sequence(F.lit(0), last), draw)
    )
    return placed.select("row_", F.col("size_").alias("size"), "source_size", "target", draws.alias("draws"))


def mix(docs: DataFrame, text: str = "text", length: str = "n_chars", **options) -> DataFrame:
    """``docs`` as the mix has them: a row for each draw, with ``mix_shard`` and ``mix_order``.

    Where only some words are taken the text ends after them, and a column of
    its length follows.  Columns of ``docs`` named like the two are replaced.
    """
    kept = [c for c in docs.columns if c not in ("mix_shard", "mix_order")]
    rows = drawn(docs, text=text, keep=kept, **options).select("row_", "size", F.explode("draws").alias("draw_"))
    own = F.col("row_").getField(text)
    gaps, runs = F.split(own, WORD), words(own)
    cut = F.array_join(
        F.transform(F.slice(F.arrays_zip(gaps.alias("g"), runs.alias("r")), F.lit(1), F.col("draw_.taken").cast("int")),
                    lambda p: F.concat(p["g"], p["r"])), "",
    )
    partly = F.col("draw_.taken") < F.col("size")
    rows = rows.withColumn("text_", F.when(partly, cut).otherwise(own))

    def column(name: str) -> Column:
        given = F.col("row_").getField(name)
        if name == length:
            given = F.when(partly, F.char_length("text_").cast("bigint")).otherwise(given)
        return (F.col("text_") if name == text else given).alias(name)

    return rows.select(
        *map(column, kept), F.col("draw_.shard").alias("mix_shard"), F.col("draw_.order").alias("mix_order"))


def write_mix(rows: DataFrame, path: str) -> None:
    """A folder per shard, its rows shuffled."""
    (
        rows.repartition("mix_shard", F.pmod("mix_order", F.lit(16)))
        .sortWithinPartitions("mix_shard", "mix_order")
        .write.partitionBy("mix_shard").parquet(path)
    )


def op9_splitting_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that the mix takes, and where: ``draws`` is ``epoch:shard:words``, joined by commas."""
    rows = drawn(table(spark, sf_dir, "documents"), keep=["doc_id"])
    taken = F.aggregate("draws", F.lit(0).cast("bigint"), lambda total, draw: total + draw["taken"])
    told = F.transform("draws", lambda d: F.concat_ws(":", d["epoch"], d["shard"], d["taken"]))
    return rows.select(
        "row_.doc_id", "size", "source_size", "target", F.coalesce(taken, F.lit(0)).cast("bigint").alias("taken"),
        F.coalesce(F.array_join(told, ","), F.lit("")).alias("draws"),
    )


#: ``tree`` draws for one source of each node in a step; ``p`` places the documents as the mix does.
OP9_SQL = """
WITH RECURSIVE d AS (
    SELECT doc_id, source, text,
           len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
           md5('9/' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digits
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
    FROM d GROUP BY source
), r AS (
    SELECT *, 3 * source_size AS cap,
           row_number() OVER (ORDER BY 3 * source_size / weight, source NULLS LAST) AS k FROM s
), l AS (
    SELECT *, ((SELECT sum(source_size) FROM s)
               - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / ((SELECT sum(weight) FROM s)
               - coalesce(sum(weight) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
    FROM r
), t0 AS (
    SELECT source, source_size, place,
           least(cap::DOUBLE, (SELECT max(level) FROM l WHERE level * weight <= cap) * weight) AS target FROM l
), t AS (
    SELECT *, CAST(round(target) AS BIGINT) AS words, CAST(ceil(round(target) / 4096) AS BIGINT) AS blocks FROM t0
), tree AS (
    SELECT 0 AS first, 16 AS size, counts, 1 AS i, list_sum(counts)::BIGINT * 8 // 16 AS n,
           list_sum(counts)::BIGINT AS rest, []::BIGINT[] AS drawn
    FROM (SELECT list(blocks ORDER BY place) AS counts FROM t)
    UNION ALL
    SELECT CASE WHEN done AND side = 1 THEN first + size // 2 ELSE first END,
           new_size,
           new_counts,
           CASE WHEN done THEN 1 ELSE i + 1 END,
           CASE WHEN done THEN list_sum(new_counts)::BIGINT * (new_size // 2) // new_size ELSE n - drew END,
           CASE WHEN done THEN list_sum(new_counts)::BIGINT ELSE others END,
           CASE WHEN done THEN []::BIGINT[] ELSE list_append(drawn, drew) END
    FROM (
        SELECT *, CASE WHEN NOT done THEN size WHEN side = 0 THEN size // 2 ELSE size - size // 2 END AS new_size,
               CASE WHEN NOT done THEN counts WHEN side = 0 THEN drawn
                    ELSE list_transform(range(1, len(counts) + 1), lambda j: counts[j] - drawn[j]) END AS new_counts,
               CASE WHEN n > 0 AND have > 0
                    THEN least(high, low + len(list_filter(total, lambda x: x <= chance * total[len(total)]))) ELSE 0 END AS drew
        FROM (
            SELECT *, list_reduce(list_transform(weights, lambda w: [w]), lambda a, x: list_append(a, a[len(a)] + x[1])) AS total
            FROM (
                SELECT *, list_concat(list_reverse(list_reduce(list_concat([[1.0::DOUBLE]], list_transform(range(mode, low, -1),
                              lambda k: [k::DOUBLE / (have - k + 1) * ((others - n + k)::DOUBLE / (n - k + 1))])),
                              lambda a, x: list_append(a, a[len(a)] * x[1]))),
                          list_reduce(list_concat([[1.0::DOUBLE]], list_transform(range(mode, high),
                              lambda k: [(have - k)::DOUBLE / (k + 1) * ((n - k)::DOUBLE / (others - n + k + 1))])),
                              lambda a, x: list_append(a, a[len(a)] * x[1]))[2:]) AS weights
                FROM (
                    SELECT *, greatest(low, least(high, (n + 1) * (have + 1) // (have + others + 2))) AS mode
                    FROM (
                        SELECT *, greatest(0, n - others) AS low, least(have, n) AS high,
                               ('0x' || substr(md5('9/' || first || '/' || size || '/' || (i - 1)), 1, 13))::BIGINT / 4503599627370496 AS chance
                        FROM (
                            SELECT *, i > len(counts) AS done, coalesce(counts[i], 0) AS have, rest - coalesce(counts[i], 0) AS others
                            FROM tree WHERE size > 1
                        )
                    )
                )
            )
        ), (VALUES (0), (1)) AS v(side)
        WHERE done OR side = 0
    )
), leaf AS (
    SELECT first AS shard, unnest(counts) AS have, unnest(range(1, len(counts) + 1)) AS place FROM tree WHERE size = 1
), ends AS (
    SELECT place, list(reached) AS ends
    FROM (SELECT place, sum(have) OVER (PARTITION BY place ORDER BY shard) AS reached FROM leaf) GROUP BY place
), keys AS (
    SELECT list(('0x' || substr(md5('9/a/' || r), 1, 13))::BIGINT ORDER BY r) AS a,
           list(('0x' || substr(md5('9/b/' || r), 1, 13))::BIGINT ORDER BY r) AS b
    FROM range(32) AS x(r)
), p AS (
    SELECT d.*, source_size, target, words, blocks, place,
           (sum(size) OVER (PARTITION BY d.source ORDER BY digits, doc_id) - size)::BIGINT AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), met AS (
    SELECT doc_id, epoch, least(size, words - epoch * source_size - start) AS taken, blocks, place,
           (epoch * source_size + start) // 4096 AS block
    FROM (SELECT *, unnest(range(0, (words - start - 1) // source_size + 1)) AS epoch FROM p WHERE size > 0 AND start < words)
), slots AS (
    SELECT met.*, list_reduce(list_prepend(block, range(1, 33)), lambda x, r:
        CASE WHEN (((greatest(x, (a[r] - x) % blocks) + b[r]) % 2147483647) * ((greatest(x, (a[r] - x) % blocks) + b[r]) % 2147483647)
                   % 2147483647) * ((greatest(x, (a[r] - x) % blocks) + b[r]) % 2147483647) % 2147483647 * 2 < 2147483647
             THEN (a[r] - x) % blocks ELSE x END) AS slot
    FROM met, keys
), told AS (
    SELECT doc_id, sum(taken)::BIGINT AS taken,
           string_agg(epoch || ':' || len(list_filter(ends, lambda e: e <= slot)) || ':' || taken, ',' ORDER BY epoch) AS draws
    FROM slots JOIN ends USING (place) GROUP BY doc_id
)
SELECT doc_id, size::BIGINT AS size, source_size, target, coalesce(taken, 0) AS taken, coalesce(draws, '') AS draws
FROM p LEFT JOIN told USING (doc_id)
"""
