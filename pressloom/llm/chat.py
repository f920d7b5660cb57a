"""Chat formatting with a cumulative-snapshot collapse.

Logs hold a conversation again each time it has grown.  Every turn has a
rolling hash of all turns up to it; a conversation whose hash of all turns is
that of a proper prefix elsewhere is an earlier snapshot and goes.  What is left
are maximal conversations, and these are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import running, table
from pressloom.session import cut_lineage

#: Turns of a conversation that a window orders at once.
TURNS = 512
LOW = 0xFFFFFFFF
HASH = ["a1_", "a2_", "b1_", "b2_"]


def _hashes() -> dict[str, Column]:
    """Two hashes of a turn and its place, in halves, so that sums of them have room."""
    seen = [F.col("at_"), F.isnull("role_"), F.isnull("text_"), F.col("role_"), F.col("text_")]
    one, two = F.xxhash64(*seen), F.xxhash64(F.lit(7), *seen)
    return {
        "a1_": one.bitwiseAND(F.lit(LOW)), "a2_": F.shiftrightunsigned(one, 32),
        "b1_": two.bitwiseAND(F.lit(LOW)), "b2_": F.shiftrightunsigned(two, 32),
    }


def turns(log: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_ at_ role_ text_``: turns numbered from 0 in the order of ``turn``, without gaps.

    Nulls come first; turns of equal number go by role and text.  Rows of a
    null conversation are one conversation.
    """
    rows = log.select(
        F.col(conv).alias("conv_"), F.col(turn).alias("turn_"), F.col(role).alias("role_"), F.col(text).alias("text_"),
        F.coalesce(F.floor(F.col(turn) / TURNS), F.lit(-(2**62))).alias("part_"))
    order = [F.col(c).asc_nulls_first() for c in ("turn_", "role_", "text_")]
    return running(rows, ["conv_"], "part_", order, {"at_": F.lit(1)})


def collapsed(numbered: DataFrame) -> DataFrame:
    """``conv_ n_turns kept covered_by`` of each conversation.

    Of equal conversations the one with the smallest id stays (null first).
    ``covered_by`` is that one, or the smallest id among the longer
    conversations that begin with this one; null where the conversation stays.
    Both sides of the join hold each hash once, however many copies there are.
    """
    hashes = _hashes()
    order = [F.col("at_")]
    sums = running(numbered, ["conv_"], "part_", order, hashes)
    for name, own in hashes.items():
        sums = sums.withColumn(name, F.col(name) + own)
    whole = numbered.withColumns(hashes).groupBy("conv_").agg(
        F.count(F.lit(1)).alias("n_turns"), *(F.sum(h).alias(h) for h in HASH))
    first = whole.groupBy("n_turns", *HASH).agg(F.min(F.struct(F.isnotnull("conv_").alias("s"), F.col("conv_").alias("c"))).alias("first_"))
    # All prefixes, the whole ones among them; a conversation covers only shorter ones.
    ends = whole.select(F.col("conv_").alias("conv_of_"), F.col("n_turns").alias("turns_of_"))
    proper = (
        sums.join(ends, F.col("conv_").eqNullSafe(F.col("conv_of_"))).where("at_ + 1 < turns_of_")
        .groupBy((F.col("at_") + 1).alias("n_p"), *(F.col(h).alias(f"{h}p") for h in HASH))
        .agg(F.min(F.struct(F.isnotnull("conv_").alias("s"), F.col("conv_").alias("c"))).alias("longer_"))
    )
    same = F.col("n_turns") == F.col("n_p")
    for h in HASH:
        same = same & (F.col(h) == F.col(f"{h}p"))
    groups = first.join(proper, same, "left").select("n_turns", *HASH, "first_", "longer_")
    groups = groups.withColumnsRenamed({"n_turns": "n_g", **{h: f"{h}g" for h in HASH}})
    own = F.col("n_turns") == F.col("n_g")
    for h in HASH:
        own = own & (F.col(h) == F.col(f"{h}g"))
    stays = F.col("longer_").isNull() & F.col("conv_").eqNullSafe(F.col("first_.c"))
    by = F.when(F.col("longer_").isNotNull(), F.col("longer_.c")).otherwise(F.col("first_.c"))
    return whole.join(groups, own).select("conv_", "n_turns", stays.alias("kept"), F.when(~stays, by).alias("covered_by"))


def rendered(numbered: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``conv_of_ rendered`` of the conversations that stay; one is one record, and is put together in its row.

    A turn without a role has an empty one, and without a text an empty text.
    """
    piece = F.concat(F.lit("<|"), F.coalesce("role_", F.lit("")), F.lit("|>\n"), F.coalesce("text_", F.lit("")), F.lit("<|end|>\n"))
    kept = verdicts.where("kept").select(F.col("conv_").alias("conv_of_"))
    return (
        numbered.join(kept, F.col("conv_").eqNullSafe(F.col("conv_of_")))
        .groupBy("conv_of_").agg(F.array_sort(F.collect_list(F.struct("at_", piece.alias("piece")))).alias("pieces"))
        .select("conv_of_", F.array_join(F.col("pieces.piece"), "").alias("rendered"))
    )


def formatted(log: DataFrame, **columns: str) -> DataFrame:
    """``conv_id n_turns kept covered_by rendered`` of each conversation, the last null unless it stays.

    The numbered turns and the verdicts are saved here.
    """
    # Read by each branch below, so numbered and moved once.
    numbered = cut_lineage(turns(log, **columns))
    verdicts = cut_lineage(collapsed(numbered))
    texts = rendered(numbered, verdicts)
    met = verdicts.join(texts, F.col("kept") & F.col("conv_").eqNullSafe(F.col("conv_of_")), "left")
    return met.select(F.col("conv_").alias("conv_id"), "n_turns", "kept", "covered_by", "rendered")


def op7_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, snapshots of longer ones marked and the others rendered."""
    return formatted(table(spark, sf_dir, "conversations"))


OP7_SQL = r"""
WITH t AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place, role, text,
           '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS piece,
           coalesce('r' || role, 'n') || chr(0) || coalesce('t' || text, 'n') || chr(0) AS mark
    FROM conversations
), w AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(mark, '' ORDER BY place) AS whole, string_agg(piece, '' ORDER BY place) AS rendered
    FROM t GROUP BY conv_id
), pre AS (
    SELECT t.conv_id, place, string_agg(mark, '') OVER (PARTITION BY t.conv_id ORDER BY place) AS prefix FROM t
), proper AS (
    SELECT place, prefix, min(pre.conv_id) AS longer FROM pre JOIN w USING (conv_id) WHERE place < n_turns GROUP BY ALL
), firsts AS (SELECT whole, min(conv_id) AS first FROM w GROUP BY whole
), j AS (
    SELECT w.*, first, longer, longer IS NULL AND w.conv_id = first AS kept
    FROM w JOIN firsts USING (whole) LEFT JOIN proper ON whole = prefix AND n_turns = place
)
SELECT conv_id, n_turns, kept, CASE WHEN NOT kept THEN coalesce(longer, first) END AS covered_by,
       CASE WHEN kept THEN rendered END AS rendered
FROM j
"""
