"""Substring removal by super-k-mers of words whose windows are sorted in their bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import table
from pressloom.llm.superkmers import Windows, without_repeats

#: Windows of 35 words with minimisers of eight.
WORDS = Windows("word", 35, 8)


def sorted_windows(strings: list[bytes], times: list[int], size: int) -> list[np.ndarray]:
    """For each packed string, which of its windows are more than once among all, each as often as its string.

    Words get numbers; ranks of runs of one word, two, four and so on come from
    sorting pairs of ranks, until they are ranks of whole windows, to be counted.
    """
    numbers: dict[bytes, int] = {}
    split = [s.split() for s in strings]
    rank = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64)
    length = 1
    while length < size:
        step = min(length, size - length)
        pairs = rank[: len(rank) - step] * (rank.max() + 1) + rank[step:]
        rank = np.unique(pairs, return_inverse=True)[1]
        length += step
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    firsts = np.cumsum(lengths) - lengths
    inside = [slice(f, f + n - size + 1) for f, n in zip(firsts.tolist(), lengths.tolist())]
    found = np.bincount(
        np.concatenate([rank[i] for i in inside]), np.repeat(times, lengths - size + 1), minlength=len(rank))
    return [found[rank[i]] > 1 for i in inside]


def op10_super_kmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words kept of every document when windows that occur elsewhere are taken out."""
    rows = without_repeats(table(spark, sf_dir, "documents"), WORDS, sorted_windows, keep=["doc_id"])
    return rows.select(
        "row_.doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: Every window spelled out and counted.
OP10_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), w AS (
    SELECT doc_id, unnest(range(1, len(ws) - 33)) AS i, ws FROM d WHERE len(ws) >= 35
), k AS MATERIALIZED (SELECT doc_id, i, md5_number(array_to_string(ws[i:i + 34], ' ')) AS h FROM w
), again AS (SELECT h FROM k GROUP BY h HAVING count(*) > 1
), gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM k JOIN again USING (h)
), s AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d
), left_ AS (
    SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY p) AS kept
    FROM s ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN left_ USING (doc_id)
"""
