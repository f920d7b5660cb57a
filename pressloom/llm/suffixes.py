"""Substring removal by a run-length index.

Strings that share a minimiser are indexed together: their suffixes are sorted,
the Burrows-Wheeler transform is held as runs, and of each run the text
places of both ends are sampled, with the length their suffix shares with the
neighbour beyond the run.  Within a run a suffix shares with its neighbour one
byte less than the suffix before it in the text.  So the matching statistics, the
longest match elsewhere at each byte, stream through the text from the samples
alone.

A string that stands in many places is in the index that many times.  Suffixes
of its copies follow each other in the order and have the same byte before
them, so copies lengthen runs, and are sorted and sampled once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import table
from pressloom.llm.superkmers import Windows, without_repeats

#: Windows of 200 bytes with minimisers of 32.
BYTES = Windows("byte", 200, 32)

#: Bits of a number that is sorted.
BITS = 63


def sorted_suffixes(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Places in the order of their suffixes, and for each length compared the ranks by it.

    Symbol 0 ends a string.  Ends differ from each other, in the order they stand.
    """
    n = len(symbols)
    at = np.arange(n)
    place, present = n.bit_length(), np.bincount(symbols) > 0
    # Numbers carry the place in their last bits, so sorting them orders places too.
    bits = max(1, int(present.sum()).bit_length())
    length = max(1, (BITS - place) // bits)
    padded = np.concatenate([(np.cumsum(present) - 1 + (not present[0]))[symbols], np.zeros(length, np.int64)])
    key, alive = np.zeros(n, np.int64), np.ones(n, bool)
    for i in range(length):
        here = padded[i : i + n] * alive
        key = key << bits | here
        alive &= here > 0
    packed = np.sort(key << place | at)
    order, sorted_key = packed & (1 << place) - 1, packed >> place
    new = np.ones(n, bool)
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | ~alive[order[1:]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    ranks = []
    while True:
        ranks.append((length, rank.copy()))
        tied = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(tied):
            return order, ranks
        places = order[tied]
        key = rank[places] * np.int64(n) + rank[places + length]
        if 3 * place <= BITS:
            packed = np.sort(key << place | at[: len(tied)])
            by, key = packed & (1 << place) - 1, packed >> place
        else:
            by = np.argsort(key)
            key = key[by]
        places = places[by]
        order[tied] = places
        fresh = np.append(True, key[1:] != key[:-1])
        new[tied] = fresh
        rank[places] = tied[np.maximum.accumulate(np.where(fresh, at[: len(tied)], 0))]
        length *= 2


def shared(symbols: np.ndarray, ranks: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols two suffixes share, for each pair of places."""
    a, b, total = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    # Pairs that differ by a length differ by all longer ones, so few are looked at for the longest.
    reach = []
    pairs = np.arange(len(a))
    for length, rank in ranks:
        pairs = pairs[rank[a[pairs]] == rank[b[pairs]]]
        reach.append(pairs)
    for (length, rank), pairs in zip(reversed(ranks), reversed(reach)):
        pairs = pairs[rank[a[pairs]] == rank[b[pairs]]]
        total[pairs] += length
        a[pairs] += length
        b[pairs] += length
    same = np.ones(len(a), bool)
    for i in range(ranks[0][0] - 1):
        step = np.minimum(np.maximum(a, b) + i, len(symbols) - 1) - np.maximum(a, b)
        here, there = symbols[a + step], symbols[b + step]
        same &= (here == there) & (here > 0) & (step == i)
        total += same
    return total


@dataclass
class RunIndex:
    """Runs of the transform, and samples at their ends."""

    symbol: np.ndarray  # of each run
    length: np.ndarray  # in rows of the transform, copies included
    first: np.ndarray  # text place of the suffix at the start of the run
    last: np.ndarray  # and at its end
    before: np.ndarray  # symbols that the first shares with the suffix sorted before it
    after: np.ndarray  # and the last with the one after it
    places: int  # of the text, where each string stands once

    def matching_statistics(self) -> np.ndarray:
        """For each place of the text the longest match that starts elsewhere."""
        n = self.places
        best = np.zeros(n, np.int64)
        for places, lengths in ((self.first, self.before), (self.last, self.after)):
            sampled = np.zeros(n, np.int64)
            sampled[places] = places
            end = np.zeros(n, np.int64)
            end[places] = places + lengths
            best = np.maximum(best, end[np.maximum.accumulate(sampled)] - np.arange(n))
        return best


def run_index(strings: list[bytes], times: list[int]) -> RunIndex:
    """The index of all strings, one after another, each with an end of its own and in so many copies."""
    symbols = np.frombuffer(b"\x00".join(strings) + b"\x00", np.uint8).astype(np.int16) + 1
    lengths = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(lengths) - 1
    symbols[ends] = 0
    order, ranks = sorted_suffixes(symbols)
    n = len(order)
    before = symbols[order - 1]  # the place before the first is the last, an end
    start = np.ones(n, bool)
    start[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    heads = np.flatnonzero(start)
    tails = np.append(heads[1:], n) - 1
    up = np.zeros(len(heads), np.int64)
    up[1:] = shared(symbols, ranks, order[heads[1:]], order[heads[1:] - 1])
    down = np.append(up[1:], 0)
    # Copies share a sample.  All but one have a copy as the neighbour on that side, up to their end.
    copies = np.repeat(times, lengths)
    whole = np.where(copies > 1, np.repeat(ends, lengths) - np.arange(n), 0)
    return RunIndex(
        before[heads], np.add.reduceat(copies[order], heads), order[heads], order[tails],
        np.maximum(up, whole[order[heads]]), np.maximum(down, whole[order[tails]]), n)


def long_matches(strings: list[bytes], times: list[int], size: int) -> list[np.ndarray]:
    """For each string, which of its windows of ``size`` bytes start elsewhere too, in another copy of it or not."""
    matched = run_index(strings, times).matching_statistics() >= size
    flags, at = [], 0
    for string in strings:
        flags.append(matched[at : at + len(string) - size + 1])
        at += len(string) + 1
    return flags


def op6_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes kept of every document when strings that occur elsewhere are taken out."""
    rows = without_repeats(table(spark, sf_dir, "documents"), BYTES, long_matches, keep=["doc_id"])
    return rows.select(
        "row_.doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: Every string of 200 bytes, as hexadecimal digits, counted.
OP6_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), w AS (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM d WHERE length(x) >= 400
), k AS MATERIALIZED (SELECT doc_id, i, md5_number(substr(x, 2 * i + 1, 400)) AS h FROM w
), again AS (SELECT h FROM k GROUP BY h HAVING count(*) > 1
), hit AS (
    SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, TRUE) AS fresh FROM k JOIN again USING (h)
), run AS (SELECT doc_id, i, count_if(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM hit
), span AS (SELECT doc_id, r, min(i) AS a, max(i) + 200 AS b FROM run GROUP BY doc_id, r
), piece AS (
    SELECT doc_id, a, b, x, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since,
           lead(a) OVER (PARTITION BY doc_id ORDER BY a) IS NULL AS ends
    FROM span JOIN d USING (doc_id)
), kept AS (
    SELECT doc_id, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed,
           string_agg(substr(x, 2 * since + 1, 2 * (a - since)) || CASE WHEN ends THEN substr(x, 2 * b + 1) ELSE '' END, '' ORDER BY a) AS y
    FROM piece GROUP BY doc_id
)
SELECT doc_id, length(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(y, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
