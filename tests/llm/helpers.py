"""Brute-force versions and small tables for the corpus operators."""

from __future__ import annotations

import collections

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, k string, rank_ int"


def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"word{i % 977}" for i in range(60_000))
    passage = " ".join(f"shared{i}" for i in range(70))
    rows = [
        (1, "A plain text of some ten words that says nothing much.", "en", "a", 50, "x", "k", 1),
        (1, "A plain text of some ten words that says nothing much.", "en", "a", 50, "x", "k", 1),
        (2, None, "en", "a", None, None, None, None), (3, "", "fr", None, 0, "", "", 0), (4, " \n\t ", None, "b", 4, "x", "k", 1),
        (None, "Some text without an id here.", None, None, None, None, None, None),
        (None, "Some text without an id here.", None, None, None, None, None, None),
        (5, long, "de", "b", len(long), "x", "k", 2), (6, "no 123 !!", "en", "c", 9, "x", "k", 3),
        (7, passage + " tail one", "en", "c", 9, "x", "k", 3), (8, "head " + passage, "en", "a", 9, "x", "k", 3),
        (9, "ÉCOLE ünïcode 中文字符 😀 text", "fr", "c", 9, "x", "k", 3), (10, "x", "es", "", 1, "x", "k", 3),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def repeats(sequences, size):
    """For each sequence which units lie in a window that is there more than once."""
    times = collections.Counter(tuple(s[i : i + size]) for s in sequences for i in range(len(s) - size + 1))
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - size + 1):
            if times[tuple(s[i : i + size])] > 1:
                gone[i : i + size] = [True] * size
        yield gone


def classes(nodes, linked):
    """The smallest node that each node reaches."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}
