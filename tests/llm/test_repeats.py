"""Repeated bytes and words against counting every window."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from pressloom.llm import superkmers
from pressloom.llm.substrings import WORDS, sorted_windows
from pressloom.llm.suffixes import BYTES, long_matches, run_index
from pressloom.llm.superkmers import Windows, without_repeats
from tests.llm.helpers import awkward, empty, repeats


def _units(text, unit):
    return (text or "").encode() if unit == "byte" else (text or "").encode().split()


def _agrees(docs, windows, mark):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sequences = [_units(t, windows.unit) for _, t in rows]
    wanted = collections.Counter()
    for (key, _), units, gone in zip(rows, sequences, repeats(sequences, windows.size)):
        left = [u for u, g in zip(units, gone) if not g]
        wanted[key, len(units), sum(gone), bytes(left) if windows.unit == "byte" else b" ".join(left)] += 1
    found = without_repeats(docs, windows, mark).collect()
    assert collections.Counter((r.row_.doc_id, r.n_units, r.n_removed, bytes(r.kept)) for r in found) == wanted
    return found


CASES = [(Windows("byte", 40, 8), long_matches), (Windows("word", 12, 3), sorted_windows)]


@pytest.mark.parametrize(("windows", "mark"), CASES)
@pytest.mark.parametrize("bucket", [3, 1_000])
def test_shared_passages(spark, monkeypatch, windows, mark, bucket):
    monkeypatch.setattr(superkmers, "BUCKET", bucket)
    chance = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = [chance.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(120):
        words = [chance.choice(vocabulary) for _ in range(chance.randint(0, 60))]
        if i % 2:
            at = chance.randint(0, len(words))
            words = words[:at] + passage[chance.randint(0, 10) : chance.randint(40, 60)] + words[at:]
        rows.append((i, " ".join(words)))
    rows += [(200, None), (201, ""), (7, rows[7][1]), (None, rows[9][1]), (203, "ab" * 300), (204, " ".join(["x"] * 90))]
    _agrees(spark.createDataFrame(rows, "doc_id bigint, text string"), windows, mark)


@pytest.mark.parametrize(("windows", "mark"), [(BYTES, long_matches), (WORDS, sorted_windows)])
def test_awkward_rows(spark, windows, mark):
    found = _agrees(awkward(spark), windows, mark)
    assert len(found) == awkward(spark).count()
    assert without_repeats(empty(spark), windows, mark).count() == 0


def test_long_texts_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(superkmers, "PIECE", 500)
    chance = random.Random(1)
    text = " ".join(chance.choice("abcdefg") * chance.randint(1, 4) for _ in range(1_500))
    docs = spark.createDataFrame([(1, text + " end " + text[300:2_000])], "doc_id bigint, text string")
    rows = [r.text for r in docs.collect()]
    for windows, mark in CASES:
        # Workers have the usual size of a piece; the pieces are cut here.
        pieces = list(superkmers._pieces(rows[0].encode(), windows))
        assert len(pieces) > 2
        _agrees(docs, windows, mark)
        whole = _units(rows[0], windows.unit)
        windows_of = lambda s: [tuple(s[i : i + windows.size]) for i in range(len(s) - windows.size + 1)]
        assert [w for _, p in pieces for w in windows_of(_units(p.decode(), windows.unit))] == windows_of(whole)


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc", bytes(range(256))])
def test_matching_statistics(alphabet):
    chance = random.Random(3)
    for _ in range(60):
        base = bytes(chance.choice(alphabet) for _ in range(40))
        strings = [base[a : a + chance.randint(1, 30)] for a in (chance.randint(0, 20) for _ in range(chance.randint(1, 6)))]
        times = [chance.choice((1, 1, 2, 5)) for _ in strings]
        index = run_index(strings, times)
        assert index.length.sum() == sum(t * (len(s) + 1) for s, t in zip(strings, times))
        copied = [s for s, t in zip(strings, times) for _ in range(t)]
        text = [(i, j) for i, s in enumerate(copied) for j in range(len(s) + 1)]
        suffixes = [copied[i][j:] for i, j in text]

        def common(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        wanted = [max((common(s, t) for k, t in enumerate(suffixes) if k != n), default=0) for n, s in enumerate(suffixes)]
        at, once = 0, []
        for s, t in zip(strings, times):
            size = len(s) + 1
            copies = [wanted[at + c * size : at + (c + 1) * size] for c in range(t)]
            assert copies == copies[:1] * t
            once += copies[0]
            at += t * size
        assert index.matching_statistics().tolist() == once


def test_copies_lengthen_runs():
    """A string in a million places has the runs of the string, and one more for each copy's first byte at most."""
    text = bytes(random.Random(2).choice(b"abcd") for _ in range(300))
    one, many = run_index([text, text[50:250] + b"x"], [1, 1]), run_index([text, text[50:250] + b"x"], [1_000_000, 1])
    assert one.symbol.tolist() == many.symbol.tolist()
    assert many.matching_statistics()[:300].tolist() == [300 - i for i in range(300)]


def test_rows_that_share_half_their_hash(spark):
    long_text = " ".join(f"w{i % 97}" for i in range(400))
    rows = [(1, long_text), (2, long_text + " end"), (3, "short"), (4, " ".join(f"v{i}" for i in range(50)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    keyed = docs.select(F.xxhash64("doc_id").alias("k"), F.col("doc_id").alias("l"), "text")

    def found(rows_):
        return {r.l: {(f.pack, tuple(f.spans)) for f in r.found} for r in superkmers.repeated(rows_, *CASES[1]).collect()}

    wanted = found(keyed)
    assert set(wanted) == {1, 2}
    assert found(keyed.withColumn("k", F.lit(7).cast("bigint"))) == wanted
