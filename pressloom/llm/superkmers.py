"""Repeated windows of a corpus by super-k-mers.

A window is a number of consecutive units (bytes or words) of one text.  Its
minimiser is the run of a few units in it with the least hash.  Consecutive
windows that share a minimiser make a super-k-mer.  Equal windows have equal
minimisers, so windows need to be compared only within a minimiser's bucket:

1. Minimisers are counted; what stands alone is dropped.
2. Super-k-mers of the others are grouped by minimiser and by a hash of all
   their units (128 bits in all).
3. One of each group travels to its minimiser's bucket as a packed string, with
   the number of its places, and an exact method finds the windows that are
   there more than once.
4. What was found goes back to all places of each super-k-mer, and from there
   to its text.

A bucket of too many different strings is cut by what its windows have in
common: windows whose minimiser stands at nearly the same place share all but a
few units, and these are the new key; at last single windows are the key, and a
bucket then holds one string.  So no bucket is too large and nothing is dropped.

Rows are known by 128 bits of their key and text (``k`` and ``l``).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from pressloom.llm import rolling
from pressloom.llm.common import named
from pressloom.session import cut_lineage

#: Different strings that a bucket holds before it is cut.
BUCKET = 1_000
#: Bytes hashed at once; arrays of eight times that stay in a core's cache.
BATCH = 250_000
#: Bytes of strings that are marked at once.
MARKED = 150_000
#: Texts of more bytes are hashed in pieces that overlap by a window.
PIECE = 4_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True

#: Marks, in different strings that stand so many times each, the windows of a size that are more than once among all.
Mark = Callable[[list[bytes], list[int], int], list[np.ndarray]]


@dataclass(frozen=True)
class Windows:
    """What repeats: ``size`` units, with minimisers of ``gram`` units."""

    unit: str
    size: int
    gram: int

    @property
    def steps(self) -> tuple[int, ...]:
        """How many neighbouring places of the minimiser share a key, in each cut of a large bucket."""
        return math.isqrt(self.size - self.gram) + 1, 1


def units_of(texts: list[bytes], unit: str) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each unit, the texts' bounds in units, and where units start and end in the joined bytes."""
    buffer, starts, ends = rolling.joined(texts)
    if unit == "byte":
        places = np.arange(len(buffer) + 1)
        return (rolling.byte_units(buffer), rolling.byte_units(buffer, 1)), starts, ends, np.stack([places, places + 1])
    first, last = rolling.bounds(~_SPACE[buffer])
    hashes = tuple(rolling.Runs(rolling.byte_units(buffer, w), w).hash(first, last) for w in (0, 1))
    return hashes, np.searchsorted(first, starts), np.searchsorted(first, ends), np.stack([first, last])


def _pieces(text: bytes, windows: Windows) -> Iterator[tuple[int, bytes]]:
    """A text as (number of units before, bytes), in overlapping pieces if it is long."""
    if len(text) <= PIECE:
        yield 0, text
    elif windows.unit == "byte":
        for at in range(0, len(text) - windows.size + 1, PIECE):
            yield at, text[at : at + PIECE + windows.size - 1]
    else:
        first, last = rolling.bounds(~_SPACE[np.frombuffer(text, np.uint8)])
        step = max(1, PIECE // 8)
        for at in range(0, max(1, len(first) - windows.size + 1), step):
            end = min(len(first), at + step + windows.size - 1)
            yield at, text[first[at] : last[end - 1]] if end > at else b""


def _super_kmers(rows: Iterator[pa.RecordBatch], windows: Windows, whole: bool) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "l")]
        parts = [
            (row, before, piece)
            for row, text in enumerate(batch.column("text"))
            for before, piece in _pieces(text.as_py() or b"", windows)
        ]
        for base, texts in rolling.batches([p[2] for p in parts], BATCH):
            units, starts, ends, _ = units_of(texts, windows.unit)
            owner, start, count, anchor, gram, all_units = rolling.minimisers(
                units, starts, ends, windows.size, windows.gram)
            if not len(owner):
                continue
            if not whole:
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64))], ["m"])
                continue
            row = np.array([p[0] for p in parts[base : base + len(texts)]], np.int64)[owner]
            before = np.array([p[1] for p in parts[base : base + len(texts)]], np.int64)[owner]
            pack = (start + before) << 20 | count << 10 | anchor
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (*(k[row] for k in keys), gram.view(np.int64), all_units.view(np.int64), pack)],
                ["k", "l", "m", "d", "pack"])


@F.pandas_udf(BinaryType())
def squeezed(texts: pd.Series) -> pd.Series:
    press = zstandard.ZstdCompressor(level=3)
    return texts.map(lambda t: None if t is None else press.compress(t))


def unsqueezed(data: bytes | None) -> bytes:
    return b"" if data is None else zstandard.ZstdDecompressor().decompress(data)


def _strings(rows: Iterator[pa.RecordBatch], windows: Windows) -> Iterator[pa.RecordBatch]:
    """Packed strings of the super-k-mers wanted of each text."""
    for batch in rows:
        out = []
        for data, wanted in zip(batch.column("z"), batch.column("wanted")):
            text, rows_ = unsqueezed(data.as_py()), wanted.as_py()
            ends = None
            if windows.unit == "word":
                ends = rolling.bounds(~_SPACE[np.frombuffer(text, np.uint8)])
            for row in rows_:
                start, count, anchor = row["pack"] >> 20, row["pack"] >> 10 & 1023, row["pack"] & 1023
                end = start + count - 1 + windows.size
                if ends is None:
                    string = text[start:end]
                else:
                    string = b" ".join(text[ends[0][start] : ends[1][end - 1]].split())
                out.append((row["m"], row["d"], row["n"], count, anchor, string))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, STRING.types)], schema=STRING)


STRING = pa.schema([
    ("m", pa.int64()), ("d", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("a", pa.int64()), ("s", pa.binary())])
STRING_DDL = "m bigint, d bigint, n bigint, c bigint, a bigint, s binary"


def covered(flags: np.ndarray, size: int) -> list[int]:
    """Bounds of the units that lie in a marked window: start, end, start, end, ..."""
    at = np.flatnonzero(flags)
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > size)
    return np.stack([at[np.append(0, gap + 1)], at[np.append(gap, len(at) - 1)] + size], 1).ravel().tolist()


def _marked(rows: Iterator[pa.RecordBatch], windows: Windows, mark: Mark) -> Iterator[pa.RecordBatch]:
    """Spans of the repeated windows of each string; rows come sorted by bucket, some buckets are held."""
    held, size, now = [], 0, None

    def done(rows_: list[tuple]) -> pa.RecordBatch:
        strings: dict[tuple, tuple] = {(r[0], r[1]): r for r in rows_}  # repeated rows bring the same string again
        rows_ = list(strings.values())
        flags = mark([r[5] for r in rows_], [r[2] for r in rows_], windows.size)
        found = [(r[0], r[1], covered(f, windows.size)) for r, f in zip(rows_, flags)]
        found = [f for f in found if f[2]]
        return pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32())))],
            ["m", "d", "spans"])

    for batch in rows:
        for row in zip(*(batch.column(c).to_pylist() for c in STRING.names)):
            if row[0] != now and size > MARKED:
                yield done(held)
                held, size = [], 0
            now = row[0]
            held.append(row)
            size += len(row[5])
    if held:
        yield done(held)


def _refined(rows: Iterator[pa.RecordBatch], windows: Windows, step: int) -> Iterator[pa.RecordBatch]:
    """Each string cut where its windows' minimiser has moved by ``step`` places.

    The new bucket is known by the old one, the place, and the units that all
    windows of that place share.
    """
    for batch in rows:
        rows_ = list(zip(*(batch.column(c).to_pylist() for c in STRING.names)))
        for base, strings in rolling.batches([r[5] for r in rows_], BATCH):
            units, starts, _, bounds = units_of(strings, windows.unit)
            buffer = b" ".join(strings)
            runs = [rolling.Runs(u, w) for w, u in enumerate(units)]
            out = []
            for (m, d, n, c, a, _), first in zip(rows_[base : base + len(strings)], starts.tolist()):
                for place in range((a - c + 1) // step, a // step + 1):
                    low, high = max(0, a - place * step - step + 1), min(c - 1, a - place * step)
                    core = first + a - place * step, first + a - place * step - step + 1 + windows.size
                    end = high + windows.size
                    out.append((m, d, n, place, low, high - low + 1, a - low, *core, first + low, first + end))
            if not out:
                continue
            m, d, n, place, low, count, anchor, c0, c1, s0, s1 = np.array(out, np.int64).T
            with np.errstate(over="ignore"):
                key = rolling.mixed(runs[0].hash(c0, c1) ^ rolling.mixed(m.view(np.uint64) + place.astype(np.uint64)))
            texts = [buffer[bounds[0][i] : bounds[1][j - 1]] for i, j in zip(s0, s1)]
            yield pa.RecordBatch.from_arrays([
                *(pa.array(x) for x in (m, d, key.view(np.int64), runs[1].hash(s0, s1).view(np.int64), n, low, count, anchor)),
                pa.array(texts, pa.binary()),
            ], ["pm", "pd", "m", "d", "n", "low", "c", "a", "s"])


def _same_row() -> Column:
    return (F.col("k") == F.col("k_of")) & (F.col("l") == F.col("l_of"))


def _exact(strings: DataFrame, windows: Windows, mark: Mark, level: int = 0) -> DataFrame:
    """``m d spans`` of the repeated windows of strings (saved, each with the number ``n`` of its places)."""
    crowded = cut_lineage(
        strings.groupBy("m").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > BUCKET).select(F.col("m").alias("of")))
    cold = strings.join(crowded, F.col("m") == F.col("of"), "left_anti")
    found = cold.repartition("m").sortWithinPartitions("m").mapInArrow(
        lambda rows: _marked(rows, windows, mark), "m bigint, d bigint, spans array<int>")
    if crowded.isEmpty():
        return found
    step = windows.steps[level]
    hot = strings.join(crowded, F.col("m") == F.col("of"), "left_semi").select(*STRING.names)
    # Repeated rows bring the same string again, which counts once.
    parts = cut_lineage(hot.dropDuplicates(["m", "d"]).repartition("m", "d").mapInArrow(
        lambda rows: _refined(rows, windows, step),
        "pm bigint, pd bigint, m bigint, d bigint, n bigint, low bigint, c bigint, a bigint, s binary"))
    different = cut_lineage(parts.groupBy("m", "d").agg(
        F.sum("n").alias("n"), F.min("c").alias("c"), F.min("a").alias("a"), F.first("s").alias("s")))
    shared = different.groupBy("m").agg(F.sum("n").alias("places")).where("places > 1").select(F.col("m").alias("of"))
    different = cut_lineage(different.join(shared, F.col("m") == F.col("of"), "left_semi"))
    deeper = cut_lineage(_exact(different, windows, mark, level + 1))
    back = parts.drop("s", "n", "c", "a").join(
        deeper.withColumnsRenamed({"m": "m_of", "d": "d_of"}), (F.col("m") == F.col("m_of")) & (F.col("d") == F.col("d_of")))
    # A string has a bounded number of parts, so its spans are collected.
    shifted = F.expr("transform(spans, x -> CAST(x + low AS INT))")
    own = back.groupBy(F.col("pm").alias("m"), F.col("pd").alias("d")).agg(
        F.flatten(F.collect_list(shifted)).alias("spans"))
    return found.unionByName(own)


def repeated(keyed: DataFrame, windows: Windows, mark: Mark) -> DataFrame:
    """``k l found``: for each row of ``keyed`` (``k l text``) the super-k-mers with repeated windows.

    ``found`` holds structs of ``pack`` (first unit and sizes) and ``spans``
    (bounds of the repeated units, counted from it).  Jobs run here.
    """
    texts = keyed.select("k", "l", F.col("text").cast("binary").alias("text"))
    counts = cut_lineage(
        texts.mapInArrow(lambda rows: _super_kmers(rows, windows, False), "m bigint")
        .groupBy("m").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("m").alias("of")))
    places = cut_lineage(
        texts.mapInArrow(lambda rows: _super_kmers(rows, windows, True), "k bigint, l bigint, m bigint, d bigint, pack bigint")
        .join(counts, F.col("m") == F.col("of"), "left_semi"))
    groups = cut_lineage(places.groupBy("m", "d").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("k", "l", "pack")).alias("one")))
    wanted = groups.groupBy(F.col("one.k").alias("k_of"), F.col("one.l").alias("l_of")).agg(
        F.collect_list(F.struct("m", "d", "n", "one.pack")).alias("wanted"))
    strings = cut_lineage(
        texts.select("k", "l", squeezed("text").alias("z")).join(wanted, _same_row()).select("z", "wanted")
        .mapInArrow(lambda rows: _strings(rows, windows), STRING_DDL))
    spans = cut_lineage(_exact(strings, windows, mark))
    back = places.join(
        spans.withColumnsRenamed({"m": "m_of", "d": "d_of"}), (F.col("m") == F.col("m_of")) & (F.col("d") == F.col("d_of")))
    return back.groupBy("k", "l").agg(F.collect_set(F.struct("pack", "spans")).alias("found"))


def _kept(unit: str):
    """Sizes and the text without the repeated units, of a squeezed text and what was found in it."""

    def cut(data: bytes | None, found) -> tuple[int, int, int, bytes]:
        text = unsqueezed(data)
        bounds = None
        n = len(text)
        if unit == "word":
            bounds = rolling.bounds(~_SPACE[np.frombuffer(text, np.uint8)])
            n = len(bounds[0])
        if found is None:
            return n, 0, 0, text if unit == "byte" else b" ".join(text.split())
        edge = np.zeros(n + 1, np.int32)
        for one in found:
            spans = np.asarray(one["spans"], np.int64) + (one["pack"] >> 20)
            np.add.at(edge, spans[::2], 1)
            np.add.at(edge, spans[1::2], -1)
        gone = np.cumsum(edge[:n]) > 0
        starts, _ = rolling.bounds(gone)
        if unit == "byte":
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        else:
            kept = b" ".join(w for w, g in zip(text.split(), gone.tolist()) if not g)
        return n, int(gone.sum()), len(starts), kept

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            at = batch.schema.names.index("z")
            out = [cut(z.as_py(), f.as_py()) for z, f in zip(batch.column("z"), batch.column("found"))]
            made = [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(at)] + made,
                [*batch.schema.names[:at], "n_units", "n_removed", "n_spans", "kept"])

    return run


def without_repeats(
    docs: DataFrame, windows: Windows, mark: Mark, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``row_`` (columns to keep), ``n_units n_removed n_spans``, and ``kept`` (binary): the text without its repeats.

    Removed is every unit in a window that also starts anywhere else, the same
    text included.  No text is an empty one, and stays whole; so do texts
    shorter than a window.  Repeated rows are texts like others, so their
    windows count as repeated.
    """
    columns = docs.columns if keep is None else keep
    keyed = docs.select(
        F.struct(*named(columns)).alias("row_"), F.xxhash64(*named([key, text])).alias("k"),
        F.xxhash64(F.lit(1), *named([text, key])).alias("l"), named([text])[0].cast("binary").alias("text"))
    found = repeated(keyed, windows, mark).withColumnsRenamed({"k": "k_of", "l": "l_of"})
    rows = keyed.select("row_", "k", "l", squeezed("text").alias("z"))
    rows = rows.join(found, _same_row(), "left").select("row_", "z", "found")
    kind = rows.schema["row_"].dataType.simpleString()
    return rows.mapInArrow(
        _kept(windows.unit), f"row_ {kind}, n_units bigint, n_removed bigint, n_spans bigint, kept binary")
