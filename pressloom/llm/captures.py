"""WARC archives with a two-level capture index.

Pages are written as gzipped WARC records, one file a task, payloads that were
seen before as revisits.  The index holds a line a record, sorted by its key:
the address with the host reversed, and the record's id.  Lines are compressed
in blocks; a sparse directory holds the first key and the place of each block.
A search halves the list of index files, then a file's directory, reads the
one block it points to and halves that, and so finds the file, offset and
length of a record, which is read alone.
"""

from __future__ import annotations

import bisect
import functools
import gzip
import hashlib
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pressloom.llm.common import table
from pressloom.session import cut_lineage, new_folder

#: Smaller payloads are always written in full.
LEAST_REVISIT = 100
#: Captures carry no time in the given tables.
DATE = "1970-01-01T00:00:00Z"
#: A file that has grown to this is followed by another.
FILE_BYTES = 1 << 30
#: Lines of a block.
BLOCK_LINES = 1_000
#: An index file has so many lines at least, and there are so many files at
#: most, so that their list stays small however many captures there are.
PART_LINES, MOST_PARTS = 50_000, 10_000
#: A payload that more than one row in so many has is known to all tasks; there are at most so many of them.
HEAVY = 1_000
#: Records closer than this are read at once, up to so many bytes.
GAP, READ_BYTES = 1 << 16, 1 << 23
#: Stretch of a file that one task reads.
STRETCH = 1 << 26

# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:pressloom:capture:"

PLACE = pa.schema([("key_", pa.string()), ("file_", pa.string()), ("offset_", pa.int64()), ("length_", pa.int64())])
PLACE_DDL = "key_ string, file_ string, offset_ bigint, length_ bigint"
PART = pa.schema([("first_", pa.string()), ("last_", pa.string()), ("file_", pa.string()), ("lines_", pa.int64())])
PART_DDL = "first_ string, last_ string, file_ string, lines_ bigint"
RECORD = pa.schema([
    ("id", pa.string()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])
RECORD_DDL = (
    "id string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"
)

_PRINTABLE = "".join(map(chr, range(0x21, 0x7F)))


def plain(text: str) -> str:
    """A text without white space, control characters or letters beyond ASCII: these are percent-encoded."""
    return urllib.parse.quote(text, safe=_PRINTABLE)


def address_key(url: str) -> str:
    """Host reversed and in lower case, then path and query: ``com,example,www)/a?b``.

    Scheme, user and fragment play no part.  An address that cannot be read is
    its own key.
    """
    try:
        parts = urllib.parse.urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return plain(url)
    turned = ",".join(reversed(host.split("."))) + (f":{port}" if port else "")
    return plain(f"{turned}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else ""))


def capture_key(url: str | None, ident: str | None) -> str:
    """What the index is sorted by; no address and no id are the same as empty ones.

    It ends in a space, so that no key begins with another.
    """
    return f"{address_key(url or '')} {plain(ident or '')} "


@F.pandas_udf(StringType())
def capture_keys(urls: pd.Series, idents: pd.Series) -> pd.Series:
    return pd.Series([capture_key(u, i) for u, i in zip(urls, idents)], dtype=object)


def record(ident: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """A response, or a revisit of the record it refers to: that holds the header of the answer alone."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = [
        VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{RECORD_ID}{ident}>",
        f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {plain(url)}")
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def _fields(header: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in header.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def parsed(member: bytes) -> dict:
    """A record's fields; a payload that does not have its digest is an error."""
    header, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = _fields(header)
    block = rest[: int(fields["content-length"])]
    answer, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    length = int(_fields(answer)["content-length"])
    response = fields["warc-type"] == "response"
    if response and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload is not what was written")

    def ident(name: str) -> str | None:
        return fields[name].removeprefix(f"<{RECORD_ID}").removesuffix(">") if name in fields else None

    return {
        "id": ident("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"],
        "refers_to": ident("warc-refers-to"), "payload_bytes": length, "payload_digest": digest,
        "payload": payload if response else None,
    }


class _Files:
    """Files of one task, each under a name of its own, so that a task run twice harms nothing."""

    def __init__(self, folder: str, end: str, opening: bytes = b""):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.end, self.opening, self.out, self.size = end, opening, None, 0

    def put(self, data: bytes) -> tuple[str, int]:
        """Writes and gives file name and offset."""
        if self.out is not None and self.size > FILE_BYTES:
            self.close()
        if self.out is None:
            self.store.create_dir(self.folder, recursive=True)
            self.name = uuid.uuid4().hex + self.end
            self.out = self.store.open_output_stream(f"{self.folder}/{self.name}", compression=None)
            self.size = self.out.write(self.opening)
        at = self.size
        self.size += self.out.write(data)
        return self.name, at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _opening(date: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    header = (f"{VERSION}\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <{RECORD_ID}info>\r\nWARC-Date: {date}\r\n"
              f"Content-Type: application/warc-fields\r\nContent-Length: {len(block)}\r\n\r\n")
    return gzip.compress(header.encode() + block + b"\r\n\r\n", 6, mtime=0)


def _archived(batches: Iterator[pa.RecordBatch], folder: str, date: str) -> Iterator[pa.RecordBatch]:
    """Writes rows ``id_ url_ payload_ digest_ refers_`` and gives the place of each."""
    files = _Files(folder, ".warc.gz", _opening(date))
    try:
        for batch in batches:
            places = []
            for ident, url, payload, digest, refers in zip(*batch.columns):
                ident, url, refers = ident.as_py(), url.as_py(), refers.as_py()
                data = record(ident or "", url, payload.as_py() or b"", digest.as_py(), refers, date)
                places.append((capture_key(url, ident), *files.put(data), len(data)))
            columns = zip(*places) if places else [[]] * len(PLACE)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PLACE)], schema=PLACE)
    finally:
        files.close()


def _blocks(batches: Iterator[pa.RecordBatch], folder: str, block_lines: int) -> Iterator[pa.RecordBatch]:
    """Writes sorted lines in blocks and their directory; gives the first and last key of the file."""
    files, directory, held = _Files(folder, ".idx"), [], []
    first = last = None
    total = 0

    def flush() -> None:
        data = zlib.compress("".join(held).encode(), 6)
        _, at = files.put(data)
        directory.append(f"{held[0].split(chr(9), 1)[0]}\t{at}\t{len(data)}\n")
        held.clear()

    for batch in batches:
        for key, name, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
            first, last, total = (key if first is None else first), key, total + 1
            held.append(f"{key}\t{name}\t{offset}\t{length}\n")
            if len(held) == block_lines:
                flush()
    if held:
        flush()
    files.close()
    if total:
        with files.store.open_output_stream(f"{files.folder}/{files.name}.dir") as out:
            out.write("".join(directory).encode())
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((first, last, files.name, total), PART)], schema=PART)


class _Reader:
    """Searches the index; the directory and the block last read are kept."""

    def __init__(self, folder: str, parts: list[tuple[str, str, str]]):
        self.store, self.folder = fs.FileSystem.from_uri(folder)
        self.parts = parts
        self.firsts = [p[0] for p in parts]
        self.directory = functools.lru_cache(2)(self._directory)
        self.block = functools.lru_cache(2)(self._block)

    def _directory(self, part: int) -> tuple[list[str], list[tuple[int, int]]]:
        with self.store.open_input_file(f"{self.folder}/{self.parts[part][2]}.dir") as file:
            rows = [line.split("\t") for line in file.read().decode().splitlines()]
        return [r[0] for r in rows], [(int(r[1]), int(r[2])) for r in rows]

    def _block(self, part: int, number: int) -> tuple[list[str], list[str]]:
        at, length = self.directory(part)[1][number]
        with self.store.open_input_file(f"{self.folder}/{self.parts[part][2]}") as file:
            lines = zlib.decompress(file.read_at(length, at)).decode().splitlines()
        return [line.split("\t", 1)[0] for line in lines], lines

    def search(self, prefix: str) -> Iterator[tuple[str, str, int, int]]:
        """All lines whose key begins so: from the last file and block that begin before it, on."""
        part = max(0, bisect.bisect_left(self.firsts, prefix) - 1)
        while part < len(self.parts) and (self.firsts[part] < prefix or self.firsts[part].startswith(prefix)):
            if self.parts[part][1] >= prefix:
                firsts = self.directory(part)[0]
                number = max(0, bisect.bisect_left(firsts, prefix) - 1)
                while number < len(firsts) and (firsts[number] < prefix or firsts[number].startswith(prefix)):
                    keys, lines = self.block(part, number)
                    at = bisect.bisect_left(keys, prefix)
                    while at < len(keys) and keys[at].startswith(prefix):
                        key, name, offset, length = lines[at].split("\t")
                        yield key, name, int(offset), int(length)
                        at += 1
                    number += 1
            part += 1


def _searched(batches: Iterator[pa.RecordBatch], folder: str, parts: list) -> Iterator[pa.RecordBatch]:
    reader, held = _Reader(folder, parts), []

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), PLACE)], schema=PLACE)
        held.clear()
        return batch

    for batch in batches:
        for prefix in batch.column(0).to_pylist():
            for found in reader.search(prefix):
                held.append(found)
                if len(held) == 10_000:
                    yield flush()
    if held:
        yield flush()


def _stretches(rows: Iterator[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Places that are near enough to be read at once; they come sorted."""
    held: list[tuple[str, int, int]] = []
    for name, at, length in rows:
        if held and (name != held[0][0] or at > held[-1][1] + held[-1][2] + GAP or at + length > held[0][1] + READ_BYTES):
            yield held
            held = []
        held.append((name, at, length))
    if held:
        yield held


def _records(batches: Iterator[pa.RecordBatch], folder: str, payload: bool) -> Iterator[pa.RecordBatch]:
    store, path = fs.FileSystem.from_uri(folder)
    rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
    file, opened = None, None
    for places in _stretches(rows):
        name, first, _ = places[0]
        if name != opened:
            if file is not None:
                file.close()
            file, opened = store.open_input_file(f"{path}/{name}"), name
        data = file.read_at(places[-1][1] + places[-1][2] - first, first)
        found = [parsed(data[at - first : at - first + length]) for _, at, length in places]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[f.name] if payload or f.name != "payload" else None for r in found], f.type) for f in RECORD], schema=RECORD)
    if file is not None:
        file.close()


@dataclass(frozen=True)
class Archive:
    """Archive files in a folder, and the list of its index files: their first and last keys, in order."""

    folder: str
    parts: tuple[tuple[str, str, str], ...]

    def find(self, wanted: DataFrame, prefix: str = "prefix") -> DataFrame:
        """Places of the records whose key begins with one of the column's values; each value is sought once.

        ``address_key(url) + " "`` finds the captures of an address, a
        beginning of it those of a host, ``capture_key`` one record.  Null
        finds nothing.  Values are dealt by ranges, so a task meets the blocks
        of the index in their order.
        """
        folder, parts = f"{self.folder}/index", list(self.parts)
        values = wanted.select(F.col(prefix).alias("prefix_")).where("prefix_ IS NOT NULL").distinct()
        return (
            values.repartitionByRange("prefix_").sortWithinPartitions("prefix_")
            .mapInArrow(lambda batches: _searched(batches, folder, parts), PLACE_DDL)
        )

    def read(self, places: DataFrame, payload: bool = True) -> DataFrame:
        """The records at those places: ``id url record_type refers_to payload_bytes payload_digest payload``.

        The payload of a response is held against its digest; a revisit tells
        that of the record it refers to, and has none itself.
        """
        folder = f"{self.folder}/records"
        return (
            places.select("file_", "offset_", "length_")
            .repartition("file_", F.floor(F.col("offset_") / STRETCH)).sortWithinPartitions("file_", "offset_")
            .mapInArrow(lambda batches: _records(batches, folder, payload), RECORD_DDL)
        )


def with_first(pages: DataFrame, ident: Column, payload: Column, least: int = LEAST_REVISIT) -> DataFrame:
    """Adds ``digest_`` and ``first_``: the least id that has an equal payload of so many bytes, null if it is alone.

    What is saved is one row for each payload that is there more than once.
    The few that very many rows share go to all tasks; those rows then have a
    key of their own and do not meet in the join.
    """
    rows = pages.withColumns({"digest_": F.sha2(payload, 256), "ident_": ident})
    long = F.octet_length(payload) >= least
    again = cut_lineage(
        rows.where(long).groupBy("digest_").agg(F.min("ident_").alias("least_"), F.count(F.lit(1)).alias("n_")).where("n_ > 1"))
    n_rows = pages.count()
    heavy = again.where(F.col("n_") * HEAVY > n_rows).select(F.col("digest_").alias("of_"), F.col("least_").alias("known_"))
    light = again.where(F.col("n_") * HEAVY <= n_rows).select(F.col("digest_").alias("like_"), "least_")
    met = rows.join(F.broadcast(heavy), F.col("digest_") == F.col("of_"), "left")
    own = F.when(F.col("of_").isNull(), F.col("digest_")).otherwise(F.concat_ws("/", "digest_", F.monotonically_increasing_id()))
    met = met.withColumn("own_", own).join(light, F.col("own_") == F.col("like_"), "left")
    return met.withColumn("first_", F.when(long, F.coalesce("known_", "least_"))).drop(
        "of_", "known_", "like_", "least_", "own_", "ident_")


def archive(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None,
    least_revisit: int = LEAST_REVISIT, date: str = DATE, block_lines: int = BLOCK_LINES,
) -> Archive:
    """Writes each row as a record and the index of them all; the jobs run here.

    Of the rows with equal payloads of ``least_revisit`` bytes or more, that
    with the least key is a response and the others revisit it; repeated rows
    with that key are responses all of them.  A null payload is the same as an
    empty one.  A null key is written as an empty one and is never the least;
    rows that all have none are responses.  A null address has the empty one's
    place in the index.  Other columns play no part.  No rows make no files.

    The folder must be one that all tasks reach, by a path or an address that
    pyarrow reads.  A task that runs twice leaves a file which nothing names.
    """
    folder = folder or new_folder(pages.sparkSession)
    text = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    rows = with_first(
        pages.select(F.col(key).alias("id_"), F.col(url).alias("url_"), text.alias("payload_")),
        F.col("id_"), F.col("payload_"), least_revisit)
    refers = F.when(F.col("first_").isNotNull() & ~F.col("id_").eqNullSafe(F.col("first_")), F.col("first_").cast("string"))
    rows = rows.select(F.col("id_").cast("string"), "url_", "payload_", "digest_", refers.alias("refers_"))
    places = cut_lineage(rows.mapInArrow(lambda batches: _archived(batches, f"{folder}/records", date), PLACE_DDL))
    n = places.count()
    n_parts = max(1, -(-n // max(PART_LINES, n // MOST_PARTS)))
    parts = cut_lineage(
        places.repartitionByRange(n_parts, "key_", "file_", "offset_").sortWithinPartitions("key_", "file_", "offset_")
        .mapInArrow(lambda batches: _blocks(batches, f"{folder}/index", block_lines), PART_DDL))
    # A row an index file, of which there are ten thousand at most.
    listed = sorted((r.first_, r.last_, r.file_) for r in parts.collect())
    return Archive(folder, tuple(listed))


def op11_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written as a record, found through the index and read back."""
    pages = table(spark, sf_dir, "pages")
    written = archive(pages)
    places = written.find(pages.select(capture_keys("url", F.col("page_id").cast("string")).alias("prefix")))
    number = lambda name: F.when(F.col(name) != "", F.col(name)).cast("bigint")
    return written.read(places, payload=False).select(
        number("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


OP11_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM p
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""
