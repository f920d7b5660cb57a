"""Archives: round trips, searches, revisits, awkward rows."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pressloom.llm import captures

PAGES = "page_id bigint, url string, html string, file_ string, first_ int, n_ int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], PAGES)


def read_all(spark, rows, **options):
    written = captures.archive(rows, **options)
    wanted = rows.select(captures.capture_keys("url", F.col("page_id").cast("string")).alias("prefix"))
    return written, written.read(written.find(wanted)).collect()


@pytest.mark.parametrize("url,key", [
    ("https://user@WWW.Example.com:8080/a%20b/c?q=1#f", "com,example,www:8080)/a%20b/c?q=1"),
    ("http://example.com", "com,example)/"),
    ("//example.com/é x", "com,example)/%C3%A9%20x"),
    ("relative/path", ")relative/path"),
    ("http://[broken/", "http://[broken/"),
    ("http://h:port/", "http://h:port/"),
    ("", ")/"),
])
def test_address_keys(url, key):
    assert captures.address_key(url) == key


@pytest.mark.parametrize("payload", [b"", b"\r\n\r\n", "é\x00 <p>".encode() * 50])
def test_a_record_comes_back(payload):
    digest = hashlib.sha256(payload).hexdigest()
    back = captures.parsed(captures.record("7", "http://a/\n b", payload, digest, None, captures.DATE))
    assert back["payload"] == payload and back["id"] == "7" and back["payload_digest"] == digest
    assert back["url"] == "http://a/%0A%20b" and back["record_type"] == "response" and back["refers_to"] is None
    again = captures.parsed(captures.record("8", None, payload, digest, "7", captures.DATE))
    assert (again["payload"], again["payload_bytes"], again["refers_to"], again["url"]) == (None, len(payload), "7", None)


def test_a_changed_payload_is_an_error():
    with pytest.raises(ValueError):
        captures.parsed(captures.record("7", "u", b"text", hashlib.sha256(b"other").hexdigest(), None, captures.DATE))


def test_small_blocks_and_all_kinds_of_searches(spark, monkeypatch):
    monkeypatch.setattr(captures, "PART_LINES", 40)
    rng = random.Random(3)
    rows = [(i, f"http://h{rng.randrange(9)}.example.org/p{rng.randrange(30)}", f"<p>{rng.randrange(40)}" * 60) for i in range(500)]
    table = pages(spark, rows)
    written = captures.archive(table, block_lines=7)
    assert len(written.parts) > 5 and list(written.parts) == sorted(written.parts)
    sought = ["org,example,h3)/p4 ", "org,example,h3)", "org,example,h3)/p1", "zz", "", "org,example,h3)/p4 17 ", None, "zz"]
    found = written.find(spark.createDataFrame([(s,) for s in sought], "prefix string")).collect()
    keys = [captures.capture_key(u, str(i)) for i, u, _ in rows]
    expected = sorted(k for s in {x for x in sought if x is not None} for k in keys if k.startswith(s))
    assert sorted(r.key_ for r in found) == expected


def test_every_record_is_read_back_and_the_least_of_equals_is_the_response(spark):
    rows = [(i, f"http://e.org/{i % 60}", f"<html>{i % 7}" * (1 if i % 2 else 30)) for i in range(300)]
    _, found = read_all(spark, pages(spark, rows))
    assert sorted(int(r.id) for r in found) == list(range(300))
    least = {}
    for i, _, html in rows:
        least.setdefault(html, i)
    for r in found:
        html = rows[int(r.id)][2]
        first = least[html] if len(html) >= 100 else int(r.id)
        assert r.payload_digest == hashlib.sha256(html.encode()).hexdigest() and r.payload_bytes == len(html)
        if first == int(r.id):
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, html.encode())
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", str(first), None)


def test_awkward_rows(spark):
    long = "<p>é</p>" * 400_000
    rows = [(1, None, None), (2, "", ""), (None, "http://a.b/", "x" * 200), (3, "http://a.b/", "x" * 200), (3, "http://a.b/", "x" * 200),
            (4, "http://a.b/", "x" * 200), (None, "http://n.n/", "y" * 200), (None, "http://n.n/", "y" * 200), (5, "http://l/\r\nX: y", long)]
    _, found = read_all(spark, pages(spark, rows))
    told = sorted((r.id, r.record_type, r.refers_to or "", r.payload_bytes) for r in found)
    assert told == sorted([
        ("1", "response", "", 0), ("2", "response", "", 0), ("", "revisit", "3", 200), ("3", "response", "", 200),
        ("3", "response", "", 200), ("4", "revisit", "3", 200), ("", "response", "", 200), ("", "response", "", 200),
        ("5", "response", "", len(long.encode()))])


def test_rows_that_one_payload_dominates(spark):
    rows = [(i, f"http://e.org/{i}", "same" * 50 if i % 3 else f"own {i}" * 30) for i in range(4_000)]
    _, found = read_all(spark, pages(spark, rows))
    assert len(found) == 4_000 and sum(r.refers_to == "1" for r in found) == sum(1 for i in range(4_000) if i % 3) - 1


def test_no_rows(spark):
    written, found = read_all(spark, pages(spark, []))
    assert found == [] and written.parts == ()


def test_files_are_plain_gzip_members(spark, tmp_path):
    written = captures.archive(pages(spark, [(1, "http://a/", "text"), (2, "http://b/", "more")]), folder=str(tmp_path))
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in (tmp_path / "records").glob("*.warc.gz"))
    assert whole.count(b"WARC/1.1\r\n") == 2 + len(list((tmp_path / "records").glob("*.warc.gz"))) and written.parts
