"""Fingerprints, components, list joins and conversations against brute force and awkward rows."""

import datetime
import random

import numpy as np
import pytest
import xxhash

from pressloom.llm import chat, queries, simhash, urls
from pressloom.llm.components import components
from tests.conftest import SMALL
from tests.llm.helpers import awkward, classes, empty


def _fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _near(values, distance=3):
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= distance:
                yield a, b


def test_fingerprints(spark, monkeypatch):
    texts = ["", "one", "one two", "One TWO three", "É one two three " * 5, " ".join(f"w{i}" for i in range(700))]
    assert [simhash.fingerprint(t.encode()) for t in texts] == [_fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "BATCH", 100)
    assert [simhash.fingerprint(t.encode()) for t in texts] == [_fingerprint(t) for t in texts]


@pytest.mark.parametrize(("centres", "each", "flips", "bucket"), [(80, 8, 6, 4_096), (2, 150, 4, 30)])
def test_no_link_is_lost(spark, monkeypatch, centres, each, flips, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    chance, values = random.Random(3), set()
    for _ in range(centres):
        centre = chance.getrandbits(64)
        values.add(centre)
        for _ in range(each):
            values.add(centre ^ sum(1 << b for b in chance.sample(range(64), chance.randint(1, flips))))
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(v, v) for v in signed], "node_ bigint, print_ bigint"))
    found = {r.node: r.component for r in components(links).collect()}
    wanted = classes(signed, ((a, b) for a, b in _near_signed(signed)))
    assert {n: found.get(n, n) for n in signed} == wanted


def _near_signed(values):
    return _near_pairs([(v, v & (2**64 - 1)) for v in values])


def _near_pairs(pairs):
    for i, (a, x) in enumerate(pairs):
        for b, y in pairs[i + 1 :]:
            if (x ^ y).bit_count() <= 3:
                yield a, b


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (400, 500)], "a bigint, b bigint")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 0 for i in range(201)} | {400: 400, 500: 400}
    assert components(links.limit(0)).count() == 0


def test_near_duplicates_of_awkward_rows(spark):
    rows = simhash.classed(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    prints = {r.row_.text: _fingerprint(r.row_.text) for r in rows}
    assert all(r.print_ & (2**64 - 1) == prints[r.row_.text] for r in rows)
    groups = classes(set(prints.values()), _near(sorted(set(prints.values()))))
    kept = simhash.keep_first(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert kept.count() == len(set(groups.values()))
    assert simhash.keep_first(empty(spark)).count() == 0


def test_near_duplicates_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in queries.LLM_QUERIES["op8_pigeonring"](spark, SMALL).collect()}
    prints = {r.doc_id: _fingerprint(r.text) for r in docs.collect()}
    keys = sorted(prints)
    linked = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    wanted = classes(keys, linked)
    assert {k: (f"{prints[k]:016x}", wanted[k]) for k in keys} == {k: (r.fingerprint, r.component_id) for k, r in rows.items()}


def test_lists_hold_at_fetch_time(spark):
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    entries = [
        ("bad.org", day(10), True), ("bad.org", day(100), False), ("BAD.org", day(200), True), ("bad.org", day(200), False),
        ("site.net/ads", day(0), True), ("site.net/ads/x", day(5), True), (None, day(1), True), ("late.com", None, True),
        ("gone.com", day(3), False),
    ]
    captures = [
        (1, "http://bad.org/", day(9)), (2, "http://www.bad.org:80/a", day(10)), (3, "https://u:p@bad.org", day(99)),
        (4, "http://bad.org", day(100)), (5, "http://bad.org", day(250)), (6, "http://notbad.org", day(50)),
        (7, "http://site.net/ads/", day(1)), (8, "http://site.net/ads/x/y?z=/w", day(6)), (9, "http://site.net/ads", day(6)),
        (10, "http://gone.com/", day(9)), (11, None, day(9)), (12, "no url", day(9)), (13, "http://bad.org", None),
        (14, "", day(9)), (2, "http://www.bad.org:80/a", day(10)), (15, "http://" + "a." * 2_000 + "bad.org/", day(50)),
        (16, "http://bad.org./" + "d/" * 3_000, day(50)),
    ]
    rows = urls.judged(
        spark.createDataFrame(captures, "id int, url string, fetched_at timestamp").withColumn("pattern", urls.F.lit("mine")),
        spark.createDataFrame(entries, "pattern string, at timestamp, listed boolean")).collect()
    assert sorted((r.id, r.n_entries, r.pattern) for r in rows if r.blocked) == [
        (2, 1, "bad.org"), (2, 1, "bad.org"), (3, 1, "bad.org"), (5, 1, "bad.org"), (7, 1, "site.net/ads"),
        (8, 2, "site.net/ads/x"), (16, 1, "bad.org")]
    assert len(rows) == len(captures)
    none = spark.createDataFrame([], "pattern string, at timestamp, listed boolean")
    some = spark.createDataFrame(captures, "id int, url string, fetched_at timestamp")
    assert urls.allowed(some, none).count() == len(captures) and urls.allowed(some.limit(0), none).count() == 0


def test_snapshots_collapse(spark):
    talk = [("user", "hi"), ("bot", "hello"), ("user", None), ("bot", "")]
    logs = {1: talk[:1], 2: talk[:2], 3: talk, 4: talk, 5: talk[:2] + [("user", "")], 6: [("user", "other")], 7: [(None, "hi")]}
    rows = [(c, i * 2, r, t, "x") for c, ts in logs.items() for i, (r, t) in enumerate(ts)]
    rows += [(None, None, None, None, "x"), (None, None, None, None, "x"), (8, 5, "user", "ü" * 100_000, "x")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, kept string")
    found = {r.conv_id: r for r in chat.formatted(frame).collect()}
    assert {c: (r.n_turns, r.kept, r.covered_by) for c, r in found.items()} == {
        1: (1, False, 2), 2: (2, False, 3), 3: (4, True, None), 4: (4, False, 3), 5: (3, True, None), 6: (1, True, None),
        7: (1, True, None), 8: (1, True, None), None: (2, True, None)}
    assert found[3].rendered == "<|user|>\nhi<|end|>\n<|bot|>\nhello<|end|>\n<|user|>\n<|end|>\n<|bot|>\n<|end|>\n"
    assert found[4].rendered is None
    assert chat.formatted(frame.limit(0)).count() == 0


def test_long_conversations_are_numbered_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(chat, "TURNS", 7)
    rows = [(c, t, "user", f"turn {t}") for c, n in ((1, 60), (2, 25), (3, 25)) for t in range(n)]
    found = {r.conv_id: (r.n_turns, r.kept, r.covered_by) for r in chat.formatted(
        spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert found == {1: (60, True, None), 2: (25, False, 1), 3: (25, False, 1)}
