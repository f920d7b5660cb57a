"""Appends that happen once, stop rules bit by bit, crawls whose links and pages arrive in any order."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from pressloom.operators import crawl
from pressloom.profiles import SITES, site_profiles
from pressloom.sources import ledger
from pressloom.sources.pages import stream_pages
from pressloom.streaming import cuts
from pressloom.streaming.crawl import follow_stream
from pressloom.streaming.extraction import append_stream

ROWS = "site STRING, page_no BIGINT, title STRING"


def releases(spark, pages):
    return spark.createDataFrame([(s, n, f"{s}{n}/{i}") for s, n in pages for i in range(n % 3)], ROWS)


def pages(spark, numbers):
    return spark.createDataFrame(numbers, ledger.PAGES)


def test_a_run_that_died_before_its_commit_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    first, rest = [("a", n) for n in range(5)], [(s, n) for s in "ab" for n in range(9)]
    assert ledger.append_once(releases(spark, first), pages(spark, first), path) is not None
    ledger.stage(path, "died", rows=releases(spark, rest), pages=pages(spark, rest))
    assert ledger.read(spark, path, "rows", ROWS).count() == releases(spark, first).count()
    assert ledger.append_once(releases(spark, rest), pages(spark, rest), path) is not None
    got = sorted(r.title for r in ledger.read(spark, path, "rows", ROWS).collect())
    assert got == sorted(r.title for r in releases(spark, rest).collect())
    assert sorted(tuple(r) for r in ledger.finished(spark, path).collect()) == sorted(rest)
    assert ledger.append_once(releases(spark, rest), pages(spark, rest), path) is None
    assert not os.path.exists(f"{path}/staging/died")


def test_a_commit_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "table")
    given = [("a", 1), ("a", 2)]
    ledger.stage(path, "r", rows=releases(spark, given), pages=pages(spark, given))
    ledger.commit(spark, path, "r")
    ledger.stage(path, "r", rows=releases(spark, given), pages=pages(spark, given))
    ledger.commit(spark, path, "r")
    assert ledger.read(spark, path, "rows", ROWS).count() == releases(spark, given).count()


def test_nothing_written_yet(spark, tmp_path):
    assert ledger.finished(spark, str(tmp_path / "none")).count() == 0
    assert ledger.append_once(releases(spark, []), pages(spark, []), str(tmp_path / "none")) is None


@pytest.mark.parametrize("seed", range(2))
def test_stops_bit_by_bit(spark, tmp_path, seed):
    """Any order, repeated batches, repeated pages: the same cut as over all pages at once."""
    rng = random.Random(seed)
    path = str(tmp_path / "cuts")
    names = ["aoc", "hawley", "lee", "sanders"]
    profiles = site_profiles(spark)
    every = [(s, n, rng.choice((0, 0, 3)) if n > 4 else 2) for s in names for n in range(30)]
    shuffled = rng.sample(every, len(every))
    parts = [shuffled[i::5] for i in range(5)]
    parts[3] += parts[0][:7]
    schema = "site STRING, page_no BIGINT, n_releases BIGINT"
    for number, part in enumerate(parts):
        batch = spark.createDataFrame(part, schema)
        cuts.merge(batch, profiles, path, f"batch-{number}")
        if number % 2:
            cuts.merge(batch, profiles, path, f"batch-{number}")
    got = sorted(tuple(r) for r in cuts.reached(spark, path).collect())
    wanted = crawl.cut_by_profile(spark.createDataFrame(every, schema), profiles).collect()
    assert got == sorted((r.site, r.page_no, r.n_releases) for r in wanted)


def test_a_batch_that_died_before_its_commit_is_done_again(spark, tmp_path):
    path, profiles = str(tmp_path / "cuts"), site_profiles(spark)
    batch = spark.createDataFrame([("aoc", 0, 2), ("aoc", 1, 0), ("aoc", 2, 4)], "site STRING, page_no BIGINT, n_releases BIGINT")
    ledger.stage(path, "batch-0", pages=batch.limit(1), votes=spark.createDataFrame([], cuts.VOTES), stops=spark.createDataFrame([], cuts.STOPS))
    cuts.merge(batch, profiles, path, "batch-0")
    assert [tuple(r) for r in cuts.reached(spark, path).collect()] == [("aoc", 0, 2)]


MARKEY = {p.site: p.base_url for p in SITES}["markey"]
HOME = "https://www.markey.senate.gov"
START = datetime.datetime(2024, 5, 1)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def listing(number, minutes, hrefs):
    items = "".join(f'<a class="ArticleBlock__title__link" href="{h}">t</a>' for h in hrefs)
    return ("markey", number, items, at(minutes))


def capture(href, minutes, text="x"):
    return (HOME + href, f'<h1 class="Heading Heading--h2">{text}</h1>', at(minutes))


def run(spark, folder, listed, captured, finish=True):
    """One run of the stream after some more rows arrived; its progress."""
    for name, rows, schema in (
        ("listings", listed, "site STRING, page_no BIGINT, html STRING, seen_at TIMESTAMP"),
        ("captures", captured, "url STRING, html STRING, captured_at TIMESTAMP"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    stream = follow_stream(
        stream_pages(spark, f"{folder}/listings", "site STRING, page_no BIGINT, html STRING, seen_at TIMESTAMP"),
        stream_pages(spark, f"{folder}/captures", "url STRING, html STRING, captured_at TIMESTAMP"),
        site_profiles(spark), delay="10 minutes", wait="1 hour", early="30 minutes")
    query = append_stream(stream, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    return query.recentProgress


def test_links_and_pages_in_any_order(spark, tmp_path):
    folder = str(tmp_path)
    run(spark, folder, [listing(1, 0, ["/late", "/never", "/soon", "/stale"])], [capture("/first", 1), capture("/soon", 2), capture("/stale", -40)])
    run(spark, folder, [listing(2, 8, ["/first", "/twice"])], [capture("/late", 50), capture("/twice", 9), capture("/twice", 10, "y")])
    run(spark, folder, [listing(3, 2_000, ["/end"])], [capture("/end", 2_000)])
    run(spark, folder, [listing(4, 4_000, ["/after"])], [capture("/after", 4_000)])
    got = sorted((r.page_no, r.url.removeprefix(HOME), r.title, r.error) for r in spark.read.parquet(f"{folder}/out").collect())
    missing = "Error: Timeout occurred while loading "
    assert got[:-2] == [
        (1, "/late", "x", None), (1, "/never", None, missing + HOME + "/never"), (1, "/soon", "x", None),
        (1, "/stale", None, missing + HOME + "/stale"), (2, "/first", "x", None), (2, "/twice", got[5][2], None),
    ]
    assert got[5][2] in ("x", "y") and [g[1] for g in got[-2:]] == ["/end", "/after"]


def test_what_waits_is_bounded(spark, tmp_path):
    """As time goes on the state holds the links and pages of the last hours and no more."""
    folder = str(tmp_path)
    held = []
    for hour in range(4):
        listed = [listing(hour * 10 + i, hour * 180 + i, [f"/p{hour}/{i}/{k}" for k in range(20)]) for i in range(5)]
        captured = [capture(f"/p{hour}/{i}/{k}", hour * 180 + i) for i in range(5) for k in range(0, 20, 2)]
        progress = run(spark, folder, listed, captured)
        held.append(sum(o["numRowsTotal"] for o in progress[-1]["stateOperators"]))
    assert max(held[2:]) <= 1.2 * held[1], held
    rows = spark.read.parquet(f"{folder}/out")
    assert rows.where("error IS NULL").count() >= 3 * 50 and rows.where(F.col("error").isNotNull()).count() >= 2 * 50
