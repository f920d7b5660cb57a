import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from pressloom.operators import crawl, links, numbering, releases
from pressloom.plans.corpus import normalise_corpus
from pressloom.plans.extraction import releases_of
from pressloom.profiles import SITES, site_profiles
from pressloom.session import cut_lineage, drop_saved
from pressloom.sources import corpus, sinks
from pressloom.sources.pages import unplaced, with_site
from tests.conftest import SMALL


def stats(spark, counts, site="s"):
    rows = [(site, i, n) for i, n in enumerate(counts, 1)]
    return spark.createDataFrame(rows, "site STRING, page_no BIGINT, n_releases BIGINT")


@pytest.mark.parametrize(
    "counts, run, last",
    [
        ([3, 0, 0, 2, 0, 0, 0, 5], 3, 6), ([3, 0, 0, 2, 0, 0, 0, 5], 1, 1), ([1, 2, 3], 3, 3), ([0, 0, 0, 1], 3, 2),
        ([0, 1], 1, 0), ([0, 0], 3, 2),
    ],
)
def test_cut(spark, counts, run, last):
    kept = crawl.cut(stats(spark, counts), run)
    assert sorted(r.page_no for r in kept.collect()) == list(range(1, last + 1))
    longer = crawl.cut(stats(spark, counts + [9, 9]), run)
    if last < len(counts) - (run > 1):
        assert longer.count() == kept.count()


def test_row_numbers_of_a_hot_group(spark):
    rows = [("hot", i * 3) for i in range(1000)] + [("cold", i * 7) for i in range(5)]
    frame = spark.createDataFrame(rows, "g STRING, k BIGINT").repartition(5)
    got = numbering.number_rows(frame, "g", "k").collect()
    assert sorted((r.k, r.row_no, r.total) for r in got if r.g == "hot") == [(i * 3, i + 1, 1000) for i in range(1000)]
    assert max(r.row_no for r in got if r.g == "cold") == 5


def test_row_numbers_of_scattered_and_repeated_keys(spark):
    rows = [("hot", hash(("k", i)) if i % 3 else 7) for i in range(1000)] + [(None, i) for i in range(3)]
    frame = spark.createDataFrame(rows, "g STRING, k BIGINT").repartition(5)
    got = numbering.number_rows(frame, "g", "k").collect()
    hot = sorted((r.row_no, r.k) for r in got if r.g == "hot")
    assert [n for n, _ in hot] == list(range(1, 1001)) and [k for _, k in hot] == sorted(k for _, k in hot)
    assert sorted(r.row_no for r in got if r.g is None) == [1, 2, 3]


def test_members_are_replaced_one_by_one(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("aoc", "one"), ("lee", "two")], "member STRING, text STRING")
    sinks.write_formatted(rows, out)
    sinks.write_formatted(rows.where("member = 'aoc'").withColumn("text", F.lit("new")), out)
    read = {r.member: r.value.strip() for r in spark.read.text(out, wholetext=True).collect()}
    assert "new" in read["aoc"] and "one" not in read["aoc"] and "two" in read["lee"]


def test_appended_rows_carry_the_run(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("aoc", "t")], "site STRING, title STRING")
    for day in ("2024-05-01 01:02:03", "2024-05-02 00:00:00"):
        sinks.append_releases(rows, out, F.lit(day).cast("timestamp"))
    assert sorted(r.run for r in spark.read.parquet(out).collect()) == ["20240501_010203", "20240502_000000"]


def test_saved_tables_are_removed(spark, tmp_path):
    saved = cut_lineage(spark.range(3))
    folder = saved.inputFiles()[0].removeprefix("file:").lstrip("/").rsplit("/", 1)[0]
    assert os.path.isdir(f"/{folder}") and drop_saved(spark) >= 1
    assert not os.path.isdir(f"/{folder}") and drop_saved(spark) == 0


def test_pages_without_a_site_are_told(spark):
    base = {p.site: p.base_url for p in SITES}["lee"]
    addresses = [base, "http://bad host/|x", "http://[broken", None, "https://unknown.org/", ""]
    frame = spark.createDataFrame([(u, "") for u in addresses], "url STRING, html STRING")
    profiles = site_profiles(spark)
    assert [r.url for r in with_site(frame, profiles).collect()] == [base]
    reasons = {r.url: r.reason for r in unplaced(frame, profiles).collect()}
    assert len(reasons) == 5 and reasons[None] == "no address" and reasons["https://unknown.org/"] == "unknown host"
    assert reasons["http://[broken"] == reasons["http://bad host/|x"] == "malformed"


def test_listing_addresses(spark):
    profiles = site_profiles(spark)
    with pytest.raises(Exception, match="no last listing page given for"):
        links.listing_pages(profiles).collect()
    got = {(r.site, r.page_no): r.url for r in links.listing_pages(profiles.where("page_cap IS NOT NULL")).collect()}
    assert len(got) == 92 + 119 + 298 + 425
    assert {r.site for r in links.listing_pages(profiles, 2).collect()} == {p.site for p in SITES}
    base = {p.site: p.base_url for p in SITES}
    assert got["hawley", 1] == base["hawley"] and got["hawley", 2] == base["hawley"] + "/page/2/?et_blog"
    assert got["lee", 3] == base["lee"] + "?page=3"
    assert got["manchin", 1] == base["manchin"] + "?PageNum_rs=1"
    assert got["sanders", 1] == base["sanders"] and got["sanders", 425] == base["sanders"] + "/425/"


@pytest.fixture()
def member_folder(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "aoc.txt").write_text("Title: a\n\nteh one\n\n==\nTitle: b\n\n==\n\nTitle: c\n\n==\n", encoding="utf-8")
    (folder / "lee.x.txt").write_text("Title: d\n\n==\n\nTitle: e\n\n==\n\n", encoding="utf-8")
    return str(folder)


def test_release_files(spark, member_folder):
    tolerant = corpus.read_releases(spark, member_folder)
    assert sorted((r.member, r.text) for r in tolerant.collect()) == [
        ("aoc", "Title: a\n\nteh one"), ("aoc", "Title: b"), ("aoc", "Title: c"), ("lee", "Title: d"), ("lee", "Title: e"),
    ]
    strict = corpus.read_releases(spark, member_folder, strict=True)
    for name in os.listdir(member_folder):
        whole = open(f"{member_folder}/{name}", encoding="utf-8").read()
        member = name.split(".")[0]
        got = sorted(r.text for r in strict.where(F.col("member") == member).collect())
        assert got == sorted(whole.split("\n\n==\n\n"))


def test_normalised_corpus_round_trip(spark, member_folder, tmp_path):
    dictionary = spark.createDataFrame([("the", 9), ("title", 5), ("one", 3)], "word STRING, freq BIGINT")
    out = str(tmp_path / "out")
    normalise_corpus(spark, member_folder, dictionary, out)
    files = sorted(glob.glob(f"{out}/member=aoc/part-*"))
    whole = "".join(open(f, encoding="utf-8").read() for f in files)
    assert whole.startswith("Title : a\n\nthe one\n\n==\n\n") and whole.count("\n\n==\n\n") == 3


def test_chunked_files(spark, tmp_path):
    rows = spark.range(2500).select(F.lit("m").alias("member"), "id", F.col("id").cast("string").alias("text"))
    out = str(tmp_path / "out")
    sinks.write_formatted(rows.coalesce(1), out, order=("id",))
    files = glob.glob(f"{out}/member=m/part-*")
    counts = [open(f).read().count("\n\n==\n\n") for f in files]
    assert sum(counts) == 2500 and max(counts) <= 1000


def test_append_keeps_earlier_records(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.createDataFrame([("aoc", "Title: x\n\n==\n")], "site STRING, record STRING")
    sinks.append_records(rows, out)
    sinks.append_records(rows, out)
    whole = "".join(open(f).read() for f in glob.glob(f"{out}/site=aoc/part-*"))
    assert whole == "Title: x\n\n==\n" * 2


def test_crawl_from_pages(spark):
    base = {p.site: p.base_url for p in SITES}["hawley"]
    item = '<article class="et_pb_post"><h2 class="entry-title"><a href="{}">t</a></h2></article>'
    page = '<h1 class="entry-title"> T </h1><div class="et_pb_post_content"><p>a</p>b</div>'
    pages = [
        (base, item.format("/one") + item.format("https://other.org/two") + item.format("/gone")),
        (base + "/page/2/?et_blog", ""), (base + "/page/3/?et_blog", '<article class="et_pb_post"><h2 class="entry-title"><a>x</a></h2></article>'),
        (base + "/page/4/?et_blog", "none"), (base + "/page/5/?et_blog", item.format("/late")),
        ("https://www.hawley.senate.gov/one", page), ("https://other.org/two", page.replace("T", "U")),
    ]
    frame = spark.createDataFrame(pages, "url STRING, html STRING")
    profiles = site_profiles(spark)
    frontier = links.listing_pages(profiles, 5).where("site = 'hawley'")
    got = {r.url: r for r in releases_of(frame, profiles, frontier).collect()}
    assert set(got) == {"https://www.hawley.senate.gov/one", "https://other.org/two", "https://www.hawley.senate.gov/gone"}
    assert got["https://www.hawley.senate.gov/one"].title == "T"
    assert got["https://www.hawley.senate.gov/one"].content == "a\nb"
    assert got["https://other.org/two"].title == "U"
    assert got["https://www.hawley.senate.gov/gone"].error == (
        "Error: Timeout occurred while loading https://www.hawley.senate.gov/gone"
    )
    twice = releases_of(frame.union(frame).union(spark.createDataFrame([(base, "old")], frame.schema)), profiles, frontier)
    assert twice.count() in (0, 3) and twice.count() == twice.select("url").distinct().count()
    twice = releases_of(frame.union(frame), profiles, frontier)
    assert sorted(twice.collect(), key=lambda r: r.url) == sorted(got.values(), key=lambda r: r.url)
    assert releases.count_releases(releases_of(frame, profiles, frontier)).first().n_releases == 3


def test_crawl_of_whole_pages_under_robots_rules(spark):
    """Given pages in full at the addresses of their own links; a blocked listing, a blocked link, repeated captures."""
    base = {p.site: p.base_url for p in SITES}["markey"]
    given = [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").collect()]
    hrefs = iter(dict.fromkeys(h for g in given for h in re.findall(r'<li><a href="(/[A-Za-z]{4,})">', g)))
    listed = [[next(hrefs) for _ in range(3)] for _ in range(3)]
    home = "https://www.markey.senate.gov"
    whole = dict(zip([home + h for hs in listed for h in hs], given))
    item = '<a class="ArticleBlock__title__link" href="{}">t</a>'
    pages = [(f"{base}{n}", "".join(map(item.format, hs))) for n, hs in enumerate(listed)]
    pages += [(url, f'<div class="RawHTML">{page}</div>') for url, page in whole.items()]
    frame = spark.createDataFrame(pages, "url STRING, html STRING")
    frontier = spark.createDataFrame([("markey", n, f"{base}{n}") for n in range(3)], "site STRING, page_no INT, url STRING")
    blocked = listed[0][1]
    text = f"User-agent: *\nDisallow: /news/press-releases?pagenum_rs=2\nDisallow: {blocked}\n"
    files = spark.createDataFrame([("markey", text), ("hawley", "User-agent: *\nDisallow: /\n")], "site STRING, text STRING")
    profiles = site_profiles(spark)
    rows = releases_of(frame.union(frame), profiles, frontier, files).collect()
    assert sorted(r.url for r in rows) == sorted(home + h for hs in listed[:2] for h in hs if h != blocked)
    for r in rows:
        texts = re.findall(r">([^<>&]*\w[^<>&]*)", re.search(r"</h1>(.*)</article>", whole[r.url], re.S)[1])
        content = " ".join(r.content.split())
        assert r.error is None and texts and all(" ".join(t.split()) in content for t in texts)
    free = releases_of(frame, profiles, frontier).select("url").collect()
    assert sorted(r.url for r in free) == sorted(whole)
