"""A crawl reads the listings a run would reach, in rounds, and one capture of each page."""

import pytest

from pressloom.operators import crawl, links, releases
from pressloom.plans import extraction
from pressloom.profiles import SITES, site_profiles

BASE = {p.site: p.base_url for p in SITES}
ITEM = {
    "hawley": '<article class="et_pb_post"><h2 class="entry-title"><a href="{}">t</a></h2></article>',
    "stefanik": '<table><tr><td class="recordListTitle"><a href="{}">t</a></td></tr></table>',
}


def listings(spark, profiles, empty, last=130):
    """Listing pages of two sites, each with one link but for the empty ones, and their addresses; one page is listed twice."""
    frontier = links.listing_pages(profiles.drop("page_cap").selectExpr("*", "CAST(NULL AS INT) AS page_cap"), last).where(
        "site IN ('hawley', 'stefanik')")
    frontier = frontier.union(frontier.where("page_no = 4"))
    rows = [
        (r.url, ITEM[r.site].format(f"/{r.site}/{r.page_no}") if r.page_no not in empty[r.site] else "none") for r in frontier.collect()
    ]
    return spark.createDataFrame(rows, "url STRING, html STRING"), frontier


def whole(pages, profiles, frontier):
    """The same links from all listing pages at once."""
    read = frontier.join(extraction.latest_capture(pages, frontier), "url")
    found = links.discover(read, profiles)
    reached = crawl.cut_by_profile(links.page_stats(frontier, found), profiles)
    return found.join(reached.select("site", "page_no"), ["site", "page_no"], "left_semi")


@pytest.mark.parametrize(
    "empty",
    [
        {"hawley": (), "stefanik": ()}, {"hawley": (7, 8, 9), "stefanik": (8,)}, {"hawley": (7, 8, 10, 15, 16, 17), "stefanik": (9,)},
        {"hawley": (1, 2, 3), "stefanik": (1,)}, {"hawley": (3, 4, 90, 91, 92), "stefanik": (4, 100)},
    ],
)
def test_rounds_cut_as_all_pages_at_once_do(spark, monkeypatch, empty):
    monkeypatch.setattr(extraction, "ROUND_PAGES", 8, raising=False)
    monkeypatch.setattr(extraction, "ROUND_GROWTH", 2, raising=False)
    profiles = site_profiles(spark)
    pages, frontier = listings(spark, profiles, empty)
    columns = ("site", "page_no", "link_pos", "href", "url")
    got = extraction.crawl_links(pages, profiles, frontier).select(*columns).collect()
    assert sorted(got) == sorted(whole(pages, profiles, frontier).select(*columns).collect())


def test_pages_past_the_stop_and_the_cap_are_not_parsed(spark, monkeypatch):
    monkeypatch.setattr(extraction, "ROUND_PAGES", 64, raising=False)
    profiles = site_profiles(spark)
    pages, frontier = listings(spark, profiles, {"hawley": (), "stefanik": (20,)})
    read, discover = [], links.discover

    def spy(rows, *more):
        read.extend((r.site, r.page_no) for r in rows.select("site", "page_no").distinct().collect())
        return discover(rows, *more)

    monkeypatch.setattr(links, "discover", spy)
    got = extraction.crawl_links(pages, profiles, frontier).select("site", "page_no").distinct().collect()
    assert sorted(read) == [("hawley", n) for n in range(1, 93)] + [("stefanik", n) for n in range(1, 65)]
    assert sorted(map(tuple, got)) == [("hawley", n) for n in range(1, 93)] + [("stefanik", n) for n in range(1, 20)]


def test_one_capture_of_an_address_is_parsed(spark, monkeypatch):
    profiles = site_profiles(spark)
    page = '<h2 class="title">{}</h2><div class="content"><p>x</p></div>'
    rows = [(f"{BASE['stefanik']}?page=1", ITEM["stefanik"].format("/one") + ITEM["stefanik"].format("/null"))]
    rows += [("https://stefanik.house.gov/one", page.format(n)) for n in range(20)] + [("https://stefanik.house.gov/null", None)] * 2
    pages = spark.createDataFrame(rows, "url STRING, html STRING")
    frontier = links.listing_pages(profiles, 1).where("site = 'stefanik'")
    parsed, extract = [], releases.extract

    def spy(rows, *more, **named):
        parsed.extend(r.url for r in rows.select("url").collect())
        return extract(rows, *more, **named)

    monkeypatch.setattr(releases, "extract", spy)
    got = {r.url: r for r in extraction.releases_of(pages, profiles, frontier).collect()}
    assert sorted(parsed) == ["https://stefanik.house.gov/null", "https://stefanik.house.gov/one"]
    best = pages.where("url LIKE '%/one'").selectExpr("max_by(html, md5(html)) AS html").first().html
    assert page.format(got["https://stefanik.house.gov/one"].title) == best
    assert [got["https://stefanik.house.gov/null"][c] for c in ("title", "content", "error")] == [None] * 3
