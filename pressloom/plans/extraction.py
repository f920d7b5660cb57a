"""From captured pages to releases in listing order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.operators import crawl, links, releases, robots
from pressloom.operators.prefilter import may_meet
from pressloom.session import cut_lineage
from pressloom.sources.pages import with_site


#: Pages of each site that the first round reads, and how many times as far each further round goes.
ROUND_PAGES, ROUND_GROWTH = 512, 8


def crawl_links(
    pages: DataFrame, profiles: DataFrame, frontier: DataFrame, robots_files: DataFrame | None = None, user_agent: str = "*"
) -> DataFrame:
    """Links a run would follow: robots rules, page limits and stop rules applied.

    A listing page that the rules block counts as empty, so it can end a crawl;
    its markup is not read.  Nor is that of pages beyond the page limits.

    As a run does, this reads a site's listing pages from the first on until
    the site has stopped or has no more, all sites side by side, in rounds of
    growing width; no page is read twice.  Whether a page ends a site depends
    on earlier pages only, so the cut is that of all pages.
    """
    ranged = crawl.in_range_by_profile(frontier, profiles)
    begin = ranged.groupBy(F.col("site").alias("_site")).agg(F.min("page_no").alias("_begin"))
    ranged = cut_lineage(
        ranged.join(begin, F.col("site") == F.col("_site")).withColumn("_at", F.col("page_no") - F.col("_begin")).drop("_site", "_begin"))
    unread, rules = ranged, None
    if robots_files is not None:
        guarded = profiles.where("robots").select("site")
        rules = robots.saved_rules(robots_files.join(guarded, "site", "left_semi"), user_agent)
        unread = cut_lineage(robots.permitted_by(ranged, rules))
    rounds, end = [], ROUND_PAGES
    while True:
        rounds.append(_found(pages, profiles, unread.where(F.col("_at") < end), rules))
        found = union_runs(*rounds)
        # All votes for these pages are in; those for pages further on may not be.
        known = ranged.where(F.col("_at") < end)
        stops = crawl.stop_by_profile(links.page_stats(known, found), profiles)
        stopped = known.select("site", F.col("page_no").alias("stop_page")).join(stops, ["site", "stop_page"], "left_semi")
        further = cut_lineage(unread.where(F.col("_at") >= end).join(stopped, "site", "left_anti"))
        nearest = further.agg(F.min("_at")).first()[0]
        if nearest is None:
            break
        unread, end = further, max(end, nearest) * ROUND_GROWTH
    reached = crawl.cut_by_profile(links.page_stats(ranged, found), profiles).select("site", "page_no")
    return found.join(reached, ["site", "page_no"], "left_semi")


def _found(pages: DataFrame, profiles: DataFrame, listings: DataFrame, rules: DataFrame | None) -> DataFrame:
    """Links on these listing pages that may be read; saved here, since they are counted, cut and followed."""
    found = cut_lineage(links.discover(listings.join(latest_capture(pages, listings), "url"), profiles))
    return found if rules is None else cut_lineage(robots.permitted_by(found, rules))


def latest_capture(pages: DataFrame, frontier: DataFrame) -> DataFrame:
    """One capture of each wanted page: url, html.

    Of different captures the one with the largest checksum counts, whatever
    the order they come in; there is no time in a page.
    """
    found = captured(pages, frontier)
    return found.groupBy("url").agg(F.max_by("html", F.md5("html")).alias("html"))


def captured(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Captures of the wanted addresses; others leave where they are read, before any markup moves.

    The addresses are distinct, so the join behind the filter repeats no page.
    Were it a semi join, Catalyst would move it before the filter.
    """
    targets = cut_lineage(wanted.select("url").distinct())
    return may_meet(pages.select("url", "html"), targets, "url").join(targets, "url").select("url", "html")


def releases_of(
    pages: DataFrame, profiles: DataFrame, frontier: DataFrame, robots_files: DataFrame | None = None, user_agent: str = "*"
) -> DataFrame:
    """One release row for every followed link, an error row if its page was not captured.

    Followed addresses are saved first; pages nobody follows leave by a Bloom
    filter in the scan, and are not parsed.  Of several captures of a page one
    is used, and only that one is parsed (see ``latest_capture``).  Only fields
    are joined with the links.  Links to other hosts fetch their pages by
    address.  Jobs run here.
    """
    followed = crawl_links(pages, profiles, frontier, robots_files, user_agent)
    # Small beside the markup; as tables they tell the planner so.
    followed = cut_lineage(followed)
    away = cut_lineage(foreign_targets(followed, profiles))
    # Only pages that are followed are parsed, and one capture of each; saved, as it is used twice.
    wanted = cut_lineage(latest_capture(pages, followed)).withColumn("capture", F.md5("html"))
    columns = ("site", "url", "html", "capture")
    placed = with_site(wanted, profiles).select(*columns).unionByName(wanted.join(away, "url").select(*columns))
    read = releases.one_per_address(releases.extract(placed, profiles, keys=("capture",)), F.col("capture"))
    return releases.attach(followed, read).select(
        "site", "page_no", "link_pos", "url", "title", "date", "extras", "content", "error"
    )


def foreign_targets(followed: DataFrame, profiles: DataFrame) -> DataFrame:
    """Distinct followed addresses on another host than their site's."""
    hosts = profiles.select("site", F.try_parse_url("base_url", F.lit("HOST")).alias("_home"))
    away = followed.join(hosts, "site").where(
        ~F.col("_home").eqNullSafe(F.try_parse_url("url", F.lit("HOST")))
    )
    return away.select("site", "url").distinct()


def records_of(release_rows: DataFrame, profiles: DataFrame) -> DataFrame:
    return releases.serialise(release_rows, profiles, keys=("page_no", "link_pos"))


def union_runs(*runs: DataFrame) -> DataFrame:
    """Releases of several runs as one table."""
    whole = runs[0]
    for run in runs[1:]:
        whole = whole.unionByName(run)
    return whole
