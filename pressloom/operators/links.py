"""Listing pages: their addresses, and the links they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import html
from pressloom.functions import select as S
from pressloom.functions.text import let
from pressloom.functions.urls import join_url
from pressloom.operators.selectors import follow, matches
from pressloom.session import built_once


def page_url(page_no: Column) -> Column:
    """Address of a listing page, from the profile columns in scope."""
    numbered = F.concat(
        F.col("base_url"), F.col("page_prefix"), page_no.cast("string"), F.col("page_suffix")
    )
    return F.when(F.col("first_is_base") & (page_no <= 1), F.col("base_url")).otherwise(numbered)


def listing_pages(profiles: DataFrame, last_page: Column | int | None = None) -> DataFrame:
    """All listing pages of every site, up to its cap or to ``last_page``.

    A site that has neither stops the job: where its list ends is not known.
    """
    cap = F.col("page_cap")
    if last_page is not None:
        cap = F.least(cap, last_page if isinstance(last_page, Column) else F.lit(last_page))
    unknown = F.raise_error(F.concat(F.lit("no last listing page given for "), F.col("site"))).cast("int")
    end = F.coalesce(cap.cast("int"), unknown)
    pages = F.when(end >= F.col("first_page"), F.sequence(F.col("first_page"), end))
    numbered = profiles.withColumn("page_no", F.explode(pages))
    return numbered.select("site", "page_no", page_url(F.col("page_no")).alias("url"))


def distinct_first(hrefs: Column) -> Column:
    """Distinct links of one page, each at its first position."""
    return F.array_distinct(hrefs)


def preview(links: Column, size: int = 5) -> Column:
    return F.slice(links, 1, size)


def listing_hrefs(doc: Column, profile=F.col) -> Column:
    """Link targets on a listing page, in order.

    Null when a required target is missing: such a page counts as failed.
    """

    def target(item: Column) -> Column:
        return let(follow(doc, item, profile("link_steps")), lambda a: F.struct(
            a.isNotNull().alias("found"), a.attrs["href"].alias("href")
        ))

    items = F.filter(doc.nodes, lambda n: matches(doc, n, profile("link_item")))
    targets = F.filter(F.transform(items, target), lambda t: t.found)

    def collect(found: Column) -> Column:
        with_href = F.filter(found, lambda t: t.href.isNotNull())
        hrefs = F.transform(with_href, lambda t: t.href)
        failed = profile("href_required") & (F.size(with_href) < F.size(found))
        return F.when(
            ~failed,
            F.when(profile("links_distinct"), distinct_first(hrefs)).otherwise(hrefs),
        )

    return let(targets, collect)


@built_once
def _page_hrefs() -> Column:
    return let(html.page_of("html", "p_mode"), lambda doc: listing_hrefs(doc))


def discover(listings: DataFrame, profiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Links of captured listing pages: site, page_no, link_pos, href, url.

    ``listings`` needs ``site``, ``page_no`` and ``html``; ``keys`` are further
    columns to keep.
    """
    read = listings.join(profiles, "site").select(
        "site", "page_no", *keys, "base_url",
        _page_hrefs().alias("hrefs"),
    )
    return read.select("site", "page_no", *keys, "base_url", F.posexplode("hrefs").alias("pos", "href")).select(
        "site", "page_no", (F.col("pos") + 1).alias("link_pos"), *keys, "href",
        join_url(F.col("base_url"), F.col("href")).alias("url"),
    )


def listing_counts(listings: DataFrame, profiles: DataFrame) -> DataFrame:
    """Links of each captured listing page: site, page_no, n_releases; a failed page has none."""
    hrefs = _page_hrefs()
    count = let(hrefs, lambda found: F.when(found.isNull(), 0).otherwise(F.size(found)))
    return listings.join(profiles, "site").select("site", "page_no", count.cast("bigint").alias("n_releases"))


def nav_links(doc: Column, scope_tag: str = "nav") -> Column:
    """Link targets inside every element of one tag, in document order."""
    scopes = S.find_all(doc.nodes, S.has_tag(scope_tag))
    anchors = F.filter(
        doc.nodes,
        lambda n: S.has_tag("a")(n) & S.has_attr("href")(n)
        & F.exists(scopes, lambda s: S.is_inside(n, s)),
    )
    return F.transform(anchors, lambda a: a.attrs["href"])


def links_per_page(links: DataFrame) -> DataFrame:
    return links.groupBy("site", "page_no").agg(F.count("*").alias("n_links"))


def page_stats(frontier: DataFrame, links: DataFrame) -> DataFrame:
    """Releases per listing page; a page that failed or held none counts as empty."""
    counted = links_per_page(links)
    return frontier.select("site", "page_no").join(counted, ["site", "page_no"], "left").select(
        "site", "page_no", F.coalesce("n_links", F.lit(0)).alias("n_releases")
    )
