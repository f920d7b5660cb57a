"""Release pages to release rows, and release rows to text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions import html
from pressloom.functions.content import NO_CONTENT, by_mode
from pressloom.functions.text import let
from pressloom.operators.selectors import broken_path, field_text, locate
from pressloom.profiles import SiteProfile, profile_rows
from pressloom.session import built_once

RECORD_END = "\n\n==\n"
NO_TITLE = "No title found"
NO_DATE = "No date found"


# The messages of error rows, before the address.
MESSAGES = {
    "missing": "Error: Timeout occurred while loading ",
    "broken": "Error: An error occurred while scraping ",
}


def failure(reason: str, url: Column) -> Column:
    """Error text of a release that could not be read."""
    return F.concat(F.lit(MESSAGES[reason]), url)


@built_once
def _page_fields() -> Column:
    """All fields of a page, from its markup and the profile columns beside it."""
    return let(html.page_of("html", "p_mode"), _fields)


def _fields(doc: Column) -> Column:
    profile = F.col
    content = let(
        locate(doc, profile("selectors"), "content"),
        lambda hit: F.when(
            hit.node.isNotNull() | (profile("content_mode") == "page_fallback"),
            by_mode(profile("content_mode"), doc, hit.node, profile("dedupe_text")),
        ),
    )
    return F.struct(
        field_text(doc, profile("selectors"), "title").alias("title"),
        field_text(doc, profile("selectors"), "date").alias("date"),
        field_text(doc, profile("selectors"), "extra").alias("extra"),
        content.alias("content"),
        broken_path(doc, profile("selectors")).alias("broken"),
    )


def extract(pages: DataFrame, profiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """One release row per page of a known site.

    ``pages`` needs ``site``, ``url`` and ``html``; ``keys`` are further page
    columns to keep.  Parsing and selection happen inside the page's row, so
    the plan is a scan, a join with the small profile table and a projection.
    """
    return _read(pages.join(profiles, "site"), keys)


def extract_one(pages: DataFrame, profile: SiteProfile, keys: tuple[str, ...] = ()) -> DataFrame:
    """Release rows of pages that all belong to one site; needs no join."""
    settings = F.get(profile_rows((profile,)), F.lit(0))
    own = pages.select("url", "html", *keys, settings.alias("_profile"))
    return _read(own.select("url", "html", *keys, "_profile.*"), keys)


def _read(pages: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    read = pages.select(
        "site", "url", *keys, "extra_label",
        F.inline(F.array(_page_fields())),
    )
    sound = ~F.col("broken")
    extras = F.map_from_arrays(F.array("extra_label"), F.array("extra"))
    return read.select(
        "site", "url", *keys,
        F.when(sound, F.col("title")).alias("title"),
        F.when(sound, F.col("date")).alias("date"),
        F.when(sound & F.col("extra_label").isNotNull(), extras).alias("extras"),
        F.when(sound, F.col("content")).alias("content"),
        F.when(~sound, failure("broken", F.col("url"))).alias("error"),
    )


def extract_field(pages: DataFrame, build, name: str, keys: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """A single expression over each page; ``build`` maps the page to a value."""
    return pages.select(*keys, let(html.page_of(), build).alias(name))


def one_per_address(releases: DataFrame, rank: Column) -> DataFrame:
    """One release of each site and address: that of the largest rank."""
    fields = [c for c in releases.columns if c not in ("site", "url")]
    best = releases.groupBy("site", "url").agg(F.max_by(F.struct(*fields), rank).alias("_best"))
    return best.select("site", "url", *(F.col(f"_best.{c}").alias(c) for c in fields))


def attach(links: DataFrame, releases: DataFrame) -> DataFrame:
    """Listing links with the release found at their address.

    The releases come already read, so the join moves their text and not the
    markup.  A link without a page is a release too: an error row.
    """
    read = releases.withColumn("captured", F.lit(True))
    joined = links.join(read, ["site", "url"], "left")
    return joined.withColumn(
        "error",
        F.when(F.col("captured").isNull(), failure("missing", F.col("url"))).otherwise(
            F.col("error")
        ),
    ).drop("captured")


def serialise(releases: DataFrame, profiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Release rows as text records, missing values spelled out."""
    labels = profiles.select("site", "extra_label", "extra_default")
    label = F.col("extra_label")
    extra = F.when(
        label.isNotNull(),
        F.concat(
            F.lit("\n"), label, F.lit(": "),
            F.coalesce(F.col("extras")[label], F.col("extra_default")),
        ),
    ).otherwise("")
    record = F.concat(
        F.lit("Title: "), F.coalesce("title", F.lit(NO_TITLE)),
        F.lit("\nDate: "), F.coalesce("date", F.lit(NO_DATE)), extra,
        F.lit("\n\nContent:\n"), F.coalesce("content", F.lit(NO_CONTENT)),
    )
    return releases.join(labels, "site").select(
        "site", *keys,
        F.concat(F.coalesce(F.col("error"), record), F.lit(RECORD_END)).alias("record"),
    )


def in_order(releases: DataFrame) -> DataFrame:
    """Site, listing page, position on it: the order records are written in."""
    return releases.orderBy("site", "page_no", "link_pos")


def count_releases(releases: DataFrame) -> DataFrame:
    """Releases per site, error rows included."""
    return releases.groupBy("site").agg(F.count("*").alias("n_releases"))

