"""A crawl as it goes: links of arriving listings meet arriving pages.

Either may come first.  A link waits for its page so long, and a page for a
link that was found a little later; what waits is the state, and it is bounded
by those times.  A link whose page does not come in time becomes an error row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.operators import links, releases
from pressloom.sources.pages import with_site


def follow_stream(
    listings: DataFrame, captures: DataFrame, profiles: DataFrame, delay: str = "1 hour", wait: str = "1 day", early: str = "1 day"
) -> DataFrame:
    """Releases as they become known: site, page_no, link_pos, url, title, date, extras, content, error, found_at.

    ``listings`` (site, page_no, html, seen_at) and ``captures`` (url, html,
    captured_at) are streams, which may be late by ``delay``.  A page counts
    for a link if it was captured from ``early`` before to ``wait`` after the
    link was seen; of several captures of an address, as far apart as
    ``delay`` at most, the first to come.  Addresses on other hosts than a
    profile's have no page here.
    """
    found = links.discover(listings.withWatermark("seen_at", delay), profiles, keys=("seen_at",)).withColumnRenamed("seen_at", "found_at")
    read = releases.extract(with_site(captures.withWatermark("captured_at", delay), profiles), profiles, keys=("captured_at",))
    once = read.dropDuplicatesWithinWatermark(["site", "url"]).withColumnsRenamed({"site": "_site", "url": "_url"})
    met = found.join(
        once,
        (F.col("site") == F.col("_site")) & (F.col("url") == F.col("_url"))
        & (F.col("captured_at") >= F.col("found_at") - F.expr(f"INTERVAL {early}"))
        & (F.col("captured_at") <= F.col("found_at") + F.expr(f"INTERVAL {wait}")),
        "leftOuter",
    )
    missing = releases.failure("missing", F.col("url"))
    return met.select(
        "site", "page_no", "link_pos", "url", "title", "date", "extras", "content",
        F.when(F.col("captured_at").isNull(), missing).otherwise(F.col("error")).alias("error"), "found_at",
    )
