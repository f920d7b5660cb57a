"""Crawl cuts: which listing pages a run would have reached."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def votes(stats: DataFrame) -> DataFrame:
    """For pages that could end a run of empty ones, how many of the run are empty: site, page_no, stop_after, votes.

    ``stats`` has one row per page and the length of the run that stops the
    site in ``stop_after``.  Each empty page votes for the pages whose run it
    could belong to.
    """
    empty = stats.where(F.col("n_releases") == 0)
    last = F.col("page_no") + F.col("stop_after") - 1
    each = empty.select(
        "site", "stop_after", F.explode(F.sequence(F.col("page_no"), last)).alias("page_no")
    )
    return each.groupBy("site", "page_no", "stop_after").agg(F.count("*").alias("votes"))


def first_stop(stats: DataFrame) -> DataFrame:
    """Per site, the page that completes the first run of empty pages.

    A page with all votes ends a run.  Votes are grouped by site *and* page and
    the site minimum is taken from partial minima, so no task ever holds a
    whole site.
    """
    ends = votes(stats).where(F.col("votes") == F.col("stop_after"))
    return ends.groupBy("site").agg(F.min("page_no").alias("stop_page"))


def cut(stats: DataFrame, stop_after: int | None = None) -> DataFrame:
    """Pages before the site's stopping page; all pages where it never stops.

    ``stop_after`` is the run length for every site; without it the column of
    that name decides.
    """
    if stop_after is not None:
        stats = stats.withColumn("stop_after", F.lit(stop_after))
    return (
        stats.join(first_stop(stats), "site", "left")
        .where(F.col("stop_page").isNull() | (F.col("page_no") < F.col("stop_page")))
        .drop("stop_page", "stop_after")
    )


def cut_by_profile(stats: DataFrame, profiles: DataFrame) -> DataFrame:
    """Range limit and stop rule of each site's profile, applied together."""
    return cut(_ruled(stats, profiles))


def stop_by_profile(stats: DataFrame, profiles: DataFrame) -> DataFrame:
    """``first_stop`` within the range limit and by the stop rule of each site's profile."""
    return first_stop(_ruled(stats, profiles))


def _ruled(stats: DataFrame, profiles: DataFrame) -> DataFrame:
    rules = profiles.select("site", "first_page", "page_cap", "stop_after")
    return in_range(stats.join(rules, "site")).drop("first_page", "page_cap")


def in_range(stats: DataFrame) -> DataFrame:
    """Pages between the first page and the cap in the row; no cap means no end."""
    return stats.where(_in_range())


def in_range_by_profile(pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """Pages within the range limit of their site's profile."""
    limits = profiles.select(F.col("site").alias("_site"), "first_page", "page_cap")
    return pages.join(limits, (F.col("site") == F.col("_site")) & _in_range(), "left_semi")


def _in_range() -> Column:
    page = F.col("page_no")
    return (page >= F.col("first_page")) & (F.col("page_cap").isNull() | (page <= F.col("page_cap")))


def resume(stats: DataFrame, start_page: int) -> DataFrame:
    """What a run restarted at ``start_page`` still has to add."""
    return stats.where(F.col("page_no") >= start_page)
