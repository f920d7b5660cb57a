"""The stop rules over listings that arrive bit by bit, in any order.

What is known lies in a table of runs, one a micro-batch: the pages with their
numbers of releases, and for pages that could end a run of empty ones, how
many of the run are known to be empty.  A batch adds its own and looks up only
those it touches.  A batch that is repeated after a failure finds its run
there and adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressloom.operators import crawl
from pressloom.operators.links import listing_counts
from pressloom.session import cut_lineage
from pressloom.sources import ledger

PAGES = "site STRING, page_no BIGINT, n_releases BIGINT"
VOTES = "site STRING, page_no BIGINT, votes BIGINT"
STOPS = "site STRING, stop_page BIGINT"


def stops(spark: SparkSession, path: str) -> DataFrame:
    """Per site the page that ended its crawl, as far as is known: site, stop_page."""
    return ledger.read(spark, path, "stops", STOPS).groupBy("site").agg(F.min("stop_page").alias("stop_page"))


def reached(spark: SparkSession, path: str) -> DataFrame:
    """Known pages before the site's stopping page: site, page_no, n_releases."""
    pages = ledger.read(spark, path, "pages", PAGES)
    return pages.join(stops(spark, path), "site", "left").where(
        F.col("stop_page").isNull() | (F.col("page_no") < F.col("stop_page"))).drop("stop_page")


def merge(counts: DataFrame, profiles: DataFrame, path: str, run: str) -> None:
    """Add a batch of listing pages (site, page_no, n_releases).

    A page counts once, as it was when it first came; of several captures in
    one batch the one with the most releases.  Pages outside their site's range
    are left out.
    """
    spark = counts.sparkSession
    if ledger.is_committed(spark, path, run):
        return
    ledger.clear(spark, path)
    rules = profiles.select("site", "first_page", "page_cap", "stop_after")
    known = ledger.read(spark, path, "pages", PAGES)
    batch = crawl.in_range(counts.join(rules, "site")).groupBy("site", "page_no").agg(
        F.max("n_releases").cast("bigint").alias("n_releases"))
    fresh = cut_lineage(
        batch.withColumn("page_no", F.col("page_no").cast("bigint")).join(known.select("site", "page_no"), ["site", "page_no"], "left_anti"))
    # Beyond a known stop nothing can end the crawl any earlier.
    before = stops(spark, path)
    open_pages = fresh.join(before, "site", "left").where("stop_page IS NULL OR page_no < stop_page").drop("stop_page")
    votes = cut_lineage(crawl.votes(open_pages.join(rules.select("site", "stop_after"), "site")))
    touched = ledger.read(spark, path, "votes", VOTES).join(votes.select("site", "page_no"), ["site", "page_no"], "left_semi")
    total = touched.unionByName(votes.select("site", "page_no", "votes")).groupBy("site", "page_no").agg(F.sum("votes").alias("votes"))
    ends = total.join(rules.select("site", "stop_after"), "site").where(F.col("votes") == F.col("stop_after"))
    ledger.stage(
        path, run, pages=fresh, votes=votes.select("site", "page_no", "votes"),
        stops=ends.groupBy("site").agg(F.min("page_no").alias("stop_page")))
    ledger.commit(spark, path, run)


def cut_stream(listings: DataFrame, profiles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Count the links of arriving listing pages (site, page_no, html) and keep the stops up to date."""
    return (
        listing_counts(listings, profiles)
        .writeStream.foreachBatch(lambda batch, number: merge(batch, profiles, path, f"batch-{number}"))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
