"""URL filters by a temporal list join.

List entries are dated: from a time on a pattern is listed, or no longer.  They
become intervals in which the pattern is listed.  A capture is judged by the
intervals that hold at its own fetch time.  A pattern is a host, which covers
its subdomains, or a host with the first directories of a path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.common import named, table
from pressloom.session import cut_lineage

#: Longer names are no hosts.
LONGEST_HOST = 253


def host(url: Column) -> Column:
    """The host in lower case, null where there is none."""
    name = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    name = F.regexp_replace(name, r"\.$", "")
    return F.when((F.length(name) > 0) & (F.length(name) <= LONGEST_HOST), name)


def directories(url: Column) -> Column:
    """Path segments that another one or a slash follows."""
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    parts = F.split(path, "/")
    return F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))


def intervals(entries: DataFrame, pattern: str = "pattern", at: str = "at", listed: str = "listed") -> DataFrame:
    """``pattern_ from_ until_``: when each pattern is listed; ``until_`` is null for still.

    Of entries for one pattern and time, a listing wins.  Entries without a
    pattern or time say nothing.  Repeated entries count once, so a window
    holds the different times of one pattern.
    """
    said = entries.where(F.col(pattern).isNotNull() & F.col(at).isNotNull()).groupBy(
        F.lower(pattern).alias("pattern_"), F.col(at).cast("timestamp").alias("from_")
    ).agg(F.max(F.coalesce(F.col(listed), F.lit(False))).alias("listed_"))
    after = F.lead("from_").over(Window.partitionBy("pattern_").orderBy("from_"))
    return said.withColumn("until_", after).where("listed_").select("pattern_", "from_", "until_")


def _month(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time)


def matched(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", **columns: str) -> DataFrame:
    """``url_ fetched_ n_entries pattern``: the captures that are listed at their time, each url and time once.

    ``pattern`` is the longest.  Intervals stand in each month they touch, from
    the first capture's to the last one's, so a capture meets those of its month
    only, however long the history.  The intervals are saved here, and a number
    of theirs and the captures' first and last months come to the driver.
    """
    valid = cut_lineage(intervals(entries, **columns))
    different = captures.select(F.col(url).alias("url_"), F.col(fetched).cast("timestamp").alias("fetched_")).where(
        "url_ IS NOT NULL AND fetched_ IS NOT NULL").distinct()
    depth = valid.agg(F.max(F.size(F.split("pattern_", "/"))).alias("n")).first().n
    seen = different.agg(F.min(_month(F.col("fetched_"))).alias("first"), F.max(_month(F.col("fetched_"))).alias("last")).first()
    begin = F.greatest(_month(F.col("from_")), F.lit(seen.first))
    end = F.least(F.coalesce(_month(F.col("until_")), F.lit(seen.last)), F.lit(seen.last))
    months = F.when(begin <= end, F.sequence(begin, end))
    placed = valid.withColumn("month_", F.explode(months))
    labels = F.split("host_", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    # No deeper than the deepest pattern.
    prefixes = F.transform(
        F.slice("path_", F.lit(1), F.lit(max(0, (depth or 1) - 1))),
        lambda part, i: F.concat_ws("/", "host_", F.slice("path_", F.lit(1), i + 1)))
    keys = different.withColumns({"host_": host(F.col("url_")), "path_": directories(F.col("url_"))}).where(
        "host_ IS NOT NULL").select(
        "url_", "fetched_", _month(F.col("fetched_")).alias("in_"),
        F.explode(F.array_distinct(F.concat(suffixes, F.transform(prefixes, F.lower)))).alias("key_"))
    active = (
        (F.col("key_") == F.col("pattern_")) & (F.col("in_") == F.col("month_")) & (F.col("from_") <= F.col("fetched_"))
        & (F.col("until_").isNull() | (F.col("fetched_") < F.col("until_")))
    )
    return keys.join(placed, active).groupBy("url_", "fetched_").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.max(F.struct(F.length("pattern_").alias("n"), F.col("pattern_").alias("p")))["p"].alias("pattern"))


def judged(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched_at", **columns: str) -> DataFrame:
    """``captures`` with ``blocked n_entries pattern``.

    Captures without a url, a host or a time match nothing.  Repeated rows get
    equal verdicts.  Columns of these names are replaced.
    """
    found = matched(captures, entries, url, fetched, **columns)
    kept = [c for c in captures.columns if c not in ("blocked", "n_entries", "pattern")]
    packed = captures.select(F.struct(*named(kept)).alias("row_"), F.col(url).alias("own_"), F.col(fetched).cast("timestamp").alias("time_"))
    met = packed.join(found, (F.col("own_") == F.col("url_")) & (F.col("time_") == F.col("fetched_")), "left")
    return met.select(
        "row_.*", F.col("n_entries").isNotNull().alias("blocked"),
        F.coalesce("n_entries", F.lit(0)).cast("bigint").alias("n_entries"), "pattern")


def allowed(captures: DataFrame, entries: DataFrame, **columns: str) -> DataFrame:
    """``captures`` that are not blocked."""
    return judged(captures, entries, **columns).where(~F.col("blocked")).select(*captures.columns)


def _number(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 6), 16, 10).cast("int")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), number.cast("int"))


def dated_lists(pages: DataFrame) -> DataFrame:
    """Entries for hosts, first directories and domains of the pages, dated by their hashes."""
    seen = pages.select(host(F.col("url")).alias("h"), F.get(directories(F.col("url")), 0).alias("d")).where("h IS NOT NULL").distinct()
    hosts = seen.select(F.col("h").alias("pattern")).distinct().withColumn("n", _number(F.col("pattern")))
    paths = seen.where("d IS NOT NULL").select(F.lower(F.concat_ws("/", "h", "d")).alias("pattern")).distinct()
    paths = paths.withColumn("n", _number(F.col("pattern")))
    domains = hosts.select(F.substring_index("pattern", ".", -2).alias("pattern")).distinct().withColumn(
        "n", _number(F.col("pattern")))

    def said(rows: DataFrame, when: str, day: str, listed: bool) -> DataFrame:
        return rows.where(when).select("pattern", _day(F.expr(day)).alias("at"), F.lit(listed).alias("listed"))

    return (
        said(hosts, "n % 4 = 0", "n % 400", True).unionAll(said(hosts, "n % 8 = 0", "n % 400 + 100", False))
        .unionAll(said(hosts, "n % 16 = 0", "n % 400 + 200", True))
        .unionAll(said(paths, "n % 5 = 0", "n % 300", True)).unionAll(said(paths, "n % 10 = 0", "n % 300 + 50", False))
        .unionAll(said(domains, "n % 2 = 0", "600 + n % 100", True))
    )


def op5_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page against the list entries active on the day it was fetched."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", _day(_number(F.col("page_id").cast("string")) % 730).alias("fetched_at"))
    return judged(pages, dated_lists(pages)).select("page_id", "fetched_at", "blocked", "n_entries", "pattern")


OP5_SQL = r"""
WITH p AS (
    SELECT page_id, url, DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 6))::INT % 730 AS INT) AS fetched_at,
           nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS h,
           string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)', 1), '/')[2:-2] AS dirs
    FROM pages
), hosts AS (SELECT DISTINCT h AS pattern, ('0x' || substr(md5(h), 1, 6))::INT AS n FROM p WHERE h IS NOT NULL
), dirs AS (
    SELECT DISTINCT lower(h || '/' || dirs[1]) AS pattern, ('0x' || substr(md5(lower(h || '/' || dirs[1])), 1, 6))::INT AS n
    FROM p WHERE h IS NOT NULL AND len(dirs) > 0
), domains AS (
    SELECT DISTINCT d AS pattern, ('0x' || substr(md5(d), 1, 6))::INT AS n
    FROM (SELECT array_to_string(string_split(pattern, '.')[-2:], '.') AS d FROM hosts)
), said AS (
    SELECT pattern, n % 400 AS day, TRUE AS listed FROM hosts WHERE n % 4 = 0
    UNION ALL SELECT pattern, n % 400 + 100, FALSE FROM hosts WHERE n % 8 = 0
    UNION ALL SELECT pattern, n % 400 + 200, TRUE FROM hosts WHERE n % 16 = 0
    UNION ALL SELECT pattern, n % 300, TRUE FROM dirs WHERE n % 5 = 0
    UNION ALL SELECT pattern, n % 300 + 50, FALSE FROM dirs WHERE n % 10 = 0
    UNION ALL SELECT pattern, 600 + n % 100, TRUE FROM domains WHERE n % 2 = 0
), once AS (SELECT pattern, DATE '2024-01-01' + CAST(day AS INT) AS since, bool_or(listed) AS listed FROM said GROUP BY ALL
), valid AS (
    SELECT * FROM (SELECT *, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS until FROM once) WHERE listed
), keyed AS (
    SELECT page_id, fetched_at, unnest(list_distinct(list_concat(
        list_transform(range(1, len(string_split(h, '.')) + 1), lambda i: array_to_string(string_split(h, '.')[i:], '.')),
        CASE WHEN len(dirs) > 0 THEN [lower(h || '/' || dirs[1])] ELSE []::VARCHAR[] END))) AS key
    FROM p WHERE h IS NOT NULL
), hit AS (
    SELECT page_id, count(*) AS n, arg_max(pattern, (length(pattern), pattern)) AS pattern
    FROM keyed JOIN valid ON key = pattern AND since <= fetched_at AND (until IS NULL OR fetched_at < until) GROUP BY page_id
)
SELECT p.page_id, p.fetched_at, n IS NOT NULL AS blocked, coalesce(n, 0) AS n_entries, pattern
FROM p LEFT JOIN hit USING (page_id)
"""
