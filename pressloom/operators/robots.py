"""Robots rules as data: parse the files, look addresses up by prefix, filter links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressloom.functions.text import let, strip
from pressloom.functions.urls import robots_path
from pressloom.session import cut_lineage


#: A line, and a path, that need no trimming, cutting or decoding; most are.
PLAIN_LINE = r'\A[A-Za-z-]+: ?[!-"$-~]*\z'
PLAIN_PATH = r'\A/([!-"$&-.0->@-~][!-"$&->@-~]*)?\z'
#: Numbers of a file's lines that one block spans; windows see a block each.
BLOCK = 1 << 20


def _lines(robots: DataFrame) -> DataFrame:
    """Lines of each site's file that mean something: blank, agent or rule.

    Files come whole (``site``, ``text``), or by line (``site``, ``no``,
    ``raw``) where they are too long for one value; numbers may have gaps.  Of
    several whole files of a site the one with the largest checksum counts.
    """
    lines = robots
    if "text" in robots.columns:
        one = robots.groupBy("site").agg(F.max_by("text", F.md5("text")).alias("text"))
        lines = one.select("site", F.posexplode(F.split("text", "\r\n|\r|\n")).alias("no", "raw"))
    plain = strip(F.regexp_replace("raw", "#.*$", ""))
    simple, colon = F.rlike("raw", F.lit(PLAIN_LINE)), F.instr("raw", ":")
    name = F.when(simple, F.substring("raw", F.lit(1), colon - 1)).otherwise(strip(F.regexp_extract(plain, "^([^:]*):", 1)))
    value = F.when(simple, F.ltrim(F.substring("raw", colon + 1, F.length("raw")))).otherwise(
        strip(F.regexp_extract(plain, "^[^:]*:(.*)$", 1)))
    # Catalyst does not work out again what a generator made.
    named = lines.select(
        "site", F.col("no").cast("bigint").alias("no"), (F.col("raw") == "").alias("blank"),
        F.inline(F.array(F.struct(F.lower(name).alias("name"), value.alias("value")))),
    )
    # Delay and rate lines end a list of agents as rules do.
    rule = F.col("name").isin("allow", "disallow", "crawl-delay", "request-rate")
    typed = named.withColumns({"agent": F.col("name") == "user-agent", "rule": rule})
    return typed.where("blank OR agent OR rule")


def _marked(robots: DataFrame) -> DataFrame:
    """Lines with their block, the marks (blank and agent lines) and the rules of the block so far; saved here."""
    far = Window.partitionBy("site", "block").orderBy("no").rowsBetween(Window.unboundedPreceding, 0)
    lines = _lines(robots).withColumn("block", F.floor(F.col("no") / BLOCK))
    return cut_lineage(lines.withColumns({
        "mark": F.sum((~F.col("rule")).cast("bigint")).over(far),
        "rules": F.sum(F.col("rule").cast("bigint")).over(far),
    }))


def _entries(lines: DataFrame) -> DataFrame:
    """Marks whose rules belong to an entry: site, block, mark, since, shift, entry_no, agents, n_paths.

    An entry is a run of agent lines and the rules after it.  A blank line or
    an agent line after a rule ends it; agents without a rule are dropped, and
    so are rules without an agent.  Rules between two marks count as one row
    (two where a block ends between), so the windows over a site see its marks
    and blocks, not its rules.  ``shift`` makes the number of a rule in its
    block that in its entry.
    """
    rule = F.col("rule").cast("bigint")
    runs = lines.groupBy("site", "block", "mark").agg(
        F.min("no").alias("no"), F.bool_or("blank").alias("blank"), F.bool_or("agent").alias("agent"),
        F.max(F.when(F.col("agent"), F.col("value"))).alias("value"),
        F.sum(rule).alias("n_rules"), F.min(F.col("rules") - rule).alias("base"),
        F.count_if(F.col("name").isin("allow", "disallow")).alias("n_paths"),
    )
    in_file = Window.partitionBy("site").orderBy("no")
    in_entry = Window.partitionBy("site", "entry").orderBy("no")
    whole = in_entry.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = F.col("blank") | (F.col("agent") & F.coalesce(F.lag("n_rules").over(in_file) > 0, F.lit(False)))
    agent = F.col("agent")
    entries = (
        runs.withColumn("entry", F.sum(starts.cast("bigint")).over(in_file))
        .withColumns({
            "agents": F.collect_list(F.when(agent, F.col("value"))).over(whole),
            "since": F.min(F.when(agent, F.col("no"))).over(whole),
        })
        .where((F.col("no") >= F.col("since")) & (F.col("n_rules") > 0))
    )
    before = F.sum("n_rules").over(in_entry.rowsBetween(Window.unboundedPreceding, -1))
    return entries.withColumns({
        "entry_no": F.dense_rank().over(Window.partitionBy("site").orderBy("entry")),
        "shift": F.coalesce(before, F.lit(0)) - F.col("base"),
    }).select("site", "block", "mark", "shift", "entry_no", "agents", "n_paths")


def _rules(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """One row per rule of the entries: site, entry_no, agents, rule_no, allow, path."""
    few = cut_lineage(entries.select(F.col("site").alias("_site"), "block", "mark", "shift", "entry_no", "agents"))
    paths = lines.where(F.col("name").isin("allow", "disallow"))
    met = (paths.site.eqNullSafe(few._site)) & (paths.block == few.block) & (paths.mark == few.mark)
    return paths.join(few, met).select(
        "site", "entry_no", "agents", (F.col("rules") + F.col("shift")).cast("int").alias("rule_no"),
        ((F.col("name") == "allow") | (F.col("value") == "")).alias("allow"),
        F.when(F.rlike("value", F.lit(PLAIN_PATH)), F.col("value")).otherwise(robots_path(F.col("value"))).alias("path"),
    )


def rules_table(robots: DataFrame) -> DataFrame:
    """One row per rule: site, entry_no, agents, rule_no, allow, path; see ``_entries``.  Tables are saved here."""
    lines = _marked(robots)
    return _rules(lines, _entries(lines))


def prefix_rules(robots: DataFrame, user_agent: str) -> DataFrame:
    """The rules that hold for the agent, by prefix: site, path, rule_no, allow.

    They are those of the first entry that names the agent, else of the first
    for all.  Of rules with one path the first counts.  Tables are saved here.
    """
    agent = F.lit(user_agent.split("/")[0].lower())
    for_all = F.array_contains("agents", "*")
    named = ~for_all & F.exists("agents", lambda a: F.contains(agent, F.lower(a)))
    lines = _marked(robots)
    ranked = _entries(lines).withColumn("rank", F.when(named, 0).when(for_all, 1)).where("rank IS NOT NULL AND n_paths > 0")
    best = F.min(F.struct("rank", "entry_no")).over(Window.partitionBy("site"))
    chosen = ranked.withColumn("best", best).where("entry_no = best.entry_no AND rank = best.rank")
    return _rules(lines, chosen).groupBy("site", "path").agg(
        F.min("rule_no").alias("rule_no"), F.min_by("allow", "rule_no").alias("allow"))


def saved_rules(robots: DataFrame, user_agent: str) -> DataFrame:
    """``prefix_rules`` as a table, for several lookups.  Tables are saved here."""
    return cut_lineage(prefix_rules(robots, user_agent))


def verdicts_by(rows: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Addresses that a rule fits: site, url, allowed.

    The first rule whose path an address starts with decides.  The rules are
    an index by prefix: an address is looked up once for each length that
    paths of its site have, however many rules there are, and no row carries a
    site's rules.
    """
    lengths = rules.groupBy("site").agg(F.collect_set(F.length("path")).alias("_lengths"))
    path = let(robots_path(F.col(url)), lambda p: F.when(p == "", "/").otherwise(p))
    sought = rows.select("site", F.col(url).alias("url"), path.alias("_path")).join(lengths, "site")
    fitting = F.filter("_lengths", lambda n: n <= F.length("_path"))
    probes = sought.select("site", "url", F.col("_path"), F.explode(fitting).alias("_length")).select(
        "site", "url", F.substring(F.col("_path"), F.lit(1), F.col("_length")).alias("path"))
    return probes.join(rules, ["site", "path"]).groupBy("site", "url").agg(F.min_by("allow", "rule_no").alias("allowed"))


def verdicts(rows: DataFrame, robots: DataFrame, user_agent: str, url: str = "url") -> DataFrame:
    """``verdicts_by`` the rules of the files; they are saved here."""
    return verdicts_by(rows, saved_rules(robots, user_agent), url)


def with_verdict(rows: DataFrame, robots: DataFrame, user_agent: str, url: str = "url") -> DataFrame:
    """Adds ``allowed``; what no rule speaks of is."""
    known = verdicts(rows, robots, user_agent, url).withColumnsRenamed({"site": "_site", "url": "_url"})
    met = rows.join(known, (F.col("site") == F.col("_site")) & (F.col(url) == F.col("_url")), "left")
    return met.withColumn("allowed", F.coalesce("allowed", F.lit(True))).drop("_site", "_url")


def permitted_by(rows: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Only the rows whose address the saved rules allow."""
    blocked = verdicts_by(rows, rules, url).where(~F.col("allowed")).select(
        F.col("site").alias("_site"), F.col("url").alias("_url"))
    return rows.join(blocked, (F.col("site") == F.col("_site")) & (F.col(url) == F.col("_url")), "left_anti")


def permitted(rows: DataFrame, robots: DataFrame, user_agent: str, url: str = "url") -> DataFrame:
    """Only the rows whose address the site's rules allow."""
    return permitted_by(rows, saved_rules(robots, user_agent), url)
