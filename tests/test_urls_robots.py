import random
from collections import Counter
from urllib.parse import urljoin
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from pressloom.checks import derived
from pressloom.checks.queries import from_sql
from pressloom.functions import urls
from pressloom.operators import robots
from tests.conftest import SMALL

BASES = [
    "https://h.gov/a/b/c", "https://h.gov/a/b/", "https://h.gov", "https://h.gov/?q=1", "http://h.gov/a?x=/y#z",
    "https://h.gov/a//b/c",
]
HREFS = [
    "", "p", "/p", "//o.gov/p", "https://o.gov/q", "../p", "./p", "../../../p", ".", "..", "../", "p/", "?q=2", "#f",
    "p?q#f", "/a/../b", "/a/./b/..", "a//b", "mailto:x@y.z", "p;v=1",
]


def test_join_url_agrees_with_the_standard_library(spark):
    pairs = [(b, h) for b in BASES for h in HREFS]
    frame = spark.createDataFrame(pairs, "base STRING, href STRING")
    rows = frame.select("base", "href", urls.join_url(F.col("base"), F.col("href")).alias("u")).collect()
    wrong = [(r.base, r.href, r.u, urljoin(r.base, r.href)) for r in rows if r.u != urljoin(r.base, r.href)]
    assert wrong == []


ROBOTS = [
    "User-agent: *\nDisallow:\n",
    "User-agent: *\nAllow: /a/b\nDisallow: /a\n",
    "User-agent: *\nDisallow: /\n\nUser-agent: Reader\nDisallow: /x # no\nAllow: /\n",
    "User-agent: one\nUser-agent: reader\nDisallow: /a%20b\n\n\nUser-agent: *\nDisallow: /",
    "Disallow: /\nUser-agent: none\n\nUser-agent: *\nCrawl-delay: 3\nDisallow: /q?x=1\nUser-agent: *\nDisallow: /z",
    "User-agent: *\r\nDisallow: *\r\n",
    "",
]
PATHS = ["", "/", "/a", "/a/b/c", "/x/y", "/a b", "/a%20b/c", "/q?x=1", "/q", "/z#f"]


def test_robots_agree_with_the_standard_library(spark):
    agent = "News Reader/2.0 (x)"
    files = spark.createDataFrame(list(enumerate(ROBOTS)), "site INT, text STRING")
    frame = spark.createDataFrame([(i, "https://h.gov" + p) for i in range(len(ROBOTS)) for p in PATHS], "site INT, url STRING")
    rows = robots.with_verdict(frame, files, agent).collect()
    kept = {(r.site, r.url) for r in robots.permitted(frame, files, agent).collect()}
    assert len(rows) == len(ROBOTS) * len(PATHS)
    for row in rows:
        parser = RobotFileParser()
        parser.parse(ROBOTS[row.site].splitlines())
        wanted = not ROBOTS[row.site] or parser.can_fetch(agent, row.url)
        assert row.allowed == wanted == ((row.site, row.url) in kept), (ROBOTS[row.site], row.url)


def test_many_rules(spark):
    """Ten thousand rules each of two sites against one after the other."""
    rng = random.Random(4)
    words = ["a" + "".join(rng.choice(("a", "b", "c/")) for _ in range(rng.randint(1, 9))) for _ in range(10_000)]
    rules = {s: [(rng.random() < 0.5, f"/{w}x{i % 7 or ''}") for i, w in enumerate(words)] for s in ("s", "t")}
    files = spark.createDataFrame(
        [(s, "User-agent: *\n" + "\n".join(f"{'Allow' if ok else 'Disallow'}: {p}" for ok, p in rs)) for s, rs in rules.items()],
        "site STRING, text STRING")
    paths = [f"/{w}x{rng.choice('123abc/')}tail" for w in rng.sample(words, 300)] + ["/", "", "/zzz"]
    rows = spark.createDataFrame([(s, "https://h.gov" + p) for s in ("s", "t", "u") for p in paths], "site STRING, url STRING")
    for row in robots.with_verdict(rows, files, "any").collect():
        path = row.url.removeprefix("https://h.gov") or "/"
        assert row.allowed == next((ok for ok, p in rules.get(row.site, []) if path.startswith(p)), True), row
    assert robots.prefix_rules(files, "any").count() <= 20_000


def test_no_robots_file_allows_all(spark):
    rows = spark.createDataFrame([("a", "https://h.gov/x")], "site STRING, url STRING")
    files = spark.createDataFrame([("a", None)], "site STRING, text STRING")
    assert robots.permitted(rows, files, "x").count() == 1
    assert robots.permitted(rows, files.where("site = 'b'"), "x").count() == 1


def test_files_by_line_and_in_blocks(spark, monkeypatch):
    """A file that comes line by line gives the rules of the whole one, wherever blocks of its lines end."""
    texts = [t for t in ROBOTS if t] + ["User-agent: a\nUser-agent: b\nDisallow: /1\nDisallow: /2\nCrawl-delay: 1\nAllow: /3\nUser-agent: *\n\nDisallow: /4\n"]
    files = spark.createDataFrame(list(enumerate(texts)), "site INT, text STRING")
    lines = spark.createDataFrame(
        [(i, 3 * no, line) for i, t in enumerate(texts) for no, line in enumerate(t.split("\n"))][::-1], "site INT, no BIGINT, raw STRING")
    whole = sorted(map(tuple, robots.rules_table(files).collect()))
    assert [r[1:] for r in whole[-3:]] == [(1, ["a", "b"], 1, False, "/1"), (1, ["a", "b"], 2, False, "/2"), (1, ["a", "b"], 4, True, "/3")]
    for block in (1, 2, 7, 1 << 20):
        monkeypatch.setattr(robots, "BLOCK", block)
        assert sorted(map(tuple, robots.rules_table(lines).collect())) == whole, block


def test_lines_of_many_rules_are_those_of_the_files(spark):
    files, lines = (from_sql(spark, SMALL, sql) for sql in (derived.MANY_RULES, derived.MANY_RULE_LINES))
    counted = {r.site: Counter(r.text.split("\n")) for r in files.collect()}
    found = {}
    for r in lines.orderBy("no").collect():
        found.setdefault(r.site, []).append(r.raw)
    assert {s: Counter(ls) for s, ls in found.items()} == counted
    assert all(ls[:2] == ["User-agent: *", "Allow: /en/1"] for ls in found.values())
