"""What the plans must look like to hold at any size."""

import pytest

from pressloom.checks.queries import QUERIES
from pressloom.operators import releases
from pressloom.operators.prefilter import may_meet
from pressloom.plans.extraction import captured
from pressloom.profiles import site_profiles
from tests.conftest import SMALL


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_extraction_moves_no_page(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").selectExpr("split_part(url, '.', 2) AS site", "url", "html")
    plan = plan_of(releases.extract(pages, site_profiles(spark)))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEval" not in plan


@pytest.mark.parametrize("name", [n for n in QUERIES if n == "extract_releases" or n == "extract_sites" or n.startswith("content_")])
def test_queries_on_pages_move_no_page(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    moved = [line for line in plan.split("\n") if "Exchange" in line and "BroadcastExchange" not in line]
    assert not moved, moved


def test_scans_read_only_what_they_need(spark):
    plan = plan_of(QUERIES["url_robots"](spark, SMALL))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_no_query_crosses_or_hints_unchecked(spark):
    for name in ("cut_three_empty", "agg_progress", "robots_links", "links_discover"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_pages_nobody_follows_leave_before_any_markup_moves(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    followed = pages.where("page_id % 5 = 0").select("url").union(spark.createDataFrame([("https://nowhere/",), (None,)], "url STRING"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = captured(pages, followed)
        lines = plan_of(found).split("\n")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    moved = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(url" in line)
    assert any("bit" in line and "conv(hex(" in line for line in lines[moved:]) and "SortMergeJoin" in "".join(lines[:moved])
    wanted = {r.url for r in followed.collect()}
    assert sorted(r.url for r in found.collect()) == sorted(r.url for r in pages.collect() if r.url in wanted)


def test_few_rows_pass_the_filter_in_vain(spark):
    keys = spark.range(50_000).selectExpr("concat('https://h/', id) AS url")
    others = spark.range(50_000, 150_000).selectExpr("concat('https://h/', id) AS url")
    assert may_meet(keys, keys, "url").count() == 50_000
    assert may_meet(others, keys, "url").count() < 1_500
    assert may_meet(keys, keys.limit(0), "url").count() == 0


def test_nodes_need_no_exchange(spark):
    assert "Exchange" not in plan_of(QUERIES["html_nodes"](spark, SMALL))
