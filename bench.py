"""Times the headline queries and prints one JSON line.

Every query is run through to its last row.  A first pass over the same tables
warms the JVM and builds the expressions; the second pass is the one timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pressloom import build_session
from pressloom.checks.queries import QUERIES

HEADLINE = (
    "html_tokens", "html_nodes", "text_stripped", "sel_descendant", "content_paras",
    "content_all_strings", "extract_releases", "extract_sites", "links_discover", "links_absolute",
    "join_link_page", "robots_filter", "cut_three_empty", "agg_progress", "sink_chunks",
    "clean_text", "norm_release", "spell_correct", "norm_corpus", "stream_extract",
)


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "pressloom-bench", f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__driver__memory="20g", spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm = {}, {}
    for timings in (cold, warm):
        for name in names:
            timings[name] = round(run(spark, name, sf_dir), 3)
            print(name, timings[name], file=sys.stderr, flush=True)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "first_pass": cold, "sf": scale, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
