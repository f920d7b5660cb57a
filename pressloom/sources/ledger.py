"""Appends that happen once: runs are staged, then become visible by one rename.

A table has a folder of runs.  A run holds what it adds and the pages it has
finished; it is written under ``staging`` and moved as a whole, so a run that
dies leaves nothing that readers see.  The next run skips finished pages and
clears what was left behind.  One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

PAGES = "site STRING, page_no BIGINT"


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    place, store = _store(spark, path)
    return store.exists(place)


def is_committed(spark: SparkSession, path: str, run: str) -> bool:
    return _exists(spark, f"{path}/runs/{run}")


def read(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """What all finished runs added to a table; no rows before the first."""
    place, store = _store(spark, f"{path}/runs/*/{table}")
    if not store.globStatus(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/runs/*/{table}")


def finished(spark: SparkSession, path: str) -> DataFrame:
    """Pages that some run has finished."""
    return read(spark, path, "pages", PAGES)


def stage(path: str, run: str, **tables: DataFrame) -> None:
    """Write the tables of a run where no reader looks."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/staging/{run}/{name}")


def commit(spark: SparkSession, path: str, run: str) -> None:
    """Make a staged run visible; one that is visible already stays as it is."""
    if is_committed(spark, path, run):
        return
    runs, store = _store(spark, f"{path}/runs")
    store.mkdirs(runs)
    staged, target = _store(spark, f"{path}/staging/{run}")[0], _store(spark, f"{path}/runs/{run}")[0]
    if not store.rename(staged, target):
        raise OSError(f"{run} could not be moved to the finished runs")


def clear(spark: SparkSession, path: str) -> None:
    """Remove what runs left behind that did not get as far as their commit."""
    place, store = _store(spark, f"{path}/staging")
    store.delete(place, True)


def append_once(rows: DataFrame, pages: DataFrame, path: str, run: str | None = None) -> str | None:
    """Add the rows of pages that no run has finished; the run's name, or nothing if there are none.

    ``pages`` (site, page_no) are what this run finishes, also pages without
    rows.  Rows of other pages are left out, so a page is never added in part.
    """
    spark = rows.sparkSession
    clear(spark, path)
    todo = pages.select("site", "page_no").distinct().join(finished(spark, path), ["site", "page_no"], "left_anti")
    if todo.isEmpty():
        return None
    run = run or uuid.uuid4().hex
    stage(path, run, rows=rows.join(todo, ["site", "page_no"], "left_semi"), pages=todo)
    commit(spark, path, run)
    return run
