"""Releases appended as captured pages arrive.

Reading a page needs that page alone, so the stream keeps no state: the
checkpoint remembers which files were read and a restarted run adds the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pressloom.operators.releases import extract


def extract_stream(pages: DataFrame, profiles: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return extract(pages, profiles, keys)


def append_stream(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start appending to a table; stops by itself when no input is left."""
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("site")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
