"""From release files to normalised release files, all members in one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressloom.operators.normalise import normalise
from pressloom.sources import corpus, sinks


def normalise_corpus(
    spark: SparkSession,
    paths: str | list[str],
    dictionary: DataFrame,
    out: str,
    strict: bool = False,
) -> None:
    """Read, clean, correct and rewrite; order within each member is kept."""
    read = corpus.read_releases(spark, paths, strict)
    done = normalise(read, dictionary)
    sinks.write_formatted(done, out, order=("file_path", "block_start", "line_no"))
