"""Raw documents to training shards, one corpus operator after another.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written in
the shared folder and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressloom.llm import decontamination, mixing, quality, sharding, simhash
from pressloom.session import cut_lineage, drop_saved, saved_count


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality.keep_good(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates."""
    return simhash.keep_first(docs)


def unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def weighed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target asks for, the last one of a source cut."""
    return mixing.mix(docs).select(*docs.columns)


def dealt(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shards of equal row counts with all sources in each."""
    return sharding.interleave(docs)


STAGES = [
    ("quality rules", good),
    ("near duplicates", different),
    ("decontamination", unseen),
    ("mixing", weighed),
    ("sharding", dealt),
]

#: SimHash fingerprints need XXH64, which the other engine lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; stages but the last are run as this is called."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), saved_count()
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs)
            # What this stage and the one before it saved is read no more.
            drop_saved(spark, before, but_last=True)
    return docs
