"""Writers: append per run, rewrite per member, text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.operators.releases import RECORD_END
from pressloom.sources.corpus import STRICT

CHUNK_SIZE = 1000


def run_stamp(at: Column) -> Column:
    """Time as it stands in file names."""
    return F.date_format(at, "yyyyMMdd_HHmmss")


def append_releases(releases: DataFrame, path: str, at: Column | None = None) -> None:
    """Add releases to the table at ``path``, one folder per site.

    With ``at``, the time of the run, each row gets its stamp as ``run``.
    """
    if at is not None:
        releases = releases.withColumn("run", run_stamp(at))
    releases.write.mode("append").partitionBy("site").parquet(path)


def append_records(records: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """Add serialised records as text, the record end standing as line end."""
    rows = records
    if order:
        rows = rows.repartitionByRange("site", *order).sortWithinPartitions("site", *order)
    body = F.substring("record", F.lit(1), F.length("record") - len(RECORD_END))
    (
        rows.select("site", body.alias("record"))
        .write.mode("append")
        .partitionBy("site")
        .text(path, lineSep=RECORD_END)
    )


def write_formatted(releases: DataFrame, path: str, order: tuple[str, ...] = ()) -> None:
    """Replace the members of ``releases`` in the corpus at ``path``: one folder per member.

    Members that are not among them keep their files.

    Files hold at most a thousand releases, each followed by the separator.
    Ranges of member and order keep the sequence and split big members.
    """
    rows = releases
    if order:
        rows = rows.repartitionByRange("member", *order).sortWithinPartitions("member", *order)
    (
        rows.select("member", "text")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("member")
        .option("maxRecordsPerFile", CHUNK_SIZE)
        .text(path, lineSep=STRICT)
    )
