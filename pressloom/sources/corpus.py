"""Release text files: records between separators, one member per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STRICT = "\n\n==\n\n"
TOLERANT = "\n\n==\n"

# The members whose files make up the corpus.
MEMBERS = ("aoc", "hawley", "lee", "manchin", "markey", "mtg", "pocan", "sanders", "stefanik")


def member_of(file_name: Column) -> Column:
    """File name up to its first dot."""
    return F.split_part(file_name, F.lit("."), F.lit(1))


def member_in_path(path: Column) -> Column:
    """Member of a file: that of its ``member=`` folder, else by its name."""
    folder = F.url_decode(F.regexp_extract(path, "/member=([^/]+)/[^/]*$", 1))
    return F.when(folder != "", folder).otherwise(member_of(F.element_at(F.split(path, "/"), -1)))


def formatted_name(file_name: Column) -> Column:
    """Name of the file the normalised releases go to."""
    return F.concat(member_of(file_name), F.lit("_formatted.txt"))


def split_records(text: Column, strict: bool = False) -> Column:
    """Records of a text held in a column.

    Strict cuts at the separator of normalised files and keeps what follows
    the last one, even if empty.  Tolerant also accepts records that start
    right after the separator, and drops empty ones.
    """
    if strict:
        return F.split(text, STRICT, -1)
    return F.filter(F.split(text, "\n\n==\n\n?", -1), lambda r: r != "")


def read_releases(spark: SparkSession, paths: str | list[str], strict: bool = False) -> DataFrame:
    """Releases of text files: member, file_path, block_start, line_no, text.

    Files are named by member, or lie in the folders that the writer makes.

    The separator is the reader's line separator, so big files are split among
    tasks.  The three position columns order the releases of a file.
    """
    raw = spark.read.text(paths, lineSep=STRICT if strict else TOLERANT)
    rows = raw.select(
        member_in_path(F.col("_metadata.file_path")).alias("member"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("value").alias("text"),
    )
    columns = ["member", "file_path", "block_start", "line_no", "text"]
    if not strict:
        trimmed = rows.withColumn("text", F.regexp_replace("text", "^\n", ""))
        return trimmed.where(F.col("text") != "").select(columns)
    # The reader drops what follows a final separator; strictly that is one
    # more, empty release.  Sizes tell which files end with a separator.
    sized = rows.groupBy("member", "file_path").agg(
        F.first("file_size").alias("file_size"),
        F.sum(F.octet_length("text") + len(STRICT)).alias("with_ends"),
    )
    ended = sized.where(F.col("file_size") == F.col("with_ends")).select(
        "member", "file_path", F.col("file_size").alias("block_start"),
        F.lit(0).cast("long").alias("line_no"), F.lit("").alias("text"),
    )
    return rows.select(columns).unionByName(ended)


def member_files(folder: str, members: tuple[str, ...] = MEMBERS) -> list[str]:
    return [f"{folder}/{member}.txt" for member in members]
