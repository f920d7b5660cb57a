"""Release text to clean, spell-corrected release text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.text import clean_text
from pressloom.operators.spelling import corrections, unknown
from pressloom.session import cut_lineage


def sections(text: Column) -> Column:
    """The release's paragraphs; empty ones count."""
    return F.split(text, "\n\n", -1)


def clean_sections(text: Column) -> Column:
    return F.transform(sections(text), clean_text)


def join_sections(parts: Column) -> Column:
    return F.array_join(parts, "\n\n")


def words(cleaned: Column) -> Column:
    """Words of cleaned text, which has single spaces only."""
    return F.filter(F.split(cleaned, " "), lambda w: w != "")


def clean_release(text: Column) -> Column:
    """Every section cleaned, no spelling."""
    return join_sections(clean_sections(text))


#: A map is searched from its beginning for each word, so a release's corrections are cut into so many.
PARTS = 64


def _part(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(PARTS)).cast("int")


def normalise(releases: DataFrame, dictionary: DataFrame, key: str | None = None) -> DataFrame:
    """Replace ``text`` by its cleaned and corrected form.

    Cleaned text is saved once and does not move until the last join.  Words
    are looked up in the dictionary once each, and only those that change
    travel, once per release; what comes back are small maps of corrections per
    release, applied in place.  The correction of a word does not depend on
    where it stands, so a key shared by several releases (the default is a hash
    of the text) merges maps and harms nothing.
    """
    name = key or "_key"
    if key is None:
        releases = releases.withColumn(name, F.xxhash64("text"))
    base = cut_lineage(releases.withColumn("_sections", clean_sections(F.col("text"))).drop("text"))

    per_release = F.array_distinct(
        F.flatten(F.transform("_sections", lambda s: words(s)))
    )
    used = base.select(name, F.explode(per_release).alias("word"))
    missing = cut_lineage(unknown(used.select("word").distinct(), dictionary))
    lowered = missing.select(F.lower("word").alias("word")).distinct()
    fixed = corrections(lowered, dictionary).withColumnRenamed("word", "_lower")
    # Saved, so that Catalyst knows how few they are.
    changed = cut_lineage(missing.join(fixed, F.lower(F.col("word")) == F.col("_lower")).select("word", "correction"))
    changed = changed.withColumn("part", _part(F.col("word")))
    fixes = used.join(changed, "word").groupBy(name).agg(F.collect_set(F.struct("part", "word", "correction")).alias("_all"))
    maps = fixes.select(name, F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.map_from_entries(
        F.transform(F.filter("_all", lambda f: f.part == p), lambda f: F.struct(f.word, f.correction)))).alias("_fixes"))

    def corrected(section: Column) -> Column:
        return F.array_join(
            F.transform(words(section), lambda w: F.coalesce(F.get("_fixes", _part(w))[w], w)), " "
        )

    joined = base.join(maps, name, "left")
    done = joined.withColumn("text", join_sections(F.transform("_sections", corrected)))
    return done.select(*releases.columns).drop("_key")
