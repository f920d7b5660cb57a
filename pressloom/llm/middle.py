"""Fill-in-the-middle by repeated captures.

One full match of ``(unit)*`` keeps the end of every repetition of its group:
their number is the number of units, and the ends are the offsets at which the
text may be cut.  Two cuts give prefix, middle and suffix, which are put in
another order behind marks, so that a model that only reads forward learns to
fill a gap.
"""

from __future__ import annotations

import hashlib

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import named, table

#: One code point, line breaks included.
CODE_POINT = r"(?s:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Texts in a hundred that stay as they are, and of the others those that show the suffix first.
PLAIN_PCT, SPM_PCT = 10, 20
SEED = 1

CUT = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
COLUMNS = ("n", "form", "prefix_chars", "middle_chars", "output")


def numbers(key: str, seed: int) -> list[int]:
    """Four numbers below 2 to the 32 that look random and are fixed by seed and key."""
    digits = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def cut_text(text: str, key: str, units: regex.Pattern, seed: int, plain_pct: int, spm_pct: int) -> tuple:
    """Units, form, code points of prefix and middle, and the text in its new order."""
    found = units.fullmatch(text)
    ends = found.ends(1) if found else []
    n = len(ends)
    h1, h2, h3, h4 = numbers(key, seed)
    if not text or not found or h3 % 100 >= 100 - plain_pct or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (ends[cut - 1] if cut else 0 for cut in (first, second))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_pct:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def cutter(unit: str = CODE_POINT, seed: int = SEED, plain_pct: int = PLAIN_PCT, spm_pct: int = SPM_PCT):
    """A function of a text and a key column: struct of what ``cut_text`` gives.

    The match is possessive, as a repetition that can be had again differently
    is no unit.  Texts are matched one at a time, at about 150 bytes of memory
    a unit.
    """

    @F.pandas_udf(CUT)
    def cut(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
        units = regex.compile(f"({unit})*+")
        rows = [cut_text(t or "", k or "", units, seed, plain_pct, spm_pct) for t, k in zip(texts, keys)]
        columns = dict(zip(COLUMNS, zip(*rows) if rows else [()] * len(COLUMNS)))
        return pd.DataFrame({
            name: pd.Series(columns[name], dtype="Int64" if name in ("n", "prefix_chars", "middle_chars") else object)
            for name in COLUMNS
        })

    return cut


def restored(output: Column, form: Column) -> Column:
    """The text that was cut: each mark stands once, since texts with a mark stay plain."""

    def between(start: str, end: str | None) -> Column:
        since = F.locate(start, output) + len(start)
        to = F.locate(end, output) if end else F.char_length(output) + 1
        return F.substr(output, since, to - since)

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame, text: str = "text", key: str = "doc_id", keep: list[str] | None = None, unit: str = CODE_POINT, **options
) -> DataFrame:
    """``docs`` (or the columns to keep) with ``n form prefix_chars middle_chars output``.

    ``unit`` is a pattern of the regex library for what must not be cut, such
    as ``\\X`` for letters with their marks or ``\\s*\\S+\\s*`` for words; cuts
    and ``n`` count units, the other numbers code points.  A text that is not
    made of units stays plain and has none.  A null text counts as empty;
    empty texts stay plain.  A null key is the same as an empty one; rows with
    equal keys draw equal numbers, repeated rows equal results.  Columns of
    ``docs`` named like a result are replaced.  No rows give no rows.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in COLUMNS]
    quoted = named(kept)
    cut = cutter(unit, **options)(F.col(text), F.col(key).cast("string"))
    packed = docs.select(F.struct(*quoted).alias("row_") if kept else F.lit(None).alias("row_"), cut.alias("cut_"))
    return packed.select(*(["row_.*"] if kept else []), "cut_.*")


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and put in order, as checksums, with the text got back from the result."""
    rows = fill_in_middle(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


OP12_SQL = """
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
           sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
), h AS (
    SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS c2,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
), c AS (
    SELECT *, substr(t, 1, least(c1, c2)) AS p, substr(t, least(c1, c2) + 1, abs(c1 - c2)) AS m,
           substr(t, greatest(c1, c2) + 1) AS s FROM h
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN least(c1, c2) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN abs(c1 - c2) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
"""
