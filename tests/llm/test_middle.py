"""Fill-in-the-middle against slices of the text."""

import hashlib

import pytest
import regex
from pyspark.sql import functions as F

from pressloom.llm import middle
from tests.llm.helpers import awkward, empty

WHOLE = regex.compile(f"({middle.CODE_POINT})*+")


def plainly(doc_id, text):
    """Form, code points of prefix and middle, output, by the rule alone."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 20 else (n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_rows(spark, make):
    docs = make(spark)
    rows = middle.fill_in_middle(docs).withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, r.text)
        assert r.back == (r.text or "")


def test_many_keys_marks_and_signs(spark):
    texts = ["a", "<", "<P", "x<S>y", "<<M", "P><S", "日本語 😀\n\r\n", "é́", "\x00\x1f", "<S", "a" * 1000]
    rows = [(i, texts[i % len(texts)]) for i in range(1_100)]
    found = middle.fill_in_middle(spark.createDataFrame(rows, "doc_id bigint, text string")).withColumn(
        "back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert all((r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, r.text) for r in found)
    assert all(r.back == r.text for r in found)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_other_units():
    letters = regex.compile(r"(\X)*+")
    text = "éö" * 50
    for key in map(str, range(60)):
        n, form, prefix, _, _ = middle.cut_text(text, key, letters, 1, 0, 50)
        assert n == 100 and form != "plain" and prefix % 2 == 0
    words = regex.compile(r"(\s*\S+\s*)*+")
    n, form, prefix, inner, _ = middle.cut_text("one two  three", "5", words, 1, 0, 0)
    assert n == 3 and form == "psm" and {prefix, prefix + inner} <= {0, 4, 9, 14}
    assert middle.cut_text("one 2", "5", regex.compile(r"([a-z ])*+"), 1, 0, 0)[:2] == (0, "plain")


def test_shares(spark):
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.lit("some text to cut").alias("text"))
    forms = {r.form: r["count"] for r in middle.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(forms["plain"] / 4_000 - 0.1) < 0.02 and abs(forms["spm"] / (forms["spm"] + forms["psm"]) - 0.2) < 0.03


def test_columns_of_the_same_name_are_replaced(spark):
    docs = spark.createDataFrame([(1, "text", "mine", 5, "k")], "doc_id bigint, text string, output string, n int, `a.b` string")
    found = middle.fill_in_middle(docs)
    assert found.columns == ["doc_id", "text", "a.b", *middle.COLUMNS]
    assert found.first().n == 4
