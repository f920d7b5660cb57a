import itertools

import pytest
from pyspark.sql import functions as F

from pressloom.operators import normalise, spelling

LETTERS = "abc"


def edits(word):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return (
        {a + b[1:] for a, b in cuts if b} | {a + b[1] + b[0] + b[2:] for a, b in cuts if len(b) > 1}
        | {a + c + b[1:] for a, b in cuts if b for c in LETTERS} | {a + c + b for a, b in cuts for c in LETTERS}
    )


def all_words(longest):
    return ["".join(w) for n in range(1, longest + 1) for w in itertools.product(LETTERS, repeat=n)]


@pytest.fixture(scope="module")
def dictionary(spark):
    words = [(w, (i * 37) % 11 + 1) for i, w in enumerate(all_words(4)) if i % 5 == 0]
    return spark.createDataFrame(words, "word STRING, freq BIGINT")


def best_by_edit_sets(words, known):
    best = {}
    for word in words:
        one = edits(word)
        two = set().union(*map(edits, one))
        ranked = [
            (0 if c == word else 1 if c in one else 2, -freq, c) for c, freq in known.items() if c == word or c in one or c in two
        ]
        if ranked:
            best[word] = min(ranked)[2]
    return best


@pytest.mark.parametrize("long", [3, 20])
def test_corrections_agree_with_edit_sets(spark, dictionary, monkeypatch, long):
    """With either way to find candidates, the pieces being used from three letters on in one case."""
    monkeypatch.setattr(spelling, "LONG", long)
    words = all_words(5)[::3] + ["aabbccab"]
    known = {r.word: r.freq for r in dictionary.collect()}
    found = spelling.corrections(spark.createDataFrame([(w,) for w in words], "word STRING"), dictionary)
    assert {r.word: r.correction for r in found.collect()} == best_by_edit_sets(words, known)


def test_long_words_and_short_ones_of_other_scripts(spark):
    long = "abcdefghij" * 1_000
    known = {long: 3, long[:40] + "zz": 2, "\u65e5\u672c": 9, "\u4e2d": 7, "abc": 1}
    words = {
        long[:5_000] + "x" + long[5_001:]: long, long[1:9_000] + "q" + long[9_000:]: long, long + "xyz": None,
        long[:38] + "jizz": long[:40] + "zz", long[:42]: long[:40] + "zz", long[:60]: None,
        "\u65e5\u6708": "\u65e5\u672c", "\u65e6": "\u4e2d", "\u4eba\u4eba": "\u65e5\u672c", "abcde": "abc",
        "x" * 100_000: None,
    }
    rows = spark.createDataFrame([(w,) for w in words], "word STRING")
    found = spelling.corrections(rows, spark.createDataFrame(list(known.items()), "word STRING, freq BIGINT"))
    assert {r.word: r.correction for r in found.collect()} == {w: c for w, c in words.items() if c}


def test_best_candidate(spark):
    dictionary = spark.createDataFrame(
        [("the", 50), ("then", 9), ("thin", 9), ("then2", 1), ("house", 5), ("mouse", 5)], "word STRING, freq BIGINT"
    )
    words = ["hte", "The", "teh", "thn", "rouse", "zzzzzz", "12", "--", "1e5", "houxxe", "HOUSE", "Hous"]
    frame = spark.createDataFrame([(w,) for w in words], "word STRING")
    got = {r.word: r.correction for r in spelling.correct_words(frame, dictionary).collect()}
    assert got == {
        "hte": "the", "The": "The", "teh": "the", "thn": "the", "rouse": "house", "zzzzzz": "zzzzzz", "12": "12",
        "--": "--", "1e5": "1e5", "houxxe": "house", "HOUSE": "HOUSE", "Hous": "house",
    }


def test_known_words_never_change(spark, dictionary):
    frame = dictionary.select(F.upper("word").alias("word"))
    assert all(r.word == r.correction for r in spelling.correct_words(frame, dictionary).collect())


def test_normalise_keeps_sections_and_copies(spark):
    dictionary = spark.createDataFrame([("the", 9), ("house", 5)], "word STRING, freq BIGINT")
    text = "Title: teh hous\nDate: June\n\n\n\nContent:\nThe  house.And"
    rows = spark.createDataFrame([(1, text), (2, text), (3, "")], "id INT, text STRING")
    got = {r.id: r.text for r in normalise.normalise(rows, dictionary).collect()}
    # Punctuation stays on the word and counts as a letter of it.
    fixed = "Title : the house Date : June\n\n\n\nContent : The house And"
    assert got == {1: fixed, 2: fixed, 3: ""}


def test_single_letters_share_no_key(spark):
    """Two thousand unknown letters and as many known ones: no pairs of them, and still the right answer."""
    known = [(chr(0x4E00 + i), i % 97 + 1) for i in range(2_000)]
    words = [chr(0x5600 + i) for i in range(2_000)] + ["ab"]
    rows = spark.createDataFrame([(w,) for w in words], "word STRING")
    dictionary = spark.createDataFrame(known + [("b", 1_000), ("bc", 500)], "word STRING, freq BIGINT")
    keys = dictionary.select(F.explode(spelling.single_keys(F.col("word"))).alias("k")).groupBy("k").count()
    assert keys.agg(F.max("count")).first()[0] <= 2
    found = {r.word: r.correction for r in spelling.corrections(rows, dictionary).collect()}
    assert found == {w: "b" for w in words}


def test_keys_by_row_are_those_of_the_arrays(spark):
    words = ["a", "ab", "aa", "aab", "abb", "aaa", "aba", "abab", "aabbaa", "baab", "mississippi", "übergrößen", "😀😀a", "x" * 9, "qu" * 9]
    rows = spark.createDataFrame([(w,) for w in words], "word STRING")
    salt = F.length("word") % spelling.SALTS
    for given in (None, salt):
        wanted = {r.word: set(r.keys) for r in rows.select("word", spelling.double_keys(F.col("word"), given).alias("keys")).collect()}
        found = {}
        for r in spelling.with_double_keys(rows, "word", given).collect():
            found.setdefault(r.word, []).append(r.key)
        assert {w: set(ks) for w, ks in found.items()} == wanted
    assert len(found["mississippi"]) < 12 * 13 / 2
    single = {r.word: set(r.keys) for r in rows.select("word", spelling.single_keys(F.col("word")).alias("keys")).collect()}
    found = {}
    for r in spelling.with_single_keys(rows, "word").collect():
        found.setdefault(r.word, []).append(r.key)
    assert {w: sorted(ks) for w, ks in found.items()} == {w: sorted(ks) for w, ks in single.items()}


def test_corrections_of_a_long_release_are_in_parts(spark):
    """Many corrections of one release, and releases without any, give what each word's own correction says."""
    wrong = [f"{a}{b}spellinx" for a in "abcdefghijk" for b in "lmnopqrstuv"]
    dictionary = spark.createDataFrame([(w[:-1] + "g", 1) for w in wrong], "word STRING, freq BIGINT")
    rows = spark.createDataFrame([(1, " ".join(wrong * 2)), (2, "qqq zzz"), (3, "")], "doc_id INT, text STRING")
    found = {r.doc_id: r.text for r in normalise.normalise(rows, dictionary, key="doc_id").collect()}
    assert found == {1: " ".join(w[:-1] + "g" for w in wrong * 2), 2: "qqq zzz", 3: ""}
    assert normalise.PARTS > 1
