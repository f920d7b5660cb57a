import random

import pytest
from pyspark.sql import functions as F

from pressloom.functions import text

GOLDEN = [
    ("don't say \"it's\" now:10:30;x  McDonald.The end,And!Yes?No",
     "don ' t say \" it ' s \" now : 10 : 30 ; x Mc Donald. The end, And! Yes? No"),
    ("a  b\x1cc", "a b c"),
    ("''\"\"x", "' ' \" \" x"),
    ("https://a.b/c?d=E::f;;g", "https : //a.b/c?d=E : :f ; ;g"),
    (" lead\n\ntrail \n", "lead trail"),
]


def test_golden_strings(one_column):
    got = one_column([g[0] for g in GOLDEN], text.clean_text(F.col("v")))
    assert got == [g[1] for g in GOLDEN]


def test_white_space_agrees_with_python(one_column):
    every = ["x" + chr(c) + "y" for c in range(1, 0x3100) if not 0xD800 <= c <= 0xDFFF]
    words = one_column(every, text.split_words(F.col("v")))
    assert words == [v.split() for v in every]
    padded = [v[1] + v + v[1] for v in every]
    assert one_column(padded, text.strip(F.col("v"))) == [v.strip() for v in padded]


def test_marks_in_runs(one_column):
    """The fast form takes marks in the same pairs as matching left to right."""
    rng = random.Random(7)
    values = ["".join(rng.choice("a :;'\"”") for _ in range(rng.randint(0, 12))) for _ in range(400)]

    def paired(value, marks):
        out, i = [], 0
        while i < len(value):
            if i + 1 < len(value) and not value[i].isspace() and value[i + 1] in marks:
                out.append(value[i] + " " + value[i + 1])
                i += 2
            else:
                out.append(value[i])
                i += 1
        return "".join(out)

    assert one_column(values, text.space_before_quotes(F.col("v"))) == [paired(v, "\"'”’") for v in values]
    assert one_column(values, text.space_before_colons(F.col("v"))) == [paired(v, ":;") for v in values]


def test_clean_text_has_no_double_spaces(one_column):
    rng = random.Random(3)
    values = ["".join(rng.choice("aB \n\t .,") for _ in range(40)) for _ in range(200)]
    for value in one_column(values, text.clean_text(F.col("v"))):
        assert "  " not in value and value == value.strip()


def test_collapse_newlines(one_column):
    assert one_column(["a\n\n\n\nb\n\nc\nd"], text.collapse_newlines(F.col("v"))) == ["a\n\nb\n\nc\nd"]


@pytest.mark.parametrize("value", ["", " ", "\n\n"])
def test_blank(one_column, value):
    assert one_column([value], text.is_blank(F.col("v"))) == [True]
