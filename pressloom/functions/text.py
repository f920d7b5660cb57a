"""Whitespace, cleaning and small text helpers as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space for trimming and
# splitting (Unicode white space plus the four ASCII separators).
WHITESPACE = "".join(
    chr(point)
    for point in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)

# The same set for the regex engine, spelled out: an explicit class is tested
# several times faster than a Unicode property.  OTHER_SPACE leaves out " ".
_OTHER = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = f"[ {_OTHER}]"
OTHER_SPACE = f"[{_OTHER}]"
NON_SPACE = f"[^ {_OTHER}]"

# The quote characters the cleaner sets apart.
CLOSING_QUOTES = "\"'”’"
OPENING_QUOTES = "\"'“‘"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand the result to ``body``.

    Folding an empty array only binds the start value to a lambda variable, so
    the optimiser cannot inline a costly expression at each place it is used.
    Unlike an element of ``transform`` the result is not copied.
    """
    nothing = F.array().cast("array<int>")
    return F.aggregate(nothing, value, lambda bound, _: bound, lambda bound: body(bound))


#: Items per inner step of a scan.
SCAN_CHUNK = 128


def scan(items: Column, start: Column, step: Callable[[Column, Column], Column], out_type: str) -> Column:
    """What ``step`` makes of each item in turn, as an array.

    ``step`` maps a state and an item to a struct of the next ``state`` and
    ``out``.  Appending to an array copies it, so the items are taken in
    chunks, and the time grows with their number and not with its square.
    """
    count = F.size(items)
    starts = F.when(count > 0, F.sequence(F.lit(1), count, F.lit(SCAN_CHUNK))).otherwise(F.array().cast("array<int>"))
    none = F.array().cast(f"array<{out_type}>")

    def inner(held: Column, item: Column) -> Column:
        return let(step(held.state, item), lambda made: F.struct(
            made.state.alias("state"), F.concat(held.outs, F.array(made.out)).alias("outs")))

    def outer(held: Column, at: Column) -> Column:
        part = F.aggregate(
            F.slice(items, at, F.lit(SCAN_CHUNK)), F.struct(held.state.alias("state"), none.alias("outs")), inner)
        return let(part, lambda last: F.struct(
            last.state.alias("state"), F.concat(held.done, F.array(last.outs)).alias("done")))

    whole = F.struct(start.alias("state"), F.array().cast(f"array<array<{out_type}>>").alias("done"))
    return F.aggregate(starts, whole, outer, lambda held: F.flatten(held.done))


def strip(text: Column) -> Column:
    """Trim white space of every kind from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return F.length(strip(text)) == 0


def split_words(text: Column) -> Column:
    """Words between runs of white space; no empty strings."""
    pieces = F.split(text, f"{SPACE}+")
    return F.filter(pieces, lambda w: w != "")


def collapse_newlines(text: Column) -> Column:
    """At most two newlines in a row."""
    return F.regexp_replace(text, "\n{3,}", "\n\n")


# -- cleaner steps, in the order they apply ---------------------------------


def collapse_whitespace(text: Column) -> Column:
    """Runs of white space to one space; a single space needs no rewriting."""
    return F.regexp_replace(text, f"{OTHER_SPACE}{SPACE}*| {SPACE}+", " ")


def space_before_capitals(before: str, text: Column) -> Column:
    """A space before each capital letter that follows a character of the class."""
    return F.regexp_replace(text, f"(?<=[{before}])(?=[A-Z])", " ")


SENTENCE_MARKS = ".,!?"
SMALL_LETTERS = "a-z"


def split_sentence_gaps(text: Column) -> Column:
    return space_before_capitals(SENTENCE_MARKS, text)


def split_camel_case(text: Column) -> Column:
    return space_before_capitals(SMALL_LETTERS, text)


def _space_before(marks: str, text: Column) -> Column:
    """A space before each mark that follows a character other than a space.

    Marks are taken in pairs with what precedes them, so the second of two
    marks in a row counts as spoken for; hence the optional one at the end.
    Looking for the mark first and behind it second keeps the scan fast.
    """
    return F.regexp_replace(text, f"([{marks}])(?<={NON_SPACE}[{marks}])([{marks}]?)", " $1$2")


def space_before_quotes(text: Column) -> Column:
    return _space_before(CLOSING_QUOTES, text)


def space_after_quotes(text: Column) -> Column:
    return F.regexp_replace(text, f"([{OPENING_QUOTES}])({NON_SPACE})", "$1 $2")


def space_before_colons(text: Column) -> Column:
    return _space_before(":;", text)


def space_after_colons(text: Column) -> Column:
    return F.regexp_replace(text, f"([:;])({NON_SPACE})", "$1 $2")


def clean_text(text: Column) -> Column:
    """The whole cleaner.

    The four sentence marks and the camel-case rule all put a space before a
    capital, and no match of one can overlap a match of another, so they share
    one pass.  Nothing needs doing for newlines: the first step removed them.
    """
    text = collapse_whitespace(text)
    text = space_before_capitals(SENTENCE_MARKS + SMALL_LETTERS, text)
    text = space_before_quotes(text)
    text = space_after_quotes(text)
    text = space_before_colons(text)
    text = space_after_colons(text)
    return strip(text)
