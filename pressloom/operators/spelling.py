"""Spelling correction as joins on words, not as a pass over the text.

A word the dictionary knows stays.  Any other becomes the most frequent
dictionary word one edit away, else the most frequent two edits away, else it
stays too.  An edit inserts, deletes or replaces a letter or swaps two
neighbours; equal frequencies go to the first word in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.functions.text import let, split_words
from pressloom.session import cut_lineage

# Numbers are left alone, whatever their notation.
NUMBER = r"^[+-]?([0-9][0-9_]*\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?inf(inity)?$"


def is_checked(word: Column) -> Column:
    """Words with a letter that are not numbers."""
    return F.rlike(word, F.lit(r"\p{L}")) & ~F.rlike(F.lower(word), F.lit(NUMBER))


def build_dictionary(texts: DataFrame, column: str = "text", min_freq: int = 1) -> DataFrame:
    """Word frequencies of a trusted corpus: word, freq.

    Saved here as a table: every join below reads it, and none should count again.
    """
    words = texts.select(F.explode(split_words(F.lower(F.col(column)))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("freq"))
    return cut_lineage(counted.where((F.col("freq") >= min_freq) & is_checked(F.col("word"))))


def _without(word: Column, position: Column) -> Column:
    return F.concat(
        F.substring(word, F.lit(1), position - 1), F.substring(word, position + 1, F.length(word))
    )


def _positions(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


#: Dictionary words of at least this many letters are found by pieces instead of
#: by leaving letters out, whose number grows with the square of the length.
LONG = 20
#: Two edits spoil four pieces at most (a swap across a cut spoils two), so one survives.
PIECES = 5
#: Words that share one letter only are spread over so many keys.
SALTS = 16


def _one_left_out(word: Column) -> Column:
    return F.transform(_positions(F.lit(1), F.length(word)), lambda i: _without(word, i))


def single_keys(word: Column) -> Column:
    """Hashes of the word and of it without one letter; two words one edit apart share one.

    But for single letters, any two of which are one edit apart: they need no key.
    """
    parts = F.filter(F.concat(F.array(word), _one_left_out(word)), lambda w: w != "")
    return F.array_distinct(F.transform(parts, lambda w: F.xxhash64(w)))


def _two_left_out(word: Column) -> Column:
    """The word, and it without one or two letters, but for the empty string."""

    def from_position(i: Column) -> Column:
        """The word without letter ``i``, and that without any later letter."""
        return let(_without(word, i), lambda shorter: F.concat(
            F.array(shorter),
            F.transform(_positions(i, F.length(shorter)), lambda j: _without(shorter, j)),
        ))

    shorter = F.flatten(F.transform(_positions(F.lit(1), F.length(word)), from_position))
    return F.filter(F.array_distinct(F.concat(F.array(word), shorter)), lambda w: w != "")


def double_keys(word: Column, salt: Column | None = None) -> Column:
    """Hashes of a short word without up to two letters; two words two edits apart share one.

    Pairs that share no letter have two letters each at most and need no key.
    Single letters are shared by many words: with ``salt`` they get the key of
    that salt, without it all of them.
    """
    def hashed(part: Column) -> Column:
        if salt is not None:
            single = F.array(F.xxhash64(part, salt))
        else:
            single = F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.xxhash64(part, i))
        return F.when(F.length(part) == 1, single).otherwise(F.array(F.xxhash64(part)))

    return F.flatten(F.transform(_two_left_out(word), hashed))


def _apart(word: Column, position: Column) -> Column:
    """Whether the letter differs from the one before: of equal neighbours only the first is left out."""
    return (position <= 1) | (F.substring(word, position, F.lit(1)) != F.substring(word, position - 1, F.lit(1)))


def _with_one_left_out(rows: DataFrame, column: str) -> DataFrame:
    """Rows with a position (0: none) as ``_i`` and what the column's word is without it as ``_once``."""
    word, i = F.col(column), F.col("_i")
    placed = rows.withColumn("_i", F.explode(F.sequence(F.lit(0), F.length(word)))).where(_apart(word, i))
    return placed.withColumn("_once", F.when(i == 0, word).otherwise(_without(word, i)))


def with_single_keys(rows: DataFrame, column: str) -> DataFrame:
    """Rows with each of ``single_keys`` of a column as ``key``.

    Positions are rows, so that the parts of a word are made by compiled code
    and not inside an array.
    """
    return _with_one_left_out(rows, column).where("_once <> ''").withColumn("key", F.xxhash64("_once")).drop("_i", "_once")


def with_double_keys(rows: DataFrame, column: str, salt: Column | None = None) -> DataFrame:
    """Rows with each of ``double_keys`` of a column as ``key``, a few of them twice; made as single ones are."""
    once, i, j = _with_one_left_out(rows, column), F.col("_i"), F.col("_j")
    # A second letter before the first leaves no other out; the whole word has none.
    later = F.when(i > 0, F.length("_once")).otherwise(-1)
    twice = once.withColumn("_j", F.explode(F.sequence(i - 1, later))).where((j < i) | _apart(F.col("_once"), j))
    part = F.when(j < i, F.col("_once")).otherwise(_without(F.col("_once"), j))
    parts = twice.withColumn("_part", part).where("_part <> ''")
    salts = [salt] if salt is not None else [F.lit(i) for i in range(SALTS)]
    single = F.array(*(F.xxhash64("_part", s) for s in salts))
    key = F.explode(F.when(F.length("_part") == 1, single).otherwise(F.array(F.xxhash64("_part"))))
    return parts.withColumn("key", key).drop("_i", "_j", "_once", "_part")


def _piece(p: Column, length: Column) -> tuple[Column, Column]:
    """Where a piece of a word of this length begins (from 0), and its letters."""
    start = F.floor(p * length / PIECES).cast("int")
    return start, (F.floor((p + 1) * length / PIECES) - start).cast("int")


def piece_keys(word: Column) -> Column:
    """Length, number and letters of the five pieces of a dictionary word, hashed."""
    def key(p: Column) -> Column:
        start, size = _piece(p, F.length(word))
        return F.xxhash64(F.length(word), p, F.substring(word, start + 1, size))

    return F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), key)


def searched_piece_keys(word: Column) -> Column:
    """What a piece of a word within two edits can be: of up to two letters more or fewer, moved by two at most."""
    n = F.length(word)

    def moved(length: Column, p: Column) -> Column:
        start, size = _piece(p, length)
        at = F.filter(F.sequence(start - 2, start + 2), lambda i: (i >= 0) & (i + size <= n))
        return F.transform(at, lambda i: F.xxhash64(length, p, F.substring(word, i + 1, size)))

    every = F.transform(
        F.sequence(F.greatest(n - 2, F.lit(LONG)), n + 2),
        lambda length: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), lambda p: moved(length, p))),
    )
    return F.array_distinct(F.flatten(every))


def _swapped(word: Column, i: Column) -> Column:
    """The word with letter ``i`` and the next one swapped."""
    return F.concat(
        F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.lit(1)),
        F.substring(word, i, F.lit(1)), F.substring(word, i + 2, F.length(word)),
    )


def _letters(word: Column) -> Column:
    """The word's letters in order; a swap leaves them as they are."""
    return F.array_join(F.sort_array(F.split(word, "")), "")


def _swaps(a: Column, b: Column) -> Column:
    """How many swaps of neighbours, all apart, make one word of the other (one or two); null if not that way."""

    def compared(pair: Column) -> Column:
        crossed = lambda i, j: (F.get(pair.a, i) == F.get(pair.b, j)) & (F.get(pair.a, j) == F.get(pair.b, i))
        differ = F.filter(
            _positions(F.lit(0), F.size(pair.a) - 1), lambda i: F.get(pair.a, i) != F.get(pair.b, i))

        def judged(at: Column) -> Column:
            couple = lambda k: (F.get(at, F.lit(k + 1)) == F.get(at, F.lit(k)) + 1) & crossed(
                F.get(at, F.lit(k)), F.get(at, F.lit(k + 1)))
            return F.when((F.size(at) == 2) & couple(0), 1).when((F.size(at) == 4) & couple(0) & couple(2), 2)

        return let(differ, judged)

    return let(F.struct(F.split(a, "").alias("a"), F.split(b, "").alias("b")), compared)


def edit_distance(a: Column, b: Column, plain: Column) -> Column:
    """Edits between two words, swaps of neighbours counting one; null above two.

    ``plain`` is the distance without swaps, -1 above four.  A swap is two
    plain edits, so swaps matter up to four; and since a swap keeps the
    letters, comparing those settles most pairs before any swap is tried.
    """
    same_letters = (F.length(a) == F.length(b)) & (_letters(a) == _letters(b))
    one_letter_off = (F.abs(F.length(a) - F.length(b)) <= 1) & (
        F.levenshtein(_letters(a), _letters(b), 2) >= 0
    )

    def near(x: Column, y: Column) -> Column:
        places = _positions(F.lit(1), F.length(x) - 1)
        return F.exists(places, lambda i: F.levenshtein(_swapped(x, i), y, 1) >= 0)

    swaps = F.when(plain.between(2, 4) & same_letters, _swaps(a, b))
    return (
        F.when(plain.between(0, 1), plain)
        .when(plain == 2, F.coalesce(swaps, F.lit(2)))
        .when(swaps.isNotNull(), swaps)
        .when((plain == 3) & one_letter_off & (near(a, b) | near(b, a)), 2)
    )


def _best(left: DataFrame, right: DataFrame) -> DataFrame:
    """Best candidate of each word among those that share a key: word, best.

    Far pairs drop out as nulls of the minimum: a filter before it would be
    pushed into the join and work out every distance several times.  The
    dictionary's keys are many times its words; as a table they show the
    planner their own size.
    """
    pairs = left.join(cut_lineage(right), "key").select(
        "word", "candidate", "freq", F.levenshtein("word", "candidate", 4).alias("plain"))
    distance = edit_distance(F.col("word"), F.col("candidate"), F.col("plain"))
    graded = pairs.select("word", "candidate", "freq", distance.alias("distance"))
    rank = F.when(
        F.col("distance").isNotNull(),
        F.struct(F.col("distance"), (-F.col("freq")).alias("rarity"), F.col("candidate")),
    )
    return graded.groupBy("word").agg(F.min(rank).alias("best")).where(F.col("best").isNotNull())


def _with_default(found: DataFrame, words: DataFrame, known: DataFrame, distance: int) -> DataFrame:
    """Candidates, and for words that are so near to every one of ``known`` the most frequent of those."""
    least = known.agg(F.min(F.struct((-F.col("freq")).alias("rarity"), "candidate")).alias("least")).first().least
    if least is None:
        return found
    default = F.struct(
        F.lit(distance).alias("distance"), F.lit(least.rarity).cast("bigint").alias("rarity"), F.lit(least.candidate).alias("candidate"))
    return found.unionByName(words.select("word", default.alias("best")))


def corrections(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Best candidate for each distinct unknown word: word, correction.

    Words more than two letters longer than any of the dictionary have none and
    get no keys.  Candidates one edit away, and all long ones, are sought
    first; only words without one at one edit are sought at two.  The keys of a
    word grow with its length, not with the square of it.  Tables are saved here.
    """
    n = F.length("word")
    longest = dictionary.agg(F.max(n).alias("n")).first().n or 0
    words = cut_lineage(words.select("word").where(n <= longest + 2))
    known = dictionary.select(F.col("word").alias("candidate"), "freq")
    m = F.length("candidate")

    def keyed(rows: DataFrame, keys: Column) -> DataFrame:
        return rows.withColumn("key", F.explode(keys))

    short, short_known = words.where(n <= LONG + 1), known.where(m < LONG)
    near = _best(with_single_keys(short, "word"), with_single_keys(short_known, "candidate")).unionByName(_best(
        keyed(words.where(n >= LONG - 2), searched_piece_keys(F.col("word"))),
        keyed(known.where(m >= LONG), piece_keys(F.col("candidate"))),
    ))
    near = cut_lineage(_with_default(near, words.where(n == 1), known.where(m == 1), 1))
    settled = near.where("best.distance <= 1").select("word")
    open_words = cut_lineage(short.join(settled, "word", "left_anti"))
    salt = F.pmod(F.xxhash64("candidate"), F.lit(SALTS)).cast("int")
    far = _best(with_double_keys(open_words, "word"), with_double_keys(short_known, "candidate", salt))
    # Any two words of one or two letters are within two edits.
    found = _with_default(near.unionByName(far), open_words.where(n <= 2), known.where(m <= 2), 2)
    best = found.groupBy("word").agg(F.min("best").alias("best"))
    return best.select("word", F.col("best.candidate").alias("correction"))


def unknown(words: DataFrame, dictionary: DataFrame, column: str = "word") -> DataFrame:
    """Rows whose word is checked and not in the dictionary in any case."""
    known = dictionary.select(F.col("word").alias("_known"))
    checked = words.where(is_checked(F.col(column)))
    return checked.join(known, F.lower(F.col(column)) == F.col("_known"), "left_anti")


def correct_words(words: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Each distinct word of ``words`` with what it becomes: word, correction."""
    distinct = cut_lineage(words.select("word").distinct())
    missing = unknown(distinct, dictionary).select(F.lower("word").alias("word")).distinct()
    fixed = corrections(missing, dictionary).withColumnRenamed("word", "_lower")
    joined = distinct.join(fixed, F.lower(F.col("word")) == F.col("_lower"), "left")
    return joined.select("word", F.coalesce("correction", "word").alias("correction"))
