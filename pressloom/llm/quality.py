"""Quality rules: robust multivariate outliers per language and source.

Every text gets counts; a few hard limits come first.  The counts of texts that
pass become a vector of five transformed statistics.  For each language and
source the minimum covariance determinant is sought: concentration steps from
three starts keep the half of the rows nearest to the current centre, and the
start whose covariance has the least determinant wins.  A group's estimate is
drawn towards that of its language, and a language's towards that of the whole
table, as if by some more rows of these; the fewer rows it has, the more.  A
text is rejected if its squared Mahalanobis distance is above a limit.  Equal
texts of a group count once in the estimate, so copies of one text cannot make
up its half, however many they are; every row gets a verdict.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.common import SPACE, dice, named, share, table, words
from pressloom.session import cut_lineage

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

#: Statistics are held as whole numbers of 1/256, so that sums are exact and reruns agree.
GRAIN = 256.0
#: A spread below these is not trusted: most texts have no symbol at all, and a
#: few must not become outliers by that alone.  In the order of ``vector``.
LEAST_SPREAD = (0.5, 0.06, 0.5, 1.0, 1.0)
DIMS = len(LEAST_SPREAD)
#: Share of rows that a concentration step keeps, and what the covariance of
#: that share must be multiplied by to hold for all (normal data, five dimensions).
KEPT_SHARE = 0.5
CONSISTENCY = 1.916
#: Squared distance beyond which a text is an outlier: the 0.9999 quantile of
#: chi-squared with five degrees of freedom.
LIMIT = 25.74
#: How many rows of its language a group is given beside its own, a language of
#: the whole table, and the table of a population as wide as this.
MORE_ROWS = 25
WIDE_SPREAD = (1.5, 0.25, 1.5, 2.0, 2.0)
#: Steps for all starts, then for the best one.
FIRST_STEPS, LAST_STEPS = 2, 2
STARTS = 3
#: Rows in a random start, about.
START_ROWS = 60
#: Parts of a doubling into which squared distances are binned.
BINS = 32

GROUP = ["lang_", "source_"]


def counted(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` (long).

    No text and an empty one have zero of each.  Everything is per row, in time
    near linear in the text: repeated windows are found by sorting hashes of
    the row's windows, and only where a hash occurs twice.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    bare = functools.reduce(lambda t, s: F.replace(t, F.lit(s), F.lit("")), SYMBOLS, whole)
    lines = F.filter(F.split(whole, "\n"), lambda line: F.regexp_replace(line, SPACE, "") != "")
    hashes = F.expr(
        "CASE WHEN size(words_) >= {n} THEN transform(sequence(0, size(words_) - {n}), i -> xxhash64({ws})) "
        "ELSE CAST(array() AS array<bigint>) END".format(
            n=WINDOW, ws=", ".join(f"get(words_, i + {i})" for i in range(WINDOW))
        )
    )
    rows = rows.withColumn("words_", words(F.col(text))).withColumn("lines_", lines)
    rows = rows.withColumn("hashes_", hashes)
    rows = rows.withColumn(
        "sorted_",
        F.when(
            F.size(F.array_distinct("hashes_")) < F.size("hashes_"),
            F.sort_array(F.transform("hashes_", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    rows = rows.withColumn(
        "starts_",
        F.expr(
            "sort_array(transform(filter(sorted_, (s, j) -> s.h <=> get(sorted_, j - 1).h "
            "OR s.h <=> get(sorted_, j + 1).h), s -> s.i))"
        ),
    )
    repeated = F.expr(
        f"aggregate(transform(starts_, (s, j) -> least({WINDOW}, coalesce(get(starts_, j + 1) - s, {WINDOW}))), "
        "0L, (sum, n) -> sum + n)"
    )
    return rows.withColumns({
        "n_words": F.size("words_").cast("bigint"),
        "word_chars": F.char_length(F.array_join("words_", "")).cast("bigint"),
        "n_symbols": (F.char_length(whole) - F.char_length(bare)).cast("bigint"),
        "n_dup_lines": (F.size("lines_") - F.size(F.array_distinct("lines_"))).cast("bigint"),
        "n_repeat_words": F.coalesce(repeated, F.lit(0)).cast("bigint"),
    }).drop("words_", "lines_", "hashes_", "sorted_", "starts_")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))


def vector() -> list[Column]:
    """Logarithm of length, word length, symbols, repeated words and lines in a hundred words.

    Rates are drawn towards a usual value as if by twenty more words, since
    those of short texts scatter.
    """
    n = F.col("n_words") + 20
    rate = lambda c: F.log1p(100 * F.col(c) / n)
    parts = [F.log1p("n_words"), F.log((F.col("word_chars") + 100) / n), rate("n_symbols"), rate("n_repeat_words"), rate("n_dup_lines")]
    return [F.round(p * GRAIN).cast("bigint") for p in parts]


def _solved() -> list[Column]:
    """The vector less the centre, solved by the triangular factor row after row."""
    y: list[Column] = []
    for i in range(DIMS):
        rest = F.col(f"x{i}") / GRAIN - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * F.col(f"y{j}")
        y.append(rest / F.col(f"l{i}{i}"))
    return y


def with_distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2_`` to rows that hold a vector, a centre and a triangular factor."""
    for i, y in enumerate(_solved()):
        rows = rows.withColumn(f"y{i}", y)
    total = functools.reduce(lambda a, b: a + b, (F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIMS)))
    return rows.withColumn("d2_", total).drop(*(f"y{i}" for i in range(DIMS)))


PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]
SUMS = [*(f"s{i}" for i in range(DIMS)), *(f"s{i}{j}" for i, j in PAIRS)]


def _sums(chosen: DataFrame, keys: list[str]) -> DataFrame:
    """Number, sums and sums of products of each group's rows."""
    return chosen.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_"),
        *(F.sum(f"x{i}").alias(f"s{i}") for i in range(DIMS)),
        *(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in PAIRS),
    )


def _estimate(sums: DataFrame, keys: list[str], consistency: float) -> DataFrame:
    """Centre, triangular factor and log determinant from each group's sums."""
    pairs = PAIRS
    for i in range(DIMS):
        sums = sums.withColumn(f"m{i}", F.col(f"s{i}") / F.col("n_") / GRAIN)
    for i, j in pairs:
        spread = F.col(f"s{i}{j}") / F.col("n_") / GRAIN**2 - F.col(f"m{i}") * F.col(f"m{j}")
        spread = spread * consistency + (F.lit(LEAST_SPREAD[i] ** 2) if i == j else F.lit(0.0))
        sums = sums.withColumn(f"c{i}{j}", spread)
    for i, j in pairs:
        rest = F.col(f"c{i}{j}")
        for k in range(j):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
        # The added spread keeps the diagonal positive; rounding must not undo it.
        sums = sums.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(1e-6))) if i == j else rest / F.col(f"l{j}{j}"))
    det = functools.reduce(lambda a, b: a + b, (F.log(F.col(f"l{i}{i}")) for i in range(DIMS)))
    return sums.select(
        *keys, "n_", det.alias("det_"), *(f"m{i}" for i in range(DIMS)), *(f"l{i}{j}" for i, j in pairs)
    )


def _met(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Each row with each estimate of its group."""
    e = estimates.select(*(F.col(g).alias(f"{g}e") for g in GROUP), *(c for c in estimates.columns if c not in GROUP))
    same = functools.reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"{g}e")) for g in GROUP))
    return rows.join(e, same, how).drop(*(f"{g}e" for g in GROUP))


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One concentration step: sums over the nearest half, found by bins of the distance."""
    keys = [*GROUP, "start_"]
    near = with_distance(_met(rows, estimates)).withColumn(
        "bin_", F.floor(F.log2(F.col("d2_") + 1e-6) * BINS)
    ).select(*keys, "bin_", *(f"x{i}" for i in range(DIMS)))
    bins = near.groupBy(*keys, "bin_").agg(F.count(F.lit(1)).alias("in_bin_"))
    upto = Window.partitionBy(*keys).orderBy("bin_")
    cut = (
        bins.withColumn("upto_", F.sum("in_bin_").over(upto))
        .withColumn("all_", F.sum("in_bin_").over(Window.partitionBy(*keys)))
        .where(F.col("upto_") >= KEPT_SHARE * F.col("all_"))
        .groupBy(*keys).agg(F.min("bin_").alias("last_"))
        .select(*(F.col(k).alias(f"{k}c") for k in keys), "last_")
    )
    same = functools.reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}c")) for k in keys))
    kept = near.join(cut_lineage(cut), same).where(F.col("bin_") <= F.col("last_"))
    return cut_lineage(_sums(kept, keys))


def _starts(rows: DataFrame) -> DataFrame:
    """Three starts a group: the rows about the medians of all statistics, and two random handfuls."""
    sizes = cut_lineage(rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows_")))
    sized = _met(rows, sizes)
    spread = sized.select(
        *GROUP, F.posexplode(F.array(*(F.col(f"x{i}") for i in range(DIMS)))).alias("dim_", "x_")
    )
    counts = spread.groupBy(*GROUP, "dim_", "x_").agg(F.count(F.lit(1)).alias("in_"))
    whole = Window.partitionBy(*GROUP, "dim_")
    middle = (
        counts.withColumn("upto_", F.sum("in_").over(whole.orderBy("x_")))
        .withColumn("all_", F.sum("in_").over(whole))
        .groupBy(*GROUP, "dim_")
        .agg(*(
            F.min(F.when(F.col("upto_") >= q * F.col("all_"), F.col("x_"))).alias(f"q{int(q * 100)}")
            for q in (0.25, 0.5, 0.75)
        ))
    )
    at = [F.max(F.when(F.col("dim_") == i, F.col("q50"))).alias(f"m{i}") for i in range(DIMS)]
    scale = [
        F.sqrt(
            F.pow(F.max(F.when(F.col("dim_") == i, F.col("q75") - F.col("q25"))) / 1.349 / GRAIN, F.lit(2))
            + LEAST_SPREAD[i] ** 2
        ).alias(f"l{i}{i}")
        for i in range(DIMS)
    ]
    median = middle.groupBy(*GROUP).agg(*at, *scale)
    median = median.select(
        *GROUP, F.lit(0).alias("start_"), F.lit(0).cast("bigint").alias("n_"), F.lit(0.0).alias("det_"),
        *((F.col(f"m{i}") / GRAIN).alias(f"m{i}") for i in range(DIMS)),
        *(F.col(f"l{i}{i}") if i == j else F.lit(0.0).alias(f"l{i}{j}") for i in range(DIMS) for j in range(i + 1)),
    )
    drawn = sized.withColumn("start_", F.explode(F.array(*(F.lit(s) for s in range(1, STARTS)))))
    drawn = drawn.where(share(dice(0, F.col("start_"), F.col("row_no_"))) * F.col("rows_") < START_ROWS)
    return cut_lineage(median.unionByName(_estimate(_sums(drawn, [*GROUP, "start_"]), [*GROUP, "start_"], 1.0)))


def _with_more(sums: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Sums as if each group held some more rows, spread like those of ``more`` (its means, by the keys)."""
    m = more.select(*(F.col(k).alias(f"{k}m") for k in keys), *(F.col(c).alias(f"{c}m") for c in SUMS))
    same = functools.reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{k}m")) for k in keys), F.lit(True))
    return sums.join(m, same).select(
        *(g for g in GROUP if g in sums.columns), (F.col("n_") + MORE_ROWS).alias("n_"),
        *((F.col(c) + MORE_ROWS * F.col(f"{c}m")).alias(c) for c in SUMS))


def _pooled(sums: DataFrame, keys: list[str]) -> DataFrame:
    return sums.groupBy(*keys).agg(F.sum("n_").alias("n_"), *(F.sum(F.col(c).cast("double")).alias(c) for c in SUMS))


def _means(sums: DataFrame, keys: list[str]) -> DataFrame:
    return sums.select(*keys, *((F.col(c) / F.col("n_")).alias(c) for c in SUMS))


def _drawn_together(groups: DataFrame) -> DataFrame:
    """Sums of the groups, each with rows like its language's, and these with rows like the table's."""
    table_ = _pooled(groups, [])
    # The table's own means, and around them a population that is wide.
    more = {
        f"s{i}{j}": F.col(f"s{i}") / F.col("n_") * F.col(f"s{j}") / F.col("n_")
        + (F.lit((WIDE_SPREAD[i] * GRAIN) ** 2 / CONSISTENCY) if i == j else F.lit(0.0))
        for i, j in PAIRS
    } | {f"s{i}": F.col(f"s{i}") / F.col("n_") for i in range(DIMS)}
    table_ = table_.where("n_ > 0").select(
        (F.col("n_") + MORE_ROWS).alias("n_"), *((F.col(c) + MORE_ROWS * more[c]).alias(c) for c in SUMS))
    languages = _with_more(_pooled(groups, ["lang_"]), cut_lineage(_means(table_, [])), [])
    return _with_more(groups, cut_lineage(_means(languages, ["lang_"])), ["lang_"])


def fit(measured: DataFrame) -> DataFrame:
    """Centre and triangular factor for each language and source.

    ``measured`` has ``lang_ source_ row_no_`` and the vector ``x0`` to ``x4``
    of texts that passed the base rules; equal rows count once.  Jobs run here;
    what they save is the distinct vectors and one row a group.
    """
    vectors = [f"x{i}" for i in range(DIMS)]
    rows = cut_lineage(measured.select("lang_", "source_", "row_no_", *vectors).distinct())
    keys = [*GROUP, "start_"]
    estimates = _starts(rows)
    for _ in range(FIRST_STEPS):
        sums = _step(rows, estimates)
        estimates = _estimate(sums, keys, CONSISTENCY)
    best = Window.partitionBy(*GROUP).orderBy("det_", "start_")
    estimates = cut_lineage(estimates.withColumn("place_", F.row_number().over(best)).where("place_ = 1").drop("place_"))
    for _ in range(LAST_STEPS):
        sums = _step(rows, estimates)
        estimates = _estimate(sums, keys, CONSISTENCY)
    return cut_lineage(_estimate(_drawn_together(sums.drop("start_")), GROUP, CONSISTENCY).drop("det_"))


def judged(
    docs: DataFrame, keep: list[str] | None = None, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """A struct ``row_`` of the columns to keep, the counts, ``base_failed``, ``distance`` and ``kept``.

    No text and an empty one fail the base rules.  Null languages and sources
    are groups like others.  Repeated rows get equal verdicts.  What fitting
    reads several times is saved: without the texts, which are counted again
    if they are kept, since counting costs less than another copy of them.
    """
    kept_columns = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*named(kept_columns)).alias("row_") if kept_columns else F.lit(None).alias("row_"),
        F.col(lang).cast("string").alias("lang_"), F.col(source).cast("string").alias("source_"),
        F.xxhash64(text, lang, source).alias("row_no_"), F.col(text).alias("text_"),
    )
    rows = counted(rows, "text_").drop("text_").withColumn("base_failed", base_failed())
    measured = rows.withColumns({f"x{i}": x for i, x in enumerate(vector())})
    if text in kept_columns:
        fitted = cut_lineage(measured.select(
            "lang_", "source_", "row_no_", "base_failed", *(f"x{i}" for i in range(DIMS))))
    else:
        fitted = measured = cut_lineage(measured)
    estimates = fit(fitted.where(~F.col("base_failed")))
    met = _met(measured, estimates, "left")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    # One condition on both sides of the join: split, its part on the counts
    # would move below them and be worked out from the text again.
    stays = F.when(F.col("base_failed"), False).otherwise(F.coalesce(F.col("d2_") <= LIMIT, F.lit(True)))
    return with_distance(met).select(
        "row_", *counts, "base_failed", F.sqrt("d2_").alias("distance"),
        stays.alias("kept"),
    )


def keep_good(docs: DataFrame, **columns: str) -> DataFrame:
    """``docs`` without the rejected."""
    return judged(docs, **columns).where("kept").select("row_.*")


def op3_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return judged(table(spark, sf_dir, "documents"), keep=["doc_id"]).select(
        "row_.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance",
    )
