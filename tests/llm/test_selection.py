"""Shards, mixtures, quality rules, decontamination and language against brute force and awkward rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressloom.llm import decontamination, language, mixing, quality, sharding
from tests.conftest import SMALL
from tests.llm.helpers import awkward, empty


def _documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_shards_are_even_and_match_the_mixture(spark):
    docs = _documents(spark)
    rows = sharding.interleave(docs, 7).collect()
    sizes = collections.Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and len(rows) == docs.count()
    for shard, n in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))
    for source, n in collections.Counter(r.source for r in rows).items():
        for shard in sizes:
            have = sum(r.source == source and r.shard == shard for r in rows)
            assert abs(have - n / 7) < 2
    again = {(r.doc_id, r.shard, r.slot) for r in sharding.interleave(docs.repartition(5), 7).collect()}
    assert again == {(r.doc_id, r.shard, r.slot) for r in rows}


def test_shards_of_awkward_rows(spark):
    rows = sharding.interleave(awkward(spark), 4).collect()
    assert len(rows) == awkward(spark).count()
    assert sorted(collections.Counter(r.shard for r in rows).values()) == [3, 3, 3, 4]
    assert rows[0].asDict().keys() == {*awkward(spark).columns, "slot"}
    assert sharding.interleave(empty(spark)).count() == 0


def _targets(sizes, weights=(5, 2, 1)):
    """Reshares what is above a limit until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        free = [s for s in names if s not in fixed]
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    chance = random.Random(seed)
    sizes = {f"s{i}": chance.choice([0, 1, 10, 100, 5_000]) for i in range(7)} | {None: 30}
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source_ string, source_size bigint")).collect()
    wanted = _targets(sizes)
    assert {r.source_: round(r.target, 6) for r in rows} == {s: round(t, 6) for s, t in wanted.items()}


def test_quotas_are_exact_and_random():
    counts = np.array([100, 7, 0, 301, 12])
    leaves = [mixing.leaf_quotas(counts, i, 6, 1) for i in range(6)]
    assert (sum(q for q, _ in leaves) == counts).all()
    before = np.zeros_like(counts)
    for quota, start in leaves:
        assert (start == before).all()
        before = before + quota
    totals = [int(q.sum()) for q, _ in leaves]
    assert max(totals) - min(totals) <= 2
    draws = [mixing.leaf_quotas(counts, 0, 2, seed)[0][0] for seed in range(400)]
    # Half of 420 blocks drawn, 100 of them good: mean 50, variance 19.1.
    assert abs(np.mean(draws) - 50) < 1 and 14 < np.var(draws) < 25


def test_draws_have_the_chances_of_the_urn():
    for have, rest, n in [(5, 7, 4), (1, 0, 1), (3, 0, 2), (40, 2, 41), (9, 30, 20)]:
        ways = [math.comb(have, k) * math.comb(rest, n - k) if k <= n else 0 for k in range(have + 1)]
        total = np.cumsum(ways) / sum(ways)
        for at in np.arange(0.005, 1, 0.01):
            if np.abs(total - at).min() > 1e-9:
                assert mixing.drawn_of(have, rest, n, at) == int(np.count_nonzero(total <= at))
    # Far beyond what fits a 32-bit number: mean and variance of the quantiles.
    draws = [mixing.drawn_of(3 * 10**8, 6 * 10**8, 45 * 10**7, (i + 0.5) / 100) for i in range(100)]
    assert abs(np.mean(draws) / 1.5e8 - 1) < 1e-6 and 0.95 < np.var(draws) / 5e7 < 1.01


@pytest.mark.parametrize("n", [1, 2, 8, 9, 504, 1_000])
def test_blocks_are_permuted(spark, n):
    block = F.monotonically_increasing_id()
    slots = [r[0] for r in spark.range(n).coalesce(1).select(mixing.permuted(block, F.lit(n), 9)).collect()]
    assert sorted(slots) == list(range(n))
    if n >= 504:  # neighbours part
        assert sum(abs(a - b) < 3 for a, b in zip(slots, slots[1:])) < 0.02 * n


def test_shards_of_a_mix_share_no_block(spark, tmp_path):
    chance = random.Random(4)
    docs = spark.createDataFrame(
        [(i, " ".join(f"w{i}" for _ in range(chance.randint(1, 9))), f"s{i % 3}") for i in range(3_000)],
        "doc_id bigint, text string, source string")
    rows = mixing.drawn(docs, n_shards=6, block_words=50).collect()
    of = collections.defaultdict(set)
    for r in rows:
        for d in r.draws or ():
            of[r.row_.source, d.block].add(d.shard)
    assert all(len(shards) == 1 for shards in of.values())
    # No document is as long as a block, so each block begins one, and a shard has all its quota.
    counts = [-(-round({r.row_.source: r.target for r in rows}[s]) // 50) for s in ("s0", "s1", "s2")]
    for leaf in range(6):
        quota, _ = mixing.leaf_quotas(np.array(counts), leaf, 6, mixing.SEED)
        assert [sum(shards == {leaf} for (s, _), shards in of.items() if s == name) for name in ("s0", "s1", "s2")] == quota.tolist()
    mixed = mixing.mix(docs, n_shards=6, block_words=50)
    mixing.write_mix(mixed, str(tmp_path / "mix"))
    written = spark.read.parquet(str(tmp_path / "mix")).select(*mixed.columns)
    as_rows = lambda df: collections.Counter(map(tuple, df.collect()))
    assert as_rows(written) == as_rows(mixed)
    ids = [r.doc_id for r in spark.read.parquet(str(tmp_path / "mix" / "mix_shard=0")).coalesce(1).collect()]
    assert ids != sorted(ids)


def test_mix_takes_the_targets(spark):
    docs = _documents(spark)
    rows = mixing.drawn(docs, keep=["doc_id", "source"]).collect()
    assert len(rows) == docs.count()
    taken = collections.Counter()
    for r in rows:
        words = sum(d.taken for d in r.draws or ())
        assert words <= 3 * r.size and all(0 <= d.shard < 16 for d in r.draws or ())
        taken[r.row_.source] += words
    targets = {r.row_.source: r.target for r in rows}
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    mixed = mixing.mix(docs).collect()
    assert sum(len(r.text.encode().split()) for r in mixed) == sum(taken.values())


def test_mix_of_awkward_rows(spark):
    rows = mixing.drawn(awkward(spark), keep=["doc_id"]).collect()
    assert len(rows) == awkward(spark).count()
    assert all(not r.draws for r in rows if r.size == 0)
    mixed = mixing.mix(awkward(spark))
    assert mixed.columns == [*awkward(spark).columns, "mix_shard", "mix_order"]
    assert mixed.count() == sum(len(r.draws or ()) for r in rows)
    assert mixing.mix(empty(spark)).count() == 0


def _counts(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if line.encode().split()]
    return len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(repeated)


def _judged(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality.judged(docs).collect()
    for r in rows:
        assert tuple(r[n] for n in names) == _counts(r.row_.text)
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
    return rows


def test_quality_counts_and_verdicts(spark):
    lines = [(i, f"line {i % 3} here\n" * (i % 5) + "a b c d e f g h i j a b c d e", "en", "s") for i in range(20)]
    _judged(spark.createDataFrame(lines, "doc_id bigint, text string, lang string, source string"))
    rows = _judged(awkward(spark))
    assert len(rows) == awkward(spark).count()
    assert quality.keep_good(awkward(spark)).columns == awkward(spark).columns
    assert quality.keep_good(empty(spark)).count() == 0


def _planted(junk, share):
    """Rows of one group: 300 clean texts, and a share of junk that passes the base rules."""
    chance = random.Random(7)
    word = lambda a, b: "".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=chance.randint(a, b)))
    clean = [" ".join(word(2, 9) for _ in range(int(chance.lognormvariate(5, 0.5)) + 20)) for _ in range(300)]
    junk_text = lambda: " ".join(word(1, 3) + chance.choice(("", "#", "$%", "|<>")) for _ in range(chance.randint(30, 80)))
    n = round(300 * share / (1 - share))
    bad = [junk_text()] * n if junk == "copied" else [junk_text() for _ in range(n)]
    return [(i, t, "en", "s") for i, t in enumerate(clean + bad)]


@pytest.mark.parametrize("junk", ["copied", "varied"])
@pytest.mark.parametrize("share", [0.3, 0.4])
def test_junk_does_not_shape_its_group(spark, junk, share):
    rows = quality.judged(spark.createDataFrame(_planted(junk, share), "doc_id bigint, text string, lang string, source string")).collect()
    assert not any(r.base_failed for r in rows)
    assert sum(r.kept for r in rows if r.row_.doc_id < 300) >= 297
    assert not any(r.kept for r in rows if r.row_.doc_id >= 300)


def test_outliers_against_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judged(docs, keep=["doc_id"]).where(~F.col("base_failed")).select("row_.doc_id", "kept", "distance")
    by = {(r.quality, r.kept): r["count"] for r in rows.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert by.get((1, False), 0) <= 0.005 * by[1, True]
    assert by.get((0, True), 0) <= 0.1 * by[0, False]


def test_covariance_is_the_least(spark):
    """On one group, the estimate is near that of the rows without the planted outliers."""
    draw = np.random.default_rng(0)
    clean = draw.multivariate_normal([5, 5, 1, 1, 1], np.diag([1, 0.3, 0.5, 0.4, 0.2]), 900)
    far = draw.multivariate_normal([9, 9, 6, 6, 6], np.diag([0.1] * 5), 200)
    rows = [("en", "s", i, *map(int, np.round(x * quality.GRAIN))) for i, x in enumerate(np.vstack([clean, far]))]
    measured = spark.createDataFrame(rows, "lang_ string, source_ string, row_no_ bigint, x0 bigint, x1 bigint, x2 bigint, x3 bigint, x4 bigint")
    found = quality.fit(measured).first()
    assert np.abs([found[f"m{i}"] for i in range(5)] - clean.mean(0)).max() < 0.15


def test_masks_fit_between_any_three_changes():
    for changed in itertools.combinations(range(decontamination.WINDOW), 3):
        assert any(
            all(bit == "0" or at + i not in changed for i, bit in enumerate(mask))
            for mask in decontamination.MASKS for at in range(decontamination.WINDOW - len(mask) + 1)
        )


def test_decontamination_tolerates_changes(spark):
    chance = random.Random(2)
    words = [f"word{i}" for i in range(300)]
    items = [(i, " ".join(chance.choices(words, k=n))) for i, n in enumerate([40, 15, 22, 9, 5, 300])] + [(9, None), (10, "")]
    docs, wanted = [], {}
    for d in range(60):
        item, text = items[d % 6]
        body = text.split()
        changes = d // 6 % 5
        # Spread so that every fifteen tokens hold about as many changes.
        body = [("changed" if changes and i % (15 // changes) == 1 else w) for i, w in enumerate(body)]
        docs.append((d, " ".join(chance.choices(words, k=30) + body + chance.choices(words, k=30)).upper()))
        if (len(body) >= 15 and changes <= 3) or (8 <= len(body) < 15 and body.count("changed") <= len(body) // 5):
            wanted[d] = item
    rows = decontamination.found_items(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    found = {r.row_.doc_id: r.items_ for r in rows if r.items_}
    assert found == {d: [i] for d, i in wanted.items()} and len(rows) == len(docs)


def _tokens(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def _contains(doc, item):
    """By comparing every alignment: 12 of 15 tokens, or a whole short item but for one token in five."""
    if not item or not doc:
        return False
    if len(item) < 8:
        return doc == item
    number = {t: i for i, t in enumerate(dict.fromkeys(doc + item))}
    a, b = np.array([number[t] for t in doc]), np.array([number[t] for t in item])
    span, least = (15, 12) if len(b) >= 15 else (len(b), len(b) - len(b) // 5)
    for shift in range(span - len(b), len(a) - span + 1):
        low, high = max(0, -shift), min(len(b), len(a) - shift)
        same = np.concatenate([[0], np.cumsum(a[shift + low : shift + high] == b[low:high])])
        if high - low >= span and (same[span:] - same[:-span]).max() >= least:
            return True
    return False


def test_decontamination_against_every_alignment(spark):
    """All documents, with items of one to three hundred tokens planted with none to three changes each."""
    chance = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    docs = [(r.doc_id, r.text) for r in _documents(spark).collect() if len(r.text or "") < 20_000]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for i, n in enumerate((1, 2, 3, 5, 7, 8, 8, 9, 9, 10, 10, 11, 12, 13, 14, 14, 15, 16, 40, 300)):
        body = chance.choices(words, k=n)
        items.append((1_000 + i, " ".join(body)))
        for changes in range(4):
            own = list(body)
            for at in chance.sample(range(n), min(changes, n)):
                own[at] = "other"
            around = chance.choices(words, k=8) if changes % 2 else []
            docs.append((10_000 + 10 * i + changes, ", ".join(around + own + around).upper()))
        docs.append((10_005 + 10 * i, " ".join(chance.choices(words, k=4) + body + ["end"])))
    rows = decontamination.found_items(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    found = {r.row_.doc_id: r.items_ or [] for r in rows}
    cut = {i: _tokens(t) for i, t in items}
    short = {i: set(t) for i, t in cut.items()}
    for doc_id, text in docs:
        own = _tokens(text)
        inside = set(own)
        # An alignment needs most of fifteen tokens, so few items need be compared.
        near = [i for i, t in cut.items() if len(short[i] & inside) >= min(len(short[i]) * 0.5, 4)]
        assert found[doc_id] == sorted(i for i in near if _contains(own, cut[i])), doc_id
    assert sum(map(len, found.values())) > 60


def test_decontamination_without_a_table_of_seeds(spark, monkeypatch):
    docs, items = _documents(spark), spark.read.parquet(f"{SMALL}/benchmark.parquet")
    with_table = {(r.row_.doc_id, tuple(r.items_ or ())) for r in decontamination.found_items(docs, items).collect()}
    monkeypatch.setattr(decontamination, "MOST_SEEDS", 0)
    assert {(r.row_.doc_id, tuple(r.items_ or ())) for r in decontamination.found_items(docs, items).collect()} == with_table
    assert any(i for _, i in with_table)


def test_decontamination_of_awkward_rows(spark):
    items = spark.createDataFrame([(1, "nothing of this kind is there at all in these rows, not at all"), (2, None)], "item_id bigint, text string")
    rows = decontamination.decontaminated(awkward(spark), items)
    assert rows.count() == awkward(spark).count() and rows.columns == awkward(spark).columns
    assert decontamination.decontaminated(awkward(spark), items.limit(0)).count() == awkward(spark).count()
    assert decontamination.decontaminated(empty(spark), items).count() == 0


def _ways(word, probability):
    """Sum over all ways to cut a word."""
    if not word:
        return 1.0
    return sum(probability(word[:n]) * _ways(word[n:], probability) for n in range(1, len(word) + 1))


def test_forward_sums_all_segmentations():
    vocabulary = ["a", "ab", "b", "ba", "bab", "▁", "▁a"]
    lattice = language.Lattice(vocabulary)
    model = np.vstack([np.linspace(0.05, 0.3, 7)[:, None] * [1, 0.5], [[1e-10, 1e-10]]])
    words = ["▁abab", "▁", "▁babx", "a", "▁aaaa"]
    found = lattice.likelihoods(words, model)
    for column in (0, 1):
        chance = lambda p, c=column: model[vocabulary.index(p), c] if p in vocabulary else (1e-10 if len(p) == 1 else 0)
        assert np.allclose(found[:, column], [np.log(_ways(w, chance)) for w in words])
    used = lattice.expected(["▁abab"], np.array([2.0]), model[:, 0])
    letters = sum(u * len(p) for u, p in zip(used, vocabulary))
    assert abs(letters - 2 * 5) < 1e-9


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.predicted(docs, keep=["lang"]).where("held_out").collect()
    assert sum(r.lang_pred == r.row_.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    rows = language.predicted(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    for r in rows:
        letters = any(c.isalpha() for c in r.row_.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)
    assert language.predicted(empty(spark)).count() == 0


def test_texts_without_a_letter_and_words_of_any_length(spark):
    long = "wort" * 30_000
    rows = [(i, f"the cat and the dog number {i}", "en") for i in range(40)] + [(100 + i, f"der hund und die katze {i}", "de") for i in range(40)]
    rows += [(500, "½ ² ①", None), (501, "123 __ !?", None), (502, long, None), (503, "हिन्दी हिन्दी", None), (504, "", None)]
    found = {r.row_.doc_id: r for r in language.predicted(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (500, 501, 504))
    assert found[502].lang_pred in ("en", "de") and 0 <= found[502].score <= 1 and found[503].lang_pred != "und"
    assert language.WORD.findall("हिन्दी") == ["हिन्दी"]


def test_sources_of_one_row_fill_all_shards_alike(spark):
    rows = [(i, f"t{i}", f"own{i}" if i % 3 == 0 else "big") for i in range(4_800)]
    found = sharding.interleave(spark.createDataFrame(rows, "doc_id bigint, text string, source string"), 16).collect()
    own = collections.Counter(r.shard for r in found if r.source != "big")
    assert min(own.values()) > 60 and max(own.values()) < 140 and len(own) == 16
    assert set(collections.Counter(r.shard for r in found).values()) == {300}


def test_columns_that_clash_with_those_of_the_mix(spark):
    docs = spark.createDataFrame(
        [(i, "a b c d", "s", i, "x", 1, "k") for i in range(40)],
        "doc_id bigint, text string, source string, size_ bigint, draw_ string, mix_shard int, `a.b` string")
    mixed = mixing.mix(docs)
    assert mixed.columns == ["doc_id", "text", "source", "size_", "draw_", "a.b", "mix_shard", "mix_order"]
    assert all(r.size_ == r.doc_id and r.draw_ == "x" for r in mixed.collect())
    assert sharding.interleave(docs).count() == 40 and quality.keep_good(docs.withColumn("lang", F.lit("en"))).columns == [*docs.columns, "lang"]


def test_a_word_of_many_millions_of_letters_is_no_overflow(spark):
    rows = [("en", "s", i, 400 + i % 50, 400, 10, 0, 0) for i in range(60)] + [("en", "s", 99, 5_000, int(256 * np.log(4e8)), 0, 0, 0)]
    measured = spark.createDataFrame(rows, "lang_ string, source_ string, row_no_ bigint, x0 bigint, x1 bigint, x2 bigint, x3 bigint, x4 bigint")
    assert quality.fit(measured).first().n_ >= 30
    vectors = spark.createDataFrame([(10, 4_000_000_000, 0, 0, 0)], "n_words bigint, word_chars bigint, n_symbols bigint, n_repeat_words bigint, n_dup_lines bigint")
    assert max(vectors.select(*quality.vector()).first()) < 10_000


def test_small_groups_are_drawn_towards_their_language(spark):
    """A group of a few rows takes most of its centre from its language, one of many rows its own."""
    draw = np.random.default_rng(1)

    def group(source, centre, n):
        return [("en", source, hash((source, i)), *map(int, np.round(draw.normal(centre, 0.3, 5) * quality.GRAIN))) for i in range(n)]

    rows = group("big", 4, 2_000) + group("own", 6, 2_000) + group("few", 9, 4)
    measured = spark.createDataFrame(rows, "lang_ string, source_ string, row_no_ bigint, x0 bigint, x1 bigint, x2 bigint, x3 bigint, x4 bigint")
    found = {r.source_: r for r in quality.fit(measured).collect()}
    assert abs(found["big"].m0 - 4) < 0.1 and abs(found["own"].m0 - 6) < 0.1 and found["few"].m0 < 5.6
