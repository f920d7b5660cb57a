"""What each stage of the pipeline keeps, against brute force over its own input."""

import collections
import hashlib

import corpus_pipeline
from pressloom.llm import quality
from tests.conftest import SMALL
from tests.llm.helpers import classes
from tests.llm.test_groups import _fingerprint
from tests.llm.test_selection import _contains, _counts, _targets, _tokens


def _rows(table):
    return sorted(table.collect(), key=lambda r: (r.doc_id, r.text or ""))


def _stage(name, spark, docs):
    return _rows(dict(corpus_pipeline.STAGES)[name](spark, docs, SMALL))


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = _rows(docs)

    good = _stage("quality rules", spark, docs)
    verdicts = {r.row_.doc_id: r.kept for r in quality.judged(docs, keep=["doc_id"]).collect()}
    kept = [r for r in given if verdicts[r.doc_id]]
    assert good == kept and len(kept) < len(given)
    for r in kept:
        n, _, _, _, repeated = _counts(r.text)
        assert n >= 10 and 100 * repeated <= 20 * n

    docs = spark.createDataFrame(good, docs.schema)
    prints = {r.doc_id: _fingerprint(r.text) for r in good}
    ids = list(prints)
    linked = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 3]
    component = classes(ids, linked)
    different = _stage("near duplicates", spark, docs)
    assert different == [r for r in good if component[r.doc_id] == r.doc_id] and len(different) < len(good)

    docs = spark.createDataFrame(different, docs.schema)
    items = [_tokens(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    unseen = _stage("decontamination", spark, docs)
    found = set()
    for r in different:
        own = _tokens(r.text)
        inside = set(own)
        if any(len(set(t) & inside) >= 4 and _contains(own, t) for t in items):
            found.add(r.doc_id)
    assert unseen == [r for r in different if r.doc_id not in found] and found

    docs = spark.createDataFrame(unseen, docs.schema)
    weighed = _stage("mixing", spark, docs)
    sizes = collections.Counter()
    for r in unseen:
        sizes[r.source] += len((r.text or "").encode().split())
    targets, taken = _targets(sizes), collections.Counter()
    times = collections.Counter(r.doc_id for r in weighed)
    whole = {r.doc_id: r.text for r in unseen}
    for r in weighed:
        taken[r.source] += len((r.text or "").encode().split())
        assert whole[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items()) and max(times.values()) <= 3

    dealt = corpus_pipeline.STAGES[-1][1](spark, spark.createDataFrame(weighed, docs.schema), SMALL).collect()
    assert sorted((r.doc_id, r.text) for r in dealt) == sorted((r.doc_id, r.text) for r in weighed)
    ranked = collections.defaultdict(list)
    for r in dealt:
        ranked[r.source].append((hashlib.md5(f"20/{r.doc_id}".encode()).hexdigest(), r))
    for source, rows in ranked.items():
        offset = int(hashlib.md5(f"20/{source}".encode()).hexdigest()[:8], 16) / 2**32
        rows.sort(key=lambda x: (x[0], x[1].shard, x[1].slot))
        place = [(r.shard, r.slot) for _, r in rows]
        assert place == sorted(place)
        for rank, (_, r) in enumerate(rows):
            # The fraction says how far into all rows a row stands; other sources move it by a few rows.
            assert abs((rank + offset) / len(rows) * 16 - r.shard - r.slot / (len(dealt) / 16)) < 16 * len(ranked) / len(dealt) + 0.2
    counts = collections.Counter(r.shard for r in dealt)
    assert max(counts.values()) - min(counts.values()) <= 1
