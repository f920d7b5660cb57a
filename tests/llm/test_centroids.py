"""Clusters against Lloyd's rounds in whole numbers, one vector at a time."""

import hashlib
import math
import random

from pyspark.sql import functions as F

from pressloom.llm import centroids

SCHEMA = "vec_id bigint, embedding array<float>, cluster string, at_ int"


def plainly(rows, dims, clusters, rounds):
    """Cluster and squared distance of each usable vector, and the last centroids."""
    usable = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    ints = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in usable]
    order = sorted(ints, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(v) for _, v in order[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centres))

    for _ in range(rounds):
        told = [near(v)[1] for _, v in ints]
        for k in range(len(centres)):
            own = [v for (_, v), c in zip(ints, told) if c == k]
            if own:
                centres[k] = [sum(column) // len(own) for column in zip(*own)]
    return sorted((repr(i), near(v)[1], near(v)[0]) for i, v in ints), centres


def check(spark, rows, **options):
    table = spark.createDataFrame([(i, v, "mine", 0) for i, v in rows], SCHEMA).repartition(5)
    placed, clusters = centroids.clustered(table, **options)
    dims, k, rounds = options.get("dims", 64), options.get("clusters", 16), options.get("rounds", 3)
    expected, centres = plainly(rows, dims, k, rounds)
    found = placed.select("row_.*", F.col("cluster").alias("c"), "distance").collect()
    assert sorted((repr(r.vec_id), r.c, r.distance) for r in found) == expected
    told = sorted(clusters.collect())
    assert [list(r.centroid) for r in told] == centres
    for r in told:
        own = [d for _, c, d in expected if c == r.cluster]
        assert (r.n, r.inertia) == (len(own), sum(own))
    return told


def test_against_single_rounds(spark, monkeypatch):
    monkeypatch.setattr(centroids, "TILE_ROWS", 13)
    rng = random.Random(5)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() * (1 + i % 3) for _ in range(10)]) for i in range(400)]
    check(spark, rows, dims=10, clusters=7, rounds=4, block_dims=3)


def test_awkward_vectors(spark):
    rng = random.Random(6)
    good = [(i, [rng.uniform(-2, 2) for _ in range(64)]) for i in range(60)]
    same = good[0][1]
    bad = [(100, None), (101, []), (102, [0.5] * 63), (103, [None] + [0.5] * 63), (104, [float("nan")] + [0.5] * 63),
           (105, [float("inf")] + [0.5] * 63), (106, [-float("inf")] * 64)]
    ties = [(None, same), (None, same), (7, same), (7, same), *[(200 + i, same) for i in range(200)], (300, [1e4] * 64)]
    check(spark, good + bad + ties)


def test_fewer_vectors_than_clusters_and_empty_clusters(spark):
    told = check(spark, [(i, [0.25] * 64) for i in range(3)])
    assert [r.n for r in told] == [3, 0, 0]


def test_no_vectors(spark):
    for rows in ([], [(1, None)]):
        placed, clusters = centroids.clustered(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA))
        assert placed.count() == 0 and clusters.count() == 0


def test_numbers_beyond_exact_distances_stop_the_job(spark):
    import pytest
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException):
        centroids.clustered(spark.createDataFrame([(1, [1e30] * 64, "", 0)], SCHEMA))


def test_reruns_agree_whatever_the_partitions(spark):
    rng = random.Random(7)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(64)], "", 0) for i in range(500)]
    table = spark.createDataFrame(rows, SCHEMA)
    answers = [sorted(centroids.clustered(table.repartition(n), keep=["vec_id"])[0].select("row_.vec_id", "cluster").collect())
               for n in (1, 9)]
    assert answers[0] == answers[1]
