"""Lloyd's clustering with the dimensions dealt to shards.

Vectors lie in tiles: some thousand rows by a block of columns.  A shard holds
the tiles of its columns and its slice of every centroid, never a whole vector.
A round has three steps: each tile gives the exact partial squared distances of
its rows to all centroid slices; a tile's rows add them over the blocks and
take the nearest centroid; each shard sums its own columns over the rows of a
centroid and moves its slice.  What the driver holds is the centroids.

Components are whole numbers, so sums do not depend on their order and reruns
agree to the last digit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm import rolling
from pressloom.llm.common import named, table
from pressloom.session import cut_lineage

DIMS = 64
CLUSTERS = 16
ROUNDS = 3
SEED = 1
#: Components are multiplied by this and rounded down.
SCALE = 64
#: Columns of a shard.
BLOCK_DIMS = 16
#: Rows of a tile, at most; partial distances of a tile are this by the number of centroids.
TILE_ROWS = 4_096
#: Distances are held in 64 bits: components must stay below this for 64 of them.
MOST = 2.0**27

TILE = pa.schema([
    ("tile_", pa.int64()), ("block_", pa.int32()), ("first_", pa.int64()), ("rows_", pa.int32()), ("type_", pa.string()),
    ("values_", pa.binary()),
])
TILE_DDL = "tile_ bigint, block_ int, first_ bigint, rows_ int, type_ string, values_ binary"


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers: each times ``scale``, rounded down."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column, dims: int = DIMS) -> Column:
    """Whether a vector has that many components, none of them null, infinite or no number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) == dims) & ~bad, F.lit(False))


def _narrowest(values: np.ndarray) -> str:
    """The smallest type that holds all the numbers."""
    return next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= values.min() and values.max() <= np.iinfo(t).max)


def _tiles(batches: Iterator[pa.RecordBatch], dims: int, block_dims: int) -> Iterator[pa.RecordBatch]:
    """Rows (``at_``, ``ints_``) as tiles; a tile's rows are numbered without gaps.

    Tiles are known by a number mixed from that of their first row, as those
    of the rows themselves are multiples that would all fall to one task.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.column(0).to_numpy()
        values = batch.column(1).flatten().to_numpy().reshape(-1, dims)
        breaks = np.flatnonzero(np.diff(at) != 1) + 1
        for low, high in zip([0, *breaks], [*breaks, len(at)]):
            for start in range(low, high, TILE_ROWS):
                part = values[start : min(high, start + TILE_ROWS)]
                blocks = [part[:, c : c + block_dims] for c in range(0, dims, block_dims)]
                types = [_narrowest(b) for b in blocks]
                tile = rolling.mixed(at[start : start + 1].astype(np.uint64)).view(np.int64)[0]
                n = len(blocks)
                yield pa.RecordBatch.from_arrays([
                    pa.array([tile] * n), pa.array(range(n), pa.int32()), pa.array([at[start]] * n),
                    pa.array([len(part)] * n, pa.int32()), pa.array(types),
                    pa.array([b.astype(t).tobytes() for b, t in zip(blocks, types)], pa.binary()),
                ], schema=TILE)


def _values(tile) -> np.ndarray:
    return np.frombuffer(tile.values_, tile.type_).astype(np.int64).reshape(tile.rows_, -1)


def partial_distances(values: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centroids over a block's columns, exactly."""
    out = np.empty((len(values), len(slices)), np.int64)
    for c, centroid in enumerate(slices):
        away = values - centroid
        out[:, c] = np.einsum("ij,ij->i", away, away)
    return out


def _nearest(distances: np.ndarray) -> tuple[bytes, bytes]:
    """The nearest centroid of each row, the first of equals, and how far it is."""
    nearest = distances.argmin(1)
    return nearest.astype(np.int32).tobytes(), distances[np.arange(len(nearest)), nearest].tobytes()


def _assigned(tiles: RDD, centroids: np.ndarray, block_dims: int) -> RDD:
    """For each tile the nearest centroids and distances of its rows."""
    sent = tiles.context.broadcast(centroids)

    def distances(pair) -> tuple[int, np.ndarray]:
        (block, tile), held = pair
        first = block * block_dims
        return tile, partial_distances(_values(held), sent.value[:, first : first + block_dims])

    return tiles.map(distances).reduceByKey(lambda a, b: a + b).mapValues(_nearest)


def _moved(tiles: RDD, assigned: RDD, centroids: np.ndarray, block_dims: int) -> np.ndarray:
    """Centroids after each shard moved its slice; empty ones stay.

    Only the assignments travel, to the shard of each block; its columns stay.
    """
    k, n_blocks = len(centroids), -(-centroids.shape[1] // block_dims)

    def sums(pair) -> tuple[int, tuple[np.ndarray, np.ndarray]]:
        (block, _), (held, nearest) = pair
        nearest, values = np.frombuffer(nearest, np.int32), _values(held)
        total = np.array([values[nearest == c].sum(0) for c in range(k)])
        return block, (total, np.bincount(nearest, minlength=k))

    def moved(summed) -> tuple[np.ndarray, np.ndarray]:
        total, count = summed
        return total // np.maximum(count, 1)[:, None], count > 0

    told = assigned.flatMap(lambda pair: [((block, pair[0]), pair[1][0]) for block in range(n_blocks)])
    slices = (
        tiles.join(told.partitionBy(tiles.getNumPartitions())).map(sums)
        .reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).mapValues(moved)
    )
    after = centroids.copy()
    # One slice of all centroids a shard, however many rows there are.
    for block, (values, full) in slices.collect():
        after[full, block * block_dims : block * block_dims + values.shape[1]] = values[full]
    return after


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of tiles (``first_ clusters_ distances_``) with their cluster and distance."""
    for batch in batches:
        for first, near, away in zip(*(c.to_pylist() for c in batch.columns)):
            near = np.frombuffer(near, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + np.arange(len(near))), pa.array(near), pa.array(np.frombuffer(away, np.int64))],
                names=["at_", "cluster", "distance"])


def clustered(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: list[str] | None = None, dims: int = DIMS,
    clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, block_dims: int = BLOCK_DIMS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Rows with their cluster, and the clusters.

    The first table has ``row_`` (struct of the columns to keep), ``cluster``
    and ``distance`` (squared); the second ``cluster centroid`` (whole
    numbers) ``n inertia``, also of empty clusters.

    A vector that is null or has another number of components, or one that is
    null, infinite or no number, is left out.  Centroids start as the vectors
    with the smallest sha256 of ``seed:key``, in that order; a null key is the
    same as an empty one, equal keys follow each other by their components,
    and repeated rows are vectors of their own.  Fewer vectors than clusters
    make fewer clusters; no vector gives two empty tables.  A component beyond
    2^27 after scaling stops the job, as its distances would not fit.

    Jobs run here.  The vectors, as whole numbers and as tiles, and the result
    of each row are saved, so rounds read them whatever executor is lost.
    """
    spark = vectors.sparkSession
    kept = vectors.columns if keep is None else keep
    quoted = named(kept)
    ints = whole_numbers(F.col(vector), scale)
    wide = F.exists(ints, lambda x: F.abs(x) >= F.lit(MOST))
    rows = cut_lineage(
        vectors.where(usable(F.col(vector), dims)).select(
            F.monotonically_increasing_id().alias("at_"),
            F.when(wide, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(ints).alias("ints_"),
            F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256).alias("digits_"),
            (F.struct(*quoted) if kept else F.lit(None)).alias("row_"),
        )
    )
    first = rows.orderBy("digits_", "ints_", "at_").limit(clusters).select("ints_").collect()
    centroids = np.array([r.ints_ for r in first], np.int64).reshape(len(first), dims)
    saved = cut_lineage(rows.select("at_", "ints_").mapInArrow(lambda b: _tiles(b, dims, block_dims), TILE_DDL))
    found_ddl = "at_ bigint, cluster int, distance bigint"
    if len(centroids):
        whole = saved.rdd
        tiles = whole.keyBy(lambda t: (t.block_, t.tile_)).partitionBy(whole.getNumPartitions())
        for _ in range(rounds):
            centroids = _moved(tiles, _assigned(tiles, centroids, block_dims), centroids, block_dims)
        nearest = _assigned(tiles, centroids, block_dims).map(lambda pair: (pair[0], *pair[1])).toDF(
            "tile_of_ bigint, clusters_ binary, distances_ binary")
        firsts = saved.where("block_ = 0").select("tile_", "first_")
        found = cut_lineage(
            firsts.join(nearest, F.col("tile_") == F.col("tile_of_")).select("first_", "clusters_", "distances_")
            .mapInArrow(_unpacked, found_ddl))
    else:
        found = spark.createDataFrame([], found_ddl)
    placed = rows.select("at_", "row_").join(found, "at_").select("row_", "cluster", "distance")
    sizes = found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("distance").alias("inertia"))
    centres = spark.createDataFrame(list(enumerate(centroids.tolist())), "cluster int, centroid array<bigint>")
    zero = F.lit(0).cast("bigint")
    return placed, cut_lineage(centres.join(sizes, "cluster", "left").select(
        "cluster", "centroid", F.coalesce("n", zero).alias("n"), F.coalesce("inertia", zero).alias("inertia")))


def op13_dimension_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster of every usable vector after three rounds."""
    rows, centres = clustered(table(spark, sf_dir, "embeddings"), keep=["vec_id"])
    told = centres.select(
        F.col("cluster").alias("of_"), F.col("inertia").alias("cluster_inertia"),
        F.sum("inertia").over(Window.partitionBy()).alias("inertia"),
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )
    return rows.join(told, F.col("cluster") == F.col("of_")).select(
        "row_.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql() -> str:
    """The rounds written out one after the other: distances by component, the nearest, its centroid moved."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""d{r} AS (
    SELECT a, c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS distance FROM v JOIN m{r} m USING (i) GROUP BY a, c
), n{r} AS MATERIALIZED (
    SELECT a, arg_min(c, (distance, c)) AS c, min(distance) AS distance FROM d{r} GROUP BY a
)""")
        if r < ROUNDS:
            steps.append(f"""m{r + 1} AS MATERIALIZED (
    SELECT m.c, m.i, coalesce(s.x, m.x) AS x FROM m{r} m LEFT JOIN (
        SELECT c, i, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM n{r} JOIN v USING (a) GROUP BY c, i) s USING (c, i)
)""")
    return f"""
WITH k AS (
    SELECT vec_id, row_number() OVER () AS a, sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h,
           list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS xs
    FROM embeddings
    WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIMS}
), v AS MATERIALIZED (
    SELECT a, unnest(xs) AS x, unnest(range({DIMS})) AS i FROM k
), m0 AS MATERIALIZED (
    SELECT s.c, v.i, v.x FROM (SELECT a, row_number() OVER (ORDER BY h, xs) - 1 AS c FROM k) s JOIN v USING (a)
    WHERE s.c < {CLUSTERS}
), {", ".join(steps)}, t AS (
    SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM m{ROUNDS} GROUP BY c
)
SELECT vec_id, c::INT AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM n{ROUNDS} JOIN k USING (a) JOIN t USING (c)
"""


OP13_SQL = _sql()
