"""Operator 11: centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors become integers, are ordered along a Hilbert curve through all components
and written in blocks with their minimum and maximum per component. In each round a
block first bounds its box's distance to every centroid; only centroids that can be
nearest to one of its vectors are compared, exactly and in integers. A block left
with one candidate is assigned as a whole.

Each round is one narrow pass over the written blocks; a task returns one partial sum
per centroid, so that nothing but ``k`` centroids passes the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from collidex.llm.common import saved, table

#: Components are held between plus and minus this bound, so that 64 squared differences fit in 63 bits.
LARGEST = 1 << 27
LONG_MAX = (1 << 63) - 1


def integer_vectors(df: DataFrame, dims: int, scale: float, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, v``: floor(scale * component) of the vectors with exactly ``dims`` components, none null or non-finite."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("v", lambda x: F.greatest(F.least(F.floor(x * F.lit(float(scale))), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int"))
    return (df.select(F.col(id_col).alias("vec_id"), v.alias("v"))
              .filter(F.col("v").isNotNull() & (F.size("v") == dims)).filter(fine).select("vec_id", whole.alias("v")))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (integers of ``bits`` bits), as rows of bytes.

    The published transform of J. Skilling (2004) from axes to the curve's transposed
    index, carried out on whole columns at a time.
    """
    x = cells.T.astype(np.int64)
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            there = (x[i] & q) != 0
            swap = np.where(there, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(there, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        flip = np.where((x[n - 1] >> b) & 1, flip ^ ((1 << b) - 1), flip)
    x ^= flip
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])
    return np.packbits(planes.reshape(bits * n, -1).T.astype(np.uint8), axis=1)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _lists(a: np.ndarray) -> pa.Array:
    rows, width = a.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(a.ravel(), pa.int32()))


def zone_blocks(vectors: DataFrame, dims: int, block_rows: int = 128, bits: int = 3) -> DataFrame:
    """Blocks ``ids, vals, low, high`` of ``vectors`` (``vec_id, v``) along the Hilbert curve.

    A component's cells part its mean plus and minus three standard deviations (over all
    vectors); components of larger variance come first in the curve. Equal vectors share
    a key, so the row number is the last part of the range key: a vector that fills a
    third of the table is dealt over many partitions.
    """
    spark = vectors.sparkSession
    rows = saved(vectors.withColumn("rid", F.monotonically_increasing_id()), "vectors")
    stats = rows.agg(F.count("*").alias("n"), *[f(F.col("v")[i].cast("double")).alias(f"{c}{i}")
                                                for i in range(dims) for f, c in ((F.avg, "m"), (F.stddev_pop, "s"))]).first()
    mean, spread = (np.array([stats[f"{c}{i}"] or 0.0 for i in range(dims)]) for c in "ms")
    order = np.argsort(-spread, kind="stable")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = (_matrix(b.column("v"), dims) - mean) / (6 * np.where(spread > 0, spread, 1)) + 0.5
            cells = np.clip(at[:, order] * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
            keys = pa.array([k.tobytes() for k in hilbert_keys(cells, bits)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, keys], names=[*b.schema.names, "curve"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for b in batches:
            rest.append(b)
            if sum(x.num_rows for x in rest) >= block_rows:
                t = pa.Table.from_batches(rest).combine_chunks()
                whole = t.num_rows - t.num_rows % block_rows
                yield _blocks(t.slice(0, whole), dims, block_rows)
                rest = t.slice(whole).to_batches()
        if sum(x.num_rows for x in rest):
            yield _blocks(pa.Table.from_batches(rest).combine_chunks(), dims, block_rows)

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    along = (rows.mapInArrow(keyed, f"vec_id {id_type}, v array<int>, rid long, curve binary")
                 .repartitionByRange("curve", "rid").sortWithinPartitions("curve", "rid"))
    return saved(along.select("vec_id", "v").mapInArrow(
        cut, f"ids array<{id_type}>, vals array<int>, low array<int>, high array<int>"), "zones")


def _blocks(t: pa.Table, dims: int, block_rows: int) -> pa.RecordBatch:
    ids = t.column("vec_id").combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    v = t.column("v").combine_chunks()
    v = _matrix(v.chunk(0) if isinstance(v, pa.ChunkedArray) else v, dims)
    starts = np.arange(0, len(v), block_rows)
    ends = np.append(starts, len(v)).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        pa.ListArray.from_arrays(pa.array(ends), ids),
        pa.ListArray.from_arrays(pa.array(ends * dims), pa.array(v.ravel(), pa.int32())),
        _lists(np.minimum.reduceat(v, starts)), _lists(np.maximum.reduceat(v, starts))], names=["ids", "vals", "low", "high"])


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector within the box, in ascending order.

    A centroid stays if its distance to the box is at most the smallest farthest
    distance, and if some corner of the box is at least as near to it as to the centroid
    of that smallest farthest distance.
    """
    near = (np.maximum(0, np.maximum(low - centroids, centroids - high)) ** 2).sum(1)
    far = (np.maximum(np.abs(centroids - low), np.abs(high - centroids)) ** 2).sum(1)
    left = np.flatnonzero(near <= far.min())
    if len(left) > 1:
        c = centroids[left]
        best = c[far[left].argmin()]
        w = 2 * (c - best)
        left = left[np.maximum(low * w, high * w).sum(1) + (best * best).sum() - (c * c).sum(1) >= 0]
    return left


def nearest(vals: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and squared distance of each vector of a block."""
    left = candidates(low, high, centroids)
    d = np.stack([((vals - c) ** 2).sum(1) for c in centroids[left]], axis=1)
    at = d.argmin(1)
    return left[at], d[np.arange(len(d)), at]


def _zones(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    ids, vals = batch.column("ids"), batch.column("vals")
    low, high = _matrix(batch.column("low"), dims), _matrix(batch.column("high"), dims)
    for i in range(batch.num_rows):
        v = vals[i].values.to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
        yield ids[i].values, v, low[i], high[i]


def _sums(blocks: DataFrame, centroids: np.ndarray) -> list[tuple[int, int, list[int]]]:
    """Per non-empty cluster: number, count and exact sum of its vectors."""
    k, dims = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            for _, v, low, high in _zones(b, dims):
                cluster, _ = nearest(v, low, high, centroids)
                n += np.bincount(cluster, minlength=k)
                np.add.at(total, cluster, v)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(n[there]),
                                          pa.array(total[there].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    parts = blocks.mapInArrow(partial, "cluster int, n long, total array<long>")
    rows = (parts.select("cluster", "n", F.posexplode("total").alias("pos", "x")).groupBy("cluster", "pos")
                 .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x"))).collect()    # k * dims rows
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["cluster"], (r["n"], [0] * dims))[1][r["pos"]] = int(r["x"])
    return [(c, n, x) for c, (n, x) in sorted(out.items())]


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: float = 64.0, seed: int = 1,
            id_col: str = "vec_id", vec_col: str = "embedding", block_rows: int = 128) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector.

    Rows whose vector is null, has another number of components or a null, NaN or
    infinite one are left out. Components are held within 2^27 in size after scaling;
    inertias beyond 63 bits are given as 2^63 - 1. A null id counts as the text ``null``
    in the choice of the first centroids; rows that repeat an id are vectors of their
    own. With fewer than ``k`` vectors each starts a centroid. Other columns are not
    read; a table without usable vectors gives an empty result.
    """
    vectors = integer_vectors(df, dims, scale, id_col, vec_col)
    spark = df.sparkSession
    start = (vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256).alias("h"), "v")
                    .orderBy("h", "v").limit(k).collect())                          # k rows
    blocks = zone_blocks(vectors, dims, block_rows)
    centroids = np.array([r["v"] for r in sorted(start, key=lambda r: (r["h"], r["v"]))], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(centroids) else 0):
        for c, n, total in _sums(blocks, centroids):
            centroids[c] = [x // n for x in total]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, v, low, high in _zones(b, dims):
                number, distance = nearest(v, low, high, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(number, pa.int32()), pa.array(distance)],
                                                 names=["vec_id", "cluster", "distance"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    assigned = saved(blocks.mapInArrow(assign, f"vec_id {id_type}, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: int(r["i"]) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("i")).collect()}      # k rows
    total = min(sum(inertia.values()), LONG_MAX)
    facts = spark.createDataFrame(
        [(c, min(i, LONG_MAX), total, hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
         for c, i in sorted(inertia.items())], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql(k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> str:
    """The same clustering by plain comparison of all vectors with all centroids."""
    steps = [f"""kept AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM (SELECT * FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})),
e AS MATERIALIZED (SELECT rid, pos, v[pos] AS x FROM kept, range(1, {dims + 1}) t(pos)),
first AS (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS k, v FROM kept QUALIFY k < {k}),
c0 AS MATERIALIZED (SELECT k, pos, v[pos] AS x FROM first, range(1, {dims + 1}) t(pos))"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (
    SELECT rid, k, d FROM (SELECT rid, k, sum((e.x - c.x) * (e.x - c.x)) AS d FROM e JOIN c{r} c USING (pos) GROUP BY rid, k)
    QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
    SELECT c.k, c.pos, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN (
        SELECT k, pos, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
        FROM a{r} JOIN e USING (rid) GROUP BY k, pos) m ON m.k = c.k AND m.pos = c.pos)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, s.sha AS centroid_sha256
FROM a{rounds} a JOIN kept USING (rid)
JOIN (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY pos)) AS sha FROM c{rounds} GROUP BY k) s ON s.k = a.k
"""


SQL = _sql()
