"""Centroid clustering over zone maps on a Hilbert curve.

Vectors become whole numbers and are ordered along a Hilbert curve through all their
dimensions. Runs of ``block`` neighbours on the curve are written as one row with their
smallest and largest value in each dimension. For such a box, a centroid whose least
possible distance exceeds another one's greatest possible distance is out for the whole
block; what is left is compared with all vectors of the block at once, exactly. A block
with one candidate needs no comparison: its sums are in its row.

Each round reads the blocks, adds up per task, and sends a row per task and cluster to the
aggregate; the driver sees ``k`` centroids. The assignment is exact for any order of the rows.

Vectors that are null, have another number of components, or hold a null or a
non-finite one take no part. Components count as at most 2**27 in size. A null vec_id is
assigned, but is no starting centroid. Rows that share a vec_id are rows like others (their
ties as starting centroids go by the vector). Fewer than ``k`` vectors: as many centroids.
No vectors: an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctuality.llm.common import materialize

#: Bits of each dimension that the curve tells apart.
CURVE_BITS = 4
_MOST = 1 << 27
#: Up to this size, sums of products of 64 components are exact in double precision.
_EXACT = 1 << 22


def hilbert_keys(x: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of the points ``x`` (a row each, ``0 <= x < 2**bits``), as rows of
    bytes that sort like them (Skilling's transform of axes)."""
    x = np.ascontiguousarray(x.T.astype(np.int64))
    q = 1 << (bits - 1)
    while q > 1:
        for row in x:
            up = (row & q) != 0
            swapped = np.where(up, 0, (x[0] ^ row) & (q - 1))
            x[0] ^= np.where(up, q - 1, swapped)
            if row is not x[0]:
                row ^= swapped
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1  # bit, dimension, point
    return np.packbits(planes.reshape(-1, x.shape[1]).T.astype(np.uint8), axis=1)


def whole_points(batch: pa.RecordBatch, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``batch`` that hold a usable vector, and floor(scale * x) of it."""
    lists = batch.column(1)
    size = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(size == dims)
    values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null is NaN
    values = values.reshape(len(rows), dims)
    fine = np.isfinite(values).all(1)
    with np.errstate(over="ignore"):
        return rows[fine], np.clip(np.floor(values[fine] * scale), -_MOST, _MOST).astype(np.int32)


def _packed(x: np.ndarray) -> pa.Array:
    """Rows of bytes of a matrix."""
    flat = np.ascontiguousarray(x)
    width = flat.dtype.itemsize * flat.shape[1]
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(flat), [None, pa.py_buffer(flat)]).cast(pa.binary())


def _unpacked(column: pa.Array, dims: int, kind=np.int32) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims)


def points(vectors: DataFrame, dims: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, point): the usable vectors as packed 32-bit whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, x = whole_points(b, dims, scale)
            if len(rows):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), _packed(x)], ["vec_id", "point"])

    kind = vectors.schema[id_col].dataType.simpleString()
    v = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return v.mapInArrow(run, f"vec_id {kind}, point binary")


def _extent(pts: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of points, and the least and greatest value of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, np.full(dims, _MOST, np.int64), np.full(dims, -_MOST, np.int64)
        for b in batches:
            x = _unpacked(b.column(0), dims)
            if len(x):
                n, low, high = n + len(x), np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        columns = [pa.array([n] * dims, pa.int64()), pa.array(range(dims), pa.int32()), pa.array(low), pa.array(high)]
        yield pa.RecordBatch.from_arrays(columns, ["n", "i", "low", "high"])

    per_task = pts.select("point").mapInArrow(run, "n long, i int, low long, high long")
    rows = per_task.groupBy("i").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    if not rows:
        return 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    return rows[0].n, np.array([r.low for r in rows]), np.array([r.high for r in rows])


def zone_blocks(pts: DataFrame, dims: int, block: int, rows_per_part: int = 1 << 17) -> DataFrame:
    """One row per run of ``block`` points along the curve: ids, points, low, high (the box) and sums."""
    n, low, high = _extent(pts, dims)
    step = np.maximum(high - low + 1, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _unpacked(b.column(1), dims).astype(np.int64)
            cell = (x - low) * (1 << CURVE_BITS) // step
            yield pa.RecordBatch.from_arrays([*b.columns, _packed(hilbert_keys(cell, CURVE_BITS))], ["vec_id", "point", "place"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, block):
                ids, x = b.column(0).slice(at, block), _unpacked(b.column(1).slice(at, block), dims)
                box = [x.min(0).astype(np.int64), x.max(0).astype(np.int64), x.sum(0, dtype=np.int64)]
                columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), ids), *(pa.array([v.tobytes()]) for v in (x, *box))]
                yield pa.RecordBatch.from_arrays(columns, ["ids", "points", "low", "high", "sums"])

    spark, kind = pts.sparkSession, pts.schema["vec_id"].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // rows_per_part))
    placed = pts.mapInArrow(place, f"vec_id {kind}, point binary, place binary")
    # Equal places and ids are spread too: a vector may be repeated any number of times.
    placed = placed.withColumn("row", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(parts, "place", "vec_id", "row").sortWithinPartitions("place", "vec_id")
    blocks = ordered.select("vec_id", "point").mapInArrow(
        cut, f"ids array<{kind}>, points binary, low binary, high binary, sums binary"
    )
    return materialize(blocks, "zones-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Centroids that may be nearest to some point of the box, ascending; ties stay."""
    outside = np.maximum(low - centers, 0) + np.maximum(centers - high, 0)
    across = np.maximum(np.abs(centers - low), np.abs(centers - high))
    return np.flatnonzero((outside**2).sum(1) <= (across**2).sum(1).min())


def nearest_center(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of ``centers`` to each row of ``x`` (ties: the first) and the squared distance."""
    if max(np.abs(x).max(initial=0), np.abs(centers).max(initial=0)) <= _EXACT and x.shape[1] <= 64:
        f, c = x.astype(np.float64), centers.astype(np.float64)
        d = (c**2).sum(1) - 2 * (f @ c.T)  # whole numbers below 2**53, so exact
        d += (f**2).sum(1)[:, None]
        d = d.astype(np.int64)
    else:
        d = np.stack([((x.astype(np.int64) - c) ** 2).sum(1) for c in centers], 1)
    best = d.argmin(1)
    return best, d[np.arange(len(x)), best]


def _blocks_of(batch: pa.RecordBatch, dims: int, centers: np.ndarray):
    """Each block's row, its candidates, its sums."""
    box = [_unpacked(batch.column(batch.schema.get_field_index(c)), dims, np.int64) for c in ("low", "high", "sums")]
    for i, (low, high, sums) in enumerate(zip(*box, strict=True)):
        yield i, candidates(low, high, centers), sums


def cluster_sums(blocks: DataFrame, centers: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Of each non-empty cluster: its number of vectors and the sums of their components."""
    k, dims = centers.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            for i, some, sums in _blocks_of(b, dims, centers):
                x = np.frombuffer(b.column(0)[i].as_buffer(), np.int32).reshape(-1, dims)
                if len(some) == 1:
                    n[some[0]] += len(x)
                    total[some[0]] += sums
                    continue
                to = some[nearest_center(x, centers[some])[0]]
                n += np.bincount(to, minlength=k)
                order = np.argsort(to, kind="stable")
                there, first = np.unique(to[order], return_index=True)
                total[there] += np.add.reduceat(x[order], first, axis=0, dtype=np.int64)
        some = np.flatnonzero(n)
        columns = [pa.array(some, pa.int32()), pa.array(n[some]), pa.array(list(total[some]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    per_task = blocks.select("points", "low", "high", "sums").mapInArrow(run, "cluster int, n long, total array<long>")
    entries = per_task.select("cluster", "n", F.posexplode("total").alias("i", "x"))
    rows = entries.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:  # k times dims rows
        out.setdefault(r.cluster, (r.n, [0] * dims))[1][r.i] = int(r.x)
    return out


def assigned(blocks: DataFrame, centers: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    dims = centers.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, some, _ in _blocks_of(b, dims, centers):
                x = np.frombuffer(b.column(1)[i].as_buffer(), np.int32).reshape(-1, dims)
                to, d = nearest_center(x, centers[some])
                columns = [b.column(0)[i].values, pa.array(some[to], pa.int32()), pa.array(d)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    rows = blocks.select("ids", "points", "low", "high", "sums")
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def starting_centers(pts: DataFrame, dims: int, k: int, seed: int) -> np.ndarray:
    """The ``k`` points with the smallest sha256 of ``<seed>:<vec_id>``, in that order."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = pts.where("vec_id is not null").select(named.alias("h"), "point").orderBy("h", "point").limit(k).collect()
    return np.array([np.frombuffer(r.point, np.int32) for r in first], np.int64).reshape(-1, dims)


def cluster_vectors(
    vectors: DataFrame,
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    seed: int = 2,
    block: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every usable vector after ``rounds`` rounds, and the centroids."""
    pts = points(vectors, dims, scale, id_col, vector_col)
    centers = starting_centers(pts, dims, k, seed)
    blocks = zone_blocks(pts, dims, block)
    if not len(centers):
        return blocks.sparkSession.createDataFrame([], f"vec_id {blocks.schema['ids'].dataType.elementType.simpleString()}, cluster int, distance long"), centers
    for _ in range(rounds):
        for cluster, (n, total) in cluster_sums(blocks, centers).items():
            centers[cluster] = [x // n for x in total]
    return assigned(blocks, centers), centers


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256. Inertia beyond 64 bits is null."""
    spark = vectors.sparkSession
    found, centers = cluster_vectors(vectors, **options)
    found = materialize(found, "zones-assigned")
    per = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole = Decimal(sum(per.values()))
    rows = [(c, Decimal(d), whole, hashlib.sha256(",".join(map(str, centers[c].tolist())).encode()).hexdigest()) for c, d in sorted(per.items())]
    small = spark.createDataFrame(rows, "cluster int, d decimal(38,0), w decimal(38,0), centroid_sha256 string")  # at most k rows
    out = found.join(F.broadcast(small), "cluster")
    return out.select("vec_id", "cluster", "distance", F.col("d").try_cast("long").alias("cluster_inertia"), F.col("w").try_cast("long").alias("inertia"), "centroid_sha256")
