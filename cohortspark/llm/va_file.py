"""Centroid clustering over a vector-approximation file: a few bits per dimension decide, full vectors are read where they must.

Vectors become integers, are put in blocks, and each block keeps two things: the full vectors, in a file of fixed-width
rows in the shared folder, and its approximation, a cell of `BITS` bits per dimension (equal shares of the block's own values)
with the least and greatest value of each cell. A centroid's distance to a cell lies between two bounds, which a lookup table has
for each dimension, cell and centroid; summed over the dimensions they give an interval for each vector and centroid. Where
the interval of one centroid ends before all others begin, the vector is assigned without being read. Full vectors are
fetched where intervals overlap, and where the assignment has changed, since the sums of a cluster are kept up by what joins
and leaves it. All distances and sums are exact integers.

Blocks are rows of a written table, so a round is one pass over approximations; centroids and their sums, some hundred
numbers, are all that the driver sees.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortspark.llm.common import settle, shared_folder
from cohortspark.llm.files import open_new, open_random
from cohortspark.session import inline

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
BITS = 8  # of 4, 6, 7, 8 bits the rounds on 10,256 random vectors read 96, 54, 28, 14 % of them in full
BLOCK = 16384  # vectors a block
LARGEST = 1 << 27  # of a component: squared distances of up to 127 dimensions then fit in 64 bits
NEAR_ROWS = 16  # fetched rows closer than this are read together
STATE = "path string, place long, n int, cells binary, lows binary, highs binary, labels binary, sums binary, fetched long, changed long"
RESULT = "{key} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def usable(vector: Column, dims: int, scale: int) -> Column:
    """Exactly `dims` components, none NULL or not finite, none so large that distances leave 64 bits."""
    inside = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) <= LARGEST / scale))
    return F.coalesce((F.size(vector) == dims) & inside, F.lit(False))


# --- blocks and their approximations ----------------------------------------------------------------------------------
def approximate(vectors: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each component, least and greatest value of each cell (by dimension), for the vectors of one block."""
    n, dims = vectors.shape
    count = 1 << bits
    ordered = np.sort(vectors, axis=0)
    marks = ordered[np.arange(1, count) * n // count]  # a component is in cell c if c marks are at most as large
    cells = np.empty((n, dims), np.uint8)
    lows, highs = np.zeros((dims, count), np.int64), np.zeros((dims, count), np.int64)
    for j in range(dims):
        cells[:, j] = np.searchsorted(marks[:, j], vectors[:, j], "right")
        cuts = np.concatenate([[0], np.searchsorted(ordered[:, j], marks[:, j], "left"), [n]])
        own = np.flatnonzero(cuts[1:] > cuts[:-1])
        lows[j, own], highs[j, own] = ordered[cuts[own], j], ordered[cuts[own + 1] - 1, j]
    return cells, lows, highs


def pack_cells(cells: np.ndarray, bits: int) -> bytes:
    """Cells as `bits` bits each."""
    if bits == 8:
        return cells.tobytes()
    return np.packbits((cells.reshape(-1, 1) >> np.arange(bits - 1, -1, -1, dtype=np.uint8)) & 1).tobytes()


def unpack_cells(raw: bytes, n: int, dims: int, bits: int) -> np.ndarray:
    packed = np.frombuffer(raw, np.uint8)
    if bits == 8:
        return packed.reshape(n, dims)
    ones = np.unpackbits(packed)[: n * dims * bits].reshape(-1, bits)
    return (ones << np.arange(bits - 1, -1, -1, dtype=np.uint8)).sum(1, dtype=np.uint8).reshape(n, dims)


def intervals(cells: np.ndarray, lows: np.ndarray, highs: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of each vector to each centroid, less that to the centroids' mean, by lookup tables.

    The part taken off is the same for all centroids. What is left is linear in each component, (mean - c) * (2 x - c - mean), so
    that its interval is only as wide as a cell is and as the centroid is far from the others.
    """
    k, dims = centroids.shape
    middle = centroids.sum(0) // k
    away = (middle - centroids).T[:, None, :]  # dimension, cell, centroid
    both = (middle + centroids).T[:, None, :]
    at_low, at_high = away * (2 * lows[:, :, None] - both), away * (2 * highs[:, :, None] - both)
    table = np.concatenate([np.minimum(at_low, at_high), np.maximum(at_low, at_high)], 2)
    out = np.zeros((len(cells), 2 * k), np.int64)
    for j in range(dims):
        out += table[j][cells[:, j]]
    return out[:, :k], out[:, k:]


def candidates(least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which centroids may be the nearest: those whose interval begins before the first one ends."""
    return least <= most.min(1, keepdims=True)


def exact(vectors: np.ndarray, centroids: np.ndarray, possible: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest possible centroid (of equally near ones that of the smaller number) and the squared distance to it."""
    far = np.full(possible.shape, np.iinfo(np.int64).max)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(possible[:, k])
        far[rows, k] = ((vectors[rows] - centroid) ** 2).sum(1)
    nearest = far.argmin(1)
    return nearest, far[np.arange(len(nearest)), nearest]


def moved(sums: np.ndarray, vectors: np.ndarray, labels: np.ndarray, sign: int) -> None:
    """Add vectors and their number (the last column) to the sums of their clusters, or take them away."""
    for k in np.unique(labels):
        own = vectors[labels == k]
        sums[k, :-1] += sign * own.sum(0)
        sums[k, -1] += sign * len(own)


# --- the file of full vectors: for each block keys (int64), a flag per key (is it known?), components (int32) ------------
def block_bytes(keys: np.ndarray, known: np.ndarray, vectors: np.ndarray) -> bytes:
    return keys.astype("<i8").tobytes() + known.astype(np.uint8).tobytes() + vectors.astype("<i4").tobytes()


def read_block(path: str, place: int, n: int, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    with open_random(path) as f:
        f.seek(place)
        raw = f.read(n * (9 + 4 * dims))
    keys, known = np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, n, 8 * n)
    return keys, known, np.frombuffer(raw, "<i4", n * dims, 9 * n).reshape(n, dims).astype(np.int64)


def fetch(path: str, place: int, n: int, dims: int, rows: np.ndarray) -> np.ndarray:
    """The vectors of some rows (ascending) of a block; rows close together are read in one go."""
    out = np.empty((len(rows), dims), np.int64)
    if not len(rows):
        return out
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(rows) > NEAR_ROWS) + 1, [len(rows)]])
    with open_random(path) as f:
        for a, b in zip(cuts[:-1], cuts[1:]):
            first, last = int(rows[a]), int(rows[b - 1])
            f.seek(place + 9 * n + 4 * dims * first)
            raw = f.read(4 * dims * (last - first + 1))
            out[a:b] = np.frombuffer(raw, "<i4").reshape(-1, dims)[rows[a:b] - first]
    return out


# --- passes over the blocks -------------------------------------------------------------------------------------------
def state_batch(path, place, n, cells, lows, highs, labels, sums, fetched, changed) -> pa.RecordBatch:
    raw = [cells, lows.astype("<i4").tobytes(), highs.astype("<i4").tobytes(), labels.astype("<u2").tobytes(), sums.astype("<i8").tobytes()]
    columns = [pa.array([path]), pa.array([place], pa.int64()), pa.array([n], pa.int32()), *(pa.array([r], pa.binary()) for r in raw)]
    columns += [pa.array([fetched], pa.int64()), pa.array([changed], pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["path", "place", "n", "cells", "lows", "highs", "labels", "sums", "fetched", "changed"])


def build_blocks(rows: DataFrame, folder: str, centroids: np.ndarray, bits: int, block: int) -> DataFrame:
    """Blocks of rows (key, v): full vectors to a file a task, approximations and first assignment as rows."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, place = f"{folder}/{uuid.uuid4().hex}", None, 0
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def close() -> pa.RecordBatch:
            nonlocal out, place
            keys, known, vectors = (np.concatenate(x) for x in zip(*parts))
            if out is None:
                out = open_new(path)
            raw = block_bytes(keys, known, vectors)
            out.write(raw)
            labels, _ = exact(vectors, centroids, np.ones((len(vectors), k), bool))
            sums = np.zeros((k, dims + 1), np.int64)
            moved(sums, vectors, labels, 1)
            cells, lows, highs = approximate(vectors, bits)
            made = state_batch(path, place, len(keys), pack_cells(cells, bits), lows, highs, labels, sums, len(keys), len(keys))
            place += len(raw)
            parts.clear()
            return made

        waiting = 0
        made = []
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                own = batch.slice(at, block - waiting)
                keys = own.column(0)
                known = np.asarray(keys.is_valid())
                vectors = own.column(1).flatten().to_numpy().reshape(-1, dims).astype(np.int64)
                parts.append((keys.fill_null(0).to_numpy(), known, vectors))
                at, waiting = at + own.num_rows, waiting + own.num_rows
                if waiting == block:
                    made.append(close())
                    waiting = 0
        if parts:
            made.append(close())
        if out is not None:
            out.close()
        yield from made  # only now: a row must not name a file that is not whole

    return rows.mapInArrow(run, STATE)


def reassign(state: DataFrame, centroids: np.ndarray, bits: int) -> DataFrame:
    """The blocks with new assignments; `sums` is what clusters have gained and lost."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                n, old = r["n"], np.frombuffer(r["labels"], "<u2").astype(np.int64)
                lows, highs = (np.frombuffer(r[c], "<i4").reshape(dims, -1).astype(np.int64) for c in ("lows", "highs"))
                possible = candidates(*intervals(unpack_cells(r["cells"], n, dims, bits), lows, highs, centroids))
                labels = possible.argmax(1)
                unsure = possible.sum(1) > 1
                rows = np.flatnonzero(unsure | (labels != old))
                vectors = fetch(r["path"], r["place"], n, dims, rows)
                labels[rows] = exact(vectors, centroids, possible[rows])[0]
                changed = labels[rows] != old[rows]
                sums = np.zeros((k, dims + 1), np.int64)
                moved(sums, vectors[changed], labels[rows][changed], 1)
                moved(sums, vectors[changed], old[rows][changed], -1)
                yield state_batch(r["path"], r["place"], n, r["cells"], lows, highs, labels, sums, len(rows), int(changed.sum()))

    return state.mapInArrow(run, STATE)


def total_sums(state: DataFrame, clusters: int, dims: int) -> list[list[int]]:
    """The blocks' sums added up: by cluster the components and, last, the number of vectors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                own = np.frombuffer(raw, "<i8")
                sums = own if sums is None else sums + own
        if sums is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums, pa.int64())], ["place", "value"])

    parts = state.select("sums").mapInArrow(add, "place int, value long")
    out = [[0] * (dims + 1) for _ in range(clusters)]
    for place, value in parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)"))).collect():
        out[place // (dims + 1)][place % (dims + 1)] = int(value)
    return out


def measured(state: DataFrame, centroids: np.ndarray, bits: int, schema: StructType) -> DataFrame:
    """Key, cluster and squared distance of every vector; exact distances only to centroids that the intervals leave."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lows, highs = (np.frombuffer(r[c], "<i4").reshape(dims, -1).astype(np.int64) for c in ("lows", "highs"))
                possible = candidates(*intervals(unpack_cells(r["cells"], r["n"], dims, bits), lows, highs, centroids))
                keys, known, vectors = read_block(r["path"], r["place"], r["n"], dims)
                labels, far = exact(vectors, centroids, possible)
                own = pa.array(keys, pa.int64(), mask=known == 0)
                yield pa.RecordBatch.from_arrays([own, pa.array(labels, pa.int32()), pa.array(far, pa.int64())], schema.names)

    return state.select("path", "place", "n", "cells", "lows", "highs").mapInArrow(run, schema)


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def fits(value: int) -> int | None:
    return value if -(1 << 63) <= value < 1 << 63 else None


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMENSIONS, scale: int = SCALE, seed: int = SEED,
    key: str = "vec_id", vector: str = "embedding", bits: int = BITS, block: int = BLOCK, watch: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Lloyd's rounds in integers: key, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector kept.

    Kept are vectors of exactly `dims` components, none NULL or not finite; a component x becomes floor(scale * x). A component above
    2 ** 27 in size would lead to distances beyond 64 bits: such a vector is not kept either. Centroids start as the vectors with
    the smallest SHA-256 of "seed:key" (equal keys: the smaller vector first, unknown keys last); fewer kept vectors than clusters
    give fewer clusters. Each round assigns every vector to its nearest centroid (ties: the smaller number) and moves each
    centroid that has vectors to the floor of their mean; rounds that would change nothing are not run. Keys are cast to long; rows
    that repeat a key are vectors of their own, rows without key keep NULL. Other columns are not carried, so their names cannot
    clash. An empty table gives no rows. An inertia beyond 64 bits is NULL.

    `watch` receives (vectors read in full, vectors that changed cluster) for every round after the first.
    """
    if dims > 127 or not 1 <= bits <= 8 or clusters > 1 << 16:
        raise ValueError("at most 127 dimensions, 8 bits and 65536 clusters")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.col(vector).alias("v")).filter(usable(F.col("v"), dims, scale))
    rows = rows.select("key", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("int")).alias("v"))
    schema = StructType.fromDDL(RESULT.format(key=f"`{key}`", kind="long"))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")), 256)
    first = rows.orderBy(hashed.asc_nulls_last(), "v").limit(clusters).collect()
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in first], np.int64)
    # Sums are of counted vectors: what the first pass has gathered plus what later rounds have moved.
    state = settle(build_blocks(rows, shared_folder(spark, "va-vectors"), centroids, bits, block), "va-file")
    sums = total_sums(state, len(first), dims)
    for k in range(rounds):
        if k:
            state = settle(reassign(state, centroids, bits), "va-file")
            gained = total_sums(state, len(first), dims)
            sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, gained)]
            if watch is not None:
                watch.append(tuple(state.agg(F.sum("fetched"), F.sum("changed")).first()))
        new = np.array([[s // x[-1] for s in x[:-1]] if x[-1] else c for x, c in zip(sums, centroids.tolist())], np.int64)
        if (new == centroids).all():
            break
        centroids = new
    found = settle(measured(state, centroids, bits, StructType(schema.fields[:3])), "va-assigned")
    inertia = {r[0]: int(r[1]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect()}
    whole = fits(sum(inertia.values()))
    facts = inline(spark, [(k, fits(v), whole, digest(centroids[k])) for k, v in inertia.items()], "_k int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), found["cluster"] == facts["_k"]).select(*schema.names)
