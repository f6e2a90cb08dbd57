"""Nearest neighbours by inner product: a vantage-point tree per shard, pruned by the triangle inequality.

Inner products become distances by one more coordinate: with M the largest norm, a vector x is placed at
(x, sqrt(M^2 - |x|^2)) and a query q at (q * M / |q|, 0). Their squared distance is 2 M^2 - 2 M (q x) / |q|, so the smallest distance has
the largest product, and distances obey the triangle inequality. A tree halves its points by their distance to a vantage point. The
far half is left out when the distance to the border, times `factor`, already exceeds the k-th best distance found: factor 1 is
exact, larger factors prune more.

Vectors go to the cell of their nearest pivot (pivots are a bounded sample of the vectors), and a cell has as many shards as its size
asks for. Of a cell it is known between which distances from the pivot its vectors lie, and within what distance more than k of them
do. The latter bounds a query's k-th distance before any shard is read, so packed blocks of queries travel only to cells that the
triangle inequality (times `factor`) leaves open. The best of each shard meet in a ranking per query; neither side is collected.
Without a given factor, a bounded sample of the queries is searched at each of `FACTORS` and exactly, in one pass over the shards, and
the first whose recall is enough is used for all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortspark.llm.common import settle

SHARD = 8192  # vectors a tree, about
BLOCK = 512  # queries a block
LEAF = 512
PIVOTS = 1024  # cells at most; their pivots and radii are what the driver and each task hold
FACTORS = (2.0, 1.4)  # tried in this order, then 1
RECALL = 0.95  # share of the true neighbours that a factor must find
MEASURED = 128  # queries that are searched for this
SLACK = 1e-7  # of the largest norm: what distances may be off by
TIE = 1e-12  # of the largest norms' product: what quick products may be off by


class Tree:
    """A tree over vectors and their ids, kept in the order of its leaves. No norm is above `largest`."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, leaf: int = LEAF):
        self.vectors, self.ids, self.largest, self.leaf = vectors, ids, largest, leaf
        self.points = lifted(vectors, largest)
        self.order = np.arange(len(ids))
        self.root = self._build(0, len(ids), np.random.default_rng(len(ids)))

    def _build(self, a: int, b: int, rng: np.random.Generator):
        """(first, last) of a leaf, or (vantage point, inner border, outer border, inside, outside)."""
        if b - a <= self.leaf:
            return a, b
        own = self.order[a:b]
        vantage = int(own[rng.integers(len(own))])
        far = np.sqrt(((self.points[own] - self.points[vantage]) ** 2).sum(1))
        by = np.argsort(far, kind="stable")
        self.order[a:b] = own[by]
        half = (b - a) // 2
        return vantage, far[by[half - 1]], far[by[half]], self._build(a, a + half, rng), self._build(a + half, b, rng)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """The k candidates of largest product for each query, its own id left out: (places, products), places -1 if fewer."""
        norm = np.sqrt((queries**2).sum(1))
        places = np.full((len(queries), k), -1)
        best = np.full((len(queries), k), -np.inf)  # quick products, smallest last
        slack = SLACK * self.largest

        def exact(row: int, points: np.ndarray) -> np.ndarray:
            return (queries[row] * self.vectors[points]).sum(1)

        def leaf(points: np.ndarray, rows: np.ndarray) -> None:
            quick = queries[rows] @ self.vectors[points].T
            quick[self.ids[points][None] == own[rows][:, None]] = -np.inf
            tie = TIE * norm[rows] * self.largest
            some = quick.max(1) >= best[rows, -1] - tie  # only there the list can change
            rows, quick, tie = rows[some], quick[some], tie[some]
            every = np.concatenate([best[rows], quick], 1)
            which = np.concatenate([places[rows], np.broadcast_to(points, quick.shape)], 1)
            order = np.argsort(-every, axis=1, kind="stable")[:, : k + 1]
            sorted_ = np.take_along_axis(every, order, 1)
            if order.shape[1] > k:
                # Where rounding may hide on which side of the cut a candidate is, exact products decide, then the id.
                near = np.isfinite(sorted_[:, k]) & (sorted_[:, k - 1] - sorted_[:, k] <= 2 * tie)
                for j in np.flatnonzero(near):
                    close = np.flatnonzero(every[j] >= sorted_[j, k] - 2 * tie[j])
                    close = close[np.lexsort((self.ids[which[j, close]], -exact(rows[j], which[j, close])))[:k]]
                    order[j, :k] = close[np.argsort(-every[j, close], kind="stable")]
            order = order[:, :k]
            best[rows] = np.take_along_axis(every, order, 1)
            places[rows] = np.where(np.isneginf(best[rows]), -1, np.take_along_axis(which, order, 1))

        def visit(node, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if len(node) == 2:
                leaf(self.order[node[0] : node[1]], rows)
                return
            vantage, inner, outer, inside, outside = node
            d = apart(queries[rows] @ self.vectors[vantage], norm[rows], self.largest)
            near = d <= (inner + outer) / 2
            for first, second, mine in ((inside, outside, near), (outside, inside, ~near)):
                some, to = rows[mine], d[mine]
                visit(first, some)
                gap = outer - to if second is outside else to - inner
                visit(second, some[(gap - slack) * factor <= apart(best[some, -1], norm[some], self.largest) + slack])

        if len(self.ids):
            visit(self.root, np.arange(len(queries)))
        products = np.full(places.shape, -np.inf)
        for j in range(places.shape[1]):
            have = places[:, j] >= 0
            products[have, j] = (queries[have] * self.vectors[places[have, j]]).sum(1)
        return places, products


class Cells:
    """Pivots, and of each one's cell: the distances between which its vectors lie (`low`, `high`) and that within which vectors of
    more than k ids lie (`within`). Cells without vectors have low infinite and high below 0."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.points, self.largest = pivots, lifted(pivots, largest), largest
        self.low, self.high, self.within = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.full(len(pivots), np.inf)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector its cell and the distance to the pivot."""
        points = lifted(vectors, self.largest)
        to = (self.points**2).sum(1)[None] - 2 * points @ self.points.T  # but for the vector's own square
        cell = to.argmin(1)
        return cell, np.sqrt(((points - self.points[cell]) ** 2).sum(1))

    def open(self, queries: np.ndarray, factor: float) -> np.ndarray:
        """Which queries (rows) must visit which cells (columns)."""
        d = apart(queries @ self.pivots.T, np.sqrt((queries**2).sum(1))[:, None], self.largest)
        least = (d + self.within).min(1, keepdims=True) + 2 * SLACK * self.largest
        gap = np.maximum(d - self.high, self.low - d) - SLACK * self.largest
        return np.isfinite(self.low) & (gap * factor <= least)


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    return np.concatenate([vectors, np.sqrt(np.maximum(largest**2 - (vectors**2).sum(1), 0))[:, None]], 1)


def apart(products: np.ndarray, norm: np.ndarray, largest: float) -> np.ndarray:
    """Distances of queries of these norms to vectors, from their products (infinite for a product of minus infinity)."""
    return np.sqrt(np.maximum(2 * largest**2 - 2 * largest / norm * products, 0))


def by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the column, matrix) of the vectors of each length."""
    length, flat = column.value_lengths().to_numpy(), column.flatten().to_numpy()
    begin = np.cumsum(length) - length
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        yield int(n), rows, flat[begin[rows][:, None] + np.arange(n)]


def usable(vector: Column) -> Column:
    """Neither NULL, empty, nor zero, nor with a component that is NULL or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def first_k(found: DataFrame, k: int, *query: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*query).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k)


SHARD_KIND = "cell int, part int, low double, high double, within double, ids binary, data binary"


def sharded(rows: DataFrame, cells: Cells, width: int, k: int, shard: int) -> tuple[DataFrame, DataFrame]:
    """Packed shards of `rows` (salt, id, v), and the number of shards (parts) of each cell. Vectors of another length than the pivots'
    are in the cell of their length, which all queries of that length visit."""
    pivots = len(cells.pivots)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            for n, at, vectors in by_length(batch.column(2)):
                cell[at], far[at] = cells.nearest(vectors) if n == width else (pivots + n, 0.0)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(far), *batch.columns], ["cell", "far", "salt", "id", "v"])

    placed = settle(rows.select("salt", "id", "v").mapInArrow(place, "cell int, far double, salt long, id long, v array<double>"), "placed")
    parts = settle(placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("id", "salt"), F.col("parts")).cast("int").alias("part")
    dealt = placed.join(parts, "cell").select("cell", part, "id", "far", "v")
    shards = max(1, parts.agg(F.sum("parts")).first()[0] or 0)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row a shard; shards arrive one after the other."""

        def whole() -> pa.RecordBatch:
            ids, far, data = (np.concatenate(x) for x in kept)
            order = np.argsort(far, kind="stable")
            _, first = np.unique(ids[order], return_index=True)
            different = far[order][np.sort(first)]
            within = different[k] if len(different) > k else np.inf
            values = [*name, far.min(), far.max(), within, ids.astype("<i8").tobytes(), data.astype("<f8").tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], ["cell", "part", "low", "high", "within", "ids", "data"])

        name, kept = None, ([], [], [])
        for batch in batches:
            cell, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            edges = np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(cell)]):
                if a == b:
                    continue
                if name is not None and name != (cell[a], part[a]):
                    yield whole()
                    kept = ([], [], [])
                name = cell[a], part[a]
                kept[0].append(batch.column(2).to_numpy()[a:b])
                kept[1].append(batch.column(3).to_numpy()[a:b])
                kept[2].append(next(by_length(batch.column(4).slice(a, b - a)))[2])
        if name is not None:
            yield whole()

    packed = dealt.repartition(shards, "cell", "part").sortWithinPartitions("cell", "part").mapInArrow(pack, SHARD_KIND)
    return settle(packed, "shards"), parts


def measured(shards: DataFrame, wanted: DataFrame, cells: Cells, width: int, k: int) -> float:
    """The first of `FACTORS` that finds enough of what an exact search finds for `MEASURED` queries, or 1."""
    few = wanted.filter(F.size("v") == width).orderBy(F.xxhash64("id"), "id").limit(MEASURED).collect()
    if not few:
        return 1.0
    keys, queries, largest, pivots = np.array([r["id"] for r in few]), np.array([r["v"] for r in few]), cells.largest, len(cells.pivots)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ways = [(factor, cells.open(queries, factor)) for factor in (1.0, *FACTORS)]
        for batch in batches:
            for cell, ids, data in zip(*(batch.column(c).to_pylist() for c in range(3))):
                if cell >= pivots:
                    continue
                own = np.frombuffer(ids, "<i8")
                tree = Tree(own, np.frombuffer(data, "<f8").reshape(len(own), -1), largest)
                for factor, visits in ways:
                    rows = np.flatnonzero(visits[:, cell])
                    if len(rows):
                        query, vec, score = listed(tree, queries[rows], keys[rows], k, factor)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(query), factor)), query, vec, score], ["factor", "query_id", "vec_id", "score"])

    found = shards.select("cell", "ids", "data").mapInArrow(search, "factor double, query_id long, vec_id long, score double")
    best: dict[float, set] = {}
    for r in first_k(found, k, "factor", "query_id").select("factor", "query_id", "rank", "vec_id").collect():
        best.setdefault(r["factor"], set()).add((r["query_id"], r["vec_id"]))
    true = best.get(1.0, set())
    return next((f for f in FACTORS if len(true & best.get(f, set())) >= RECALL * len(true)), 1.0)


def listed(tree: Tree, queries: np.ndarray, keys: np.ndarray, k: int, factor: float) -> list[pa.Array]:
    places, products = tree.search(queries, keys, k, factor)
    have = places >= 0
    return [pa.array(np.broadcast_to(keys[:, None], places.shape)[have]), pa.array(tree.ids[places[have]]), pa.array(products[have])]


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, factor: float | None = None, key: str = "vec_id", vector: str = "embedding",
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """For every row that `queries` selects its k nearest other rows: query_id, rank (from 1), vec_id, score (inner product).

    Products are of the original vectors in double precision; ties go to the smaller id. Rows without an id, and vectors that are NULL,
    empty, zero, or have components that are NULL or not finite, take no part; a query meets the vectors of its own length only. Rows
    that repeat an id are candidates of their own, except for queries of that id; a query id that is repeated is searched once, by
    its smallest vector. Fewer candidates than k give fewer rows, an empty table none. `factor` None: measured (see above).
    """
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("salt", F.monotonically_increasing_id())
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sizes = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("c"), F.max(norm).alias("norm"))
    first = sizes.orderBy(F.desc("c"), "width").first()
    if first is None:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    width, count, largest = first["width"], first["c"], sizes.agg(F.max("norm")).first()[0]
    some = rows.filter(F.size("v") == width).select("id", "v", F.xxhash64("id", "v").alias("h")).orderBy("h", "id").limit(min(PIVOTS, -(-count // shard)))
    cells = Cells(np.unique(np.array([r["v"] for r in some.collect()]), axis=0), largest)
    pivots = len(cells.pivots)
    shards, parts = sharded(rows, cells, width, k, shard)
    total = shards.count()
    for r in shards.filter(F.col("cell") < pivots).groupBy("cell").agg(F.min("low"), F.max("high"), F.min("within")).collect():
        cells.low[r[0]], cells.high[r[0]], cells.within[r[0]] = r[1:]
    wanted = rows.filter("q").groupBy("id").agg(F.min("v").alias("v"))
    if factor is None:
        wanted = settle(wanted, "wanted")
        factor = measured(shards, wanted, cells, width, k)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of queries for each cell that they must visit."""
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for n, at, points in by_length(batch.column(1)):
                for a in range(0, len(at), block):
                    own, some = keys[at[a : a + block]], points[a : a + block]
                    visits = cells.open(some, factor) if n == width else np.ones((len(own), 1), bool)
                    for cell in np.flatnonzero(visits.any(0)).tolist():
                        go = visits[:, cell]
                        values = cell if n == width else pivots + n, own[go].astype("<i8").tobytes(), some[go].astype("<f8").tobytes()
                        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, (pa.int32(), pa.binary(), pa.binary()))], ["cell", "ids", "data"])

    blocks = wanted.select("id", "v").mapInArrow(route, "cell int, ids binary, data binary").join(parts, "cell")
    sent = blocks.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(1).alias("kind"), "ids", "data")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per shard first its vectors (kind 0), then blocks of queries."""
        tree, number = None, None
        for batch in batches:
            for k_ in range(batch.num_rows):
                cell, part, kind, ids, data = (batch.column(c)[k_].as_py() for c in range(5))
                keys = np.frombuffer(ids, "<i8")
                points = np.frombuffer(data, "<f8").reshape(len(keys), -1)
                if kind == 0:
                    tree, number = (ids, data), (cell, part)
                elif number == (cell, part):
                    if isinstance(tree, tuple):  # shards that no query visits need no tree
                        own = np.frombuffer(tree[0], "<i8")
                        tree = Tree(own, np.frombuffer(tree[1], "<f8").reshape(len(own), -1), largest)
                    yield pa.RecordBatch.from_arrays(listed(tree, points, keys, k, factor), ["query_id", "vec_id", "score"])

    both = shards.select("cell", "part", F.lit(0).alias("kind"), "ids", "data").union(sent)
    both = both.repartition(max(1, total), "cell", "part").sortWithinPartitions("cell", "part", "kind")
    found = both.mapInArrow(search, "query_id long, vec_id long, score double")
    return first_k(found, k, "query_id").select("query_id", "rank", "vec_id", "score")
