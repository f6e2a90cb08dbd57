"""Comparing two data sets: balance, histograms, KS, chi-square, t-test, pairs, embedding trust."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import IntegralType

from cohortspark.functions.ordered import plan_slices, running_sum
from cohortspark.functions.pvalues import chi2_p_value, ks_p_value, t_p_value
from cohortspark.functions.skew import HOT_ROWS
from cohortspark.session import settle


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """One row: positives and negatives of a 0/1 label."""
    return df.agg(
        F.sum(label).cast("bigint").alias("positives"), (F.count(label) - F.sum(label)).cast("bigint").alias("negatives")
    )


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """bin, lower, upper, n, cumulative, remaining for `bins` equal bins; the last bin is closed and empty bins stay.

    The windows run over the `bins` result rows only.
    """
    values = df.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    ends = values.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    flat = F.col("s.lo") == F.col("s.hi")
    low = F.when(flat, F.col("s.lo") - 0.5).otherwise(F.col("s.lo"))
    width = F.when(flat, F.lit(1.0)).otherwise(F.col("s.hi") - F.col("s.lo"))
    number = F.least(F.floor((F.col("v") - low) * bins / width), F.lit(bins - 1)).cast("int")
    counts = values.select("v", ends.alias("s")).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    axis = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"), ends.alias("s"))
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = axis.join(counts, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.select(
        "bin",
        (low + F.col("bin") * width / bins).alias("lower"),
        (low + (F.col("bin") + 1) * width / bins).alias("upper"),
        "n",
        F.sum("n").over(upto).alias("cumulative"),
        (F.sum("n").over(whole) - F.sum("n").over(upto)).alias("remaining"),
    )


def _two_sides(a: DataFrame, b: DataFrame, col: str, kind: str) -> DataFrame:
    one = a.select(F.col(col).cast(kind).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b"))
    two = b.select(F.col(col).cast(kind).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b"))
    both = one.unionByName(two).filter(F.col("v").isNotNull())
    return both.filter(~F.isnan("v")) if kind == "double" else both


def ks_2samp(a: DataFrame, b: DataFrame, col: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Two-sample Kolmogorov–Smirnov: n_a, n_b, statistic, p_value.

    Values are counted first; the running shares then go over distinct values, in slices when there are many rows.
    """
    both = _two_sides(a, b, col, "double")
    slices = plan_slices(both, [], "v", hot_rows=hot_rows)
    counts = both.groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    totals = counts.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b")).alias("s")).scalar()
    shares = running_sum(counts, [], ["v"], {"ca": F.col("a"), "cb": F.col("b")}, slices)
    gap = F.abs(F.col("ca") / F.col("s.a") - F.col("cb") / F.col("s.b"))
    found = shares.select("*", totals.alias("s")).agg(F.max(gap).alias("statistic"), F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))
    return found.select(
        "n_a", "n_b", "statistic", ks_p_value(F.col("statistic"), F.col("n_a"), F.col("n_b")).alias("p_value")
    )


def chi_square_stat(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """Homogeneity of two frequency tables: categories, dof, statistic."""
    counts = _two_sides(a, b, col, "string").groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    totals = counts.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b")).alias("s")).scalar()
    row, everything = F.col("a") + F.col("b"), (F.col("s.a") + F.col("s.b")).cast("double")

    def term(side: str) -> Column:
        expected = row * F.col(f"s.{side}") / everything
        return (F.col(side) - expected) ** 2 / expected

    return counts.select("*", totals.alias("s")).agg(
        F.count(F.lit(1)).alias("categories"),
        (F.count(F.lit(1)) - 1).alias("dof"),
        F.sum(term("a") + term("b")).alias("statistic"),
    )


def chi_square(a: DataFrame, b: DataFrame, col: str) -> DataFrame:
    """The statistic with its p-value."""
    return chi_square_stat(a, b, col).withColumn("p_value", chi2_p_value("statistic", "dof"))


def t_stat(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """Pooled-variance t of every column: column, n_a, n_b, dof, t. One pass over each side."""

    def moments(df: DataFrame, side: str) -> DataFrame:
        cells = [
            F.struct(
                F.lit(c).alias("column"), F.count(c).alias(f"n_{side}"),
                F.avg(c).alias(f"m_{side}"), F.var_samp(c).alias(f"v_{side}"),
            )
            for c in cols
        ]
        return df.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select("x.*")

    joined = moments(a, "a").join(moments(b, "b"), "column")
    dof = F.col("n_a") + F.col("n_b") - 2
    pooled = ((F.col("n_a") - 1) * F.col("v_a") + (F.col("n_b") - 1) * F.col("v_b")) / dof
    t = (F.col("m_a") - F.col("m_b")) / F.sqrt(pooled * (F.lit(1.0) / F.col("n_a") + F.lit(1.0) / F.col("n_b")))
    return joined.select("column", "n_a", "n_b", dof.alias("dof"), t.alias("t"))


def ttest_ind(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    """The statistic with its two-sided p-value."""
    return t_stat(a, b, cols).withColumn("p_value", t_p_value("t", "dof"))


def pair_points(df: DataFrame, x: str, y: str, n: int, key: str, seed: int | str = 0) -> DataFrame:
    """A repeatable sample of at most n (x, y) pairs: the n lowest key hashes."""
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .select(key, x, y, F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))).alias("_h"))
        .orderBy("_h", key)
        .limit(n)
        .drop("_h")
    )


# --- embedding trust ------------------------------------------------------------------------------------------------
SHARD_POINTS = 65_536  # points of a shard
BLOCK_ANCHORS = 256  # anchors of a block
PACKED = "shard int, kind int, n int, ids binary, x binary, e binary, gaps binary, others binary"


def _packed(rows: DataFrame, most: int) -> DataFrame:
    """Rows (shard, kind, id, x, e and, for anchors, gaps and others) as blocks of at most `most`, numbers as bytes.

    `gaps` and `others` hold squared input distances and ids of each anchor's neighbours.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = np.asarray(batch.column(0))
            order = np.argsort(shards, kind="stable")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shards[order])) + 1, [len(order)]]) if len(order) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                for k in range(a, b, most):
                    own = batch.take(pa.array(order[k : min(b, k + most)]))
                    flat = [own.column(c).flatten().to_numpy(zero_copy_only=False) for c in (3, 4, 5, 6)]
                    raw = [np.asarray(own.column(2)).astype("<i8"), *(f.astype("<f8") for f in flat[:3]), flat[3].astype("<i8")]
                    head = [pa.array([int(shards[order[k]])], pa.int32()), own.column(1).slice(0, 1), pa.array([own.num_rows], pa.int32())]
                    yield pa.RecordBatch.from_arrays([*head, *(pa.array([r.tobytes()], pa.binary()) for r in raw)], [f.split()[0] for f in PACKED.split(", ")])

    return rows.mapInArrow(run, PACKED)


def _met(points: DataFrame, anchors: DataFrame, shards: int, scan: Callable, schema: str) -> DataFrame:
    """Every block of anchors meets every shard of points: `scan` gets both as arrays and yields a record batch.

    Points of a shard arrive first and are held, blocks of anchors pass by.
    """
    names = schema.replace(",", "").split()[::2]
    sent = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    both = points.unionByName(sent).repartition(shards, "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                n, numbers = r["n"], {c: np.frombuffer(r[c], "<f8") for c in ("x", "e", "gaps")}
                block = {c: v.reshape(n, -1) for c, v in numbers.items()} | {c: np.frombuffer(r[c], "<i8") for c in ("ids", "others")}
                block["others"] = block["others"].reshape(n, -1)
                if r["kind"] == 0:
                    if r["shard"] != number:
                        number, held = r["shard"], []
                    held.append(block)
                elif r["shard"] == number:
                    if len(held) > 1:
                        held = [{c: np.concatenate([h[c] for h in held]) for c in ("ids", "x", "e")}]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in scan(held[0], block)], names)

    return both.mapInArrow(run, schema)


def _squared(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances from a point to others, from the differences, so that equal distances come out equal."""
    gaps = others - one
    return np.einsum("pd,pd->p", gaps, gaps)


def trustworthiness(
    df: DataFrame, high: str, low: str, key: str, anchors: DataFrame, k: int = 5, shard: int = SHARD_POINTS, block: int = BLOCK_ANCHORS
) -> DataFrame:
    """How far the k neighbours in the small space (`low`) are neighbours in the input space (`high`): n, anchors, trust.

    The value is the mean over `anchors`, a table of integer keys (column `key`) that the caller chooses. Every point is ranked against every
    anchor, at every size in the same way; ties go to the smaller key. Points lie in shards, anchors travel in blocks to
    every shard, twice: each shard gives its k best per anchor, then how many of its points are closer than each neighbour.
    Neighbours and ranks meet in Spark; the driver sees the two counts of rows, and no pair is emitted.
    """
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} must hold integers, they order equal distances")
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(high).cast("array<double>").alias("x"), F.col(low).cast("array<double>").alias("e"))
    rows = settle(rows, "trust-points")
    n = rows.count()
    chosen = settle(rows.join(anchors.select(F.col(key).cast("bigint").alias("id")).distinct(), "id", "left_semi"), "trust-anchors")
    several = chosen.groupBy("id").count().filter("count > 1").take(1)
    if several:
        raise ValueError(f"{key} is repeated among the anchors")
    count = chosen.count()
    shards = max(1, -(-n // shard))
    none = F.array().cast("array<double>").alias("gaps"), F.array().cast("array<bigint>").alias("others")
    place = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")
    points = _packed(rows.select(place, F.lit(0).alias("kind"), "id", "x", "e", *none), shard)

    def nearest(held: dict, asked: dict) -> list[np.ndarray]:
        found = []
        for own, e, x in zip(asked["ids"], asked["e"], asked["x"]):
            d = _squared(e, held["e"])
            d[held["ids"] == own] = np.inf
            limit = np.partition(d, k - 1)[k - 1] if len(d) > k else np.inf
            take = np.flatnonzero((d <= limit) & np.isfinite(d))
            take = take[np.lexsort((held["ids"][take], d[take]))[:k]]
            found.append((np.full(len(take), own), held["ids"][take], d[take], _squared(x, held["x"][take])))
        return [np.concatenate(c) for c in zip(*found)]

    asking = chosen.select(F.lit(0).alias("shard"), F.lit(1).alias("kind"), "id", "x", "e", *none)
    local = _met(points, _packed(asking, block), shards, nearest, "anchor bigint, id bigint, de double, dx double")
    w = Window.partitionBy("anchor").orderBy("de", "id")
    near = local.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
    marks = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("r", "dx", F.col("id").alias("other")))).alias("m"))
    # Every anchor has the same number of neighbours, all other points or k of them: blocks are full arrays.
    known = settle(
        chosen.join(marks, chosen["id"] == marks["anchor"]).select(
            F.lit(0).alias("shard"), F.lit(1).alias("kind"), "id", "x", "e", F.col("m.dx").alias("gaps"), F.col("m.other").alias("others")
        ),
        "trust-neighbours",
    )

    def closer(held: dict, asked: dict) -> list[np.ndarray]:
        found = []
        for own, x, gaps, others in zip(asked["ids"], asked["x"], asked["gaps"], asked["others"]):
            d, ids = _squared(x, held["x"]), held["ids"]
            d[ids == own] = np.inf  # the anchor itself does not count
            before = [np.count_nonzero(d < g) + np.count_nonzero(ids[d == g] < o) for g, o in zip(gaps, others)]
            found.append((np.full(len(others), own), others, before))
        return [np.concatenate(c) for c in zip(*found)]

    counted = _met(points, _packed(known, block), shards, closer, "anchor bigint, id bigint, closer bigint")
    ranks = counted.groupBy("anchor", "id").agg((F.sum("closer") + 1).alias("rank"))
    penalty = F.coalesce(F.sum(F.greatest(F.lit(0), F.col("rank") - k)), F.lit(0))
    scale = 2.0 / (count * k * (2.0 * n - 3.0 * k - 1.0)) if count else 0.0
    return ranks.agg(
        F.lit(n).cast("bigint").alias("n"),
        F.lit(count).cast("bigint").alias("anchors"),
        (F.lit(1.0) - penalty * F.lit(scale)).alias("trust"),
    )
