"""Nearest neighbours against brute force: exact with factor 1, recall with a measured factor."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import vptree
from cohortspark.llm.common import prepare
from cohortspark.llm.queries import QUERIES


def brute(rows, wanted, k):
    fine = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    first = {}
    for i, v in fine:
        first[i] = min(first.get(i, v), v)
    out = set()
    for q, a in first.items():
        if wanted(q):
            best = sorted((-float(np.dot(a, b)), i) for i, b in fine if i != q)[:k]
            out |= {(q, r + 1, i, round(-s, 9)) for r, (s, i) in enumerate(best)}
    return out


def found(df):
    return {(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.collect()}


@pytest.mark.parametrize("shard", [10_000, 60])
def test_exact_with_factor_one(spark, shard):
    rng = random.Random(shard)
    rows = [(k, [rng.gauss(0, 1) * (1 + k % 5) for _ in range(6)]) for k in range(400)]
    rows += [(500 + k, rows[20][1]) for k in range(30)]  # ties
    rows += [(600, None), (601, []), (602, [0.0] * 6), (603, [float("nan")] + [1.0] * 5), (604, [None] + [1.0] * 5), (605, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (40, rows[3][1])]
    df = prepare(spark).createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<double>, shard string, rank int")
    out = vptree.nearest(df.repartition(4), F.col("vec_id") % 20 == 0, k=7, factor=1.0, shard=shard, block=5)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert found(out) == brute(rows, lambda q: q % 20 == 0, 7)


def test_few_candidates_and_no_rows(spark):
    df = prepare(spark).createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert found(vptree.nearest(df, F.col("vec_id") % 20 == 0)) == brute([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (3, [0.0, 1.0])], lambda q: q % 20 == 0, 20)
    assert vptree.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert vptree.nearest(df.limit(1), F.lit(True)).collect() == []


def test_pruning_saves_work():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(40, 8))[rng.integers(0, 40, 4000)] + 0.05 * rng.normal(size=(4000, 8))
    points /= np.sqrt((points**2).sum(1))[:, None]
    ids = np.arange(4000)
    exact, own = points[:50] @ points.T, ids[:50]
    exact[own, own] = -np.inf
    want = np.argsort(-exact, axis=1)[:, :10]
    tree = vptree.Tree(ids, points, float(np.sqrt((points**2).sum(1).max())), leaf=32)
    for factor, least in ((1.0, 1.0), (vptree.FACTORS[0], 0.9)):
        places, _ = tree.search(points[:50], own, 10, factor)
        recall = np.mean([len(set(ids[p]) & set(w)) / 10 for p, w in zip(places, want)])
        assert recall >= least


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], list(r["embedding"])) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, got = brute(rows, lambda q: q % 20 == 0, 20), found(QUERIES["op8_nearest"](spark, folder))
    assert len(got) == len(want) and len({x[::2] for x in got} & {x[::2] for x in want}) >= 0.95 * len(want)


@pytest.mark.parametrize("kind", ["unit", "mixed"])
def test_recall_on_full_shards(spark, kind):
    """Clustered vectors in several shards; norms all 1, or log-normal, where a large factor alone falls short."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(60, 32))[rng.integers(0, 60, 12_000)] + 0.4 * rng.normal(size=(12_000, 32))
    points /= np.sqrt((points**2).sum(1))[:, None]
    if kind == "mixed":
        points *= np.exp(rng.normal(size=(12_000, 1)))
    rows = prepare(spark).createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "vec_id long, embedding array<double>")
    products = points[::50] @ points.T
    products[np.arange(len(products)), np.arange(0, 12_000, 50)] = -np.inf
    want = {(50 * q, int(i)) for q, best in enumerate(np.argsort(-products, axis=1)[:, :20]) for i in best}
    got = {(r["query_id"], r["vec_id"]) for r in vptree.nearest(rows, F.col("vec_id") % 50 == 0, shard=2000).collect()}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_cells_leave_out_what_is_far():
    rng = np.random.default_rng(2)
    centres = np.linalg.qr(rng.normal(size=(16, 16)))[0]
    points = centres[np.arange(1600) % 16] + 0.02 * rng.normal(size=(1600, 16))
    largest = float(np.sqrt((points**2).sum(1)).max())
    cells = vptree.Cells(centres * 0.99, largest)
    cell, far = cells.nearest(points)
    for c in range(16):
        own = np.sort(far[cell == c])
        cells.low[c], cells.high[c], cells.within[c] = own[0], own[-1], own[5]
    visits = cells.open(points[:64], 1.0)
    assert visits.mean() < 0.2
    for q in range(64):
        products = points @ points[q]
        products[q] = -np.inf
        assert visits[q, cell[np.argsort(-products)[:5]]].all()


def test_lengths_do_not_meet_and_copies_are_dealt(spark):
    rng = random.Random(3)
    rows = [(k, [rng.gauss(0, 1) for _ in range(4 if k % 7 else 3)]) for k in range(300)]
    rows += [(1000, rows[1][1])] * 200  # one id, one vector
    df = prepare(spark).createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(vptree.nearest(df, F.col("vec_id") % 20 == 0, k=5, factor=1.0, shard=40, block=7))
    want = set()
    for n in (3, 4):
        want |= brute([r for r in rows if len(r[1]) == n], lambda q: q % 20 == 0, 5)
    assert got == want


def test_near_ties_are_cut_by_products():
    ids = np.arange(40)
    vectors = np.ones((40, 2))
    vectors[30:, 0] += 4e-16 * np.arange(1, 11)  # larger by less than distances can tell
    tree = vptree.Tree(ids, vectors, float(np.sqrt((vectors**2).sum(1)).max()), leaf=8)
    places, products = tree.search(np.array([[1.0, 0.0]]), np.array([-1]), 5, 1.0)
    want = sorted(range(40), key=lambda i: (-vectors[i, 0], i))[:5]
    assert set(ids[places[0]]) == set(want)
