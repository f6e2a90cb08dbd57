"""Clustering over approximations against plain Lloyd rounds in integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from cohortspark.llm import va_file
from cohortspark.llm.common import prepare


def brute(rows, clusters, rounds, dims, scale=va_file.SCALE, seed=va_file.SEED):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(x) <= va_file.LARGEST / scale for x in v)]
    if not kept:
        return []

    def first(row):
        return (row[0] is None, hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest() if row[0] is not None else "", row[1])

    centroids = [v for _, v in sorted(kept, key=first)[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        labels = [nearest(v)[1] for _, v in kept]
        for k in range(len(centroids)):
            own = [v for (_, v), label in zip(kept, labels) if label == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    sums = {k: sum(d for _, j, d in found if j == k) for k in range(len(centroids))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, k, d, sums[k], sum(sums.values()), digests[k]) for i, k, d in found), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, rows):
    return prepare(spark).createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id long, embedding array<double>, cluster string, distance int")


@pytest.mark.parametrize("bits,block", [(1, 10_000), (2, 7), (3, 64), (8, 33)])
def test_rounds(spark, bits, block):
    rng = random.Random(bits)
    heart = [[rng.gauss(0, 1) for _ in range(5)] for _ in range(6)]
    rows = [(k, [rng.gauss(x, 0.6) for x in heart[k % 6]]) for k in range(300)]
    rows += [(1000 + k, rows[3][1]) for k in range(40)] + [(7, rows[9][1]), (None, rows[4][1]), (None, [0.0] * 5)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 4), (2003, [math.nan] + [1.0] * 4), (2004, [None] + [1.0] * 4), (2005, [math.inf] + [1.0] * 4), (2006, [1e300] + [1.0] * 4), (2007, [-200000.0] + [1.0] * 4)]
    watch = []
    out = va_file.cluster(table(spark, rows).repartition(5), clusters=4, rounds=6, dims=5, bits=bits, block=block, watch=watch)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found(out) == brute(rows, 4, 6, 5)
    assert all(changed <= fetched <= 343 for fetched, changed in watch)


def test_ties_empty_clusters_and_few_rows(spark):
    same = [(k, [1.0, -2.0]) for k in range(9)]  # all centroids equal: the first takes all, the others stay
    assert found(va_file.cluster(table(spark, same), clusters=3, dims=2)) == brute(same, 3, 10, 2)
    few = [(1, [0.5, 0.25]), (2, [-0.0004, 3.0])]
    assert found(va_file.cluster(table(spark, few), dims=2)) == brute(few, 8, 10, 2)
    between = [(k, [float(k % 5), 0.0]) for k in range(50)]
    for rounds in (0, 1, 2):
        assert found(va_file.cluster(table(spark, between), clusters=2, rounds=rounds, dims=2)) == brute(between, 2, rounds, 2)


def test_no_rows(spark):
    df = table(spark, [(1, [1.0, 2.0])])
    assert va_file.cluster(df.limit(0)).collect() == []
    out = va_file.cluster(df)  # no vector of 64 components
    assert out.collect() == [] and out.columns[0] == "vec_id"


def test_large_sums(spark):
    rows = [(k, [131072.0 * (-1) ** k] * 8) for k in range(40)]
    assert found(va_file.cluster(table(spark, rows), clusters=1, rounds=2, dims=8)) == brute(rows, 1, 2, 8)


@pytest.mark.parametrize("bits", [1, 4, 5, 8])
def test_intervals_hold_every_distance(bits):
    rng = np.random.default_rng(bits)
    vectors = rng.integers(-900, 900, (500, 7))
    vectors[:200] = vectors[0]
    centroids = vectors[[0, 300, 400, 401]] + rng.integers(-3, 3, (4, 7))
    cells, lows, highs = va_file.approximate(vectors, bits)
    assert (va_file.unpack_cells(va_file.pack_cells(cells, bits), 500, 7, bits) == cells).all()
    least, most = va_file.intervals(cells, lows, highs, centroids)
    middle = centroids.sum(0) // 4
    true = ((vectors[:, None] - centroids) ** 2).sum(2) - ((vectors - middle) ** 2).sum(1)[:, None]
    assert (least <= true).all() and (true <= most).all()
    possible = va_file.candidates(least, most)
    assert possible[np.arange(500), true.argmin(1)].all()


def test_fetch_reads_the_rows_asked_for(tmp_path):
    vectors = np.arange(400 * 3).reshape(400, 3) - 500
    raw = va_file.block_bytes(np.arange(400), np.ones(400, bool), vectors)
    path = f"file://{tmp_path}/block"
    with va_file.open_new(path) as f:
        f.write(b"x" * 11 + raw)
    for rows in ([], [0], [399], [3, 4, 5, 30, 31, 200, 399], list(range(400))):
        assert (va_file.fetch(path, 11, 400, 3, np.array(rows, int)) == vectors[rows]).all()
    keys, known, whole = va_file.read_block(path, 11, 400, 3)
    assert (keys == np.arange(400)).all() and known.all() and (whole == vectors).all()


def test_most_vectors_are_not_read_again(spark):
    rng = np.random.default_rng(5)
    heart = rng.normal(size=(8, 64))
    rows = [(k, (heart[k % 8] + 0.3 * rng.normal(size=64)).tolist()) for k in range(2000)]
    watch = []
    va_file.cluster(table(spark, rows).coalesce(1), rounds=4, watch=watch)
    assert watch and all(fetched < 700 for fetched, _ in watch)
