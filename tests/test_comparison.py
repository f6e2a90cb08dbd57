"""Comparison statistics against plain Python."""

import random

import numpy as np
import pytest

from cohortspark.operators import comparison
from cohortspark.session import inline


def frame(spark, values):
    return inline(spark, [(v,) for v in values], "v double")


def ks_in_python(a, b):
    points = sorted(set(a) | set(b))
    return max(abs(sum(x <= p for x in a) / len(a) - sum(x <= p for x in b) / len(b)) for p in points)


def test_ks(spark):
    rng = random.Random(1)
    a, b = [round(rng.gauss(0, 1), 1) for _ in range(300)], [round(rng.gauss(0.5, 2), 1) for _ in range(200)]
    for rows in (1_000_000, 20):  # one window, and slices
        got = comparison.ks_2samp(frame(spark, [*a, None]), frame(spark, [*b, float("nan")]), "v", hot_rows=rows).first()
        assert (got["n_a"], got["n_b"]) == (300, 200) and got["statistic"] == pytest.approx(ks_in_python(a, b))
        assert got["p_value"] < 0.01
    same = comparison.ks_2samp(frame(spark, a), frame(spark, a), "v").first()
    assert same["statistic"] == 0 and same["p_value"] == 1


def test_chi_square_compares_frequencies(spark):
    a, b = ["x"] * 30 + ["y"] * 10, ["x"] * 20 + ["y"] * 20 + ["z"] * 4
    make = lambda vs: inline(spark, [(v,) for v in vs], "v string")
    got = comparison.chi_square(make(a), make(b), "v").first()
    table = np.array([[30, 20], [10, 20], [0, 4]], dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    assert got["dof"] == 2 and got["statistic"] == pytest.approx(((table - expected) ** 2 / expected).sum())
    assert 0.001 < got["p_value"] < 0.05
    flat = comparison.chi_square(make(a), make(a * 3), "v").first()
    assert flat["statistic"] == pytest.approx(0) and flat["p_value"] == pytest.approx(1)


def test_t(spark):
    a = inline(spark, [(1.0, 5.0), (2.0, None), (4.0, 7.0)], "x double, y double")
    b = inline(spark, [(2.0, 1.0), (6.0, 2.0), (7.0, 3.0)], "x double, y double")
    got = {r["column"]: r for r in comparison.ttest_ind(a, b, ["x", "y"]).collect()}
    x, y = np.array([1, 2, 4.0]), np.array([2, 6, 7.0])
    pooled = ((len(x) - 1) * x.var(ddof=1) + (len(y) - 1) * y.var(ddof=1)) / 4
    assert got["x"]["t"] == pytest.approx((x.mean() - y.mean()) / np.sqrt(pooled * (2 / 3)))
    assert (got["x"]["dof"], got["y"]["dof"], got["y"]["n_a"]) == (4, 3, 2)
    assert 0.1 < got["x"]["p_value"] < 0.3 and got["y"]["t"] > 0


def test_histogram_matches_numpy(spark):
    values = [0.0, 0.5, 1.0, 2.0, 7.0, 10.0, 10.0]
    got = sorted(comparison.histogram(frame(spark, [*values, None]), "v", 5).collect())
    counts, edges = np.histogram(values, 5)
    assert [r["n"] for r in got] == counts.tolist()
    assert [r["lower"] for r in got] == pytest.approx(edges[:-1].tolist()) and got[-1]["upper"] == 10.0
    assert [r["cumulative"] for r in got] == counts.cumsum().tolist()
    assert [r["remaining"] for r in got] == (7 - counts.cumsum()).tolist()
    flat = sorted(comparison.histogram(frame(spark, [3.0, 3.0]), "v", 4).collect())
    assert [r["n"] for r in flat] == np.histogram([3.0, 3.0], 4)[0].tolist()


def test_balance_and_pairs(spark):
    df = inline(spark, [(1, 1, 2.0, 3.0), (2, 0, None, 3.0), (3, 0, 4.0, 5.0), (4, None, 6.0, 7.0)], "id bigint, y int, a double, b double")
    assert tuple(comparison.class_balance(df, "y").first()) == (1, 2)
    assert {r["id"] for r in comparison.pair_points(df, "a", "b", 10, "id").collect()} == {1, 3, 4}
    few = {r["id"] for r in comparison.pair_points(df, "a", "b", 2, "id").collect()}
    assert len(few) == 2 and few == {r["id"] for r in comparison.pair_points(df.repartition(3), "a", "b", 2, "id").collect()}


def trust_in_python(x, e, k):
    n, penalty = len(x), 0
    for i in range(n):
        far = [(((x[i] - x[j]) ** 2).sum(), j) for j in range(n) if j != i]
        rank = {j: r + 1 for r, (_, j) in enumerate(sorted(far))}
        near = sorted((((e[i] - e[j]) ** 2).sum(), j) for j in range(n) if j != i)[:k]
        penalty += sum(max(0, rank[j] - k) for _, j in near)
    return 1 - penalty * 2 / (n * k * (2 * n - 3 * k - 1))


def test_trust(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 6))
    x[7] = x[8]  # equal points
    e = x[:, :2]
    data = [(i, x[i].tolist(), e[i].tolist()) for i in range(60)]
    df = inline(spark, data, "id bigint, x array<double>, e array<double>").repartition(5)
    every = df.select("id")
    got = comparison.trustworthiness(df, "x", "e", "id", every, 4).first()
    assert (got["n"], got["anchors"]) == (60, 60) and got["trust"] == pytest.approx(trust_in_python(x, e, 4))
    assert comparison.trustworthiness(df, "x", "x", "id", every, 4).first()["trust"] == 1.0
    parts = [comparison.trustworthiness(df, "x", "e", "id", df.filter(f"id % 3 = {r}").select("id"), 4).first() for r in range(3)]
    assert [p["anchors"] for p in parts] == [20, 20, 20]
    assert sum(p["trust"] for p in parts) / 3 == pytest.approx(got["trust"])
    with pytest.raises(ValueError):
        comparison.trustworthiness(df.union(df.filter("id = 3")), "x", "e", "id", every, 4)


@pytest.mark.parametrize("shard,block", [(7, 3), (1, 1), (1000, 2)])
def test_trust_in_shards_and_blocks(spark, shard, block):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(30, 4)), np.zeros((10, 4)), np.ones((5, 4))])  # many equal distances
    e = np.round(x[:, :1], 1)
    df = inline(spark, [(i, x[i].tolist(), e[i].tolist()) for i in range(45)], "id int, x array<double>, e array<double>").repartition(4)
    got = comparison.trustworthiness(df, "x", "e", "id", df.select("id"), 3, shard, block).first()
    assert (got["n"], got["anchors"]) == (45, 45) and got["trust"] == pytest.approx(trust_in_python(x, e, 3))


def test_trust_without_anchors_and_with_text_keys(spark):
    df = inline(spark, [(1, [0.0], [0.0]), (2, [1.0], [2.0])], "id bigint, x array<double>, e array<double>")
    assert tuple(comparison.trustworthiness(df, "x", "e", "id", df.filter("id > 5").select("id")).first()) == (2, 0, 1.0)
    with pytest.raises(TypeError):
        comparison.trustworthiness(df.withColumn("id", df["id"].cast("string")), "x", "e", "id", df.select("id"))
