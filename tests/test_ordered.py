"""Running values: the sliced form must equal the plain window, however hot a key is."""

import random

import pytest
from pyspark.sql import functions as F

from cohortspark.functions.ordered import carry_forward, dense_rank_by, plan_slices, running_sum, with_next
from cohortspark.functions.skew import PARTS, hot_keys, lookup_join, mark_hot, row_hash, spread_join
from cohortspark.session import inline, settle


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(3000):
        key = rng.choice([1, 1, 1, None, None, 2, 3, 4, 5 + i % 40])
        data.append((i, key, int(rng.expovariate(1 / 50)), rng.choice([None, None, rng.random()]), rng.choice([None, "a", "b"])))
    return inline(spark, data, "id bigint, k bigint, t bigint, v double, s string").repartition(4).cache()


def slices_of(df, keys, order="t"):
    found = plan_slices(df, keys, order, hot_rows=100, hot_share=1 / 20)
    assert found is not None and len(found.borders) > 3
    return found


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_only_hot_keys_are_sliced(rows):
    found = slices_of(rows, ["k"])
    hot = {r["k"] for r in found.hot.collect()}
    assert {1, None} <= hot <= {1, None, 2, 3, 4}
    assert plan_slices(rows, ["k"], "t") is None
    assert plan_slices(rows, ["id"], "t", hot_rows=0, hot_share=1 / 20) is None


@pytest.mark.parametrize("keys", [["k"], []])
def test_sliced_equals_plain(rows, keys):
    cut = slices_of(rows, keys)
    same(carry_forward(rows, keys, ["t", "id"], ["v", "s"]), carry_forward(rows, keys, ["t", "id"], ["v", "s"], cut))
    same(with_next(rows, keys, ["t", "id"], ["v", "s"]), with_next(rows, keys, ["t", "id"], ["v", "s"], cut))
    sums = {"n": F.lit(1), "total": F.col("id")}
    same(running_sum(rows, keys, ["t", "id"], sums), running_sum(rows, keys, ["t", "id"], sums, cut))


def test_sliced_dense_rank(rows):
    gaps = rows.withColumn("t", F.when(F.col("id") % 9 != 0, F.col("t"))).cache()
    cut = slices_of(gaps, ["k"])
    same(dense_rank_by(gaps, ["k"], "t", "r"), dense_rank_by(gaps, ["k"], "t", "r", cut))


def test_slices_along_time(spark):
    import datetime as dt

    start = dt.datetime(2150, 1, 1)
    data = [(1, start + dt.timedelta(minutes=i), None if i % 5 else float(i)) for i in range(600)]
    df = inline(spark, data, "k bigint, t timestamp_ntz, v double")
    cut = slices_of(df, ["k"])
    same(carry_forward(df, ["k"], ["t"], ["v"]), carry_forward(df, ["k"], ["t"], ["v"], cut))


def test_carrying_twice_changes_nothing(rows):
    once = carry_forward(rows, ["k"], ["t", "id"], ["v"])
    same(once, carry_forward(once, ["k"], ["t", "id"], ["v"]))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("nullsafe", [False, True])
def test_spread_join_equals_plain(spark, rows, how, nullsafe):
    dim = inline(spark, [(1, "x"), (None, "n"), (7, "y"), (999, "z")], "k bigint, name string")
    hot = hot_keys(rows, ["k"], 100, 1 / 20)
    plain = spread_join(rows, dim, ["k"], how, None, nullsafe)
    spread = spread_join(rows, dim, ["k"], how, hot, nullsafe)
    same(plain, spread)
    want = {"inner": "k in (1, 7)", "left": "true", "left_semi": "k in (1, 7)"}[how] + (" or k is null" if nullsafe else "")
    assert spread.count() == rows.filter(want).count()


def test_lookup_of_any_size(spark, rows, monkeypatch):
    dim = rows.groupBy("k").agg(F.count("v").alias("seen"))
    small = lookup_join(rows, dim, ["k"], nullsafe=True)
    monkeypatch.setattr("cohortspark.functions.skew.resolve_hot", lambda hot, df, keys: hot_keys(df, keys, 100, 1 / 20))
    same(small, lookup_join(rows, dim, ["k"], nullsafe=True))


def test_parts_follow_the_rows_of_a_key(rows):
    """The largest (key, part) holds about one row target, also when all rows begin in one task."""
    counts = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    hot = hot_keys(rows, ["k"], 40)
    assert {r["k"]: r[PARTS] for r in hot.collect()} == {k: -(-n // 40) for k, n in counts.items() if n > 40}
    for frame in (rows, rows.repartition(1)):
        marked = mark_hot(frame, ["k"], hot, "p").withColumn("part", F.pmod(row_hash(frame, ["k"]), F.col("p")))
        assert marked.groupBy("k", "part").count().agg(F.max("count")).first()[0] <= 80


def test_slices_follow_the_rows(rows):
    cut = plan_slices(rows, ["k"], "t", hot_rows=40)
    from cohortspark.functions.ordered import SLICE, add_slice

    sizes = add_slice(rows.filter("k = 1"), cut).groupBy(SLICE).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 120 and sizes[1] > 10


@pytest.mark.parametrize("kind", ["date", "decimal(10,2)", "string"])
def test_orders_of_other_types(rows, kind):
    value = {"date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("t").cast("int")), "string": F.format_string("é%05d", "t")}.get(kind, F.col("t").cast(kind))
    df = rows.withColumn("o", F.when(F.col("id") % 7 != 0, value))
    cut = slices_of(df, ["k"], "o")
    same(carry_forward(df, ["k"], ["o", "id"], ["v"]), carry_forward(df, ["k"], ["o", "id"], ["v"], cut))


def test_settled_rows_are_the_same(spark, rows):
    same(rows, settle(rows))
