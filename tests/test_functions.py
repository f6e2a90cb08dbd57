"""Column helpers: time, scalars, predicates, schema walks, medians, p-values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from cohortspark.functions import columns as names
from cohortspark.functions import quantiles, skew
from cohortspark.functions.predicates import any_of, code_prefix_match, holds
from cohortspark.functions.pvalues import chi2_tail, ks_p_value, t_two_sided
from cohortspark.functions.scalars import (
    band_points, fahrenheit_to_celsius, int_div, is_missing, item_class, label_text, log10_between, logistic, null_if_nan,
    parse_ids, rate, unit_hash,
)
from cohortspark.functions.time import (
    bucket_index, bucket_start, elapsed_days, elapsed_hours, elapsed_seconds, elapsed_years, within_days,
)
from cohortspark.session import inline

T = dt.datetime


def one(df, *cols):
    return tuple(df.select(*cols).first())


def test_elapsed(spark):
    df = inline(spark, [(T(2100, 1, 1), T(2101, 1, 1, 12, 0, 0, 500_000))], "a timestamp_ntz, b timestamp_ntz")
    seconds = 365 * 86400 + 43200.5
    got = one(df, elapsed_seconds("a", "b"), elapsed_hours("a", "b"), elapsed_days("a", "b"), elapsed_years("a", "b"))
    assert got == pytest.approx((seconds, seconds / 3600, seconds / 86400, seconds / 86400 / 365.242), rel=1e-14)


def test_within_days_counts_earlier_and_ignores_unknown(spark):
    d = T(2100, 3, 1)
    rows = [(d, d + dt.timedelta(days=x) if x is not None else None) for x in (-5, 0, 29.999, 30, 31, None)]
    df = inline(spark, rows, "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(within_days("a", "b", 30)).collect()] == [1, 1, 1, 0, 0, 0]


def test_bucket_ties_go_to_even(spark):
    zero = T(1970, 1, 1)
    rows = [(zero + dt.timedelta(seconds=s),) for s in (0, 899, 900, 901, 2699, 2700, 2701, -900, -901)]
    df = inline(spark, rows, "t timestamp_ntz").select(bucket_index("t", 1800).alias("b"))
    assert [r.b for r in df.collect()] == [0, 0, 0, 1, 1, 2, 2, 0, -1]
    starts = [r[0] for r in df.select(bucket_start("b", 1800)).collect()]
    assert starts[3] == zero + dt.timedelta(seconds=1800) and starts[-1] == zero - dt.timedelta(seconds=1800)


def test_bucket_of_a_far_date(spark):
    df = inline(spark, [(T(2190, 7, 5, 10, 20),)], "t timestamp_ntz")
    assert one(df, bucket_start(bucket_index("t", 1800), 1800)) == (T(2190, 7, 5, 10, 30),)


def test_scalars(spark):
    df = inline(spark, [(7, 0, 2.0e7, float("nan"), "nan", None)], "a bigint, z bigint, v double, n double, s string, m string")
    assert one(df, int_div("a", 2), int_div("a", "z"), item_class(F.lit(30012345))) == (3, None, 300123)
    assert one(df, rate("a", "z"), rate("a", F.lit(2))) == (None, 3.5)
    assert one(df, log10_between("v", 7.3, 7.477), null_if_nan("n"), is_missing("s"), is_missing("m")) == (True, None, True, True)
    assert one(df, fahrenheit_to_celsius(F.lit(212.0)), logistic(F.lit(0.0))) == (100.0, 0.5)
    assert one(df, label_text("a", "z", "m")) == ("7_0",)


def test_parse_ids(spark):
    df = inline(spark, [("(70011,80002,)",), ("(1,x,-3)",)], "t string")
    assert [r[0] for r in df.select(parse_ids("t")).collect()] == [[70011, 80002, None], [1, None, -3]]


def test_band_points_limits_are_exclusive(spark):
    df = inline(spark, [(39.9,), (40.0,), (69.9,), (70.0,), (None,)], "v double")
    points = band_points("v", [(40, 11), (70, 2)], above=0, missing=5)
    assert [r[0] for r in df.select(points).collect()] == [11, 2, 2, 0, 5]


def test_unit_hash_is_even_and_repeatable(spark):
    df = spark.range(20_000).select(unit_hash("id", 5).alias("u"))
    low, high, share = df.agg(F.min("u"), F.max("u"), F.avg((F.col("u") < 0.1).cast("double"))).first()
    assert 0 <= low and high < 1 and abs(share - 0.1) < 0.01


def test_predicates(spark):
    df = inline(spark, [("042",), ("0420",), ("1623",), (None,)], "c string")
    got = df.select(code_prefix_match("c", ["16", "04"]), holds(F.col("c") == "042"), any_of([])).collect()
    assert [tuple(r) for r in got] == [(True, True, False), (True, False, False), (True, False, False), (None, False, False)]


def test_columns(spark):
    df = inline(spark, [(1, "x", T(2100, 1, 1), 1.0, 2)], "cnt_a bigint, Name string, at timestamp_ntz, cnt_b double, stay_id int")
    assert names.columns_like(df, prefix="cnt_") == ["cnt_a", "cnt_b"]
    assert names.columns_like(df, suffix="_id") == ["stay_id"] and names.columns_like(df, capital=True) == ["Name"]
    assert names.columns_of_type(df, "string") == ["Name"] and names.columns_of_type(df, "datetime") == ["at"]
    assert names.lower_names(df).columns[1] == "name"
    assert names.drop_columns(df, ["at", "Name"]).columns == ["cnt_a", "cnt_b", "stay_id"]
    assert names.align_columns(df, ["cnt_b", "new", "cnt_a"]).first().asDict() == {"cnt_b": 1.0, "new": 0, "cnt_a": 1}
    labels = inline(spark, [("cnt_a", "Count A"), ("absent", "x")], "old string, label string")
    assert names.rename_from_map(df, labels).columns[0] == "Count A"


@pytest.mark.parametrize("values", [[3.0, 1.0, 2.0], [4.0, 1.0, 2.0, 3.0], [1.0, 1.0, 1.0, 9.0], [5.0]])
@pytest.mark.parametrize("rows", [None, 10])
def test_median_exact(spark, values, rows):
    import statistics

    df = inline(spark, [(v, None) for v in values] + [(None, None), (float("nan"), None)], "v double, e double").repartition(3)
    assert quantiles.fit_medians(df, ["v", "e"], rows) == {"v": statistics.median(values), "e": None}


def test_median_by_bracket_on_many_rows(spark, monkeypatch):
    """A coarse sketch makes the bracket wide, so the counting pass decides."""
    monkeypatch.setattr(quantiles, "ACCURACY", 100)
    monkeypatch.setattr(quantiles, "MARGIN", 4 / 100)
    df = spark.range(30_001).select(((F.col("id") * 7919) % 30_011 / 8.0).alias("a"), (F.col("id") % 7).alias("b"))
    want = df.agg(F.median("a"), F.median("b")).first()
    assert quantiles.fit_medians(df, ["a", "b"]) == {"a": want[0], "b": want[1]}


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_repeated_rows_of_a_hot_key_are_dealt_too(spark, how):
    """A thousand copies of one row: no part holds more than about a target, and each copy is joined once."""
    data = [(7, "same")] * 1000 + [(7, f"r{k}") for k in range(300)] + [(8, "x")] * 3 + [(None, "n")] * 200
    df = inline(spark, data, "k bigint, v string").repartition(5)
    hot = skew.hot_keys(df, ["k"], 50)
    salted = skew.salted_rows(df, ["k"], hot, 50)
    sizes = salted.groupBy("k", "_salt").agg(F.count(F.lit(1)).alias("rows"), F.max("_times").alias("times")).collect()
    assert max(r["rows"] for r in sizes) <= 50 and max(r["times"] for r in sizes) <= 50
    assert len({r["_salt"] for r in sizes if r["k"] == 7}) > 15
    assert salted.agg(F.sum("_times")).first()[0] == len(data)
    right = inline(spark, [(7, 1.0), (7, 2.0), (9, 3.0), (None, 4.0)], "k bigint, w double")
    got = skew.spread_join(df, right, ["k"], how, hot, nullsafe=True, hot_rows=50)
    plain = skew.spread_join(df, right, ["k"], how, None, nullsafe=True)
    assert got.columns == plain.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


BAD_BRACKETS = {
    "below both": lambda b: (b.low, b.low, b.low),
    "above both": lambda b: (b.high, b.high, b.high),
    "whole": lambda b: (b.low, (b.low + b.high) / 2, b.high),
    "between values": lambda b: ((b.low + b.high) / 2 + 0.01, (b.low + b.high) / 2 + 0.01, (b.low + b.high) / 2 + 0.02),
    "outside": lambda b: (b.low - 9, b.low - 9, b.low - 8),
}


@pytest.mark.parametrize("bad", BAD_BRACKETS)
@pytest.mark.parametrize("values", [list(range(40)), [1.0] * 50 + [2.0] * 50, [3.5] * 70, [1, 2] * 30 + [9] * 61, [-5.0, 7.0] * 20])
def test_median_whatever_the_sketch_says(spark, monkeypatch, bad, values):
    """The counts decide: a bracket that misses the middle on either side, or is too wide, is mended."""
    import statistics

    real = quantiles.propose
    calls = []

    def off(df, brackets):
        found = real(df, brackets)
        calls.append(1)
        if len(calls) > 3:  # three bad sketches, then good ones
            return found
        out = {}
        for c, s in found.items():
            b = brackets[c] or quantiles.Bracket(s["low"], s["high"], 0, s["n"], (0, 0))
            out[c] = {"n": s["n"], "low": s["low"], "high": s["high"], "at": BAD_BRACKETS[bad](b)} if s["n"] else s
        return out

    monkeypatch.setattr(quantiles, "propose", off)
    df = inline(spark, [(float(v), None) for v in values] + [(None, None), (float("nan"), None)], "v double, e double").repartition(3)
    assert quantiles.fit_medians(df, ["v", "e"], target=3) == {"v": statistics.median(values), "e": None}


def test_medians_in_batches_and_with_a_small_target(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "COLUMNS", 2)
    monkeypatch.setattr(quantiles, "ACCURACY", 20)
    monkeypatch.setattr(quantiles, "MARGIN", 0.0)
    df = spark.range(5_000).select(*[((F.col("id") * 7919) % (997 + k) / (k + 1.0)).alias(f"c{k}") for k in range(5)])
    want = df.agg(*[F.median(c) for c in df.columns]).first()
    assert quantiles.fit_medians(df, df.columns, target=10) == dict(zip(df.columns, want))


def test_p_values(spark):
    assert t_two_sided(2.0, 10) == pytest.approx(0.0733880, abs=1e-6)
    assert t_two_sided(0.0, 5) == pytest.approx(1.0) and t_two_sided(12.706, 1) == pytest.approx(0.05, abs=1e-4)
    assert chi2_tail(3.841459, 1) == pytest.approx(0.05, abs=1e-6) and chi2_tail(0, 3) == 1.0
    assert chi2_tail(2.0, 2) == pytest.approx(math.exp(-1)) and chi2_tail(55.758, 40) == pytest.approx(0.05, abs=1e-4)
    n = F.lit(1_000_000)
    got = spark.range(1).select(ks_p_value(F.lit(1.3581 / math.sqrt(500_000)), n, n), ks_p_value(F.lit(0.0), n, n)).first()
    assert got[0] == pytest.approx(0.05, abs=1e-3) and got[1] == 1.0
