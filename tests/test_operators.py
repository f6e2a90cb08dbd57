"""Operators on hand-made rows: NULLs, ties, limits, empty groups."""

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from cohortspark.functions.ordered import plan_slices
from cohortspark.operators import cohort, encoding, logistic, measurements, modelling, relational, scoring, summaries, timetable
from cohortspark.operators.measurements import DropRule, Source, UnitFix
from cohortspark.plans import clinical, rules
from cohortspark.session import inline

T0 = dt.datetime(2150, 1, 1)


def t(hours):
    return T0 + dt.timedelta(hours=hours)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


# --- relational -----------------------------------------------------------------------------------------------------
def test_delete_and_update_keep_unknown(spark):
    df = inline(spark, [(1, 5.0), (2, None), (3, 50.0)], "id bigint, v double")
    assert rows(relational.delete_where(df, F.col("v") > 10)) == [(1, 5.0), (2, None)]
    assert rows(relational.update_where(df, F.col("v") > 10, "v", F.lit(0.0))) == [(1, 5.0), (2, None), (3, 0.0)]
    assert rows(relational.flag_where(df, F.col("v") > 10, "f"), "f") == [(1,), (None,), (None,)]
    assert rows(relational.fill_constant(df, {"v": 4.0}), "v") == [(4.0,), (5.0,), (50.0,)]


def test_nan_to_null(spark):
    df = inline(spark, [(1, float("nan")), (2, 1.0)], "id bigint, v double")
    assert rows(relational.nan_to_null(df)) == [(1, None), (2, 1.0)]


def test_mask_outliers_keeps_rows(spark):
    df = inline(spark, [(i, 1.0) for i in range(20)] + [(99, 100.0), (98, None)], "id bigint, v double")
    got = dict(rows(relational.mask_outliers(df, ["v"], 2)))
    assert len(got) == 22 and got[99] is None and got[98] is None and got[0] == 1.0


def test_first_per_null_key_and_ties(spark):
    df = inline(spark, [(None, 2, "b"), (None, 1, "a"), (7, None, "c"), (7, 3, "d")], "k bigint, o bigint, s string")
    assert rows(relational.first_per(df, ["k"], ["o"])) == [(7, 3, "d"), (None, 1, "a")]


def test_enrich_does_not_multiply(spark):
    ev = inline(spark, [(1,), (2,), (None,)], "k bigint")
    dim = inline(spark, [(1, "x"), (1, "x"), (None, "z")], "k bigint, a string")
    assert rows(relational.enrich(ev, dim, ["k"], ["a"])) == [(1, "x"), (2, None), (None, None)]


def test_remap(spark):
    df = inline(spark, [("A",), ("B",), (None,)], "c string")
    mapping = inline(spark, [("A", "x"), ("DEFAULT", "y")], "category string, remap0 string")
    assert rows(relational.remap(df, "c", mapping)) == [("B",), ("x",), (None,)]
    assert rows(relational.remap(df, "c", mapping, default="y")) == [("x",), ("y",), (None,)]


def test_merges(spark):
    a = inline(spark, [(1, "a"), (None, "b"), (3, "c")], "k bigint, x string")
    b = inline(spark, [(1, "p"), (None, "q")], "k bigint, y string")
    assert rows(relational.merge_nullsafe(a, b, "k")) == [(1, "a", "p"), (None, "b", "q")]
    c = inline(spark, [(1, "a", 9)], "k bigint, x string, z int")
    assert rows(relational.merge_common(a, c), "k", "z") == [(1, 9), (3, None), (None, None)]
    assert rows(relational.append(a, b)) == [(1, "a", None), (1, None, "p"), (3, "c", None), (None, "b", None), (None, None, "q")]
    assert rows(relational.intersect_ids(a.select("k"), b.select("k"))) == [(1,), (None,)]
    assert rows(relational.restrict_to(a, b.select("k"), "k")) == [(1, "a")]


def test_drop_datetimes(spark):
    df = inline(spark, [(1, T0)], "k bigint, at timestamp_ntz")
    assert relational.drop_datetimes(df).columns == ["k"]


# --- measurements ---------------------------------------------------------------------------------------------------
def test_dominant_unit_and_mismatch(spark):
    cv = inline(spark, [(1, "ml"), (1, "ml"), (1, "mg"), (2, "mg"), (2, "ml"), (3, "ml"), (4, ""), (4, "ml"), (5, None)], "itemid bigint, amountuom string")
    mv = inline(spark, [(1, "mg"), (1, "mg"), (3, "ml")], "itemid bigint, amountuom string")
    units = measurements.dominant_unit([cv, mv])
    assert rows(units) == [(1, "mg"), (2, "mg")]  # 1: 3 mg to 2 ml; 2: a tie
    both = cv.unionByName(inline(spark, [(1, None)], "itemid bigint, amountuom string"))
    flagged = rows(measurements.flag_unit_mismatch(both, units))
    # the flags of one item survive those of the next; an unknown unit is never flagged
    assert flagged.count((1, "ml", 1)) == 2 and (2, "ml", 1) in flagged and (1, None, None) in flagged and (3, "ml", None) in flagged


def test_inventory_unites_sources(spark):
    a = inline(spark, [(1, 5), (1, 5), (2, 6)], "hadm_id bigint, itemid bigint")
    got = measurements.item_inventory([Source("x", a, "itemid"), Source("x", a, "itemid", F.col("itemid") > 5), Source("y", a, "itemid")], inline(spark, [(1,)], "hadm_id bigint"))
    assert rows(got) == [("x", "5"), ("y", "5")]


def test_filter_events_removes_duplicates(spark):
    ev = inline(spark, [(1, 7, 1.0), (1, 7, 1.0), (1, 8, 1.0), (2, 7, 1.0), (None, 7, 1.0)], "hadm_id bigint, itemid bigint, value double")
    ctx, items = inline(spark, [(1,), (1,)], "hadm_id bigint"), inline(spark, [(7,)], "itemid bigint")
    assert rows(measurements.filter_events(ev, ctx, items, value="value")) == [(1, 7, 1.0, 1.0)]


def test_sigma_outliers_touch_only_the_group(spark):
    data = [(1, float(i % 5)) for i in range(50)] + [(2, 1000.0), (1, None), (3, 1e6)]
    df = inline(spark, data, "itemid bigint, valuenum double")
    got = rows(measurements.drop_sigma_outliers(df, [1, 2]))
    assert (2, 1000.0) not in got and (1, None) in got and (3, 1e6) in got and len(got) == 52
    single = inline(spark, [(1, 5.0)], "itemid bigint, valuenum double")
    assert len(rows(measurements.drop_sigma_outliers(single, [1]))) == 1  # the deviation of one value is unknown


def test_rules_and_fixes(spark):
    df = inline(spark, [(1, 0.0), (1, 400.0), (1, 400.1), (2, 0.0), (1, None)], "itemid bigint, valuenum double")
    kept = measurements.apply_rules(df, [DropRule((1,), "eq", 0), DropRule((1,), "gt", 400)])
    assert rows(kept) == [(1, 400.0), (1, None), (2, 0.0)]
    assert measurements.apply_rules(df, []).count() == 5
    fixed = measurements.apply_unit_fixes(df, [UnitFix((1,), 2.0, shift=1.0, above=399), UnitFix((2,), 1.0, shift=5.0)])
    assert rows(fixed) == [(1, 0.0), (1, 802.0), (1, 802.2), (1, None), (2, 5.0)]


def test_range_report(spark):
    schema = "itemid bigint, nitemid bigint, outlier_low double, valid_low double, valid_high double, outlier_high double"
    ranges = inline(spark, [(1, 10, 1.0, 2.0, 8.0, 9.0), (2, 10, 99.0, 99.0, 99.0, 99.0), (3, 20, None, None, 5.0, None), (4, 30, 1.0, 1.0, 1.0, 1.0)], schema)
    ev = inline(spark, [(1, 0.0), (1, 1.0), (2, 10.0), (2, 8.0), (3, 6.0), (3, 4.0), (1, None)], "itemid bigint, valuenum double")
    got = {r["nitemid"]: r.asDict() for r in measurements.range_report(ev, ranges).collect()}
    assert got[10] == {"nitemid": 10, "min": 0.0, "max": 10.0, "avg": 4.75, "cnt": 5, "out_low_per": 0.2, "val_low_per": 0.4, "out_high_per": 0.2, "val_high_per": 0.2}
    assert (got[20]["val_high_per"], got[20]["out_high_per"], got[20]["out_low_per"]) == (0.5, 0.0, 0.0)  # high limits count without low ones
    assert got[30] == {"nitemid": 30, "min": 0.0, "max": 0.0, "avg": 0.0, "cnt": 0, "out_low_per": 0.0, "val_low_per": 0.0, "out_high_per": 0.0, "val_high_per": 0.0}
    by = measurements.range_report(ev.withColumn("who", F.lit("a")), ranges, by=["who"])
    assert rows(by, "nitemid", "who", "cnt") == [(10, "a", 5), (20, "a", 2)]


# --- time -----------------------------------------------------------------------------------------------------------
def test_spread_wide_equals_narrow(spark, monkeypatch):
    df = inline(spark, [(1, "a", 1.0), (1, "a", 3.0), (1, "b", 5.0), (2, "b", 7.0), (2, "q", 1.0), (3, "q", 2.0)], "k bigint, f string, v double")
    specs = {"avrg_{value}": ("avg", "v"), "tot_{value}": ("sum", "v"), "cnt_{value}": ("count", "v")}
    narrow = timetable.spread(df, ["k"], "f", ["a", "b"], specs)
    none = timetable.spread(df, ["k"], "f", [], specs)
    monkeypatch.setattr(timetable, "WIDE_LIMIT", 1)
    wide = timetable.spread(df, ["k"], "f", ["a", "b"], specs)
    assert narrow.columns == wide.columns == ["k", "avrg_a", "tot_a", "cnt_a", "avrg_b", "tot_b", "cnt_b"]
    assert rows(narrow) == rows(wide) == [(1, 2.0, 4.0, 2, 5.0, 5.0, 1), (2, None, None, 0, 7.0, 7.0, 1)]  # key 3 has no listed value
    assert none.columns == ["k"] and rows(none) == []


def test_pivot_and_bucketize(spark):
    ev = inline(
        spark,
        [(1, 5, t(0), "x", 1.0), (1, 5, t(0), "x", 9.0), (1, 6, t(0), "y", 2.0), (1, 5, t(0.1), "x", 3.0), (1, 5, t(-1), "x", 4.0), (1, 5, t(9), "q", 4.0)],
        "hadm_id bigint, icustay_id bigint, charttime timestamp_ntz, feature string, valuenum double",
    )
    ctx = inline(spark, [(1, t(0), t(10)), (1, t(0), t(10))], "hadm_id bigint, admittime timestamp_ntz, dischtime timestamp_ntz")
    aligned = measurements.align_events(ev, ctx)
    wide = timetable.pivot_features(aligned, ["x", "y"])
    assert rows(wide, "icustay_id", "t_since", "x", "y") == [(5, 0.0, 1.0, None), (5, pytest.approx(0.1), 3.0, None), (6, 0.0, None, 2.0)]
    out = timetable.bucketize(wide, 1800, {"x": "avg", "y": "sum"}, ["hadm_id", "icustay_id"], "charttime", ctx)
    assert rows(out, "icustay_id", "charttime", "x", "y", "t_since", "t_til") == [(5, t(0), 2.0, None, 0.0, 10.0), (6, t(0), None, 2.0, 0.0, 10.0)]


@pytest.mark.parametrize("stay,tie,within", [("s", None, None), ("s", None, True), ("s", ["t1"], True), ("s", ["t1", "s"], None), (None, None, True), (None, ["t1", "t2"], None), ("s", ["v", "t1"], True)])
def test_the_picked_row_is_the_least(spark, stay, tie, within):
    """Against sorting the rows of each time, with unknown stays, ties and values."""
    rng = random.Random(5)
    some = lambda *xs: rng.choice([None, *xs])
    data = [
        (rng.randrange(4), some(1, 2, 3), rng.randrange(5), rng.choice("xyq"), rng.choice("ab"), some(1.0, 2.5, -3.0), some(1, 2), some(1, 2, 3)) for _ in range(600)
    ]
    names = ["e", "s", "time", "f", "origin", "v", "t1", "t2"]
    df = inline(spark, [(*d, d[2] * 1.0, 1.0) for d in data], "e bigint, s bigint, time bigint, f string, origin string, v double, t1 bigint, t2 bigint, t_since double, t_til double")
    order = list(dict.fromkeys([*(tie or ([stay] if stay else []) + ["v"]), *([stay] if stay else []), "v"]))
    last = lambda x: (x is None, x or 0)
    best = {}
    for d in data:
        r = dict(zip(names, d))
        if r["f"] in "xy":
            key = r["e"], r["time"], r["f"], r["origin"] if within else ""
            best[key] = min(best.get(key, r), r, key=lambda x: [last(x[o]) for o in order])
    want = {}
    for (e, time, f, _), r in best.items():
        cell = want.setdefault((e, r["s"] if stay else None, time), {})
        if r["v"] is not None:
            cell[f] = cell.get(f, 0.0) + r["v"]
    got = timetable.pivot_features(df.repartition(4), ["x", "y"], "e", "time", stay, feature="f", value="v", tie=tie, within=("origin", ["a", "b"]) if within else None)
    found = [((r["e"], r["s"] if stay else None, r["time"]), {f: r[f] for f in "xy" if r[f] is not None}) for r in got.collect()]
    assert len(found) == len(dict(found)) and dict(found) == want


def test_impute_sequence(spark):
    data = [
        (1, 0, None), (1, 1, 5.0), (1, 2, None), (1, 3, 7.0), (1, 4, None),  # leading, inner and trailing gap
        (2, 0, None), (2, 1, 3.0), (2, 2, None),  # exactly one known value
        (3, 0, None),  # none
    ]
    df = inline(spark, data, "k bigint, o bigint, v double")
    got = rows(timetable.impute_sequence(df, ["k"], ["o"], ["v"]), "k", "o", "v", "v_imputed", "v_imputed_global")
    assert got == [
        (1, 0, 5.0, 1.0, 1.0), (1, 1, 5.0, 0.0, 0.0), (1, 2, 5.0, 1.0, 0.0), (1, 3, 7.0, 0.0, 0.0), (1, 4, 7.0, 1.0, 0.0),
        (2, 0, 5.0, 1.0, 1.0), (2, 1, 3.0, 0.0, 0.0), (2, 2, 3.0, 1.0, 0.0), (3, 0, 5.0, 1.0, 1.0),
    ]
    fixed = timetable.impute_sequence(df, ["k"], ["o"], ["v"], medians={"v": 99.0})
    assert rows(fixed.filter("k = 3"), "v") == [(99.0,)]


@pytest.mark.parametrize("sliced", [False, True])
def test_pair_intervals(spark, sliced):
    data = [
        (1, 9, t(0), 1.0, 0), (1, 9, t(2), 4.0, 1),  # first pair
        (1, 9, t(3), 1.0, 0), (1, 9, t(4), 2.0, 0), (1, 9, t(7), 5.0, 1),  # two starts in a row: the later one pairs
        (1, 8, t(1), 1.0, 0),  # start without stop
        (2, 9, t(5), 6.0, 1),  # stop without start
    ]
    df = inline(spark, data, "icustay_id bigint, nitemid bigint, time timestamp_ntz, value double, flag int")
    cut = plan_slices(df, ["icustay_id", "nitemid"], "time", hot_rows=1, hot_share=0.2) if sliced else None
    assert not sliced or cut.borders
    got = timetable.pair_intervals(df, ["icustay_id", "nitemid"], "time", "flag", value="value", slices=cut)
    assert rows(got, "icustay_id", "nitemid", "start", "elapsed", "value") == [(1, 9, t(0), 2.0, 4.0), (1, 9, t(4), 3.0, 5.0)]


# --- summaries ------------------------------------------------------------------------------------------------------
def test_wide_summary(spark):
    ctx = inline(spark, [(1, 2.0), (2, 0.0), (3, None), (4, 1.0)], "icustay_id bigint, los_total double")
    ev = inline(spark, [(1, "16_1", 4.0), (1, "16_1", 6.0), (2, "16_1", 5.0), (3, "16_1", 1.0), (1, "7_2", None)], "icustay_id bigint, cid string, valuenum double")
    levels = summaries.WideSpec(ev, "cid", "valuenum")
    totals = summaries.WideSpec(ev, "cid", "valuenum", "totals", "in", ("16_1",))
    got = {r["icustay_id"]: r for r in summaries.wide_summary(ctx, [levels, totals]).collect()}
    assert (got[1]["avrg_16_1"], got[1]["mini_16_1"], got[1]["maxi_16_1"], got[1]["cnt_16_1"], got[1]["tot_16_1_in"]) == (5.0, 4.0, 6.0, 1.0, 5.0)
    assert got[2]["cnt_16_1"] is None and got[3]["cnt_16_1"] is None and got[2]["avrg_16_1"] == 5.0  # zero and unknown span
    assert got[4]["avrg_16_1"] is None and got[1]["cnt_7_2"] == 0.0
    plain = summaries.wide_summary(ctx, [levels], span=None)
    assert rows(plain.filter("icustay_id = 1"), "cnt_16_1") == [(2,)]


def test_summaries(spark):
    df = inline(spark, [(1, 2.0, 1.0), (1, 4.0, 2.0), (2, None, 1.0)], "k bigint, v double, e double")
    assert rows(summaries.summarize(df, ["k"], "v")) == [(1, 3.0, 2.0, 4.0, 2), (2, None, None, None, 1)]
    assert rows(summaries.summarize(df, ["k"], "v", "total", "e")) == [(1, 6.0, 2.0, 4.0, 2, 3.0), (2, None, None, None, 1, 1.0)]
    assert rows(summaries.mean_by(df, "k", ["v", "e"])) == [(1, 3.0, 1.5), (2, None, 1.0)]
    assert rows(summaries.rate_per(df, "v", "e", "r"), "r") == [(2.0,), (2.0,), (None,)]
    assert rows(summaries.count_distinct(df, "v")) == [(2,)]


def test_code_counts(spark):
    df = inline(spark, [(1, "042"), (1, "042"), (1, "1623"), (2, None), (3, "042")], "hadm_id bigint, icd9 string")
    ctx = inline(spark, [(1,), (2,)], "hadm_id bigint")
    assert rows(summaries.code_counts(df, "hadm_id", "icd9", "d")) == [(1, 2, 1), (3, 1, 0)]
    assert rows(summaries.code_counts(df, "hadm_id", "icd9", "d", ctx=ctx)) == [(1, 2, 1), (2, 0, 0)]
    assert rows(summaries.code_counts(df, "hadm_id", "icd9", "d", ctx=ctx, fill=False)) == [(1, 2, 1), (2, None, None)]
    assert dict(rows(summaries.code_count_map(df, "hadm_id", "icd9"))) == {1: {"042": 2, "1623": 1}, 3: {"042": 1}}


def test_too_many_values_are_refused(spark):
    df = inline(spark, [(i,) for i in range(5)], "v bigint")
    assert cohort.distinct_values(df, "v", limit=5) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        cohort.distinct_values(df, "v", limit=4)
    with pytest.raises(ValueError):
        encoding.fit_dummies(df, ["v"], limit=4)


# --- encoding -------------------------------------------------------------------------------------------------------
def test_dummies(spark):
    train = inline(spark, [("a", 1.0), ("b", 2.0), (None, None)], "c string, v double")
    test = inline(spark, [("b", None), ("z", 4.0), (None, 5.0)], "c string, v double")
    spec = encoding.fit_dummies(train, ["c"])
    assert spec.columns() == ["c_a", "c_b"]
    assert rows(encoding.apply_dummies(test, spec), "c_a", "c_b") == [(0, 0), (0, 0), (0, 1)]
    assert encoding.fit_dummies(train, ["c"], null_column=True).columns() == ["c_a", "c_b", "c_nan"]
    assert encoding.fit_dummies(train, ["c"], drop_last=True).columns() == ["c_a"]
    full = encoding.apply_dummies(train, encoding.fit_dummies(train, ["c"], null_column=True))
    assert rows(full.select((F.col("c_a") + F.col("c_b") + F.col("c_nan")).alias("s"))) == [(1,)] * 3
    a, b = encoding.prepare_inputs(train, test, ["c"])
    assert a.columns == b.columns and rows(b, "v") == [(1.5,), (4.0,), (5.0,)]  # the training median
    _, own = encoding.prepare_inputs(train, test, ["c"], own_medians=True)
    assert rows(own, "v") == [(4.0,), (4.5,), (5.0,)]


def test_the_label_is_not_filled(spark):
    df = inline(spark, [(1.0, 0, "a"), (2.0, 1, "b"), (None, 1, "a"), (9.0, None, "b")], "v double, y int, c string")
    train, _ = encoding.prepare_inputs(df, df, ["c"], outcomes=["y"])
    assert rows(train, "v", "y") == [(1.0, 0), (2.0, 1), (2.0, 1), (9.0, None)]
    assert modelling.model_frame(train, "y").count() == 3


def test_median_impute_default_columns(spark):
    df = inline(spark, [("x", 1, 1.0), ("y", None, 3.0), ("z", 4, None)], "s string, i bigint, v double")
    assert rows(encoding.median_impute(df)) == [("x", 1.0, 1.0), ("y", 2.5, 3.0), ("z", 4.0, 2.0)]


@pytest.mark.parametrize("sliced", [False, True])
def test_ordinals_by_first_appearance(spark, sliced):
    df = inline(spark, [(3, "b"), (1, "c"), (2, "b"), (4, None), (5, "a")], "o bigint, s string")
    cut = None
    if sliced:
        first = df.groupBy("s").agg(F.min("o").alias("_first"))
        cut = plan_slices(first, [], "_first", hot_rows=1, hot_share=0.5)
    assert rows(encoding.ordinal_encode(df, "s", "o", cut), "s", "s_code") == [("a", 3), ("b", 1), ("b", 1), ("c", 0), (None, 2)]


def test_l2(spark):
    df = inline(spark, [(1, 3.0, 4.0), (2, 0.0, 0.0)], "id bigint, a double, b double")
    assert rows(encoding.l2_normalize(df, ["a", "b"])) == [(1, 0.6, 0.8), (2, 0.0, 0.0)]
    arrays = df.select("id", F.array("a", "b").alias("v"))
    assert rows(encoding.l2_normalize_array(arrays, "v")) == [(1, [0.6, 0.8]), (2, [0.0, 0.0])]


def test_item_labels(spark):
    item_map = inline(
        spark, [(1, 16, 1, "Heart rate"), (2, 3, 2, "Saline"), (3, 4, 5, "Urine"), (3, 9, 9, "Saline")],
        "nid_table int, nid_class1 int, nid_class2 int, class2 string",
    )
    assert rows(encoding.item_labels(item_map)) == [
        ("avrg_16_1", "Average Value: Heart rate"), ("tot_3_2_in", "Total Input: Saline"), ("tot_4_5_out", "Total Output: Urine"),
    ]


# --- scores and splits ----------------------------------------------------------------------------------------------
def saps_in_python(r):
    def band(v, limits, above, missing=0):
        return missing if v is None else next((p for limit, p in limits if v < limit), above)

    total = sum(band(r[c], rule["bands"], rule["above"], rule.get("missing", 0)) for c, rule in rules.SAPS2_BANDS.items())
    return total + next((p for c, p in rules.SAPS2_CHRONIC if r[c] == 1), 0)


def test_saps2_at_every_limit(spark):
    names = [*rules.SAPS2_BANDS, *[c for c, _ in rules.SAPS2_CHRONIC]]
    data = []
    for name, rule in rules.SAPS2_BANDS.items():
        for limit, _ in rule["bands"]:
            for v in (limit - 0.5, float(limit), limit + 0.5, None):
                data.append(tuple(float(v) if c == name and v is not None else None for c in names))
    data += [tuple([50.0] * 13 + flags) for flags in ([1.0, 1.0, 1.0], [0.0, 1.0, 1.0], [None, 0.0, 1.0], [0.0, 0.0, None])]
    df = inline(spark, data, ", ".join(f"{c} double" for c in names))
    for r in clinical.saps2(df).collect():
        want = saps_in_python(r)
        x = -7.7631 + 0.0737 * want + 0.9971 * math.log(want + 1)
        assert r["saps2"] == want and r["SAPS2_mortality"] == pytest.approx(math.exp(x) / (1 + math.exp(x)))
    blank = inline(spark, [tuple([None] * len(names))], ", ".join(f"{c} double" for c in names))
    assert clinical.saps2(blank).first()["saps2"] == 18  # unknown age


def test_gcs_total_needs_all_parts(spark):
    df = inline(spark, [(1.0, 2.0, 3.0), (1.0, None, 3.0)], "gcs_e double, gcs_m double, gcs_v double")
    assert rows(df.select(scoring.gcs_total())) == [(6.0,), (None,)]


@pytest.mark.parametrize("bins", [16, 256, 65_536])
@pytest.mark.parametrize("frac", [0.0, 0.1, 0.5, 1.0])
def test_split_rule(spark, bins, frac):
    """Exact sizes in every stratum, an unknown one among them, the same for any way of narrowing."""
    df = spark.range(700).select("id", F.when(F.col("id") % 7 < 5, F.col("id") % 7).alias("died")).repartition(5)
    twice = df.union(df)
    rule = modelling.fit_split(twice, "id", "died", frac, 3, bins=bins)
    train, test = rule.apply(df.union(inline(spark, [(None, 1)], "id bigint, died bigint")))
    sizes = {r["died"]: r["count"] for r in test.groupBy("died").count().collect()}
    want = {k: round(frac * n) for k, n in [*((k, 100) for k in range(5)), (None, 200)]}
    assert sizes == {k: n for k, n in want.items() if n}
    assert train.count() + test.count() == 700
    digests = {r[0]: hashlib.md5(f"3:{r[0]}".encode()).hexdigest() for r in df.collect()}
    for k in want:
        ids = sorted((digests[r["id"]] for r in df.collect() if r["died"] == k))
        assert sorted(digests[r["id"]] for r in test.collect() if r["died"] == k) == ids[: want[k]]
    assert [rows(p) for p in rule.apply(df)] == [rows(p) for p in modelling.fit_split(df, "id", "died", frac, 3).apply(df)]


def test_split_rule_joins_nothing(spark):
    df = spark.range(50).select("id", (F.col("id") % 3).alias("died"))
    for part in modelling.fit_split(df, "id", "died", 0.2).apply(df):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Exchange" not in plan
    assert modelling.fit_split(df.limit(0), "id", "died").limits == {}
    with pytest.raises(ValueError):
        modelling.fit_split(df, "id", "id", strata=10)


def test_newton_steps_and_the_library_agree(spark):
    rng = random.Random(2)
    data = []
    for _ in range(800):
        a, b = rng.gauss(0, 1), rng.uniform(0, 5)
        data.append((a, b, float(rng.random() < 1 / (1 + math.exp(-(0.5 + 1.5 * a - 0.4 * b))))))
    df = inline(spark, [*data, (None, 1.0, 1.0), (1.0, float("nan"), 0.0), (1.0, 2.0, None)], "a double, b double, y double").repartition(3)
    known = df.filter("a IS NOT NULL AND NOT isnan(b) AND y IS NOT NULL")
    fit = logistic.fit_newton(df, "y", ["a", "b"])
    model = modelling.fit_logistic(known, "y")
    assert [fit.weights["a"], fit.weights["b"], fit.intercept] == pytest.approx([*model.coefficients, model.intercept], abs=1e-4)
    assert fit.rows == 800 and fit.steps < 10
    held = fit.holdout(df, "y").first()
    p = [1 / (1 + math.exp(-(fit.intercept + fit.weights["a"] * a + fit.weights["b"] * b))) > 0.5 for a, b, _ in data]
    assert tuple(held) == (800, sum(x == bool(y) for x, (_, _, y) in zip(p, data)), sum(p))


@pytest.mark.parametrize("per_part", [1000, 7, 1])
def test_dense_ids_and_sparse_counts(spark, per_part):
    rng = random.Random(4)
    data = [(rng.randrange(20), rng.choice([None, *(f"c{k:03d}" for k in range(40))])) for _ in range(400)]
    df = inline(spark, data, "k bigint, code string").repartition(5)
    ids = summaries.dense_ids(df, "code", per_part)
    codes = sorted({c for _, c in data if c is not None})
    assert dict(rows(ids)) == {c: i for i, c in enumerate(codes)}
    got = {r["k"]: (r["ids"], r["counts"]) for r in summaries.code_vectors(df, "k", "code", ids.filter("code <> 'c003'")).collect()}
    for k in range(20):
        own = [c for x, c in data if x == k and c not in (None, "c003")]
        cells = sorted({codes.index(c): float(own.count(c)) for c in own}.items())
        assert got.get(k, ([], [])) == ([i for i, _ in cells], [n for _, n in cells])
    assert summaries.dense_ids(df.limit(0), "code").count() == 0


def test_code_limit_is_a_parameter(spark):
    df = inline(spark, [(1, "a"), (1, "b")], "k bigint, code string")
    with pytest.raises(ValueError):
        summaries.code_counts(df, "k", "code", "c", limit=1)


def test_sparse_fit_is_the_dense_one(spark):
    rng = random.Random(9)
    true = [1.0, -2.0, 0.5, 0.0, 3.0, -1.0]
    data = []
    for k in range(600):
        x = {c: float(rng.randrange(1, 4)) for c in rng.sample(range(6), rng.randrange(4))}
        p = 1 / (1 + math.exp(-(0.3 + sum(true[c] * n for c, n in x.items()))))
        data.append((k, sorted(x), [x[c] for c in sorted(x)], int(rng.random() < p), *[x.get(c, 0.0) for c in range(6)]))
    names = [f"x{c}" for c in range(6)]
    df = inline(spark, data, "k bigint, ids array<bigint>, counts array<double>, y int, " + ", ".join(f"{n} double" for n in names)).repartition(4)
    sparse, dense = logistic.fit_sparse(df, "y", 6, close=1e-9), logistic.fit_newton(df, "y", names)
    assert [*sparse.weights, sparse.intercept] == pytest.approx([*dense.weights.values(), dense.intercept], abs=1e-5)
    assert sparse.loss == pytest.approx(dense.loss) and sparse.rows == 600
    one = df.orderBy("k").first()
    more = df.select("k", "ids", "counts").union(inline(spark, [(-1, None, None), (-2, [99], [1.0])], "k bigint, ids array<bigint>, counts array<double>"))
    scored = {r["k"]: r["probability"] for r in sparse.score(more).collect()}
    z = sparse.intercept + sum(sparse.weights[i] * n for i, n in zip(one["ids"], one["counts"]))
    assert scored[0] == pytest.approx(1 / (1 + math.exp(-z))) and scored[-1] == scored[-2] == pytest.approx(1 / (1 + math.exp(-sparse.intercept)))
    assert logistic.fit_sparse(df.filter("y = 1"), "y", 6).intercept == math.inf
    with pytest.raises(ValueError):
        logistic.fit_sparse(df, "y", 10**7)


def test_newton_on_odd_data(spark):
    df = inline(spark, [(1.0, 1), (2.0, 1)], "a double, y int")
    one = logistic.fit_newton(df, "y", ["a"])
    assert one.intercept == math.inf and tuple(one.holdout(df, "y").first()) == (2, 2, 2)
    none = logistic.fit_newton(df.limit(0), "y", ["a"])
    assert none.rows == 0 and tuple(none.holdout(df.limit(0), "y").first()) == (0, 0, 0)
    apart = inline(spark, [(x * 100.0, int(x > 5)) for x in range(11)], "a double, y int")  # separable and badly scaled
    fit = logistic.fit_newton(apart, "y", ["a"])
    assert tuple(fit.holdout(apart, "y").first())[:2] == (11, 11) and math.isfinite(fit.loss)
    with pytest.raises(ValueError):
        logistic.fit_newton(df, "y", [f"x{k}" for k in range(1001)])


def test_exact_split_sizes(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("died"))
    side = modelling.stratified_split(df, "id", "died", 0.1, 1, exact=True)
    assert rows(side.groupBy("died", "side").count()) == [(0, "test", 90), (0, "train", 810), (1, "test", 10), (1, "train", 90)]
    hashed = df.select("died", modelling.unit_hash("id", 1).alias("_hash"))
    cut = plan_slices(hashed, ["died"], "_hash", hot_rows=50, hot_share=0.05)
    sliced = modelling.stratified_split(df, "id", "died", 0.1, 1, exact=True, slices=cut)
    assert rows(side) == rows(sliced)


def test_logistic_regression_separates(spark):
    df = spark.range(400).select((F.col("id") / 100.0).alias("x"), (F.col("id") >= 200).cast("int").alias("died"), F.lit(1).alias("died_inhouse"))
    model = modelling.fit_logistic(df, "died", ["died_inhouse"])
    assert model.numFeatures == 1 and model.coefficients[0] > 1
    assert modelling.accuracy(model, df, "died", ["died_inhouse"]).first()["accuracy"] > 0.97
    multi = modelling.fit_logistic(df, "died", ["died_inhouse"], family="multinomial")
    assert multi.coefficientMatrix.numRows == 2
