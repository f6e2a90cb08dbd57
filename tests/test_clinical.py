"""The clinical preset end to end on the hand-made hospital."""

import pytest
from pyspark.sql import functions as F

from cohortspark.functions.ordered import plan_slices
from cohortspark.functions.skew import hot_keys
from cohortspark.operators import cohort, modelling
from cohortspark.plans import clinical, rules, summary
from cohortspark.session import configure, inline
from tests.hospital import A1, A2, A3, A4, A5, A6, h, tables


@pytest.fixture(scope="module")
def hosp(spark):
    return tables(configure(spark))


@pytest.fixture(scope="module")
def stages(spark, hosp, tmp_path_factory):
    schema = "category string, remap0 string"
    maps = {
        "ethnicity": inline(spark, [("ASIAN", "OTHER"), ("DEFAULT", "UNKNOWN")], schema),
        "gender": inline(spark, [("F", "0"), ("M", "1")], schema),
    }
    return clinical.build_stages(spark, hosp, str(tmp_path_factory.mktemp("stages")), maps)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_cohort(hosp):
    ids = cohort.select_cohort(hosp["patients"], hosp["admissions"])
    assert rows(ids, "hadm_id") == [(A1,), (A2,), (A3,), (A5,), (A6,)]  # A4 is over 90
    first = cohort.select_cohort(hosp["patients"], hosp["admissions"], first_only=True)
    assert rows(first, "hadm_id") == [(A1,), (A3,), (A5,), (A6,)]
    strict = cohort.select_cohort(hosp["patients"], hosp["admissions"], 90, False, hosp["services"], ("CMED", "CSURG"), hosp["icustays"])
    assert rows(strict, "hadm_id") == [(A1,), (A3,)]
    assert rows(cohort.cohort_intersect(hosp["services"], hosp["icustays"], ("CMED", "CSURG")), "hadm_id") == [(A1,), (A3,)]


def test_context(hosp):
    ctx = clinical.context(hosp)
    got = {r["icustay_id"]: r for r in ctx.collect()}
    assert set(got) == {None, 1001, 1002, 1003, 1004, 1006}
    assert got[None]["hadm_id"] == A2  # A2 and A6 have no stay and share one row
    assert got[1001]["ser_ind"] == 3 and got[1003]["ser_ind"] == 4 and got[1006]["ser_ind"] is None
    assert (got[1001]["los_total"], got[1002]["los_total"], got[1003]["los_total"]) == (2.0, 0.0, None)
    assert (got[1001]["died"], got[1001]["died_inhouse"]) == (0, 0)
    assert (got[1003]["died"], got[1003]["died_inhouse"]) == (1, 1)
    assert (got[1006]["died"], got[1006]["died_inhouse"]) == (1, 0)  # exactly 30 days is not below 30 days
    assert got[1001]["icu_rank"] == 1 and got[1002]["icu_rank"] == 2
    assert got[1003]["icu_rank"] == 2 and got[1004]["icu_rank"] == 1  # unknown start ranks last
    assert got[1001]["adm_rank"] == 1 and got[None]["adm_rank"] == 2
    assert got[1003]["age_at_adm"] < 90 and abs(got[1003]["age_at_adm"] - 89.94) < 0.01
    assert (got[1001]["cmed"], got[1001]["csurg"], got[1001]["med"]) == (1, 1, 0)
    assert (got[1006]["cmed"], got[1006]["med"]) == (0, 1)
    flags = {k: (r["has_cancer"], r["has_aids"], r["has_heme"]) for k, r in got.items()}
    assert flags == {1001: (1, 1, 0), 1002: (1, 1, 0), 1003: (1, 0, 1), 1004: (1, 0, 1), 1006: (0, 0, 0), None: (0, 0, 0)}


def test_context_keeps_admissions_without_stay(hosp):
    ctx = clinical.context(hosp, keep_no_stay=True)
    assert rows(ctx.filter(F.col("icustay_id").isNull()), "hadm_id", "died_inhouse") == [(A2, 0), (A6, 1)]  # death before discharge counts
    assert "2031" not in [r[0] for r in hosp["d_icd_diagnoses"].collect()]
    assert rows(ctx.filter(F.col("hadm_id") == A6), "has_heme") == [(0,)]  # 2031 is not in the dictionary


def test_context_with_hot_patients(hosp):
    cut = plan_slices(hosp["admissions"], ["subject_id"], "admittime", hot_rows=1, hot_share=0.1)
    stay = plan_slices(hosp["icustays"], ["hadm_id"], "intime", hot_rows=1, hot_share=0.1)
    assert cut is not None and stay is not None
    args = (hosp["patients"], hosp["admissions"], hosp["icustays"])
    plain = cohort.build_context(*args, keep_no_stay=True)
    hot = hot_keys(hosp["icustays"], ["hadm_id"], 1, 0.1)
    sliced = cohort.build_context(*args, keep_no_stay=True, hot=hot, stay_slices=stay, admission_slices=cut)
    assert rows(plain, *plain.columns) == rows(sliced, *plain.columns)


def test_inventory(hosp):
    ids = cohort.select_cohort(hosp["patients"], hosp["admissions"])
    got = rows(clinical.inventory(hosp, ids), "source", "itemid")
    assert [i for s, i in got if s == "input"] == ["200000", "30000", "49999"]
    assert [i for s, i in got if s == "prescript"] == ["ASA"]
    assert [i for s, i in got if s == "microbio"] == ["{1, 2, 3}", "{1, 2, null}"]
    assert {s for s, _ in got} == {"input", "output", "chart", "lab", "microbio", "prescript"}


def test_cleaning(spark, hosp):
    ctx = clinical.context(hosp)
    chart = clinical.clean_chart(hosp, ctx, clinical.feature_table(spark, rules.CHART_FEATURES, rules.IGNORED_CHART_ITEMS))
    got = chart.collect()
    by_item = lambda i: sorted((r["valuenum"] is not None, r["valuenum"]) for r in got if r["itemid"] == i and r["hadm_id"] == A1)
    assert [v for _, v in by_item(220045)] == [None, 70.0, 71.0, 80.0, 90.0, 300.0]
    assert by_item(220050) == [(True, 120.0)] and by_item(646) == [(True, 97.0)] and by_item(999) == []
    assert by_item(223761)[0][1] == pytest.approx(37.0)
    assert not [r for r in got if r["hadm_id"] == A4]
    first = next(r for r in got if r["itemid"] == 646)
    assert (first["feature"], first["t_since"], first["t_til"]) == ("sp02", 4.0, 236.0)
    lab = clinical.clean_lab(hosp, ctx, clinical.feature_table(spark, rules.LAB_FEATURES, rules.IGNORED_LAB_ITEMS)).collect()
    assert sorted(r["valuenum"] for r in lab if r["itemid"] == 50885) == [pytest.approx(3.1 * 0.05847953216374269), 3.0]
    assert not [r for r in lab if r["itemid"] == 50912 and r["hadm_id"] == A1] and not [r for r in lab if r["hadm_id"] is None]
    assert [r["valuenum"] for r in lab if r["itemid"] == 51300] == [50.0]
    out = clinical.clean_output(hosp, ctx, clinical.feature_table(spark, rules.OUTPUT_FEATURES)).collect()
    assert sorted(r["valuenum"] for r in out if r["hadm_id"] == A1) == [100.0, 1500.0]


def test_time_table(stages):
    tt = stages.timetable
    stay = {r["time"]: r for r in tt.filter(F.col("icustay_id") == 1001).collect()}
    assert h(-1) not in stay and h(241) not in stay
    assert stay[h(3)]["heart_rate"] == 80.0  # of 80 and 84 at one time the first by value
    assert stay[h(3)]["urine"] == 1500.0 and stay[h(3)]["ignore"] == 0.5 and stay[h(3)]["sodium"] is None
    lab = {r["time"]: r for r in tt.filter((F.col("hadm_id") == A1) & F.col("icustay_id").isNull()).collect()}
    assert lab[h(3)]["sodium"] == 140.0 and lab[h(3)]["wbc"] == 50.0 and lab[h(3)]["heart_rate"] is None
    assert set(rules.CHART_FEATURES) | set(rules.LAB_FEATURES) | {"urine", "ignore"} <= set(tt.columns)


def test_buckets(stages):
    tb = {r["time"]: r for r in stages.timebucket.filter(F.col("icustay_id") == 1001).collect()}
    assert tb[h(3)]["heart_rate"] == 85.0  # 3.0 h and 3.2 h
    assert tb[h(3)]["urine"] == 1600.0 and tb[h(3)]["t_since"] == 3.0 and tb[h(3)]["t_til"] == 237.0
    assert sum(r["urine"] or 0 for r in stages.timebucket.collect()) == sum(
        r["urine"] or 0 for r in stages.timetable.collect()
    )
    day = [r for r in stages.daybucket.collect() if r["hadm_id"] == A1]
    assert sorted(r["sodium"] for r in day) == [140.0, 144.0]  # 11:00 rounds down, 04:00 of the next day too
    assert min(r["t_since"] for r in day) == -8.0  # midnight lies before the admission
    assert all(r["body_temp"] is None for r in day)


def test_remap(stages):
    got = dict(rows(stages.context.filter(F.col("icustay_id").isin(1001, 1003)), "gender", "ethnicity"))
    assert got == {"0": "WHITE", "1": "OTHER"}
    assert rows(stages.context.filter(F.col("icustay_id").isNull()), "ethnicity", "language") == [("ODD", "ENGL")]


@pytest.mark.parametrize("exact", [False, True])
def test_split(stages, exact):
    parts = clinical.split(stages, frac=0.4, seed=3, exact=exact)
    for name, (train, test) in parts.items():
        a, b = ({r[0] for r in p.select("hadm_id").collect()} for p in (train, test))
        whole = getattr(stages, name)
        assert not a & b and a | b == {r[0] for r in whole.select("hadm_id").collect()}
        assert train.count() + test.count() == whole.count()


def test_saps2_and_model_inputs(stages):
    made = clinical.assembled(stages.context, stages.timebucket, stages.daybucket, keep_ids=True)
    scored = {r["icustay_id"]: r for r in clinical.saps2(made).collect()}
    # 40-60: 7; heart rate 100: 0; no pressure, no temperature; coma 2+5+3=10: 5; urine 700: 4; sodium 130: 0
    assert scored[1006]["gcs_total"] == 10.0 and scored[1006]["saps2"] == 0 + 5 + 4
    assert 0 < scored[1006]["SAPS2_mortality"] < 0.05
    # 89.9 years: 18; 60/min: 2; 37 °C: 0; coma 4+6+5: 0; urine 30: 11; sodium 124: 5; blood disease: 10
    assert scored[1003]["saps2"] == 18 + 2 + 0 + 0 + 11 + 5 + 10
    same = {n: (df, df) for n, df in (("context", stages.context), ("timebucket", stages.timebucket), ("daybucket", stages.daybucket))}
    train, test = clinical.model_inputs(same)
    assert train.columns == test.columns and "died" in train.columns
    filled = [c for c in train.columns if train.filter(F.col(c).isNull()).count()]
    assert set(filled) <= {"pao2_fio2_ratio", "potassium", "hematocrit", "serum_bicarb", "bun", "chloride", "resp_rate"}  # never measured here
    ready_train, ready_test = train.drop(*filled), test.drop(*filled)
    model = modelling.fit_logistic(ready_train, "died", rules.OUTCOMES)
    assert model.numFeatures == len(ready_train.columns) - 2
    score = modelling.accuracy(model, ready_test, "died", rules.OUTCOMES).first()
    assert score["n"] == made.count() and 0 <= score["accuracy"] <= 1


def test_inventory_and_unit_flags_are_stages(stages):
    assert rows(stages.inventory.filter("source = 'prescript'"), "itemid") == [("ASA",)]
    flagged = rows(stages.inputs.filter("todelete = 1"), "hadm_id", "itemid", "amountuom", "system")
    assert flagged == [(A1, 49999, "ml", "cv"), (A3, 200000, "", "mv"), (A3, 200000, "mg", "mv")]  # a tie goes to mg, two of three to ml
    assert stages.inputs.filter(f"hadm_id = {A4}").count() == 0 and stages.inputs.count() == 12


def test_chart_is_scanned_once(spark, hosp, tmp_path):
    path = str(tmp_path / "chartevents")
    hosp["chartevents"].write.parquet(path)
    files = {**hosp, "chartevents": spark.read.parquet(path)}
    ctx = clinical.context(hosp)
    features = clinical.feature_table(spark, rules.CHART_FEATURES, rules.IGNORED_CHART_ITEMS)
    out = clinical.clean_chart(files, ctx, features)
    assert path not in out._jdf.queryExecution().toString()  # only the written stage is left to read
    plain = clinical.clean_chart(hosp, ctx, features)
    assert rows(out, *plain.columns) == rows(plain, *plain.columns)


def test_bucketed_stages(spark, hosp, stages, tmp_path):
    """The same rows, and no shuffle between context, time table and split."""
    bucketed = clinical.build_stages(spark, hosp, str(tmp_path), buckets=4)
    assert rows(bucketed.timetable, *stages.timetable.columns) == rows(stages.timetable, *stages.timetable.columns)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        train, _ = clinical.split(bucketed)["timebucket"]
        joined = train.join(bucketed.context.select("hadm_id", "admittime"), "hadm_id").groupBy("hadm_id").agg(F.avg("heart_rate"))
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_label_is_not_filled(stages):
    same = {n: (df, df) for n, df in (("context", stages.context), ("timebucket", stages.timebucket), ("daybucket", stages.daybucket))}
    unknown = same["context"][0].withColumn("died", F.when(F.col("icustay_id") != 1003, F.col("died")))
    train, _ = clinical.model_inputs({**same, "context": (unknown, unknown)})
    made = clinical.assembled(unknown, stages.timebucket, stages.daybucket, keep_ids=True)
    assert train.filter("died IS NULL").count() == made.filter("died IS NULL").count() > 0


def test_second_pipeline(spark):
    times = "dob timestamp_ntz, dod timestamp_ntz, admittime timestamp_ntz, dischtime timestamp_ntz, intime timestamp_ntz, outtime timestamp_ntz"
    none = (None,) * 6
    ctx = inline(
        spark, [(1, 10, 2.0, "F", "dx", *none), (2, 10, 0.0, None, "dx", *none), (3, 11, None, "M", "dx", *none), (4, None, 1.0, "M", "dx", *none)],
        f"icustay_id bigint, hadm_id bigint, los_total double, gender string, diagnosis string, {times}",
    )
    codes = lambda *x: inline(spark, list(x), "hadm_id bigint, icd9_code string")
    events = lambda value, *x: inline(spark, list(x), f"icustay_id bigint, cid1 bigint, cid2 bigint, {value} double")
    tables_ = {
        "diagnoses_icd": codes((10, "042"), (10, "042"), (10, "V1"), (12, "X"), (10, None)),
        "procedures_icd": codes((11, "99")),
        "chartevents": events("valuenum", (1, 1, 2, 4.0), (1, 1, 2, 6.0), (1, 1, 2, None), (2, 1, 2, 3.0), (3, 1, None, 9.0), (3, 1, 2, 1.0)),
        "outputevents": events("value", (1, 5, 6, 10.0), (2, 5, 6, 1.0)),
        "inputevents_mv": events("amount", (1, 7, 8, 3.0)),
    }
    out = summary.stay_summary(ctx, tables_)
    got = {r["icustay_id"]: r.asDict() for r in out.collect()}
    assert not [c for c in out.columns if c in ("dob", "diagnosis", "gender", "admittime")] and "icu_los_h" in out.columns
    assert {c for c in out.columns if c.startswith(("d_", "p_"))} == {"d_icd_042", "d_icd_V1", "d_icd_X", "p_icd_99"}
    assert (got[1]["d_icd_042"], got[1]["d_icd_X"], got[1]["p_icd_99"]) == (2, 0, 0)
    assert (got[3]["d_icd_042"], got[3]["p_icd_99"], got[4]["d_icd_042"], got[4]["p_icd_99"]) == (None, 1, None, 0)
    assert (got[1]["gender_F"], got[1]["gender_nan"], got[2]["gender_nan"]) == (1, 0, 1)
    assert (got[1]["avrg_1_2"], got[1]["mini_1_2"], got[1]["maxi_1_2"], got[1]["cnt_1_2"]) == (5.0, 4.0, 6.0, 1.0)
    assert (got[2]["avrg_1_2"], got[2]["cnt_1_2"], got[3]["cnt_1_2"]) == (3.0, None, None)  # a zero and an unknown span
    assert (got[1]["tot_5_6_out"], got[1]["tot_7_8_in"], got[2]["tot_5_6_out"]) == (5.0, 1.5, None)
    ids, vectors = summary.sparse_codes(tables_["diagnoses_icd"])
    assert rows(ids, "icd9_code", "icd9_code_id") == [("042", 0), ("V1", 1), ("X", 2)]
    assert rows(vectors, "hadm_id", "ids", "counts") == [(10, [0, 1], [2.0, 1.0]), (12, [2], [1.0])]
