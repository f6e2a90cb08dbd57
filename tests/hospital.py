"""A hand-made hospital: a few rows per table covering the NULL, tie and boundary cases."""

import datetime as dt

from cohortspark.session import inline

T = dt.datetime
A1, A2, A3, A4, A5, A6 = 101, 102, 103, 104, 105, 106
IN = T(2150, 1, 10, 8, 0)


def h(hours, base=IN):
    return base + dt.timedelta(hours=hours)


def tables(spark):
    def t(schema, *rows):
        return inline(spark, list(rows), schema)

    patients = t(
        "subject_id bigint, gender string, dob timestamp_ntz, dod timestamp_ntz, dod_hosp timestamp_ntz, dod_ssn timestamp_ntz, expire_flag int",
        (1, "F", T(2100, 1, 1), None, None, None, 0),
        (2, "M", T(2060, 2, 1), T(2150, 2, 1), None, None, 1),  # just under 90 at admission, died within 30 days
        (3, "M", T(2050, 1, 1), None, None, None, 0),  # over 90
        (4, "F", T(2120, 6, 1), T(2150, 2, 19), None, None, 1),  # died exactly 30 days after discharge
        (5, "F", T(2110, 1, 1), T(2150, 1, 1), None, None, 1),  # death recorded before discharge
    )
    blank = (None,) * 4

    def adm(hadm, subject, start, stop, kind, language, ethnicity):
        return (hadm, subject, start, stop, None, kind, "ER", "HOME", "Private", language, "X", "SINGLE", ethnicity, None, None, "dx", 0, 1)

    admissions = t(
        "hadm_id bigint, subject_id bigint, admittime timestamp_ntz, dischtime timestamp_ntz, deathtime timestamp_ntz, admission_type string, "
        "admission_location string, discharge_location string, insurance string, language string, religion string, marital_status string, "
        "ethnicity string, edregtime timestamp_ntz, edouttime timestamp_ntz, diagnosis string, hospital_expire_flag int, has_chartevents_data int",
        adm(A1, 1, IN, h(240), "EMERGENCY", None, "WHITE"),
        adm(A2, 1, T(2151, 1, 1), T(2151, 1, 5), "ELECTIVE", "ENGL", "ODD"),
        adm(A3, 2, IN, h(240), "EMERGENCY", "ENGL", "ASIAN"),
        adm(A4, 3, IN, h(240), "URGENT", "ENGL", "WHITE"),
        adm(A5, 4, IN, T(2150, 1, 20), "URGENT", "SPAN", "WHITE"),
        adm(A6, 5, IN, h(48), "ELECTIVE", "SPAN", "ASIAN"),
    )
    icustays = t(
        "icustay_id bigint, hadm_id bigint, subject_id bigint, dbsource string, first_careunit string, last_careunit string, "
        "first_wardid int, last_wardid int, intime timestamp_ntz, outtime timestamp_ntz",
        (1001, A1, 1, "metavision", "CCU", "CCU", 1, 1, h(2), h(50)),
        (1002, A1, 1, "metavision", "MICU", "MICU", 2, 2, h(100), h(100)),  # zero length
        (1003, A3, 2, "carevue", "CCU", "CCU", 1, 1, None, h(24)),  # unknown start
        (1004, A3, 2, "carevue", "CCU", "CCU", 1, 1, h(30), h(54)),
        (1005, A4, 3, "carevue", "CCU", "CCU", 1, 1, h(1), h(20)),
        (1006, A5, 4, "metavision", "CCU", "CCU", 1, 1, h(0), h(12)),
    )  # A2 and A6 have no stay
    services = t(
        "hadm_id bigint, curr_service string",
        (A1, "CMED"), (A1, "CSURG"), (A3, "CSURG"), (A3, "CSURG"), (A5, "MED"), (A6, "CMED"),
    )
    chart = t(
        "hadm_id bigint, icustay_id bigint, itemid bigint, charttime timestamp_ntz, valuenum double",
        (A1, 1001, 220045, h(3), 80.0), (A1, 1001, 220045, h(3), 80.0),  # exact duplicate
        (A1, 1001, 211, h(3), 84.0),  # second value of the feature at that time
        (A1, 1001, 220045, h(3.2), 90.0), (A1, 1001, 220045, h(4), None),
        (A1, 1001, 220045, h(5), 301.0), (A1, 1001, 220045, h(5.5), 300.0),
        (A1, 1001, 220050, h(3), 0.0), (A1, 1001, 220050, h(4), 401.0), (A1, 1001, 220050, h(5), 120.0),
        (A1, 1001, 646, h(3), 0.0), (A1, 1001, 646, h(4), 97.0),
        (A1, 1001, 223761, h(3), 98.6), (A1, 1001, 223762, h(4), 37.5),
        (A1, 1001, 220045, h(-1), 70.0), (A1, 1001, 220045, h(241), 71.0),  # before admission, after discharge
        (A3, 1003, 220045, h(10), 60.0), (A3, 1003, 723, h(10), 5.0), (A3, 1003, 223762, h(10), 37.0),
        (A5, 1006, 220045, h(1), 100.0), (A5, 1006, 723, h(1), 3.0), (A5, 1006, 454, h(1), 5.0), (A5, 1006, 184, h(1), 2.0),
        (A4, 1005, 220045, h(2), 99.0),  # outside the cohort
        (A1, 1001, 999, h(3), 1.0),  # item of no feature
        (A1, 1001, 223835, h(3), 0.5),  # ignored item
    )
    output = t(
        "hadm_id bigint, icustay_id bigint, itemid bigint, charttime timestamp_ntz, value double",
        (A1, 1001, 40055, h(3), 1500.0), (A1, 1001, 40055, h(4), 1501.0), (A1, 1001, 40069, h(3.1), 100.0), (A3, 1003, 40055, h(10), 30.0),
        (A5, 1006, 40055, h(1), 700.0),
    )
    lab = t(
        "hadm_id bigint, itemid bigint, charttime timestamp_ntz, valuenum double",
        (A1, 50885, h(3), 3.0), (A1, 50885, h(6), 3.1), (A1, 50912, h(3), 41.0), (A1, 51300, h(3), 50.0), (None, 50983, h(3), 140.0),
        (A1, 50983, h(3), 140.0), (A1, 50983, h(20), 144.0), (A3, 50983, h(10), 124.0), (A3, 50912, h(10), 1.0), (A5, 50983, h(1), 130.0),
    )
    codes = ["042", "0420", "1623", "2030", "2089"]
    return {
        "patients": patients, "admissions": admissions, "icustays": icustays, "services": services, "chartevents": chart,
        "outputevents": output, "labevents": lab,
        "diagnoses_icd": t(
            "hadm_id bigint, icd9_code string",
            (A1, "042"), (A1, "042"), (A1, "1623"), (A3, "2030"), (A3, None), (A5, "0420"), (A6, "2089"), (A6, "2031"),
        ),
        "d_icd_diagnoses": t("icd9_code string", *[(c,) for c in codes]),
        "inputevents_cv": t(
            "hadm_id bigint, itemid bigint, amount double, amountuom string",
            (A1, 29999, 1.0, "ml"), (A1, 30000, 1.0, "ml"), (A1, 49999, 1.0, "mg"), (A1, 49999, 1.0, "ml"), (A1, 50000, 1.0, "ml"),
            (A4, 30001, 1.0, "ml"),
        ),
        "inputevents_mv": t(
            "hadm_id bigint, itemid bigint, amount double, amountuom string",
            (A1, 199999, 1.0, "ml"), (A1, 200000, 1.0, "ml"), (A3, 200000, 1.0, "ml"), (A3, 200000, 1.0, "mg"), (A3, 200000, 1.0, None),
            (A3, 200000, 1.0, ""), (A1, 30000, 2.0, "ml"),
        ),
        "prescriptions": t("hadm_id bigint, formulary_drug_cd string", (A1, "ASA"), (A3, "ASA"), (A4, "HEP")),
        "microbiologyevents": t(
            "hadm_id bigint, spec_itemid bigint, org_itemid bigint, ab_itemid bigint", (A1, 1, 2, None), (A3, 1, 2, None), (A1, 1, 2, 3)
        ),
    }
