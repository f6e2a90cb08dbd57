"""The clinical preset: fixed values.

Item ids, prefixes, limits and points below are fixed values of the data set and of the published SAPS-II score
(Le Gall et al., JAMA 1993). Nothing here is computed.
"""

from __future__ import annotations

from cohortspark.operators.measurements import DropRule, UnitFix

# --- fixed values: feature -> item ids, by source table -------------------------------------------------------------
CHART_FEATURES = {
    "gcs_v": (723, 223900),
    "gcs_m": (454, 223901),
    "gcs_e": (184, 220739),
    "systolic_bp": (51, 442, 455, 6701, 220179, 220050),
    "heart_rate": (211, 220045),
    "body_temp": (678, 223761, 676, 223762),
    "resp_rate": (618,),
    "sp02": (646,),
}
OUTPUT_FEATURES = {
    "urine": (
        40055, 43175, 40069, 40094, 40715, 40473, 40085, 40057, 40056, 40405, 40428, 40086, 40096, 40651,
        226559, 226560, 226561, 226584, 226563, 226564, 226565, 226567, 226557, 226558, 227488, 227489,
    ),
}
LAB_FEATURES = {
    "pao2_fio2_ratio": (50821,),
    "bun": (51006,),
    "wbc": (51300, 51301),
    "serum_bicarb": (50882,),
    "sodium": (950824, 50983),
    "potassium": (50822, 50971),
    "bilirubin": (50885,),
    "chloride": (50902,),
    "creatinine": (50912,),
    "hematocrit": (51221,),
}
IGNORED_CHART_ITEMS = (223835, 3420, 3422, 190)
IGNORED_LAB_ITEMS = (50816,)

# --- fixed values: diagnosis code rules, name -> (prefixes, exact codes) --------------------------------------------
DIAGNOSIS_RULES = {
    "has_cancer": (
        ["14", "15", "16", "18", "19", "20", "23", "170", "171", "172", "173", "174", "175", "179"],
        [],
    ),
    "has_aids": ([], ["042"]),
    "has_heme": (["2030", "2031", "2040", "2050", "2020", "2022", "2024", "2026", "2027", "2028"], []),
}
SERVICE_WEIGHTS = {"CMED": 1, "CSURG": 2}
MAX_AGE = 90

# --- fixed values: item ranges of the two input systems -------------------------------------------------------------
INPUT_MV_FROM = 200_000
INPUT_CV_RANGE = (30_000, 49_999)

# --- fixed values: cleaning -----------------------------------------------------------------------------------------
FAHRENHEIT_ITEMS = (678, 223761)
TEMPERATURE_ITEMS = (678, 223761, 676, 223762)
SYSTOLIC_ITEMS = (51, 442, 455, 6701, 220179, 220050)
CHART_FIXES = [UnitFix(FAHRENHEIT_ITEMS, scale=5.0 / 9.0, shift=-32.0)]
CHART_RULES = [
    DropRule(SYSTOLIC_ITEMS, "eq", 0),
    DropRule(SYSTOLIC_ITEMS, "gt", 400),
    DropRule((211, 220045), "gt", 300),
    DropRule((646,), "eq", 0),
]
OUTPUT_RULES = [DropRule(None, "gt", 1500)]
LAB_RULES = [DropRule((50912,), "gt", 40), DropRule((51300, 51301), "gt", 50)]
LAB_FIXES = [UnitFix((50885,), scale=0.05847953216374269, above=3)]
SIGMA = 3.0

# --- fixed values: buckets ------------------------------------------------------------------------------------------
HALF_HOUR_S, DAY_S = 1800, 86400
HALF_HOUR_AGGS = {
    "gcs_v": "avg", "gcs_e": "avg", "gcs_m": "avg", "heart_rate": "avg", "sp02": "avg", "resp_rate": "avg",
    "systolic_bp": "avg", "body_temp": "avg", "urine": "sum",
}
DAY_AGGS = {
    "pao2_fio2_ratio": "avg", "potassium": "avg", "creatinine": "avg", "hematocrit": "avg", "serum_bicarb": "avg",
    "bun": "avg", "sodium": "avg", "chloride": "avg", "wbc": "avg", "bilirubin": "avg", "body_temp": "avg",
}
COMA_FILLS = {"gcs_e": 4.0, "gcs_v": 5.0, "gcs_m": 6.0}

# --- fixed values: columns of the model -----------------------------------------------------------------------------
NOT_MODELLED = [
    "icustay_id", "hadm_id", "subject_id", "dbsource", "first_careunit", "last_careunit", "first_wardid", "last_wardid",
    "intime", "outtime", "admittime", "dischtime", "deathtime", "admission_location", "discharge_location", "edregtime",
    "edouttime", "diagnosis", "hospital_expire_flag", "has_chartevents_data", "dob", "dod", "dod_hosp", "dod_ssn",
    "expire_flag", "ser_ind", "age_at_death", "los_total",
]
CATEGORIES = ["admission_type", "insurance", "language", "religion", "marital_status", "ethnicity"]
OUTCOMES = ["died", "died_inhouse"]

# --- fixed values: SAPS-II bands (upper limits exclusive) -----------------------------------------------------------
SAPS2_BANDS = {
    "age_at_adm": {"bands": [(40, 0), (60, 7), (70, 12), (75, 15), (80, 16)], "above": 18, "missing": 18},
    "heart_rate": {"bands": [(40, 11), (70, 2), (120, 0), (160, 4)], "above": 7},
    "systolic_bp": {"bands": [(70, 13), (100, 5), (200, 0)], "above": 2},
    "body_temp": {"bands": [(39, 0)], "above": 3},
    "gcs_total": {"bands": [(6, 26), (8, 13), (10, 7), (14, 5)], "above": 0},
    "pao2_fio2_ratio": {"bands": [(100, 11), (200, 9)], "above": 6},
    "bun": {"bands": [(28, 0), (84, 6)], "above": 10},
    "urine": {"bands": [(500, 11), (1000, 4)], "above": 0},
    "sodium": {"bands": [(125, 5), (145, 0)], "above": 1},
    "potassium": {"bands": [(3, 3), (5, 0)], "above": 3},
    "serum_bicarb": {"bands": [(15, 6), (20, 3)], "above": 0},
    "bilirubin": {"bands": [(4, 0), (6, 4)], "above": 9},
    "wbc": {"bands": [(1, 12), (20, 0)], "above": 3},
}
SAPS2_CHRONIC = [("has_aids", 17), ("has_heme", 10), ("has_cancer", 9)]
SAPS2_COEFFICIENTS = (-7.7631, 0.0737, 0.9971)
