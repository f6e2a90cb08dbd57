"""Choosing admissions and building one context row per stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortspark.functions.ordered import Slices, dense_rank_by, plan_slices
from cohortspark.functions.predicates import any_of, code_prefix_match, holds
from cohortspark.functions.skew import AUTO, hot_keys, spread_join
from cohortspark.functions.time import elapsed_days, elapsed_hours, elapsed_years, within_days
from cohortspark.operators.relational import append, enrich, first_per, intersect_ids, remap, restrict_to

# Columns of the three entity tables that make up a context row.
STAY_COLUMNS = [
    "icustay_id", "dbsource", "first_careunit", "last_careunit", "first_wardid", "last_wardid", "intime", "outtime",
]
ADMISSION_COLUMNS = [
    "hadm_id", "subject_id", "admittime", "dischtime", "deathtime", "admission_type", "admission_location",
    "discharge_location", "insurance", "language", "religion", "marital_status", "ethnicity", "edregtime", "edouttime",
    "diagnosis", "hospital_expire_flag", "has_chartevents_data",
]
PATIENT_COLUMNS = ["gender", "dob", "dod", "dod_hosp", "dod_ssn", "expire_flag"]


def select_cohort(
    patients: DataFrame,
    admissions: DataFrame,
    max_age: float = 90,
    first_only: bool = False,
    services: DataFrame | None = None,
    service_names: tuple[str, ...] = (),
    icustays: DataFrame | None = None,
) -> DataFrame:
    """hadm_id of the admissions below the age limit.

    Options, off by default: keep a patient's first admission only; require one of the named services; require a stay.
    """
    age = elapsed_years("dob", "admittime")
    base = admissions.select("subject_id", "hadm_id", "admittime")
    if first_only:
        base = first_per(base, ["subject_id"], ["admittime", "hadm_id"])
    joined = base.join(patients.select("subject_id", "dob"), "subject_id")
    ids = joined.filter(age < F.lit(max_age)).select("hadm_id")
    if services is not None and service_names:
        ids = restrict_to(ids, services.filter(F.col("curr_service").isin(*service_names)).select("hadm_id"), "hadm_id")
    if icustays is not None:
        ids = restrict_to(ids, icustays.select("hadm_id"), "hadm_id")
    return ids


def cohort_intersect(services: DataFrame, icustays: DataFrame, service_names: tuple[str, ...]) -> DataFrame:
    """hadm_id of admissions under one of the services that also have a stay."""
    picked = services.filter(F.col("curr_service").isin(*service_names)).select("hadm_id")
    return intersect_ids(picked, icustays.select("hadm_id"))


def weighted_indicator(df: DataFrame, key: str, col: str, weights: dict[str, int], name: str = "ser_ind") -> DataFrame:
    """Sum of the weights of a key's rows; keys that have none of the weighted values are absent."""
    weight = F.lit(0)
    for value, w in weights.items():
        weight = F.when(F.col(col) == value, F.lit(w)).otherwise(weight)
    return (
        df.select(key, weight.alias("_w")).filter(F.col("_w") > 0).groupBy(key).agg(F.sum("_w").cast("bigint").alias(name))
    )


def add_ranks(
    df: DataFrame,
    stay: tuple[str, str] = ("hadm_id", "intime"),
    admission: tuple[str, str] = ("subject_id", "admittime"),
    stay_slices: Slices | str | None = AUTO,
    admission_slices: Slices | str | None = AUTO,
) -> DataFrame:
    """icu_rank of a stay in its admission and adm_rank of an admission of its patient; NULL times rank last."""
    df = dense_rank_by(df, [stay[0]], stay[1], "icu_rank", stay_slices)
    return dense_rank_by(df, [admission[0]], admission[1], "adm_rank", admission_slices)


def build_context(
    patients: DataFrame,
    admissions: DataFrame,
    icustays: DataFrame,
    services: DataFrame | None = None,
    cohort: DataFrame | None = None,
    service_weights: dict[str, int] | None = None,
    keep_no_stay: bool = False,
    hot: DataFrame | str | None = AUTO,
    stay_slices: Slices | str | None = AUTO,
    admission_slices: Slices | str | None = AUTO,
) -> DataFrame:
    """One row per stay with its admission, patient, ages, length of stay, outcomes, service indicator and ranks.

    Admissions without a stay share the unknown stay id and therefore collapse to one row (the lowest hadm_id);
    `keep_no_stay` keeps each of them. `hot` are admissions with too many stays for one task (measured unless given).
    """
    bound = admissions.count() + icustays.count()  # of the joined rows
    if isinstance(hot, str):
        hot = hot_keys(icustays, ["hadm_id"], rows=bound)
    base = admissions.select(*ADMISSION_COLUMNS)
    if cohort is not None:
        base = restrict_to(base, cohort, "hadm_id")
    people = base.join(patients.select("subject_id", *PATIENT_COLUMNS), "subject_id", "left")
    stays = icustays.select("hadm_id", *STAY_COLUMNS)
    if isinstance(stay_slices, str):
        stay_slices = plan_slices(icustays, ["hadm_id"], "intime", hot=hot)
    if isinstance(admission_slices, str):  # measured without the columns and joins the ranking does not need
        narrow = base.select("hadm_id", "subject_id", "admittime").join(icustays.select("hadm_id"), "hadm_id", "left")
        admission_slices = plan_slices(narrow, ["subject_id"], "admittime", rows=bound)
    if hot is None:
        rows = people.join(stays, "hadm_id", "left")
    else:  # stays lead the join, so that those of a hot admission can be spread
        with_stay = spread_join(stays, people, ["hadm_id"], "inner", hot)
        without = people.join(stays.select("hadm_id").distinct(), "hadm_id", "left_anti")
        rows = append(with_stay, without)
    if services is not None:
        indicator = weighted_indicator(services, "hadm_id", "curr_service", service_weights or {})
        rows = enrich(rows, indicator, ["hadm_id"], ["ser_ind"], unique=True, hot=hot)
    else:
        rows = rows.withColumn("ser_ind", F.lit(None).cast("bigint"))
    rows = rows.select(
        *STAY_COLUMNS[:1],
        "hadm_id",
        "subject_id",
        *STAY_COLUMNS[1:],
        *ADMISSION_COLUMNS[2:],
        *PATIENT_COLUMNS,
        "ser_ind",
        elapsed_years("dob", "dod").alias("age_at_death"),
        elapsed_years("dob", "admittime").alias("age_at_adm"),
        elapsed_days("intime", "outtime").alias("los_total"),
        F.when(F.col("dod").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("died"),
        within_days("dischtime", "dod", 30).alias("died_inhouse"),
    )
    ranked = add_ranks(rows, stay_slices=stay_slices, admission_slices=admission_slices)
    if keep_no_stay:
        own = F.when(F.col("icustay_id").isNull(), F.col("hadm_id"))
        return first_per(ranked.withColumn("_own", own), ["icustay_id", "_own"], ["hadm_id", "intime", "outtime"]).drop("_own")
    return first_per(ranked, ["icustay_id"], ["hadm_id", "intime", "outtime"])


def flag_per_key(df: DataFrame, key: str, flags: dict[str, Column]) -> DataFrame:
    """One row per key; a flag is 1 when any row of the key meets its condition, else 0."""
    return df.groupBy(key).agg(*[F.max(F.when(holds(c), F.lit(1)).otherwise(F.lit(0))).alias(n) for n, c in flags.items()])


def attach_flags(ctx: DataFrame, flags: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Left-join a flag table and read an absent key as 0."""
    names = [c for c in flags.columns if c != key]
    joined = enrich(ctx.drop(*names), flags, [key], names, unique=True, hot=hot)
    return joined.fillna(0, subset=names)


def one_hot_membership(
    ctx: DataFrame, members: DataFrame, key: str, col: str, values: list[str] | None = None, hot: DataFrame | None = None
) -> DataFrame:
    """A 0/1 column per distinct value of `col` (lower-cased name) telling whether the key has such a row."""
    name = F.lower(F.col(col))
    if values is None:
        values = distinct_values(members, name)
    flags = flag_per_key(members.filter(F.col(col).isNotNull()), key, {v: name == v for v in sorted({v.lower() for v in values})})
    return attach_flags(ctx, flags, key, hot)


def code_flags(
    ctx: DataFrame,
    diagnoses: DataFrame,
    rules: dict[str, tuple[list[str], list[str]]],
    key: str = "hadm_id",
    code: str = "icd9_code",
    codes_dim: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Flags by rule: name -> (code prefixes, exact codes). With `codes_dim` only codes listed there count."""
    match = {
        n: any_of([code_prefix_match(code, prefixes), F.col(code).isin(*exact) if exact else F.lit(False)])
        for n, (prefixes, exact) in rules.items()
    }
    hits = diagnoses.select(key, code).filter(any_of(match.values()))
    if codes_dim is not None:
        hits = restrict_to(hits, codes_dim.select(code), code)
    return attach_flags(ctx, flag_per_key(hits, key, match), key, hot)


def remap_categories(ctx: DataFrame, maps: dict[str, DataFrame], default: str | None = None) -> DataFrame:
    """Apply one remap dictionary per column."""
    for name, mapping in maps.items():
        ctx = remap(ctx, name, mapping, default=default)
    return ctx


def duration_features(ctx: DataFrame) -> DataFrame:
    """Add ages and lengths of stay in hours."""
    return ctx.select(
        "*",
        elapsed_hours("dob", "admittime").alias("age_at_admission_h"),
        elapsed_hours("admittime", "intime").alias("adm_to_icu_h"),
        elapsed_hours("intime", "outtime").alias("icu_los_h"),
        elapsed_hours("admittime", "dischtime").alias("hosp_los_h"),
        elapsed_hours("dob", "dod").alias("age_at_death_h"),
    )


MAX_COLUMNS = 10_000  # a schema wider than this is refused: use the map or vector form instead


def distinct_values(df: DataFrame, col: Column | str, limit: int = MAX_COLUMNS) -> list:
    """Sorted non-null distinct values that are to become columns; more than `limit` of them is an error, never a cut."""
    c = F.col(col) if isinstance(col, str) else col
    found = df.select(c.alias("v")).filter(F.col("v").isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"more than {limit} distinct values cannot become columns")
    return sorted(r["v"] for r in found)
