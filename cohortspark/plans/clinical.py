"""The clinical pipeline: source tables -> cohort, context, cleaned events, buckets, split, scores, model inputs."""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortspark.functions.skew import hot_keys
from cohortspark.operators.cohort import build_context, code_flags, one_hot_membership, remap_categories, select_cohort
from cohortspark.operators.encoding import prepare_inputs
from cohortspark.operators.measurements import (
    Source,
    align_events,
    apply_rules,
    apply_unit_fixes,
    dominant_unit,
    drop_sigma_outliers,
    filter_events,
    flag_unit_mismatch,
    item_inventory,
)
from cohortspark.operators.modelling import assemble_features, fit_split, split_side
from cohortspark.operators.relational import append, restrict_to
from cohortspark.operators.scoring import severity
from cohortspark.operators.timetable import bucketize, pivot_features
from cohortspark.plans import rules
from cohortspark.session import inline, settle
from cohortspark.sources.sinks import materialize, save_bucketed


LABEL = "died"  # the outcome that strata are of; time tables carry it


def feature_table(spark: SparkSession, features: dict[str, tuple], ignored: tuple = ()) -> DataFrame:
    """(feature, itemid) lookup of a preset; ignored items carry the feature name "ignore"."""
    rows = [(f, i) for f, ids in features.items() for i in ids] + [("ignore", i) for i in ignored]
    return inline(spark, rows, "feature string, itemid bigint")


def inventory(tables: dict[str, DataFrame], cohort: DataFrame | None) -> DataFrame:
    """Item ids per source for the cohort."""
    item, composite = F.col("itemid"), F.struct("spec_itemid", "org_itemid", "ab_itemid")
    return item_inventory(
        [
            Source("input", tables["inputevents_mv"], "itemid", item >= rules.INPUT_MV_FROM),
            Source("input", tables["inputevents_cv"], "itemid", item.between(*rules.INPUT_CV_RANGE)),
            Source("output", tables["outputevents"], "itemid"),
            Source("chart", tables["chartevents"], "itemid"),
            Source("lab", tables["labevents"], "itemid"),
            Source("microbio", tables["microbiologyevents"], composite),
            Source("prescript", tables["prescriptions"], "formulary_drug_cd"),
        ],
        cohort,
    )


def context(tables: dict[str, DataFrame], maps: dict[str, DataFrame] | None = None, keep_no_stay: bool = False) -> DataFrame:
    """Cohort -> context row -> service flags -> diagnosis flags -> category remap."""
    cohort = select_cohort(tables["patients"], tables["admissions"], rules.MAX_AGE)
    hot = hot_keys(tables["icustays"], ["hadm_id"])
    rows = build_context(
        tables["patients"],
        tables["admissions"],
        tables["icustays"],
        tables["services"],
        cohort,
        rules.SERVICE_WEIGHTS,
        keep_no_stay,
        hot,
    )
    rows = one_hot_membership(rows, tables["services"], "hadm_id", "curr_service", hot=hot)
    rows = code_flags(rows, tables["diagnoses_icd"], rules.DIAGNOSIS_RULES, codes_dim=tables["d_icd_diagnoses"], hot=hot)
    return remap_categories(rows, maps or {})


def clean_chart(tables: dict[str, DataFrame], ctx: DataFrame, features: DataFrame) -> DataFrame:
    hot = hot_keys(tables["chartevents"], ["hadm_id"])
    events = filter_events(tables["chartevents"], ctx, features, hot=hot)
    # Written before the bounds are taken: the largest table is scanned and freed of copies once, the bounds read two columns.
    events = settle(apply_unit_fixes(events, rules.CHART_FIXES), "chart-events")
    events = drop_sigma_outliers(events, list(rules.TEMPERATURE_ITEMS), rules.SIGMA)
    return align_events(apply_rules(events, rules.CHART_RULES), ctx, features, hot=hot, carry=(LABEL,))


def clean_output(tables: dict[str, DataFrame], ctx: DataFrame, features: DataFrame) -> DataFrame:
    hot = hot_keys(tables["outputevents"], ["hadm_id"])
    events = filter_events(tables["outputevents"], ctx, features, value="value", hot=hot)
    return align_events(apply_rules(events, rules.OUTPUT_RULES), ctx, features, hot=hot, carry=(LABEL,))


def clean_lab(tables: dict[str, DataFrame], ctx: DataFrame, features: DataFrame) -> DataFrame:
    hot = hot_keys(tables["labevents"], ["hadm_id"])
    events = filter_events(tables["labevents"], ctx, features, hot=hot)
    events = apply_unit_fixes(apply_rules(events, rules.LAB_RULES), rules.LAB_FIXES)
    return align_events(events, ctx, features, hot=hot, carry=(LABEL,))


def flagged_inputs(tables: dict[str, DataFrame], cohort: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Input events of the cohort from both systems (`system`), flagged (`todelete`) where they are not in their item's dominant unit.

    The dominant unit is taken over both systems. `items` (source, itemid) is an inventory whose input items alone count.
    """
    parts = {}
    for system in ("cv", "mv"):
        events = tables[f"inputevents_{system}"]
        parts[system] = restrict_to(events, cohort, "hadm_id", hot_keys(events, ["hadm_id"]))
    units = dominant_unit(list(parts.values()))
    if items is not None:
        listed = items.filter("source = 'input'").select(F.col("itemid").try_cast("bigint").alias("itemid"))
        units = restrict_to(units, listed, "itemid")
    units = settle(units, "units")
    shared = [c for c in parts["cv"].columns if c in parts["mv"].columns]
    return append(*[flag_unit_mismatch(df.select(*shared), units).withColumn("system", F.lit(name)) for name, df in parts.items()])


def _long(events: DataFrame, has_stay: bool) -> DataFrame:
    stay = F.col("icustay_id") if has_stay else F.lit(None)
    return events.select(
        "hadm_id",
        stay.cast("bigint").alias("icustay_id"),
        F.col("charttime").alias("time"),
        "t_since",
        "t_til",
        LABEL,
        "feature",
        F.col("valuenum").cast("double").alias("valuenum"),
    )


INVENTORIED = {"inputevents_cv", "inputevents_mv", "outputevents", "chartevents", "labevents", "microbiologyevents", "prescriptions"}
ORIGIN = "origin"
CARRIED = ("t_since", "t_til", LABEL)  # they follow from admission and time


def time_table(sources: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """Wide table over cleaned sources; duplicates of a feature at one time count once within each source."""
    tagged = append(*[df.withColumn(ORIGIN, F.lit(name)) for name, df in sources.items()])
    return pivot_features(tagged, features, time="time", carried=CARRIED, within=(ORIGIN, list(sources)))


@dataclass(frozen=True)
class Stages:
    context: DataFrame
    timetable: DataFrame
    daily: DataFrame
    timebucket: DataFrame
    daybucket: DataFrame
    inventory: DataFrame | None = None
    inputs: DataFrame | None = None


def build_stages(
    spark: SparkSession, tables: dict[str, DataFrame], folder: str, maps: dict[str, DataFrame] | None = None, buckets: int | None = None
) -> Stages:
    """Run the preset, writing each stage that later ones read more than once below `folder` (a shared location).

    With `buckets`, context and time tables are written in so many buckets by admission, so that joins, splits and windows on it
    shuffle nothing; they are then tables of the session's catalog. Inventory and input events are built where their tables are given.
    """

    def stage(df: DataFrame, name: str) -> DataFrame:
        path = os.path.join(folder, name)
        if buckets is None or "hadm_id" not in df.columns:
            return materialize(df, path)
        return save_bucketed(df, path, f"{name}_{uuid.uuid4().hex}", ["hadm_id"], buckets)

    chart = feature_table(spark, rules.CHART_FEATURES, rules.IGNORED_CHART_ITEMS)
    output = feature_table(spark, rules.OUTPUT_FEATURES)
    lab = feature_table(spark, rules.LAB_FEATURES, rules.IGNORED_LAB_ITEMS)
    names = [*rules.CHART_FEATURES, *rules.OUTPUT_FEATURES, *rules.LAB_FEATURES, "ignore"]

    ctx = stage(context(tables, maps), "context")
    cleaned_lab = stage(_long(clean_lab(tables, ctx, lab), False), "lab")
    icu = append(_long(clean_output(tables, ctx, output), True), _long(clean_chart(tables, ctx, chart), True))
    tt = stage(time_table({"icu": icu, "adm": cleaned_lab}, names), "timetable")
    daily = stage(time_table({"adm": cleaned_lab}, names), "daily")
    keys = ["hadm_id", "icustay_id"]
    half_hours = bucketize(tt, rules.HALF_HOUR_S, rules.HALF_HOUR_AGGS, keys, ctx=ctx, keep=(LABEL,))
    days = bucketize(daily, rules.DAY_S, rules.DAY_AGGS, keys, ctx=ctx, keep=(LABEL,))
    items = stage(inventory(tables, ctx), "inventory") if INVENTORIED <= set(tables) else None
    inputs = stage(flagged_inputs(tables, ctx, items), "inputs") if items is not None else None
    return Stages(ctx, tt, daily, stage(half_hours, "timebucket"), stage(days, "daybucket"), items, inputs)


def split(stages: Stages, frac: float = 0.1, seed: int | str = 0, exact: bool = True) -> dict[str, tuple[DataFrame, DataFrame]]:
    """(train, test) of the context and the time tables; every admission is on one side only.

    By default the share holds within each outcome, by limits found on the context; else a hash of the admission decides alone.
    Either way the side follows from what a row carries, so the tables are filtered and not joined.
    """
    tables = {"context": stages.context, "timebucket": stages.timebucket, "daybucket": stages.daybucket, "timetable": stages.timetable}
    if exact:
        rule = fit_split(stages.context, "hadm_id", LABEL, frac, seed)
        return {name: rule.apply(df) for name, df in tables.items()}
    side = split_side("hadm_id", frac, seed)
    known = {name: df.filter(F.col("hadm_id").isNotNull()) for name, df in tables.items()}
    return {name: (df.filter(side == "train"), df.filter(side == "test")) for name, df in known.items()}


def assembled(ctx: DataFrame, timebucket: DataFrame, daybucket: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Model inputs of one side: context with stay and admission averages."""
    return assemble_features(
        ctx,
        timebucket,
        daybucket,
        [*rules.CHART_FEATURES, *rules.OUTPUT_FEATURES],
        list(rules.LAB_FEATURES),
        fills=rules.COMA_FILLS,
        drop=[] if keep_ids else rules.NOT_MODELLED,
    )


def saps2(df: DataFrame) -> DataFrame:
    """Add saps2 points and SAPS2_mortality to assembled rows."""
    return severity(
        df, rules.SAPS2_BANDS, rules.SAPS2_CHRONIC, rules.SAPS2_COEFFICIENTS, "saps2", "SAPS2_mortality"
    )


def model_inputs(parts: dict[str, tuple[DataFrame, DataFrame]], categories: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) numeric frames ready for fitting."""
    train, test = (
        assembled(parts["context"][i], parts["timebucket"][i], parts["daybucket"][i]) for i in (0, 1)
    )
    categories = categories or rules.CATEGORIES
    if "gender" not in categories:  # remapped to "0" / "1" by then
        train, test = (df.withColumn("gender", F.col("gender").try_cast("double")) for df in (train, test))
    return prepare_inputs(train, test, categories, outcomes=rules.OUTCOMES)
