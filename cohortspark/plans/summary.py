"""The second pipeline: one very wide row per stay, from context, codes and item-class events.

Durations, then a count column per diagnosis and procedure code, dummies of the categories, and for each item class its
statistics over the stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortspark.functions.columns import columns_of_type, drop_columns
from cohortspark.functions.scalars import label_text
from cohortspark.operators.cohort import MAX_COLUMNS, duration_features
from cohortspark.operators.encoding import apply_dummies, fit_dummies
from cohortspark.operators.summaries import WideSpec, code_counts, code_vectors, dense_ids, wide_summary

ITEM = "item_class"


def with_class(events: DataFrame) -> DataFrame:
    """Name an event's item class after its two class ids; events without either have no class."""
    both = F.col("cid1").isNotNull() & F.col("cid2").isNotNull()
    return events.withColumn(ITEM, F.when(both, label_text("cid1", "cid2")))


def coded_context(
    ctx: DataFrame, diagnoses: DataFrame, procedures: DataFrame, admission: str = "hadm_id", code: str = "icd9_code", limit: int = MAX_COLUMNS
) -> DataFrame:
    """Context with durations instead of times, code counts and dummies (a column for unknown values too).

    An admission without any diagnosis keeps unknown counts, one without procedures has none of each.
    """
    out = drop_columns(duration_features(ctx), columns_of_type(ctx, "datetime"))
    out = code_counts(diagnoses, admission, code, "d_icd", ctx=out, fill=False, limit=limit)
    out = code_counts(procedures, admission, code, "p_icd", ctx=out, limit=limit).drop("diagnosis")
    texts = columns_of_type(out, "string")
    return apply_dummies(out, fit_dummies(out, texts, null_column=True, limit=limit)) if texts else out


def stay_summary(
    ctx: DataFrame, tables: dict[str, DataFrame], stay: str = "icustay_id", admission: str = "hadm_id", span: str = "los_total", limit: int = MAX_COLUMNS
) -> DataFrame:
    """The wide row of every stay of the context.

    `tables`: diagnoses_icd and procedures_icd (admission, icd9_code); chartevents (valuenum), outputevents (value) and
    inputevents_mv (amount), each with stay, cid1 and cid2. Chart classes give average, least, greatest and counts a day of the stay,
    outputs and inputs totals a day. A stay's time table is one pivot and one join a table, however many classes there are.
    """
    out = coded_context(ctx, tables["diagnoses_icd"], tables["procedures_icd"], admission, limit=limit)
    chart, outputs, inputs = (with_class(tables[t]) for t in ("chartevents", "outputevents", "inputevents_mv"))
    specs = [
        WideSpec(chart, ITEM, "valuenum"),
        WideSpec(outputs, ITEM, "value", kind="totals", suffix="out"),
        WideSpec(inputs, ITEM, "amount", kind="totals", suffix="in"),
    ]
    return wide_summary(out, specs, stay, span)


def sparse_codes(diagnoses: DataFrame, admission: str = "hadm_id", code: str = "icd9_code") -> tuple[DataFrame, DataFrame]:
    """The codes of admissions where they are too many for columns: (code, id) and (admission, ids, counts), ready for `fit_sparse`."""
    ids = dense_ids(diagnoses, code)
    return ids, code_vectors(diagnoses, admission, code, ids)
