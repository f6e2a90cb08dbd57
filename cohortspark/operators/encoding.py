"""Imputation by constants of the training data, dummies, ordinals, normalisation, labels."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cohortspark.functions.columns import columns_of_type
from cohortspark.functions.ordered import Slices, running_sum
from cohortspark.functions.quantiles import fit_medians
from cohortspark.functions.scalars import label_text
from cohortspark.functions.skew import AUTO, lookup_join
from cohortspark.operators.cohort import MAX_COLUMNS
from cohortspark.operators.relational import first_per


def median_impute(
    df: DataFrame,
    cols: list[str] | None = None,
    stats: dict[str, float | None] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Fill NULLs with exact medians: those given (fit them on the training side), or the frame's own."""
    cols = cols or columns_of_type(df, "numeric")
    if stats is None:
        stats = fit_medians(df, cols, rows)
    filled = {c: F.coalesce(F.col(c), F.lit(stats.get(c)).cast("double")) for c in cols}
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


@dataclass(frozen=True)
class DummySpec:
    """Categories learnt per column, in order; None stands for the NULL category."""

    values: dict[str, tuple]

    def columns(self) -> list[str]:
        return [dummy_name(c, v) for c, vs in self.values.items() for v in vs]


def dummy_name(col: str, value) -> str:
    return f"{col}_{'nan' if value is None else value}"


def fit_dummies(
    train: DataFrame, cols: list[str], null_column: bool = False, drop_last: bool = False, limit: int = MAX_COLUMNS
) -> DummySpec:
    """Learn the categories of all columns in one pass over the training frame."""
    cells = F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in cols])
    pairs = train.select(F.explode(cells).alias("x")).select("x.c", "x.v").distinct().limit(limit + 1).collect()
    if len(pairs) > limit:
        raise ValueError(f"more than {limit} categories cannot become columns")
    values = {}
    for c in cols:
        found = sorted(p["v"] for p in pairs if p["c"] == c and p["v"] is not None)
        found = found + [None] if null_column else found
        values[c] = tuple(found[:-1] if drop_last else found)
    return DummySpec(values)


def apply_dummies(df: DataFrame, spec: DummySpec) -> DataFrame:
    """Replace the columns by 0/1 columns of the learnt categories: the same names in the same order on every frame."""
    kept = [F.col(c) for c in df.columns if c not in spec.values]
    made = [
        F.when(F.col(c).cast("string").eqNullSafe(F.lit(v)), F.lit(1)).otherwise(F.lit(0)).alias(dummy_name(c, v))
        for c, vs in spec.values.items()
        for v in vs
    ]
    return df.select(*kept, *made)


def prepare_inputs(
    train: DataFrame, test: DataFrame, categories: list[str], own_medians: bool = False, rows: int | None = None,
    outcomes: list[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Median imputation and dummies for both sides with statistics of the training side. `outcomes` are never filled.

    `own_medians` fills the test side with its own medians instead. `rows` is a known upper bound of either side's size.
    """
    numbers = [c for c in columns_of_type(train, "numeric") if c not in (outcomes or [])]
    stats = fit_medians(train, numbers, rows)
    spec = fit_dummies(train, categories)
    test_stats = fit_medians(test, numbers, rows) if own_medians else stats
    return (
        apply_dummies(median_impute(train, numbers, stats), spec),
        apply_dummies(median_impute(test, numbers, test_stats), spec),
    )


def ordinal_codes(df: DataFrame, col: str, order: str, slices: Slices | str | None = AUTO) -> DataFrame:
    """(value, code): codes 0, 1, 2 … by first appearance in the order; NULL is a value too."""
    first = df.groupBy(col).agg(F.min(order).alias("_first"))
    ranked = running_sum(first, [], ["_first", col], {"_n": F.lit(1)}, slices)
    return ranked.select(col, (F.col("_n") - 1).cast("int").alias(f"{col}_code"))


def ordinal_encode(df: DataFrame, col: str, order: str, slices: Slices | str | None = AUTO) -> DataFrame:
    """Add the ordinal code of a category."""
    return lookup_join(df, ordinal_codes(df, col, order, slices), [col], nullsafe=True)


def l2_normalize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Scale the columns of each row to unit length; a row of zeros stays as it is."""
    norm = F.sqrt(sum((F.col(c).cast("double") * F.col(c) for c in cols), F.lit(0.0)))
    return df.select(
        *[
            F.when(norm == 0, F.col(c).cast("double")).otherwise(F.col(c) / norm).alias(c) if c in cols else F.col(c)
            for c in df.columns
        ]
    )


def l2_normalize_array(df: DataFrame, col: str) -> DataFrame:
    """The same for a vector held in one array column."""
    numbers = F.col(col).cast("array<double>")
    norm = F.sqrt(F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + x * x))
    scaled = F.transform(numbers, lambda x: x / F.col("_norm"))
    return (
        df.withColumn("_norm", norm)
        .withColumn(col, F.when(F.col("_norm") == 0, numbers).otherwise(scaled))
        .drop("_norm")
    )


# Table digit of a hierarchical item code -> (summary column prefix, suffix, label prefix)
LABEL_KINDS = {
    1: ("avrg", "", "Average Value: "),
    2: ("tot", "_in", "Total Input: "),
    3: ("tot", "_out", "Total Output: "),
}


def item_labels(item_map: DataFrame) -> DataFrame:
    """(old, label): display names for summary columns, from (nid_table, nid_class1, nid_class2, class2).

    A class name that repeats keeps its first entry.
    """
    unique = first_per(item_map, ["class2"], ["nid_table", "nid_class1", "nid_class2"])
    old = text = F.lit(None).cast("string")
    for digit, (prefix, suffix, words) in LABEL_KINDS.items():
        here = F.col("nid_table") == digit
        old = F.when(here, F.concat(label_text(F.lit(prefix), "nid_class1", "nid_class2"), F.lit(suffix))).otherwise(old)
        text = F.when(here, F.concat(F.lit(words), F.col("class2"))).otherwise(text)
    return unique.filter(F.col("nid_table").isin(*LABEL_KINDS)).select(old.alias("old"), text.alias("label"))
