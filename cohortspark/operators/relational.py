"""Row filters, conditional updates, lookups, null-safe merges and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortspark.functions.columns import columns_of_type, common_columns
from cohortspark.functions.predicates import holds
from cohortspark.functions.scalars import null_if_nan
from cohortspark.functions.skew import spread_join


# --- rows -----------------------------------------------------------------------------------------------------------
def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows for which the condition is true; rows where it is unknown stay."""
    return df.filter(~holds(condition))


def update_where(df: DataFrame, condition: Column, name: str, value: Column) -> DataFrame:
    """Set a column where the condition is true and leave it elsewhere."""
    return df.withColumn(name, F.when(condition, value).otherwise(F.col(name)))


def flag_where(df: DataFrame, condition: Column, name: str, value: int = 1) -> DataFrame:
    """Add a flag that is NULL unless the condition is true."""
    return df.withColumn(name, F.when(condition, F.lit(value)))


def fill_constant(df: DataFrame, values: dict[str, float | str]) -> DataFrame:
    return df.fillna(values)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing floating-point numbers as NULL, once, at ingest."""
    floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    return df.select(*[null_if_nan(c).alias(c) if c in floats else F.col(c) for c in df.columns])


def mask_outliers(df: DataFrame, cols: list[str], k: float = 2.0) -> DataFrame:
    """Blank the cells further than k sample deviations from their column's mean; every row is kept."""
    limits = df.agg(
        F.struct(
            *[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(f"c{i}") for i, c in enumerate(cols)]
        ).alias("s")
    ).scalar()
    inside = {
        c: F.abs(F.col(c) - limits[f"c{i}"]["m"]) <= F.lit(float(k)) * limits[f"c{i}"]["s"] for i, c in enumerate(cols)
    }
    return df.select(*[F.when(inside[c], F.col(c)).alias(c) if c in inside else F.col(c) for c in df.columns])


def first_per(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key (NULL is a key too): the first in the given order.

    The order should be total. Spark limits each group to one row before the shuffle, so a hot key stays cheap.
    """
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).asc_nulls_last() if isinstance(o, str) else o for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


# --- joins ----------------------------------------------------------------------------------------------------------
def restrict_to(df: DataFrame, ids: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Keep the rows whose key appears among the ids. `hot` are keys of `df` to spread, see `hot_keys`."""
    return spread_join(df, ids.select(key), [key], "left_semi", hot)


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: list[str],
    cols: list[str],
    unique: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Left-join columns of a dimension; a key that repeats there contributes one row (`unique`: it is known not to).

    `hot` are keys of `df` that own too many rows for one task, see `hot_keys`.
    """
    dim = dim.select(*key, *cols)
    if not unique:
        dim = first_per(dim, key, list(cols))
    return spread_join(df, dim, key, "left", hot)


def remap(
    df: DataFrame, col: str, mapping: DataFrame, source: str = "category", target: str = "remap0", default: str | None = None
) -> DataFrame:
    """Replace a category by the dictionary's value. Unmatched values stay, or become `default` when one is given."""
    rule = first_per(mapping.select(F.col(source).alias("_from"), F.col(target).alias("_to")), ["_from"], ["_to"])
    joined = df.join(rule, F.col(col) == F.col("_from"), "left")
    other = F.col(col).cast("string") if default is None else F.lit(default)
    value = F.when(F.col("_from").isNotNull(), F.col("_to")).when(F.col(col).isNotNull(), other)
    return joined.select(*[value.alias(c) if c == col else F.col(c) for c in df.columns])


def merge_nullsafe(
    a: DataFrame, b: DataFrame, key: str, how: str = "inner", hot: DataFrame | None = None
) -> DataFrame:
    """Join in which an unknown key equals an unknown key. `hot` are keys of `a` to spread, the unknown one included."""
    return spread_join(a, b, [key], how, hot, nullsafe=True)


def merge_common(a: DataFrame, b: DataFrame, how: str = "left", hot: DataFrame | None = None) -> DataFrame:
    """Join on every column the two frames share: those columns first, then the others of each. `hot` are keys of `a` to
    spread, see `hot_keys`."""
    shared = common_columns(a, b)
    joined = spread_join(a, b, shared, how, hot)
    return joined.select(*shared, *[c for c in joined.columns if c not in shared])


# --- sets -----------------------------------------------------------------------------------------------------------
def distinct_keys(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def intersect_ids(*frames: DataFrame) -> DataFrame:
    """Ids present in every frame."""
    return reduce(lambda a, b: a.intersect(b), frames)


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def drop_datetimes(df: DataFrame) -> DataFrame:
    return df.drop(*columns_of_type(df, "datetime"))
