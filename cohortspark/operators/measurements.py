"""Cleaning long measurement tables: inventory, units, outliers, rules, alignment in time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cohortspark.functions.predicates import any_of
from cohortspark.functions.scalars import is_missing
from cohortspark.functions.skew import AUTO, lookup_join, resolve_hot, spread_join
from cohortspark.functions.time import elapsed_hours
from cohortspark.operators.relational import append, delete_where, enrich, first_per, flag_where, restrict_to


# --- inventory ------------------------------------------------------------------------------------------------------
@dataclass(frozen=True)
class Source:
    """An event table of the inventory: its item column(s) and an optional item range."""

    name: str
    df: DataFrame
    item: str | Column
    where: Column | None = None


def item_inventory(sources: list[Source], cohort: DataFrame | None = None, key: str = "hadm_id") -> DataFrame:
    """Distinct (source, itemid) among the cohort. Sources with the same name are united; item ids are text.

    Sources on one table are cells of one scan of it, made behind one semi-join a table. What is kept once is (source, item): a
    task holds the items of its rows, not every item of every admission. The semi-join's left side comes straight from its
    shuffle, so adaptive execution deals the rows of a long admission to several tasks.
    """
    tables: list[tuple[DataFrame, list[Source]]] = []
    for s in sources:
        own = next((found for df, found in tables if df is s.df or df.sameSemantics(s.df)), None)
        if own is None:
            tables.append((s.df, own := []))
        own.append(s)
    parts = []
    for df, own in tables:
        cells = []
        for s in own:
            item = (F.col(s.item) if isinstance(s.item, str) else s.item).cast("string").alias("itemid")
            cell = F.struct(F.lit(s.name).alias("source"), item)
            cells.append(cell if s.where is None else F.when(s.where, cell))
        # The cells, mostly text, are made behind the join: its sort holds the plain columns they come from.
        rows = df if any(s.where is None for s in own) else df.filter(any_of([s.where for s in own]))
        rows = rows if cohort is None else restrict_to(rows, cohort, key)
        parts.append(rows.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).select("x.source", "x.itemid"))
    return append(*parts).distinct()


# --- units ----------------------------------------------------------------------------------------------------------
def dominant_unit(inputs: list[DataFrame], item: str = "itemid", unit: str = "amountuom") -> DataFrame:
    """The most frequent unit of each item recorded in more than one unit (a tie goes to the first unit by name)."""
    units = append(*[df.select(item, unit) for df in inputs])
    counts = units.filter((F.col(unit) != "") & F.col(unit).isNotNull()).groupBy(item, unit).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.groupBy(item)
        .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(unit).alias("u"))).alias("best"), F.count(F.lit(1)).alias("units"))
        .filter(F.col("units") > 1)
        .select(item, F.col("best.u").alias(unit))
    )


def flag_unit_mismatch(
    df: DataFrame, units: DataFrame, item: str = "itemid", unit: str = "amountuom", name: str = "todelete"
) -> DataFrame:
    """Set the flag to 1 on rows whose unit differs from the item's dominant one; a NULL unit is never flagged."""
    joined = lookup_join(df, units.select(F.col(item), F.col(unit).alias("_unit")), [item])
    return flag_where(joined, F.col(unit) != F.col("_unit"), name).drop("_unit")


# --- filtering and cleaning -----------------------------------------------------------------------------------------
def filter_events(
    events: DataFrame,
    ctx: DataFrame,
    items: DataFrame,
    key: str = "hadm_id",
    item: str = "itemid",
    value: str | None = None,
    distinct: bool = True,
    hot: DataFrame | str | None = AUTO,
    hot_items: DataFrame | str | None = None,
) -> DataFrame:
    """Distinct event rows of the cohort's admissions and the wanted items, with `valuenum` copied from `value` if named.

    `hot` admissions are measured on the events unless given. `hot_items` are items of the events to spread (or "auto"), for item
    lists too long to be broadcast.
    """
    wanted = restrict_to(events, items, item, resolve_hot(hot_items, events, [item]))
    kept = restrict_to(wanted, ctx, key, resolve_hot(hot, events, [key]))
    if distinct:
        kept = kept.dropDuplicates()
    return kept if value is None else kept.withColumn("valuenum", F.col(value).cast("double"))


def sigma_bounds(df: DataFrame, value: str, k: float = 3.0) -> Column:
    """mean ± k sample deviations of a column as a scalar struct(lo, hi)."""
    spread = F.stddev_samp(value) * F.lit(float(k))
    return df.agg(F.struct((F.avg(value) - spread).alias("lo"), (F.avg(value) + spread).alias("hi")).alias("b")).scalar()


def drop_sigma_outliers(
    df: DataFrame, items: list, k: float = 3.0, item: str = "itemid", value: str = "valuenum"
) -> DataFrame:
    """Delete values of the item group outside the group's pooled mean ± k·sd; NULL values and other items stay."""
    group = F.col(item).isin(*items)
    bounds = sigma_bounds(df.filter(group), value, k)
    return delete_where(df, group & ~F.col(value).between(bounds["lo"], bounds["hi"]))


@dataclass(frozen=True)
class DropRule:
    """Delete rows of the items (None: all items) whose value equals, exceeds or falls below the bound."""

    items: tuple | None
    op: str  # "eq", "gt" or "lt"
    bound: float

    def condition(self, item: str, value: str) -> Column:
        v, b = F.col(value), F.lit(float(self.bound))
        test = {"eq": v == b, "gt": v > b, "lt": v < b}[self.op]
        return test if self.items is None else test & F.col(item).isin(*self.items)


def apply_rules(df: DataFrame, rules: list[DropRule], item: str = "itemid", value: str = "valuenum") -> DataFrame:
    """Apply all deletion rules in one pass."""
    return delete_where(df, any_of(r.condition(item, value) for r in rules))


@dataclass(frozen=True)
class UnitFix:
    """value -> (value + shift) * scale for the items, optionally only above a threshold."""

    items: tuple
    scale: float
    shift: float = 0.0
    above: float | None = None


def apply_unit_fixes(df: DataFrame, fixes: list[UnitFix], item: str = "itemid", value: str = "valuenum") -> DataFrame:
    """Apply all unit conversions in one pass; the first fix that fits a row is the one applied."""
    fixed = F.col(value)
    for f in reversed(fixes):
        test = F.col(item).isin(*f.items)
        if f.above is not None:
            test = test & (F.col(value) > F.lit(float(f.above)))
        fixed = F.when(test, (F.col(value) + F.lit(float(f.shift))) * F.lit(float(f.scale))).otherwise(fixed)
    return df.withColumn(value, fixed)


# --- alignment ------------------------------------------------------------------------------------------------------
def align_events(
    df: DataFrame,
    ctx: DataFrame,
    features: DataFrame | None = None,
    key: str = "hadm_id",
    item: str = "itemid",
    time: str = "charttime",
    start: str = "admittime",
    end: str = "dischtime",
    feature: str = "feature",
    unique: bool = False,
    keep_bounds: bool = False,
    hot: DataFrame | str | None = AUTO,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Add the feature name, t_since (hours since start) and t_til (hours until end).

    Rows without a match keep NULLs. `unique` says the context already has one row per key; `keep_bounds` keeps the two
    times and `carry` brings further columns of the context, which saves later steps the join. `hot` keys are measured on `df` unless given.
    """
    hot = resolve_hot(hot, df, [key])
    if features is not None:
        df = enrich(df, features, [item], [feature])
    joined = enrich(df, ctx, [key], [start, end, *carry], unique, hot)
    bounds = [*([start, end] if keep_bounds else []), *carry]
    return joined.select(*df.columns, *bounds, elapsed_hours(start, time).alias("t_since"), elapsed_hours(time, end).alias("t_til"))


# --- range report ---------------------------------------------------------------------------------------------------
LIMITS = ("outlier_low", "valid_low", "valid_high", "outlier_high")


def range_report(
    events: DataFrame,
    ranges: DataFrame,
    item: str = "itemid",
    group: str = "nitemid",
    value: str = "valuenum",
    by: list[str] | None = None,
    hot: DataFrame | str | None = None,
) -> DataFrame:
    """Per item group: count, min, max, average and the shares outside its outlier and valid limits.

    The limits are those of the group's lowest item id. A limit that is absent has share 0, and a group without events has
    zeros throughout. `by` adds further grouping columns (then only groups with events appear). `hot` are items of the events to spread
    (or "auto"), for range tables too long to be broadcast.
    """
    limits = first_per(ranges, [group], [item]).select(group, *LIMITS)
    limits = limits.select(group, *[F.when(~is_missing(c), F.col(c)).cast("double").alias(c) for c in LIMITS])
    # Groups and limits are brought to the items first: the events are joined once.
    known = ranges.select(item, group).distinct().join(limits, group)
    tagged = spread_join(events, known, [item], "inner", resolve_hot(hot, events, [item]))
    # Limits belong to the group, so they can be grouping columns: one aggregation, no second join of the events.
    keys = [group, *(by or [])]
    v = F.col(value)
    outside = {
        "out_low_per": v < F.col("outlier_low"),
        "val_low_per": v < F.col("valid_low"),
        "out_high_per": v > F.col("outlier_high"),
        "val_high_per": v > F.col("valid_high"),
    }
    stats = (
        tagged.groupBy(*keys)
        .agg(
            F.min(v).alias("min"),
            F.max(v).alias("max"),
            F.avg(v).alias("avg"),
            F.count(F.lit(1)).alias("cnt"),
            *[(F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0))) / F.count(F.lit(1))).alias(n) for n, c in outside.items()],
        )
    )
    if by:
        return stats
    return limits.select(group).join(stats, group, "left").fillna(0, subset=["min", "max", "avg", "cnt", *outside])
