"""Running values in an order, safe when one key owns a large share of all rows.

A window partitioned by a key puts the whole key into one task. Keys that are too big for that are cut into slices along
the order column: the window runs inside (key, slice) and what crosses a slice border travels in a summary of one row per
(key, slice). Slice borders are quantiles of the order column over the rows of the hot keys, as many as those rows hold row
targets (at most `MAX_SLICES`), so a slice holds about one target whatever the distribution inside a key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from cohortspark.functions.skew import AUTO, HOT_ROWS, hot_keys, PARTS, mark_hot, matching, spread_join
from cohortspark.functions.time import micros

SLICE, HOT = "_slice", "_hot"
MAX_SLICES = 10_000


@dataclass(frozen=True)
class Slices:
    """How to cut the hot keys: their table (None: there are no keys, all rows form one group) and the borders."""

    keys: tuple[str, ...]
    order: str
    hot: DataFrame | None
    borders: tuple[float, ...]


def order_number(df: DataFrame, order: str) -> Column:
    kind = df.schema[order].dataType
    if isinstance(kind, TimestampNTZType):
        return micros(order).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(order).cast("double")
    if isinstance(kind, NumericType):
        return F.col(order).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(order).cast("double")
    if isinstance(kind, StringType):  # the first six bytes: equal ones share a slice, others keep their order
        return F.conv(F.rpad(F.hex(F.substring(F.encode(order, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise TypeError(f"cannot slice along {order}: {kind.simpleString()} has no numeric order")


def plan_slices(
    df: DataFrame,
    keys: list[str],
    order: str,
    hot_rows: int = HOT_ROWS,
    hot_share: float = 0.0,
    hot: DataFrame | str | None = AUTO,
    rows: int | None = None,
) -> Slices | None:
    """The cuts the hot keys of a frame need; None when every group fits into one task.

    Runs one counting job on `keys` (none if the `hot` keys are given) and a quantile job if there are hot keys, so pass
    the frame the rows come from rather than an expensive derivation of it. `rows` is a known upper bound of its size.
    """
    if keys:
        hot = hot_keys(df, keys, hot_rows, hot_share, rows) if isinstance(hot, str) else hot
        if hot is None:
            return None
        body = df.join(F.broadcast(hot), matching(df, hot, [(k, k) for k in keys]), "left_semi")
        pieces = hot.agg(F.sum(PARTS)).first()[0] if PARTS in hot.columns else MAX_SLICES // 100
    else:
        total = df.count() if rows is None or rows > hot_rows else rows
        if total <= hot_rows:
            return None
        hot, body = None, df
        pieces = -(-total // max(hot_rows, 1))
    pieces = max(2, min(int(pieces), MAX_SLICES))
    numbers = body.select(order_number(df, order).alias("v"))
    borders = numbers.approxQuantile("v", [i / pieces for i in range(1, pieces)], 1 / (4 * pieces))
    return Slices(tuple(keys), order, hot, tuple(sorted(set(borders))))


def _resolve(slices: Slices | str | None, df: DataFrame, keys: list[str], order: str) -> Slices | None:
    return plan_slices(df, keys, order) if slices == AUTO else slices


def _same(left: DataFrame, right: DataFrame, keys) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(right[k])
    return condition


def add_slice(df: DataFrame, slices: Slices) -> DataFrame:
    """Add `_hot` and `_slice` (0 for the rows of keys that are not hot; a NULL order goes to the last slice)."""
    if slices.hot is None:
        marked = df.withColumn(HOT, F.lit(True))
    else:
        keys = list(slices.keys)
        own = slices.hot.select(*keys, F.lit(2).alias(PARTS))
        marked = mark_hot(df, keys, own, HOT).withColumn(HOT, F.col(HOT) > 1)
    splits = [float("-inf"), *slices.borders, float("inf")]
    cut = Bucketizer(splits=splits, inputCol="_order", outputCol="_cut", handleInvalid="keep")
    cut = cut.transform(marked.withColumn("_order", order_number(df, slices.order)))
    number = F.coalesce(F.col("_cut").cast("int"), F.lit(len(splits)))
    return cut.withColumn(SLICE, F.when(F.col(HOT), number).otherwise(F.lit(0))).drop("_order", "_cut")


def nulls_last(order: list[str]) -> list[Column]:
    return [F.col(o).asc_nulls_last() for o in order]


def order_key(order: list[str]) -> Column:
    """The order columns as one comparable value, NULL last."""
    return F.struct(*[p for o in order for p in (F.col(o).isNull().alias(f"n_{o}"), F.col(o).alias(o))])


def _per_key(keys) -> list:
    return list(keys) or [F.lit(0)]


def _attach(rows: DataFrame, summary: DataFrame, keys, names: list[str]) -> DataFrame:
    """Bring summary columns to the rows of the hot slices. No hint: a slice of a key is one row target at most."""
    right = summary.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.col(SLICE).alias("_s_slice"), *[F.col(n) for n in names]
    )
    match = rows[HOT] & matching(rows, right, [(k, f"_s_{k}") for k in keys]) & (rows[SLICE] == right["_s_slice"])
    return rows.join(right, match, "left").drop("_s_slice", *[f"_s_{k}" for k in keys])


def carry_forward(
    df: DataFrame, keys: list[str], order: list[str], cols: list[str], slices: Slices | str | None = AUTO
) -> DataFrame:
    """Replace each NULL in `cols` by the last known value of its key in the given order."""
    slices = _resolve(slices, df, keys, order[0])
    keep = [c for c in df.columns if c not in cols]
    if slices is None:
        w = Window.partitionBy(*_per_key(keys)).orderBy(*nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
        filled = {c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols}
        return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
    rows = add_slice(df, slices)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
    latest = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(order_key(order).alias("o"), F.col(c).alias("v"))))["v"].alias(f"_l_{c}")
        for c in cols
    ]
    before = Window.partitionBy(*_per_key(keys)).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    summary = rows.filter(HOT).groupBy(*keys, SLICE).agg(*latest)
    summary = summary.select(
        *keys, SLICE, *[F.last(f"_l_{c}", ignorenulls=True).over(before).alias(f"_c_{c}") for c in cols]
    )
    filled = rows.select(
        *keep, HOT, SLICE, *[F.last(F.col(c), ignorenulls=True).over(inside).alias(c) for c in cols]
    )
    joined = _attach(filled, summary, keys, [f"_c_{c}" for c in cols])
    return joined.select(*[F.coalesce(c, f"_c_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def with_next(
    df: DataFrame, keys: list[str], order: list[str], cols: list[str], slices: Slices | str | None = AUTO, prefix: str = "next_"
) -> DataFrame:
    """Add for each of `cols` its value in the following row of the key."""
    slices = _resolve(slices, df, keys, order[0])
    following = F.struct(*[F.col(c).alias(c) for c in cols])
    if slices is None:
        w = Window.partitionBy(*_per_key(keys)).orderBy(*nulls_last(order))
        return df.select("*", *[F.lead(c).over(w).alias(prefix + c) for c in cols])
    rows = add_slice(df, slices)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*nulls_last(order))
    start = F.min(F.struct(order_key(order).alias("o"), following.alias("v")))["v"]
    summary = rows.filter(HOT).groupBy(*keys, SLICE).agg(start.alias("_start"))
    across = Window.partitionBy(*_per_key(keys)).orderBy(SLICE)
    summary = summary.select(*keys, SLICE, F.lead("_start").over(across).alias("_after"))
    rows = rows.select("*", F.lead(following).over(inside).alias("_next"))
    joined = _attach(rows, summary, keys, ["_after"])
    after = F.coalesce("_next", "_after")
    return joined.select(*df.columns, *[after[c].alias(prefix + c) for c in cols])


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], slices: Slices | str | None = AUTO
) -> DataFrame:
    """Add running totals (name -> summed expression) along the order of each key, the current row included."""
    slices = _resolve(slices, df, keys, order[0])
    if slices is None:
        w = Window.partitionBy(*_per_key(keys)).orderBy(*nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(e).over(w).alias(n) for n, e in sums.items()])
    rows = add_slice(df, slices)
    inside = Window.partitionBy(*keys, SLICE).orderBy(*nulls_last(order)).rowsBetween(Window.unboundedPreceding, 0)
    summary = rows.filter(HOT).groupBy(*keys, SLICE).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])
    before = Window.partitionBy(*_per_key(keys)).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.select(*keys, SLICE, *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in sums])
    rows = rows.select("*", *[F.sum(e).over(inside).alias(n) for n, e in sums.items()])
    joined = _attach(rows, summary, keys, [f"_b_{n}" for n in sums])
    return joined.select(
        *df.columns, *[(F.col(n) + F.coalesce(F.col(f"_b_{n}"), F.lit(0))).alias(n) for n in sums]
    )


def dense_rank_by(
    df: DataFrame, keys: list[str], order: str, name: str, slices: Slices | str | None = AUTO
) -> DataFrame:
    """Add the dense rank of `order` inside its key, NULL ranked last."""
    slices = _resolve(slices, df, keys, order)
    if slices is None:
        w = Window.partitionBy(*keys).orderBy(*nulls_last([order]))
        return df.select("*", F.dense_rank().over(w).alias(name))
    values = df.select(*keys, order).distinct()  # map-side combined: a repeated value reaches the window once
    ranks = running_sum(values, keys, [order], {name: F.lit(1)}, slices)
    ranks = ranks.withColumn(name, F.col(name).cast("int"))
    # Joined on (key, value): only copies of one value share a task, and those are spread as well.
    return spread_join(df, ranks, [*keys, order], "left", hot_keys(df, [*keys, order]), nullsafe=True)
