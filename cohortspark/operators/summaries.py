"""Grouped summaries, rates, wide per-entity summaries and code counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from cohortspark.functions.scalars import rate
from cohortspark.functions.skew import HOT_ROWS
from cohortspark.operators.cohort import MAX_COLUMNS, distinct_values
from cohortspark.operators.timetable import spread
from cohortspark.session import settle


def summarize(df: DataFrame, keys: list[str], value: str, how: str = "mean", elapsed: str | None = None) -> DataFrame:
    """avg/min/max/count per key, or sum/min/max/count for how="total" (with the sum of an elapsed column if named)."""
    head = F.avg(value).alias("average") if how == "mean" else F.sum(value).alias("total")
    extra = [F.sum(elapsed).alias("time")] if elapsed else []
    return df.groupBy(*keys).agg(
        head, F.min(value).alias("minimum"), F.max(value).alias("maximum"), F.count(F.lit(1)).alias("cnt"), *extra
    )


def rate_per(df: DataFrame, num: str, den: str, name: str) -> DataFrame:
    """Add num / den, NULL when the denominator is 0 or unknown."""
    return df.withColumn(name, rate(num, den))


def mean_by(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Average of each column per key. On bucketed input this is a mean of bucket means."""
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


@dataclass(frozen=True)
class WideSpec:
    """One event table of a wide summary. kind "levels": avg/min/max and count rate; "totals": sum rate; "outputs": min/max and
    sum and count rates; "inputs": sum and count rates (the time an input ran is a "totals" spec of its own)."""

    df: DataFrame
    item: str
    value: str
    kind: str = "levels"
    suffix: str = ""
    items: tuple | None = None


# Column prefix -> aggregate, by kind.
STATISTICS = {
    "levels": {"avrg": "avg", "mini": "min", "maxi": "max", "cnt": "count"},
    "totals": {"tot": "sum"},
    "outputs": {"tot": "sum", "mini": "min", "maxi": "max", "cnt": "count"},
    "inputs": {"tot": "sum", "cnt": "count"},
}


def wide_summary(ctx: DataFrame, specs: list[WideSpec], key: str = "icustay_id", span: str | None = "los_total") -> DataFrame:
    """Context plus one column per item and statistic: specs of one event table share a single pivot and join.

    Counts and totals are divided by the span of the stay (NULL for a zero or unknown span); without a span they stay plain.
    """
    found: dict[tuple, list] = {}
    grouped: dict[tuple, tuple[WideSpec, dict]] = {}
    rates = set()
    for s in specs:
        source = (id(s.df), s.item)
        if s.items is None and source not in found:
            found[source] = distinct_values(s.df, s.item)
        items = tuple(found[source] if s.items is None else s.items)
        tail = f"_{s.suffix}" if s.suffix else ""
        stats = STATISTICS[s.kind]
        _, cells = grouped.setdefault((*source, items), (s, {}))
        cells.update({f"{label}_{{value}}{tail}": (how, s.value) for label, how in stats.items()})
        rates |= {f"{label}_{i}{tail}" for label in stats if label in ("cnt", "tot") for i in items}
    out = ctx
    for (_, _, items), (s, cells) in grouped.items():
        out = out.join(spread(s.df, [key], s.item, list(items), cells), key, "left")
    if span is None:
        return out
    return out.select(*[rate(c, span).alias(c) if c in rates else F.col(c) for c in out.columns])


def code_counts(
    df: DataFrame, key: str, code: str, prefix: str, codes: list[str] | None = None, ctx: DataFrame | None = None, fill: bool = True, limit: int = MAX_COLUMNS
) -> DataFrame:
    """One count column per code and key; 0 where a key lacks the code. With a context, left-joined to it.

    More than `limit` codes are refused: `code_vectors` has no limit.
    """
    rows = df.select(key, code).filter(F.col(code).isNotNull())
    codes = codes if codes is not None else distinct_values(rows, code, limit)
    one = rows.withColumn("_one", F.lit(1).cast("bigint"))
    wide = spread(one, [key], code, codes, {prefix + "_{value}": ("sum", "_one")})
    names = [c for c in wide.columns if c != key]
    wide = wide.fillna(0, subset=names)
    if ctx is None:
        return wide
    joined = ctx.join(wide, key, "left")
    return joined.fillna(0, subset=names) if fill else joined


def dense_ids(df: DataFrame, col: str, rows: int = HOT_ROWS) -> DataFrame:
    """(value, id): the distinct known values of a column numbered 0, 1, 2 … in their order, at any number of them.

    Values are range-partitioned and written with the number of their partition, about `rows` a partition. An id is the place
    within the partition plus the sizes of those before it; only the sizes, one row a partition, are summed in order.
    """
    name = f"{col}_id"
    values = settle(df.filter(F.col(col).isNotNull()).select(col).distinct(), "distinct-values")
    parts = max(1, -(-values.count() // rows))
    ranged = settle(values.repartitionByRange(parts, col).withColumn("_part", F.spark_partition_id()), "ranged-values")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part").alias("_at"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(col)) - 1
    numbered = ranged.withColumn("_place", place).join(F.broadcast(offsets), F.col("_part") == F.col("_at"))  # a row a partition
    return numbered.select(col, (F.col("_offset") + F.col("_place")).cast("bigint").alias(name))


def code_vectors(df: DataFrame, key: str, code: str, ids: DataFrame) -> DataFrame:
    """Sparse counts for vocabularies of any width: key, ids (ascending array), counts (array).

    `ids` is (code, id) as `dense_ids` numbers it; codes that it lacks, such as those only seen in a test set, do not count.
    Codes are counted per key on the map side first, so only different codes of a key gather.
    """
    known = ids.toDF("_code", "_id")
    counts = df.filter(F.col(code).isNotNull()).groupBy(key, code).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    cells = counts.join(known, F.col(code) == F.col("_code")).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_id", "_n"))).alias("_c"))
    return cells.select(key, F.col("_c._id").alias("ids"), F.col("_c._n").alias("counts"))


def code_count_map(df: DataFrame, key: str, code: str) -> DataFrame:
    """Sparse form for vocabularies too wide for columns: key -> map(code, count), counted before it is gathered."""
    counts = df.filter(F.col(code).isNotNull()).groupBy(key, code).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(code, "n")))).alias("counts"))


def count_distinct(df: DataFrame, col: str) -> DataFrame:
    """Number of distinct non-null ids: duplicates are removed on the map side first."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct().agg(F.count(F.lit(1)).alias("n"))
