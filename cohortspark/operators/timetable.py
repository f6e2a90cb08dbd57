"""Wide time tables, fixed buckets, imputation along time, start/stop pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortspark.functions.ordered import Slices, carry_forward, with_next
from cohortspark.functions.quantiles import fit_medians
from cohortspark.functions.skew import AUTO, HOT_ROWS
from cohortspark.functions.time import bucket_index, bucket_start, elapsed_hours, elapsed_seconds
from cohortspark.operators.relational import delete_where, enrich
from cohortspark.session import settle

WIDE_LIMIT = 256  # up to here conditional aggregates (one shuffle); beyond it lists of cells


AGGREGATES = {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}


def spread(df: DataFrame, keys: list[str], on: str, values: list, specs: dict[str, tuple[str, str]]) -> DataFrame:
    """Pivot with explicit values. specs: column name containing "{value}" -> (aggregate, value column).

    One row for each key that has a listed value, whatever the width; where a key lacks a value its count is 0 and its sum,
    average, minimum and maximum are NULL.
    """
    titles = [t.format(value=v) for v in values for t in specs]
    listed = df.filter(F.col(on).isin(*values) if values else F.lit(False))
    if len(titles) <= WIDE_LIMIT:
        cells = [AGGREGATES[how](F.when(F.col(on) == v, F.col(c))) for v in values for how, c in specs.values()]
        named = [cell.alias(t) for cell, t in zip(cells, titles)]
        return listed.groupBy(*keys).agg(*named) if named else listed.select(*keys).distinct()
    # The cells that a key has travel as a short list; the wide row is made behind the last shuffle and held for no longer than
    # one row. The built-in pivot keeps a buffer of the full width for each key of a task instead.
    parts = [f"a{i}" for i in range(len(specs))]
    cells = listed.groupBy(*keys, F.col(on).alias("_on")).agg(*[AGGREGATES[how](c).alias(a) for a, (how, c) in zip(parts, specs.values())])
    held = cells.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_on", F.struct(*parts)))).alias("_cells"))
    own = lambda v: F.element_at("_cells", F.lit(v).cast(df.schema[on].dataType))
    found = [(own(v)[a], how) for v in values for a, (how, _) in zip(parts, specs.values())]
    return held.select(*keys, *[(F.coalesce(x, F.lit(0).cast("long")) if how == "count" else x).alias(t) for t, (x, how) in zip(titles, found)])


def pivot_features(
    events: DataFrame,
    features: list[str],
    entity: str = "hadm_id",
    time: str = "charttime",
    stay: str | None = "icustay_id",
    carried: tuple[str, ...] = ("t_since", "t_til"),
    feature: str = "feature",
    value: str = "valuenum",
    tie: list[str] | None = None,
    within: tuple[str, list[str]] | None = None,
    drop_negative: bool = True,
) -> DataFrame:
    """Time table: one row per entity, time and stay, one nullable column per feature.

    Of several values of a feature at one time of an entity only the first by `tie` counts (by default the lowest stay,
    then the lowest value), whatever its stay. `within` = (column, values) decides that inside each source and adds the
    sources up. `carried` columns follow from entity and time.

    With a single `tie` and no stay, de-duplication and pivot are one aggregation keyed by entity and time: a single shuffle,
    combined on the map side, so neither copies of a row nor a long entity gather in a task. Otherwise the least of several order
    columns is found from the last to the first, an aggregation a column over the groups of the one before; each keeps plain
    numbers only, so all of them are hash aggregates, and after the first they see one row a time and stay.
    """
    order = tie or [*([stay] if stay else []), value]
    parts = [(None, F.lit(True))] if within is None else [(w, F.col(within[0]) == w) for w in within[1]]
    wanted = events.filter(F.col(feature).isin(*features))
    if drop_negative:  # the two times follow from entity and time, so whole groups go
        wanted = delete_where(wanted, (F.col("t_til") < 0) | (F.col("t_since") < 0))
    cells = {f"{i}_{j}": (F.col(feature) == f) & part for i, f in enumerate(features) for j, (_, part) in enumerate(parts)}
    if stay is None and len(order) == 1 and order[0] != value:
        picks = [F.min_by(F.when(here, F.col(value)), F.when(here, F.col(order[0]))).alias(f"_v{c}") for c, here in cells.items()]
        table = wanted.groupBy(entity, time).agg(*[F.min(c).alias(c) for c in carried], *picks)
    else:
        table = _least(wanted, [entity, time], carried, list(dict.fromkeys([*order, *([stay] if stay else []), value])), stay, value, cells)
    found = {f: [f"{i}_{j}" for j in range(len(parts))] for i, f in enumerate(features)}
    if stay is None:
        return table.select(entity, time, *carried, *[_total([F.col(f"_v{c}") for c in cs]).alias(f) for f, cs in found.items()])
    # The picked values of one time may belong to several stays: one row for each of those, without a shuffle.
    held = [F.when(F.col(f"_p{c}").isNotNull(), F.struct(F.col(f"_s{c}").alias("s"))) for c in cells]
    table = table.withColumn("_stay", F.explode(F.array_distinct(F.array_compact(F.array(*held)))))
    own = {f: [F.when(F.col(f"_p{c}").isNotNull() & F.col(f"_s{c}").eqNullSafe(F.col("_stay.s")), F.col(f"_v{c}")) for c in cs] for f, cs in found.items()}
    return table.select(entity, F.col("_stay.s").alias(stay), time, *carried, *[_total(vs).alias(f) for f, vs in own.items()])


def _least(
    rows: DataFrame, keys: list[str], carried: tuple[str, ...], order: list[str], stay: str | None, value: str, cells: dict[str, Column]
) -> DataFrame:
    """Per key and cell the value `_v` and stay `_s` of the row that is least by `order` (NULL last), and `_p`, NULL where a cell has
    no row. `order` names value and stay, so nothing is left to chance."""
    kept = {value: "_v", **({stay: "_s"} if stay else {})}
    steps = [F.min(c).alias(c) for c in carried]
    last = order[-1]
    for c, here in cells.items():
        steps.append(F.max(F.when(here, F.lit(1))).alias(f"_p{c}"))
        if last in kept:
            steps.append(F.min(F.when(here, F.col(last))).alias(f"{kept[last]}{c}"))
    table = rows.groupBy(*keys, *[F.col(o).alias(f"_o{k}") for k, o in enumerate(order[:-1])]).agg(*steps)
    for k in reversed(range(len(order) - 1)):
        by = F.col(f"_o{k}")
        steps = [F.min(c).alias(c) for c in carried]
        for c in cells:
            there = F.col(f"_p{c}").isNotNull()
            steps.append(F.max(f"_p{c}").alias(f"_p{c}"))
            if order[k] in kept:
                steps.append(F.min(F.when(there, by)).alias(f"{kept[order[k]]}{c}"))
            for name in (kept[o] + c for o in order[k + 1 :] if o in kept):
                known = F.max(F.when(there & by.isNotNull(), F.lit(1))).isNotNull()
                # At most one group of a key has an unknown order.
                first = F.min_by(F.col(name), F.when(there, by))
                steps.append(F.when(known, first).otherwise(F.max(F.when(there & by.isNull(), F.col(name)))).alias(name))
        table = table.groupBy(*keys, *[f"_o{i}" for i in range(k)]).agg(*steps)
    return table


def _total(values: list[Column]) -> Column:
    """Sum that leaves out unknown parts and is unknown when all are."""
    if len(values) == 1:
        return values[0]
    known = sum((F.coalesce(v, F.lit(0.0)) for v in values), F.lit(0.0))
    return F.when(F.coalesce(*values).isNotNull(), known)


def bucketize(
    table: DataFrame,
    width_s: int,
    aggs: dict[str, str],
    keys: list[str],
    time: str = "time",
    ctx: DataFrame | None = None,
    ctx_key: str = "hadm_id",
    start: str = "admittime",
    end: str = "dischtime",
    unique: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Average (or sum) every column inside the nearest bucket of `width_s` seconds.

    aggs: column -> "avg" or "sum"; columns to `keep` follow from the keys. Hours since start and until end are those of the bucket time (a bucket may lie before
    the start); the two times come with the table if it has the columns, else from the context if one is given.
    """
    carried = [c for c in (start, end) if c in table.columns]
    out = (
        table.groupBy(bucket_index(time, width_s).alias("_bucket"), *keys)
        .agg(*[AGGREGATES[how](c).alias(c) for c, how in aggs.items()], *[F.min(c).alias(c) for c in (*carried, *keep)])
        .withColumn(time, bucket_start("_bucket", width_s))
    )
    if len(carried) < 2:
        if ctx is None:
            return out.select(time, *keys, *keep, *aggs)
        out = enrich(out.drop(*carried), ctx, [ctx_key], [start, end], unique=unique)
    return out.select(
        time, *keys, *keep, *aggs, elapsed_hours(start, time).alias("t_since"), elapsed_hours(time, end).alias("t_til")
    )


def impute_sequence(
    df: DataFrame,
    key: list[str],
    order: list[str],
    cols: list[str],
    medians: dict[str, float | None] | None = None,
    slices: Slices | str | None = AUTO,
    rows: int | None = None,
) -> DataFrame:
    """Fill gaps of each key with the last known value, what remains with the column's global median.

    `<col>_imputed` marks cells that were missing, `<col>_imputed_global` those that took the median. `rows` is a known
    upper bound of the row count, see `fit_medians`. The frame is read several times, so a large one is settled first.
    """
    if rows is None or rows > HOT_ROWS:
        df = settle(df)
    if medians is None:
        medians = fit_medians(df, cols, rows)
    flagged = df.select("*", *[F.col(c).isNull().cast("double").alias(f"{c}_imputed") for c in cols])
    carried = carry_forward(flagged, key, order, cols, slices)

    filled = {c: F.coalesce(F.col(c), F.lit(medians[c]).cast("double")) for c in cols}
    return carried.select(
        *[filled[c].alias(c) if c in filled else F.col(c) for c in carried.columns],
        *[F.col(c).isNull().cast("double").alias(f"{c}_imputed_global") for c in cols],
    )


def pair_intervals(
    df: DataFrame,
    keys: list[str],
    ts: str,
    flag: str,
    start: object = 0,
    stop: object = 1,
    value: str | None = None,
    tie: list[str] | None = None,
    slices: Slices | str | None = AUTO,
) -> DataFrame:
    """Each start directly followed by a stop of the same key: start, stop, elapsed hours and the stop's value."""
    carried = [ts, flag, *([value] if value else [])]
    order = [ts, *(tie or [flag])]
    nxt = with_next(df.select(*dict.fromkeys([*keys, *carried, *order])), keys, order, carried, slices)
    pairs = nxt.filter((F.col(flag) == F.lit(start)) & (F.col(f"next_{flag}") == F.lit(stop)))
    return pairs.select(
        *keys,
        F.col(ts).alias("start"),
        F.col(f"next_{ts}").alias("stop"),
        (elapsed_seconds(ts, f"next_{ts}") / F.lit(3600.0)).alias("elapsed"),
        *([F.col(f"next_{value}").alias(value)] if value else []),
    )
