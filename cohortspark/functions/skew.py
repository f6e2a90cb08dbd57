"""Keys that own too large a share of the rows, and joins that spread them.

The runtime's own skew handling splits a join only where both inputs come straight from a shuffle. Here the right side is
mostly an aggregate or a first row per key, so hot keys are found by a counting job and salted explicitly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import MapType

from cohortspark.session import settle

HOT_ROWS = 1_000_000  # row target of a task: a larger group is spread over as many tasks as it holds targets
AUTO = "auto"  # measure the frame itself; None states that no group is too big for a task
PARTS = "_parts"
_SALT, _TIMES = "_salt", "_times"


def hot_keys(
    df: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS, hot_share: float = 0.0, rows: int | None = None
) -> DataFrame | None:
    """The hot keys (NULL may be one) with the number of parts each needs (`_parts`); None if there are none.

    Hot is a key above `hot_rows` rows (and, where given, above a share of all rows): at most rows / hot_rows keys, so the
    table can be broadcast. Runs one counting job on `keys` alone: pass the table the rows come from rather than an expensive
    derivation of it. `rows` is a known upper bound of the row count (a source table's count comes from its file footers);
    when that already fits into one task nothing is counted.
    """
    if rows is not None and rows <= hot_rows:
        return None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max(hot_rows, df.count() * hot_share if hot_share else 0))
    hot = settle(counts.select(*keys, F.ceil(F.col("_n") / max(hot_rows, 1)).cast("int").alias(PARTS)))
    return hot if hot.take(1) else None


def resolve_hot(hot: DataFrame | str | None, df: DataFrame, keys: list[str]) -> DataFrame | None:
    return hot_keys(df, keys) if isinstance(hot, str) else hot


def matching(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], nullsafe: bool = True) -> Column:
    """Equality of column pairs; unknown keys match each other unless told otherwise."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & (left[a].eqNullSafe(right[b]) if nullsafe else left[a] == right[b])
    return condition


def mark_hot(df: DataFrame, keys: list[str], hot: DataFrame, name: str) -> DataFrame:
    """Add the number of parts of the row's key, 1 where it is not hot. Hot keys are at most rows / hot_rows, hence the
    broadcast."""
    parts = F.col(PARTS) if PARTS in hot.columns else F.lit(2)
    side = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], parts.alias(name))
    joined = df.join(F.broadcast(side), matching(df, side, [(k, f"_h_{k}") for k in keys]), "left")
    return joined.select(*df.columns, F.coalesce(F.col(name), F.lit(1)).alias(name))


def row_hash(df: DataFrame, keys: list[str]) -> Column:
    """A hash of the row's columns besides the keys: the same on a retry, whatever task holds the row."""
    others = [f.name for f in df.schema.fields if f.name not in keys and not isinstance(f.dataType, MapType)]
    return F.xxhash64(*others) if others else F.lit(0).cast("long")


def salted_rows(df: DataFrame, keys: list[str], hot: DataFrame, hot_rows: int) -> DataFrame:
    """Add `_salt`, below the number of parts of the row's key, and where rows are folded `_times`, how many a row stands for.

    Different rows of a hot key are dealt by a hash of their other columns. Rows that are repeated more than `hot_rows` times, which
    a count by hash finds, would share a salt: they are folded on the map side into rows that stand for `hot_rows` copies at
    most, each with a salt of its own. Nothing depends on the order of rows, so a retry deals them alike.
    """
    marked = mark_hot(df, keys, hot, "_parts_left")
    plain = marked.withColumn(_SALT, F.pmod(row_hash(df, keys), F.col("_parts_left")).cast("int"))
    if any(isinstance(f.dataType, MapType) for f in df.schema.fields):  # maps cannot be grouped
        return plain.drop("_parts_left")
    names = [(k, f"_c_{k}") for k in keys]
    copies = marked.filter(F.col("_parts_left") > 1).groupBy(*keys, row_hash(df, keys).alias("_c_hash")).agg(F.count(F.lit(1)).alias("_n"))
    copies = settle(copies.filter(F.col("_n") > hot_rows).select(*[F.col(k).alias(c) for k, c in names], "_c_hash"), "copies")
    if not copies.take(1):
        return plain.drop("_parts_left")
    same = matching(marked, copies, names) & (row_hash(df, keys) == copies["_c_hash"])
    repeated = marked.join(F.broadcast(copies), same, "left_semi")  # at most rows / hot_rows of them
    others = plain.join(F.broadcast(copies), same, "left_anti").drop("_parts_left").withColumn(_TIMES, F.lit(1))
    folded = repeated.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("_n"))
    piece = F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / hot_rows).cast("int") - 1))
    pieces = folded.withColumn("_piece", piece)
    salt = F.pmod(row_hash(df, keys) + F.col("_piece"), F.col("_parts_left")).cast("int")
    times = F.least(F.lit(hot_rows), F.col("_n") - F.col("_piece") * hot_rows).cast("int")
    return others.unionByName(pieces.withColumn(_SALT, salt).withColumn(_TIMES, times).select(*others.columns))


def spread_join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, hot: DataFrame | None, nullsafe: bool = False, hot_rows: int | None = None
) -> DataFrame:
    """Join (inner, left, left_semi) that spreads each hot left key over as many tasks as its rows need; columns: left, then
    the right's others.

    A hot row is salted (`salted_rows`); the right rows of hot keys are repeated once per salt.
    """
    others = [c for c in right.columns if c not in keys]
    kept = [] if how == "left_semi" else others
    names = [(k, f"_r_{k}") for k in keys]
    renamed = right.select(*[F.col(k).alias(r) for k, r in names], *kept)
    if hot is None:
        return left.join(renamed, matching(left, renamed, names, nullsafe), how).select(*left.columns, *kept)
    salted = salted_rows(left, keys, hot, HOT_ROWS if hot_rows is None else hot_rows)
    own = hot.select(*[F.col(k).alias(r) for k, r in names], *[c for c in hot.columns if c == PARTS])
    marked = mark_hot(renamed, [r for _, r in names], own, "_parts_right")
    copies = F.sequence(F.lit(0), F.col("_parts_right") - 1)
    repeated = marked.withColumn("_r_salt", F.explode(copies)).drop("_parts_right")
    condition = matching(salted, repeated, names, nullsafe) & (salted[_SALT] == repeated["_r_salt"])
    joined = salted.join(repeated, condition, how)
    if _TIMES not in salted.columns:
        return joined.select(*left.columns, *kept)
    return joined.select(*left.columns, *kept, F.explode(F.array_repeat(F.lit(0), F.col(_TIMES))).alias(_TIMES)).drop(_TIMES)


def lookup_join(
    df: DataFrame, dim: DataFrame, keys: list[str], hot: DataFrame | str | None = AUTO, nullsafe: bool = False
) -> DataFrame:
    """Left join with a derived lookup: hot keys are spread, and adaptive execution broadcasts a side by its measured size."""
    return spread_join(df, dim, keys, "left", resolve_hot(hot, df, keys), nullsafe)
