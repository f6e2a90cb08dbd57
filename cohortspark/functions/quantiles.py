"""Exact medians that never gather a large column's values in one task.

Small inputs use the built-in median. Large ones are narrowed by passes over the data that return a few numbers a column:

1. a sketch of the values still in question proposes a bracket around the middle ranks;
2. a counting pass tests it: how many values lie below and inside, and which values are next to its two ends. Whatever the
   sketch was worth, the counts tell on which side of each end the two middle ranks lie, so the bracket becomes the proposal, or
   what lies below or above it, or the ranks fall on the two sides of an end and both values are known;
3. once the values left, or the different ones among them, fit a row target, they are counted by value and ranked.

A proposal that equals the bracket is replaced by a single value, so every counting pass makes the bracket smaller.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortspark.functions.skew import HOT_ROWS

ACCURACY = 100_000  # the sketch's rank error is at most 1 / ACCURACY of the rows
MARGIN = 4 / ACCURACY
COLUMNS = 32  # columns of one pass


@dataclass
class Bracket:
    """Both middle ranks (from 1) lie among the `inside` values from low to high; `below` values are smaller."""

    low: float
    high: float
    below: int
    inside: int
    ranks: tuple[int, int]
    values: tuple[float, float] | None = None

    def narrow(self, a: float, b: float, seen) -> None:
        """Apply the counts of the values below a, from a to b, and their neighbours, all within the bracket."""
        first, second = self.ranks
        to_a = self.below + seen["n_below"]
        to_b = to_a + seen["n_in"]
        if first > to_b:
            self.low, self.below, self.inside = seen["next_above"], to_b, self.inside - seen["n_below"] - seen["n_in"]
        elif second <= to_a:
            self.high, self.inside = seen["next_below"], seen["n_below"]
        elif first <= to_a:
            self.values = seen["next_below"], seen["first_in"] if seen["n_in"] else seen["next_above"]
        elif second > to_b:
            self.values = seen["last_in"], seen["next_above"]
        else:
            self.low, self.high, self.below, self.inside = seen["first_in"], seen["last_in"], to_a, seen["n_in"]
        if self.values is None and self.low == self.high:
            self.values = self.low, self.low


def _number(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _within(c: str, low: float | None, high: float | None) -> Column:
    value = _number(c)
    return value if low is None else F.when((value >= F.lit(low)) & (value <= F.lit(high)), value)


def propose(df: DataFrame, brackets: dict[str, Bracket | None]) -> dict:
    """One sketch pass: of the values in each bracket (None: all) their number, ends, and proposals around the middle ranks."""
    cells = []
    for c, b in brackets.items():
        value = _within(c, b and b.low, b and b.high)
        middle = 0.5 if b is None else (sum(b.ranks) / 2 - b.below) / b.inside
        at = [min(1.0, max(0.0, middle + d)) for d in (-MARGIN, 0.0, MARGIN)]
        sketch = F.percentile_approx(value, at, ACCURACY)
        cells.append(F.struct(F.count(value).alias("n"), F.min(value).alias("low"), F.max(value).alias("high"), sketch.alias("at")).alias(c))
    return df.agg(*cells).first().asDict()


def count_brackets(df: DataFrame, proposed: dict[str, tuple[Bracket, float, float]]) -> dict:
    """One counting pass: what lies below, inside and next to the proposed brackets."""
    cells = []
    for c, (b, low, high) in proposed.items():
        value, a, z = _within(c, b.low, b.high), F.lit(low), F.lit(high)
        inside = (value >= a) & (value <= z)
        cells.append(
            F.struct(
                F.count(F.when(value < a, 1)).alias("n_below"), F.count(F.when(inside, 1)).alias("n_in"),
                F.max(F.when(value < a, value)).alias("next_below"), F.min(F.when(inside, value)).alias("first_in"),
                F.max(F.when(inside, value)).alias("last_in"), F.min(F.when(value > z, value)).alias("next_above"),
            ).alias(c)
        )
    return df.agg(*cells).first().asDict()


def rank_inside(df: DataFrame, brackets: dict[str, Bracket]) -> None:
    """Count the values inside each bracket (on the map side first) and rank the counts."""
    cells = []
    for c, b in brackets.items():
        value = _within(c, b.low, b.high)
        below, first, second = (F.lit(x).cast("long").alias(n) for x, n in zip((b.below, *b.ranks), ("below", "first", "second")))
        cells.append(F.when(value.isNotNull(), F.struct(F.lit(c).alias("column"), below, first, second, value.alias("v"))))
    keys = ["column", "below", "first", "second", "v"]
    counts = df.select(F.explode(F.array_compact(F.array(*cells))).alias("x")).groupBy(*[F.col(f"x.{k}") for k in keys]).agg(F.count(F.lit(1)).alias("k"))
    upto = Window.partitionBy("column").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("upto", F.col("below") + F.sum("k").over(upto))
    at = {n: F.min(F.when(F.col("upto") >= F.col(n), F.col("v"))).alias(n) for n in ("first", "second")}
    for r in ranked.groupBy("column").agg(*at.values()).collect():
        brackets[r["column"]].values = r["first"], r["second"]


def select_middle(df: DataFrame, cols: list[str], target: int) -> dict[str, Bracket | None]:
    """The bracket of each column with both middle values found; None for a column without values."""
    found: dict[str, Bracket | None] = dict.fromkeys(cols)
    sketches = propose(df, dict.fromkeys(cols))
    for c, s in sketches.items():
        if s["n"]:
            found[c] = Bracket(s["low"], s["high"], 0, s["n"], ((s["n"] + 1) // 2, s["n"] // 2 + 1))
    unsure = {c: b for c, b in found.items() if b is not None}
    ready = {}
    while True:
        ready |= {c: b for c, b in unsure.items() if b.values is None and b.inside <= target}
        unsure = {c: b for c, b in unsure.items() if b.values is None and c not in ready}
        if not unsure:
            break
        if any(c not in sketches for c in unsure):
            sketches = propose(df, unsure)
        proposed = {}
        for c, b in unsure.items():
            low, middle, high = sketches[c]["at"]
            proposed[c] = (b, middle, middle) if (low, high) == (b.low, b.high) else (b, low, high)
        for c, seen in count_brackets(df, proposed).items():
            unsure[c].narrow(*proposed[c][1:], seen)
        sketches = {}
    if ready:
        rank_inside(df, ready)
    return found


def fit_medians(df: DataFrame, cols: list[str], rows: int | None = None, target: int = HOT_ROWS) -> dict[str, float | None]:
    """Median of each column as a plain number; NULL and NaN are left out, an empty column gives None.

    `rows` is a known upper bound of the number of rows, such as the count of the table the frame comes from; up to `target` the
    built-in median is used. Else the frame is read three times as a rule, more often where a sketch was off; materialise it
    first if it is costly to compute. At most `target` values a column are ranked.
    """
    if not cols:
        return {}
    if rows is not None and rows <= target:
        found = df.agg(*[F.median(_number(c)).alias(c) for c in cols]).first()
        return {c: found[c] for c in cols}
    out: dict[str, float | None] = {}
    for k in range(0, len(cols), COLUMNS):
        for c, b in select_middle(df, cols[k : k + COLUMNS], target).items():
            out[c] = None if b is None else (b.values[0] + b.values[1]) / 2
    return out
