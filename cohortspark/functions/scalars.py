"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from cohortspark.functions.time import ColumnOrName, col

MISSING_WORDS = ("", "None", "nan", "np.nan")  # fixed values: texts that stand for "no value"


def is_missing(c: ColumnOrName) -> Column:
    return col(c).isNull() | col(c).cast("string").isin(*MISSING_WORDS)


def null_if_nan(c: ColumnOrName) -> Column:
    return F.when(~F.isnan(col(c)), col(c))


def int_div(a: ColumnOrName, b: ColumnOrName | int) -> Column:
    """Integer quotient, truncated towards zero; NULL when the divisor is 0."""
    divisor = F.lit(b) if isinstance(b, int) else col(b)
    return F.call_function("div", col(a), F.nullif(divisor, F.lit(0)))


def item_class(code: ColumnOrName, digits: int = 2) -> Column:
    """The class part of a hierarchical item code: the code without its last `digits` decimal digits."""
    return int_div(code, 10**digits)


def rate(numerator: ColumnOrName, denominator: ColumnOrName) -> Column:
    """numerator / denominator, NULL for a zero or unknown denominator."""
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def log10_between(c: ColumnOrName, low: float, high: float) -> Column:
    """True when log10 of the value lies strictly between the two limits."""
    value = F.log10(col(c).cast("double"))
    return (value > low) & (value < high)


def fahrenheit_to_celsius(c: ColumnOrName) -> Column:
    return (col(c) - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0)


def logistic(x: Column) -> Column:
    """e^x / (1 + e^x)."""
    return F.exp(x) / (F.lit(1.0) + F.exp(x))


def parse_ids(text: ColumnOrName) -> Column:
    """The integers of a textual record "(1,2,)" as an array; anything that is no integer becomes NULL."""
    inner = F.translate(col(text), "()", "")
    # Checked before the cast: a cast that fails on every row is far slower than the check.
    return F.transform(F.split(inner, ","), lambda part: F.when(part.rlike("^-?[0-9]{1,18}$"), part.cast("bigint")))


def band_points(c: ColumnOrName, bands: Sequence[tuple[float, int]], above: int, missing: int = 0) -> Column:
    """Points of the first band whose exclusive upper limit exceeds the value, `above` past the last one."""
    value, points = col(c), None
    for limit, score in bands:
        test = value < F.lit(float(limit))
        points = F.when(test, F.lit(score)) if points is None else points.when(test, F.lit(score))
    points = F.lit(above) if points is None else points.otherwise(F.lit(above))
    return F.when(value.isNull(), F.lit(missing)).otherwise(points)


def label_text(*parts: ColumnOrName, sep: str = "_") -> Column:
    """Parts joined into one name; a NULL part is left out."""
    return F.concat_ws(sep, *[col(p).cast("string") for p in parts])


def unit_hash(c: ColumnOrName, seed: int | str) -> Column:
    """A number in [0, 1) drawn from the md5 of seed and key: the same on every run, engine and partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), col(c).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
