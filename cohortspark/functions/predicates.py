"""Boolean column builders."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from cohortspark.functions.time import ColumnOrName, col


def code_prefix_match(c: ColumnOrName, prefixes: Iterable[str]) -> Column:
    """True when the code starts with any of the prefixes; every part can be pushed into a parquet scan."""
    tests = [col(c).startswith(p) for p in prefixes]
    return reduce(or_, tests) if tests else F.lit(False)


def holds(condition: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def any_of(conditions: Iterable[Column]) -> Column:
    conditions = [holds(c) for c in conditions]
    return reduce(or_, conditions) if conditions else F.lit(False)


def same_or_both_null(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
