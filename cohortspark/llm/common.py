"""What the operators of this subpackage share: session settings, the shared folder, packed word arrays."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortspark.session import settle, shared_folder

__all__ = ["prepare", "release", "settle", "shared_folder", "share_of", "texts_of", "worker_cache"]

ARROW_ROWS = 512  # rows in a batch handed to Python: whole texts travel in it, so it bounds a worker's memory


def prepare(spark: SparkSession) -> SparkSession:
    """Hand texts to Python in batches of at most `ARROW_ROWS` rows; nothing else of the session is changed."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) != ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    return spark


def texts_of(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def worker_cache(key: str, build: Callable):
    """An object that a Python worker keeps between tasks (vocabularies, compiled tables). It must not change results."""
    home = sys.modules.setdefault("_cohortspark_worker", types.ModuleType("_cohortspark_worker"))
    kept = home.__dict__.setdefault("kept", {})
    if key not in kept:
        kept.clear()  # a worker serves one operator at a time: at most one object
        kept[key] = build()
    return kept[key]


def release() -> None:
    """Let go of what an earlier operator has kept in this worker."""
    home = sys.modules.get("_cohortspark_worker")
    if home is not None:
        home.__dict__.get("kept", {}).clear()


def share_of(key: Column, wanted: int, count: int) -> Column:
    """Does the row's key hash lie in the share of the hash range that lets about `wanted` of `count` rows through?

    Somewhat more pass (five standard deviations), so that the `wanted` smallest hashes are among them; the caller keeps those.
    The number of rows that pass is bounded only where keys do not repeat: all rows of a key pass or none.
    """
    limit = min(1.0, (wanted + 5 * wanted**0.5 + 20) / max(count, 1))
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) < F.lit(int(limit * (1 << 30)))
