"""Counts of hashes in a fixed number of slots, added up over all partitions: a few megabytes whatever the input."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICES = 256


def slices(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One partition's counts as rows (slot range, packed counts)."""
    step = len(counts) // SLICES
    for k in range(SLICES):
        part = counts[k * step : (k + 1) * step]
        if part.any():
            yield k, part.astype("<u4").tobytes()


def total(parts: DataFrame, bits: int) -> np.ndarray:
    """Sums of rows (slot int, counts binary) of all partitions; 2 ** bits counts reach the driver, at most 2 ** 32 - 1 each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(raw, "<u4").astype(np.uint64)
                sums[slot] = np.minimum(sums[slot] + own, np.uint64(2**32 - 1)) if slot in sums else own
        if sums:
            packed = [s.astype("<u4").tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(packed, pa.binary())], ["slot", "counts"])

    out = np.zeros(1 << bits, np.uint32)
    step = (1 << bits) // SLICES
    for row in parts.repartition("slot").mapInArrow(add, "slot int, counts binary").collect():
        out[row["slot"] * step : (row["slot"] + 1) * step] = np.frombuffer(bytes(row["counts"]), "<u4")
    return out


def bit_slices(flags: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """One partition's 0/1 flags as rows (slot range, packed bits)."""
    packed = np.packbits(flags)
    step = len(packed) // SLICES
    for k in range(SLICES):
        part = packed[k * step : (k + 1) * step]
        if part.any():
            yield k, part.tobytes()


def either(parts: DataFrame, bits: int) -> np.ndarray:
    """Packed flags that any partition has set, from rows (slot int, marks binary): 2 ** bits bits reach the driver."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(raw, np.uint8)
                found[slot] = found[slot] | own if slot in found else own
        if found:
            packed = [s.tobytes() for s in found.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(packed, pa.binary())], ["slot", "marks"])

    out = np.zeros((1 << bits) // 8, np.uint8)
    step = len(out) // SLICES
    for row in parts.repartition("slot").mapInArrow(join, "slot int, marks binary").collect():
        out[row["slot"] * step : (row["slot"] + 1) * step] = np.frombuffer(bytes(row["marks"]), np.uint8)
    return out
