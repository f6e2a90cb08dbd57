"""Removal of every byte that lies in a string of `SIZE` bytes occurring more than once in the corpus.

Texts are parsed into phrases at triggers of a rolling hash, as in prefix-free parsing: where a string's first trigger lies
depends on the string alone, so equal strings have it at equal places. All strings of one text with the same trigger form a
stretch. Names (64-bit hashes) replace ranks: what is asked is which strings are equal, not which is smaller, so dictionary
and parse are grouped by name and need not be sorted as suffix arrays (the README says why). Four steps, each a map-side
combined count or a join:

1. Stretches whose bytes right of the trigger occur once in the corpus hold no repeated string and are left aside.
2. Stretches that occur as a whole more than once are repeated through and through.
3. Only where a trigger's right side occurs with different surroundings are single strings compared: one text for each
   different stretch sends the names of its strings, each at most once a batch.
4. What was found meets the texts again. Texts without a repeated stretch are not moved at all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from cohortspark.llm.common import settle, texts_of
from cohortspark.llm.phrases import Rolling, mix, triggers
from cohortspark.llm.sketch import bit_slices, either

SIZE = 400
REACH = 200  # starts look so far ahead for their trigger
PICK_BITS = 23
LONG = 4 << 20  # bytes of a text parsed at a time
HOT_ROWS = 100_000  # stretches of one name that a task may be sent


def parsed(rolling: Rolling, data: bytes, size: int, reach: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(offset, trigger, first start, last start) of each block of a text; blocks overlap so that every start is in one."""
    starts = len(data) - size + 1
    for at in range(0, max(starts, 0), LONG):
        count = min(LONG, starts - at)
        rolling.load(data[at : at + count + size - 1])
        yield at, *triggers(rolling, count + size - 1, reach, count)


def stretches(docs: DataFrame, size: int, reach: int) -> DataFrame:
    """One row a text: h1, h2 (its name), first and last start of each stretch, `key` (name of the bytes right of the trigger)
    and `whole` (name of the stretch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            lists: list[list[np.ndarray]] = [[], [], [], []]
            rows = []
            for k, t in enumerate(texts_of(batch.column(2))):
                if t is None or len(t) < size:
                    continue
                parts: list[list[np.ndarray]] = [[], [], [], []]
                for at, place, first, last in parsed(rolling, t, size, reach):
                    found = first + at, last + at, rolling.hashes(place, place + size - reach + 1), rolling.hashes(first, last + size)
                    for own, x in zip(parts, found):
                        own.append(x.astype(np.uint64).view(np.int64))
                rows.append(k)
                for own, x in zip(lists, parts):
                    own.append(np.concatenate(x))
            ends = pa.array(np.cumsum([0, *map(len, lists[0])]).astype(np.int32))
            flat = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x) if x else np.zeros(0, np.int64))) for x in lists]
            kept = batch.select([0, 1]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept.columns, *flat], ["h1", "h2", "first", "last", "key", "whole"])

    return docs.mapInArrow(run, "h1 long, h2 long, first array<long>, last array<long>, key array<long>, whole array<long>")


def slot_of(names: pa.Array) -> np.ndarray:
    return (mix(names.to_numpy(zero_copy_only=False).view(np.uint64)) >> np.uint64(64 - PICK_BITS)).astype(np.int64)


def marks(names: DataFrame) -> np.ndarray:
    """A filter of fixed size on column h1: bits of the slots that are taken."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << PICK_BITS, np.uint8)
        for batch in batches:
            flags[slot_of(batch.column(0))] = 1
        rows = list(bit_slices(flags))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["slot", "marks"])

    return either(names.select("h1").mapInArrow(count, "slot int, marks binary"), PICK_BITS)


def picked(docs: DataFrame, names: DataFrame, inside: bool = True) -> DataFrame:
    """The rows of `docs` (with column h1) whose slot is marked, or the others. A marked row need not be in `names`."""
    shared = docs.sparkSession.sparkContext.broadcast(marks(names))
    at = docs.columns.index("h1")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = slot_of(batch.column(at))
            hit = (shared.value[slot >> 3] >> (7 - (slot & 7))) & 1 == 1
            yield batch.filter(pa.array(hit if inside else ~hit))

    return docs.mapInArrow(keep, docs.schema)


def packed(first, last):
    """A range of starts as one number (starts are below 2 ** 31)."""
    return (first << 32) | last


def string_names(texts: DataFrame, size: int) -> DataFrame:
    """`texts`: id, ranges (packed), text. Rows (name, id, starts, weight): a string that its batch has once comes with its
    start and weight 1; of one that the batch has more often the name alone goes out, with weight 2. The starts of the latter
    are known to be repeated: they come as ranges with weight 0 and a name that spreads them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = Rolling()
        for batch in batches:
            names, ids, starts = [], [], []
            for key, ranges, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2))):
                for r in ranges:
                    a, b = r >> 32, r & 0xFFFFFFFF
                    rolling.load(t[a : b + size])
                    names.append(rolling.fixed(size, 0, b - a + 1))
                    starts.append(np.arange(a, b + 1))
                    ids.append(np.full(b - a + 1, key))
            if not names:
                continue
            name, start, owner = np.concatenate(names), np.concatenate(starts), np.concatenate(ids)
            order = np.argsort(name, kind="stable")
            name, start, owner = name[order], start[order], owner[order]
            new = np.concatenate([[True], name[1:] != name[:-1]])
            alone = new & np.append(new[1:], True)
            several = name[new & ~alone]
            at = np.lexsort((start[~alone], owner[~alone]))
            s, o = start[~alone][at], owner[~alone][at]
            edge = np.flatnonzero(np.concatenate([[True], (s[1:] > s[:-1] + 1) | (o[1:] != o[:-1])])) if len(s) else np.zeros(0, np.int64)
            last = s[np.append(edge[1:], len(s)) - 1] if len(s) else s
            first = s[edge]
            spread = mix((o[edge].astype(np.uint64) << np.uint64(20)) ^ first.astype(np.uint64))
            none = np.zeros(len(several), np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([name[alone], several, spread]).view(np.int64)),
                    pa.array(np.concatenate([owner[alone], none, o[edge]])),
                    pa.array(np.concatenate([packed(start[alone], start[alone]), none, packed(first, last)])),
                    pa.array(np.concatenate([np.ones(int(alone.sum()), np.int32), none.astype(np.int32) + 2, np.zeros(len(edge), np.int32)])),
                ],
                ["name", "id", "starts", "weight"],
            )

    return texts.mapInArrow(run, "name long, id long, starts long, weight int")


def with_counts(rows: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """Inner join of `rows` with `names`: a settled row for each key, the number of its rows as c. Rows of a key above `HOT_ROWS`
    stay in their tasks: such keys are at most rows / HOT_ROWS, hence the broadcast. Without any, it is the plain join."""
    hot = names.filter(F.col("c") > HOT_ROWS)
    if not hot.take(1):
        return rows.join(names, key)
    others = rows.join(F.broadcast(hot), key, "left_anti").join(names.filter(F.col("c") <= HOT_ROWS), key)
    return others.unionByName(rows.join(F.broadcast(hot), key))


def repeated_starts(rows: DataFrame, size: int, reach: int) -> DataFrame:
    """For each text (h1, h2) that has any: packed ranges of starts whose strings occur more than once in the corpus. Texts
    that occur several times as a whole come with all of their starts. `rows`: h1, h2, text."""
    parsed_ = settle(stretches(rows, size, reach).withColumn("id", F.monotonically_increasing_id()), "stretches")
    each = parsed_.select("id", F.explode(F.arrays_zip("first", "last", "key", "whole")).alias("s"))
    each = each.select("id", F.shiftleft("s.first", 32).bitwiseOR(F.col("s.last")).alias("starts"), "s.key", "s.whole")
    shared = each.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("whole").alias("a"), F.max("whole").alias("b"))
    shared = settle(shared.filter("c > 1").select("key", "c", (F.col("a") != F.col("b")).alias("mixed")), "shared-keys")
    live = settle(with_counts(each, shared, "key").select("id", "starts", "whole", "mixed"), "live")
    wholes = settle(live.groupBy("whole").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("owner")), "wholes")
    known = with_counts(live, wholes, "whole")

    # One occurrence of each different stretch sends its strings; others of it are known to be repeated through and through.
    first = known.filter(F.col("mixed") & (F.col("owner") == F.col("id"))).groupBy("id", "whole").agg(F.min("starts").alias("starts"))
    sending = settle(first.groupBy("id").agg(F.collect_list("starts").alias("ranges")).join(parsed_.select("id", "h1", "h2"), "id"), "sending")
    texts = picked(rows, sending).alias("t").join(sending.alias("n"), ["h1", "h2"]).dropDuplicates(["id"]).select("id", "ranges", "text")
    sent = string_names(texts, size).withColumn("sum", F.sum("weight").over(Window.partitionBy("name", F.col("weight") == 0)))
    singles = sent.filter("weight = 0 or (weight = 1 and sum > 1)").select("id", "starts")
    full = known.filter("c > 1").select("id", "starts")
    ranges = full.union(singles).groupBy("id").agg(F.collect_list("starts").alias("ranges"))
    found = ranges.join(parsed_.select("id", "h1", "h2"), "id")
    # Rows of the same text have the same whole stretches; what single strings add is with one of them only.
    return settle(found.groupBy("h1", "h2").agg(F.max_by("ranges", F.size("ranges")).alias("ranges")), "repeated")


def cut(data: bytes, ranges: list[int], size: int) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of a text, and the maximal runs removed, if the strings that begin in the packed ranges go."""
    if not ranges:
        return data, []
    both = np.sort(np.array(ranges, np.int64))
    begin, end = both >> 32, np.maximum.accumulate((both & 0xFFFFFFFF) + size)
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
    runs = list(zip(begin[new].tolist(), end[np.append(new[1:], len(end)) - 1].tolist()))
    parts, at = [], 0
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]]), runs


def remove_repeats(docs: DataFrame, text: str = "text", size: int = SIZE, reach: int | None = None, keep: bool = True) -> DataFrame:
    """The columns of `docs` (but for `text`) plus n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with
    `keep` the bytes that are left as kept. Repeats are judged on the input: each byte in a string of `size` bytes that also
    begins anywhere else, in the same text or another, goes.

    NULL is an empty text; texts shorter than `size` lose nothing; repeated rows lose everything from `size` bytes on. Columns
    of `docs` named like a result column are replaced. Names are 64 bits (texts: twice 64).
    """
    reach = size // 2 if reach is None else reach
    result = [StructField("n_bytes", LongType()), StructField("n_removed", LongType()), StructField("n_spans", LongType()), StructField("kept_sha256", StringType())]
    result += [StructField("kept", BinaryType())] if keep else []
    names = [c for c in docs.columns if c != text and c not in {f.name for f in result}]
    raw = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.xxhash64(raw).alias("h1"), F.xxhash64(raw, F.lit(1)).alias("h2"), raw.alias("text"))
    found = repeated_starts(rows, size, reach)
    carried = docs.select(F.xxhash64(raw).alias("h1"), F.xxhash64(raw, F.lit(1)).alias("h2"), raw.alias("text"), F.struct(*names).alias("row"))
    hit = picked(carried, found).join(found, ["h1", "h2"], "left").select("text", "ranges", "row")
    missed = picked(carried, found, inside=False).select("text", F.lit(None).cast("array<long>").alias("ranges"), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[] for _ in result]
            for t, ranges in zip(texts_of(batch.column(0)), batch.column(1).to_pylist()):
                left, runs = cut(t, ranges or [], size)
                for own, x in zip(made, (len(t), len(t) - len(left), len(runs), hashlib.sha256(left).hexdigest(), left)):
                    own.append(x)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(2), *(pa.array(x, k) for x, k in zip(made, kinds))], ["row", *(f.name for f in result)])

    schema = StructType([StructField("row", carried.schema["row"].dataType), *result])
    return hit.union(missed).mapInArrow(run, schema).select("row.*", *(f.name for f in result))
