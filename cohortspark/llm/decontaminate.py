"""Benchmark decontamination: benchmark phrases searched in an FM-index per shard of the training documents.

A shard is a run of documents of one input partition with about `SHARD_WORDS` words. Words that no benchmark item holds
become breaks, runs of known words too short for the shortest phrase as well: no phrase can match there, so the index holds
only what could match. Every distinct phrase is searched backwards, its occurrences are located through sampled suffix
positions, and overlapping ones are merged into spans. Nothing is shuffled. The benchmark is the stated query set: it is
read in blocks of at most `BLOCK_WORDS` words, and only one block at a time is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from cohortspark.llm.common import settle, texts_of
from cohortspark.llm.fm_index import FmIndex

WINDOW = 13
SHARE = 20  # contaminated when SHARE * hit words >= words
SHARD_WORDS = 1 << 20
BLOCK_WORDS = 200_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_KEEP = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256)).lower()
SPANS = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType())]))
RESULT = StructType(
    [
        StructField("n_words", LongType()),
        StructField("n_hit", LongType()),
        StructField("n_items", LongType()),
        StructField("items", ArrayType(StringType())),
        StructField("hits", SPANS),
        StructField("spans", SPANS),
        StructField("contaminated", BooleanType()),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and all characters beyond ASCII."""
    return text.translate(_KEEP).split() if text else []


class Phrases:
    """One block of the benchmark: its vocabulary, and its distinct phrases by length with the items that have them."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.ids: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            known = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
            width = min(window, len(known))
            for k in range(len(known) - width + 1 if known else 0):
                owners.setdefault(tuple(known[k : k + width]), set()).add(item)
        self.tables: list[np.ndarray] = []
        self.owners: list[list[list[str]]] = []
        for width in sorted({len(p) for p in owners}):
            own = [p for p in owners if len(p) == width]
            self.tables.append(np.array(own, np.int64))
            self.owners.append([sorted(owners[p]) for p in own])
        self.shortest = min((t.shape[1] for t in self.tables), default=0)


def blocks(benchmark: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[Phrases]:
    """The benchmark in blocks; items without an id or without words have no phrases. At least one block, maybe empty."""
    rows, words, any_ = [], 0, False
    named = benchmark.select(F.col(item).cast("string").alias("item"), F.encode(F.col(text), "UTF-8").alias("text"))
    for row in named.filter(F.col("item").isNotNull() & F.col("text").isNotNull()).toLocalIterator():
        own = words_of(bytes(row["text"]))
        if rows and words + len(own) > block_words:
            yield Phrases(rows, window)
            rows, words, any_ = [], 0, True
        rows.append((row["item"], own))
        words += len(own)
    if rows or not any_:
        yield Phrases(rows, window)


def matches(ids: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Starts and ends (in words) of all occurrences in a shard, and for each the (length class, phrase) it is of.

    `ids` has 0 where no word of the benchmark is and between documents.
    """
    none = np.empty(0, np.int64), np.empty(0, np.int64), []
    if not phrases.tables:
        return none
    edge = np.flatnonzero(np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]])))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= phrases.shortest
    begin, end = begin[long], end[long]
    if not len(begin):
        return none
    sizes = end - begin + 1  # with the break behind the run
    offset = np.cumsum(sizes) - sizes
    where = np.arange(sizes.sum()) + np.repeat(begin - offset, sizes)
    seq = ids[where]
    seq[offset + sizes - 1] = 0
    index = FmIndex(seq, len(phrases.ids) + 1)
    starts, ends, which = [], [], []
    for k, table in enumerate(phrases.tables):
        low, high = index.search(table)
        hit = np.flatnonzero(low < high)
        count = (high - low)[hit]
        rows = np.arange(count.sum()) + np.repeat(low[hit] - (np.cumsum(count) - count), count)
        at = where[index.locate(rows)]
        starts.append(at)
        ends.append(at + table.shape[1])
        which += list(zip(repeat(k), np.repeat(hit, count).tolist()))
    return np.concatenate(starts), np.concatenate(ends), which


def merged(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of set flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def text_spans(text: bytes, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code-point offsets in the text."""
    places = [m.span() for m in _WORD.finditer(text.lower())]
    out, at, chars = [], 0, 0
    for a, b in runs:
        first, last = places[a][0], places[b - 1][1]
        chars += len(text[at:first].decode())
        start = chars
        chars += len(text[first:last].decode())
        at = last
        out.append({"start": start, "end": chars})
    return out


def scan_shard(texts: list[bytes | None], phrases: Phrases, before: list | None) -> list[dict]:
    """The result columns of each document of a shard. `before`: (hits, items) of each that earlier blocks have found."""
    get = phrases.ids.get
    each = [np.array(list(map(get, words_of(t), repeat(0))), np.int64) for t in texts]
    sizes = np.array([len(x) for x in each])
    first = np.concatenate([[0], np.cumsum(sizes + 1)])  # one break behind each document
    ids = np.zeros(first[-1], np.int64)
    for x, at in zip(each, first):
        ids[at : at + len(x)] = x
    starts, ends, which = matches(ids, phrases)
    step = np.zeros(len(ids) + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, ends, -1)
    flags = np.cumsum(step[:-1]) > 0
    found: dict[int, set[str]] = {}
    for d, (k, p) in set(zip((np.searchsorted(first, starts, "right") - 1).tolist(), which)):
        found.setdefault(d, set()).update(phrases.owners[k][p])
    out = []
    for d, text in enumerate(texts):
        own = flags[first[d] : first[d] + sizes[d]]
        items = found.get(d, set())
        if before is not None:
            hits, names = before[d]
            items = items | set(names)
            for span in hits:
                own[span["start"] : span["end"]] = True
        n_hit = int(own.sum())
        runs = merged(own) if n_hit else []
        out.append(
            {
                "n_words": int(sizes[d]),
                "n_hit": n_hit,
                "n_items": len(items),
                "items": sorted(items),
                "hits": [{"start": a, "end": b} for a, b in runs],
                "spans": text_spans(text, runs) if runs else [],
                "contaminated": n_hit > 0 and SHARE * n_hit >= int(sizes[d]),
            }
        )
    return out


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows and columns of `docs` plus n_words, n_hit, n_items, items (ids as text, sorted), hits (runs of hit words),
    spans (the same as code-point offsets in the text), contaminated.

    A phrase is `window` consecutive words of an item, or the whole of a shorter item. NULL and empty texts have no words;
    a benchmark item without id or text is passed over, items of the same id count as one. With an empty benchmark nothing
    is hit. Columns of `docs` named like a result column are replaced. A document longer than a shard is one shard.
    """
    taken = set(RESULT.names)
    base = docs.select(*[c for c in docs.columns if c not in taken])
    schema = StructType([*base.schema.fields, *RESULT.fields])
    arrow = pa.schema([(f.name, _arrow_type(f.name)) for f in RESULT.fields])
    spark, out = docs.sparkSession, None
    width = len(base.columns)
    for phrases in blocks(benchmark, item, item_text, window, block_words):
        again = out is not None
        source = settle(out, "contamination") if again else base
        shared = spark.sparkContext.broadcast(phrases)

        def run(batches: Iterable[pa.RecordBatch], shared=shared, again=again) -> Iterator[pa.RecordBatch]:
            def emit() -> pa.RecordBatch:
                table = pa.Table.from_batches(held).combine_chunks()
                rows = scan_shard(texts, shared.value, before if again else None)
                made = pa.RecordBatch.from_pylist(rows, arrow)
                kept = [table.column(k).combine_chunks() for k in range(width)]
                kept = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in kept]
                return pa.RecordBatch.from_arrays([*kept, *made.columns], [*table.column_names[:width], *arrow.names])

            held, texts, before, size = [], [], [], 0
            for batch in batches:
                own = texts_of(batch.column(text))
                lengths = np.cumsum([len(t or b"") // 6 for t in own])
                at = 0
                while at < len(own):
                    room = shard_words - size + (lengths[at - 1] if at else 0)
                    to = max(at + 1, int(np.searchsorted(lengths, room, "right"))) if not held or room > 0 else at
                    held.append(batch.slice(at, to - at))
                    texts += own[at:to]
                    if again:
                        pairs = zip(batch.column("hits").to_pylist()[at:to], batch.column("items").to_pylist()[at:to])
                        before += pairs
                    size += int(lengths[to - 1] - (lengths[at - 1] if at else 0)) if to > at else 0
                    at = to
                    if at < len(own) or size >= shard_words:
                        yield emit()
                        held, texts, before, size = [], [], [], 0
            if texts:
                yield emit()

        out = source.mapInArrow(run, schema)
    return out


def _arrow_type(name: str) -> pa.DataType:
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    kinds = {"items": pa.list_(pa.string()), "hits": spans, "spans": spans, "contaminated": pa.bool_()}
    return kinds.get(name, pa.int64())


def cut_spans(text: str | None, spans: list[dict]) -> str | None:
    """The text without its hit spans."""
    if text is None:
        return None
    parts, at = [], 0
    for s in spans:
        parts.append(text[at : s["start"]])
        at = s["end"]
    return "".join([*parts, text[at:]])
