"""Token counts of texts under a byte-level BPE vocabulary, by rank-synchronous merging of ragged arrays.

Texts are cut into pre-tokens; the distinct pre-tokens of a block lie one after another in a flat numpy array of symbols. In
each round every sequence finds its pair of lowest rank and merges all places of it at once, left to right, and sequences
without a pair that merges leave the array. What is left of a sequence is its number of tokens. A pre-token above
`LONG` bytes would need a round for each rank that occurs in it, so it is swept by rank instead: places wait in a bucket per
rank, the lowest bucket is merged whole, and the new pairs beside the merged places go to their buckets.

Merging all places of a pair at once needs that a merge never makes a pair of lower rank. That holds where the two parts of
each merge are single bytes or made by earlier merges, which `Merges` checks.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from cohortspark.llm.bpe import is_narrow, piece_pattern
from cohortspark.llm.common import texts_of, worker_cache

# Fixed value: how byte-level vocabularies of this kind cut texts into pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 256  # bytes of a pre-token that is swept by rank
KEPT_PIECES = 300_000  # pre-tokens whose counts a worker remembers,
KEPT_LENGTH = 64  # of at most so many characters each
BLOCK_PIECES = 131_072  # pre-tokens handled at a time
LIMIT = 512  # tokens: `over_limit`
NEVER = np.int32(2**31 - 1)
SLOT_BITS = 20


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself where it is visible Latin-1, else the next one from U+0100."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Merges:
    """The merges of a vocabulary as arrays: symbols of single bytes, and rank and result of a pair."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        if missing := [b for b, c in enumerate(letters) if c not in vocabulary]:
            raise ValueError(f"not a byte-level vocabulary: no symbol for bytes {missing[:5]}")
        made = set(letters)
        for a, b in merges:
            if a not in made or b not in made or a + b in made:
                raise ValueError(f"merge {a!r} {b!r} uses what is not made yet, or makes a symbol again")
            made.add(a + b)
        self.base = np.array([vocabulary[c] for c in letters], np.int64)
        self.size = max(vocabulary.values()) + 1
        self.left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        self.right = np.array([vocabulary[b] for _, b in merges], np.int64)
        self.result = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        # One merge a slot; the few others of a slot are looked up in a sorted list.
        keys = self.left * self.size + self.right
        slots = self._slot(keys)
        first = np.unique(slots, return_index=True)[1]
        self.slots = np.full(1 << SLOT_BITS, len(keys), np.int32)
        self.slots[slots[first]] = first
        rest = np.setdiff1d(np.arange(len(keys)), first)
        rest = rest[np.argsort(keys[rest])]
        self.rest_keys, self.rest_ranks = np.append(keys[rest], -1), np.append(rest, NEVER).astype(np.int32)
        self.shared = np.zeros(1 << SLOT_BITS, bool)
        self.shared[slots[rest]] = True
        self.keys = np.append(keys, -1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, `NEVER` where it does not merge."""
        keys = left * self.size + right
        slots = self._slot(keys)
        found = self.slots[slots]
        out = np.where(self.keys[found] == keys, found, NEVER)
        if len(self.rest_keys) > 1:
            odd = np.flatnonzero(self.shared[slots] & (out == NEVER))
            at = np.searchsorted(self.rest_keys[:-1], keys[odd])
            out[odd] = np.where(self.rest_keys[at] == keys[odd], self.rest_ranks[at], NEVER)
        return out

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = sizes.copy()
        short = np.flatnonzero((sizes > 1) & (sizes <= LONG))
        if len(short):
            out[short] = self._rounds([pieces[k] for k in short], sizes[short])
        for k in np.flatnonzero(sizes > LONG):
            out[k] = self._sweep(self.base[np.frombuffer(pieces[k], np.uint8)])
        return out

    def _rounds(self, pieces: list[bytes], sizes: np.ndarray) -> np.ndarray:
        """Rank-synchronous rounds over all sequences at once."""
        symbols = self.base[np.frombuffer(b"".join(pieces), np.uint8)]
        out, own = sizes.copy(), np.arange(len(sizes))
        while len(own):
            ends = np.cumsum(sizes)
            starts = ends - sizes
            ranks = np.full(len(symbols), NEVER, np.int32)
            ranks[:-1] = self.ranks(symbols[:-1], symbols[1:])
            ranks[ends - 1] = NEVER
            lowest = np.minimum.reduceat(ranks, starts)
            going = lowest != NEVER
            if not going.all():
                out[own[~going]] = sizes[~going]
                stay = np.repeat(going, sizes)
                symbols, ranks = symbols[stay], ranks[stay]
                own, sizes, lowest = own[going], sizes[going], lowest[going]
                if not len(own):
                    break
            number = np.repeat(np.arange(len(own)), sizes)
            at = np.flatnonzero(ranks == lowest[number])
            at = at[alternate(at[1:] == at[:-1] + 1)]
            symbols[at] = self.result[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols = symbols[keep]
            sizes = sizes - np.bincount(number[at], minlength=len(own))
        return out

    def _sweep(self, symbols: np.ndarray) -> int:
        """Tokens of one long sequence, all places of the lowest rank at a time."""
        n = len(symbols)
        following, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # n and -1: none
        left = n
        buckets: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def put(places: np.ndarray) -> None:
            ranks = self.ranks(symbols[places], symbols[following[places]])
            places, ranks = places[ranks != NEVER], ranks[ranks != NEVER]
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranks)]):
                if a < b:
                    rank = int(ranks[a])
                    if rank not in buckets:
                        buckets[rank] = []
                        heapq.heappush(waiting, rank)
                    buckets[rank].append(places[a:b])

        put(np.arange(n - 1))
        while waiting:
            rank = heapq.heappop(waiting)
            at = np.unique(np.concatenate(buckets.pop(rank)))
            # A place may be gone or have another neighbour by now. Symbols of gone places are -1.
            at = at[(symbols[at] == self.left[rank]) & (following[at] < n)]
            at = at[symbols[following[at]] == self.right[rank]]
            if not len(at):
                continue
            if self.left[rank] == self.right[rank]:
                at = at[alternate(following[at[:-1]] == at[1:])]
            gone = following[at]
            symbols[at], symbols[gone] = self.result[rank], -1
            after = following[gone]
            following[at] = after
            inner = after < n
            before[after[inner]] = at[inner]
            left -= len(at)
            ahead = before[at]
            put(np.unique(np.concatenate([at[inner], ahead[ahead >= 0]])))
        return left


def alternate(joined: np.ndarray) -> np.ndarray:
    """Which members to take of chains in which neighbours overlap (`joined`: does a member overlap the one before?)."""
    place = np.arange(len(joined) + 1)
    begin = np.ones(len(place), bool)
    begin[1:] = ~joined
    return (place - np.maximum.accumulate(np.where(begin, place, 0))) % 2 == 0 if len(place) else begin


class Counter:
    """Counts tokens of texts; remembers the counts of a bounded number of short pre-tokens."""

    def __init__(self, merges: Merges, special: list[str]):
        self.merges = merges
        self.special = re.compile("|".join(re.escape(s) for s in sorted(special, key=lambda s: (-len(s), s)))) if special else None
        self.narrow, self.wide = piece_pattern(wide=False), regex.compile(PATTERN)
        self.known: dict[str, int] = {}

    def learn(self, pieces: set[str]) -> None:
        """Add the counts of pieces not yet known."""
        some = list(pieces)
        self.known |= zip(some, self.merges.count([p.encode() for p in some]).tolist())

    def forget(self, new: set[str]) -> None:
        """Drop long pieces among the new ones, and the oldest quarter where too many are known."""
        for p in new:
            if len(p) > KEPT_LENGTH:
                del self.known[p]
        if len(self.known) > KEPT_PIECES:
            for p in list(islice(self.known, len(self.known) - KEPT_PIECES * 3 // 4)):
                del self.known[p]

    def parts(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text between special tokens, in blocks."""
        for part in [text] if self.special is None else self.special.split(text):
            pattern = self.narrow if is_narrow(part) else self.wide
            if len(part) <= 4 * BLOCK_PIECES:
                yield pattern.findall(part)
            else:
                matches = pattern.finditer(part)
                while pieces := [m[0] for m in islice(matches, BLOCK_PIECES)]:
                    yield pieces

    def count(self, texts: Iterable[str]) -> list[int]:
        """Tokens of each text. Pre-tokens of several texts are merged in one go."""
        totals: list[int] = []
        block: list[tuple[int, list[str]]] = []
        size = 0

        def flush() -> None:
            new = set().union(*(p for _, p in block)) - self.known.keys()
            self.learn(new)
            for k, pieces in block:
                totals[k] += sum(map(self.known.__getitem__, pieces))
            self.forget(new)
            block.clear()

        for k, text in enumerate(texts):
            totals.append(len(self.special.findall(text)) if self.special is not None else 0)
            for pieces in self.parts(text):
                block.append((k, pieces))
                size += len(pieces)
                if size >= BLOCK_PIECES:
                    flush()
                    size = 0
        flush()
        return totals


def load_vocabulary(path: str) -> dict:
    """The tokenizer file at `path` (of the driver's installation): its vocabulary, merges and special tokens.

    Refused is what would change counts and is not done here: normalizers, prefix spaces, other pre-tokenizers, and special
    tokens that take in blanks or only match whole words.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, cut = file["model"], file["pre_tokenizer"] or {}
    added = file["added_tokens"]
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain = plain and file["normalizer"] is None and cut.get("type") == "ByteLevel" and not cut["add_prefix_space"] and cut["use_regex"]
    if not plain or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"{path}: only plain byte-level BPE is counted")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocabulary": model["vocab"], "merges": merges, "special": [t["content"] for t in added]}


def count_tokens(docs: DataFrame, vocabulary: dict, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The columns of `docs` (but for `text`) plus n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens).

    NULL and empty texts have no bytes and no tokens. The name of a special token inside a text is that one token. Bytes that
    are no UTF-8 count as U+FFFD in n_tokens. Repeated rows are counted each. Columns of `docs` named like a result column are
    replaced. Nothing is shuffled; the vocabulary is bounded and broadcast, texts of any length are handled in blocks.
    """
    result = [StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())]
    names = [c for c in docs.columns if c != text and c not in {f.name for f in result}]
    key = hashlib.sha256(json.dumps(vocabulary, sort_keys=True).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(*names, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def build() -> Counter:
            return Counter(Merges(shared.value["vocabulary"], shared.value["merges"]), shared.value["special"])

        counter = worker_cache(f"token-counts-{key}", build)
        for batch in batches:
            texts = [t or b"" for t in texts_of(batch.column(len(names)))]
            tokens = np.array(counter.count(t.decode("utf-8", "replace") for t in texts), np.int64)
            made = [pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(names)] + made, [*names, *(f.name for f in result)])

    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in names), *result]))
