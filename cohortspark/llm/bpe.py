"""Byte-level BPE: encoding by a lazily determinised transducer, decoding as a stream.

Merging by rank has two properties that make it a finite-state job. Cutting the last token off the encoding of a text leaves
the encoding of the rest, and a sequence of tokens is an encoding exactly if each pair of neighbours is (merging the joined
bytes of the pair gives the pair back). So, reading bytes from the left, it is enough to follow every place where a token
may have begun: how far the bytes since then lead down the trie of tokens, and which token ended there. Those sets are the
states; each transition is worked out when it is first taken. A token goes out as soon as all places still open agree on it,
which is after at most a token's length of further bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from cohortspark.llm.common import texts_of, worker_cache

MAX_STATES = 150_000  # about 400 bytes each, a worker
MAX_PIECES = 400_000  # about 170 bytes each
NEVER = 1 << 62
BLOCK_PIECES = 65_536  # pieces or ids handled at a time, so that very long texts need no memory of their size


# --- the pieces a text is cut into before merging ---------------------------------------------------------------------
def _ranges(wanted: str, limit: int) -> str:
    """A character class body of all code points below `limit` whose category begins with `wanted`."""
    parts, start = [], None
    for code in range(limit + 1):
        inside = code < limit and unicodedata.category(chr(code))[0] == wanted
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            parts.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(parts)


# The characters with the White_Space property, and the endings that stand alone in the pattern.
SPACES = "\\t-\\r \\x85\\xa0"
WIDE_SPACES = "\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


def piece_pattern(wide: bool = True) -> re.Pattern[str]:
    """The pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ for the standard library.

    Not `wide`: for texts whose characters are all below U+0100, several times faster.
    """
    limit = sys.maxunicode + 1 if wide else 256
    letters, numbers = _ranges("L", limit), _ranges("N", limit)
    blank = SPACES + WIDE_SPACES if wide else SPACES
    return re.compile(
        f" ?[{letters}]+|{ENDINGS}| ?[{numbers}]+| ?[^{blank}{letters}{numbers}]+|[{blank}]+(?![^{blank}])|[{blank}]+"
    )


def is_narrow(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


# --- the transducer ---------------------------------------------------------------------------------------------------
class Transducer:
    """Encodes pieces of bytes by a rank table; states and transitions appear as they are needed."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.max_states = max_states
        self.next: dict[int, int] = {}  # the trie: node and byte -> node
        self.ends = [-1]  # the token that ends at a node
        self.inner = bytearray(1)  # does a node lead on?
        for token, rank in ranks.items():
            node = 0
            for b in token:
                child = self.next.get(node << 8 | b)
                if child is None:
                    child = self.next[node << 8 | b] = len(self.ends)
                    self.inner[node] = 1
                    self.inner.append(0)
                    self.ends.append(-1)
                node = child
            self.ends[node] = rank
        self.pairs: dict[int, bool] = {}
        self.joins: dict[int, list[tuple[int, bytes, bytes]]] = {}
        self.states: dict[bytes, int] = {}
        self.members: list[bytes] = []
        self.moves: dict[int, int] = {}  # by state and byte: the next state
        self.outs: dict[int, tuple[int, ...]] = {}  # by state and byte, where there are any: the tokens that go out
        self.finals: list[tuple[int, ...]] = []
        self.shared: dict[tuple[int, ...], tuple[int, ...]] = {}
        self._clear()

    def _clear(self) -> None:
        for known in (self.states, self.members, self.moves, self.outs, self.finals, self.shared):
            known.clear()
        self.start = self._state(array("i", (0, -1, 0)).tobytes(), ())

    def _state(self, members: bytes, final: tuple[int, ...]) -> int:
        """`members`: trie node, token before, number of tokens not yet out and these tokens, of each open place, the oldest
        first; packed, as there are many states. `final`: the tokens of the youngest place, the end of what was read."""
        state = self.states.get(members)
        if state is None:
            state = self.states[members] = len(self.members)
            self.members.append(members)
            self.finals.append(self._one(final))
        return state

    def _one(self, tokens: tuple[int, ...]) -> tuple[int, ...]:
        return self.shared.setdefault(tokens, tokens) if len(tokens) == 1 else tokens

    def _forget(self, state: int) -> int:
        """Only `state` stays; its new number."""
        members, final = self.members[state], self.finals[state]
        self._clear()
        return self._state(members, final)

    def _steps(self, token: int) -> list[tuple[int, bytes, bytes]]:
        """How a token comes about from its bytes: the rank of each join, and the first and last part before it."""
        known = self.joins.get(token)
        if known is None:
            piece, ranks, known = self.tokens[token], self.ranks, []
            parts = [piece[k : k + 1] for k in range(len(piece))]
            while len(parts) > 1:
                rank, at = min((ranks.get(parts[k] + parts[k + 1], NEVER), k) for k in range(len(parts) - 1))
                known.append((rank, parts[0], parts[-1]))
                if rank == NEVER:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            else:
                known.append((NEVER, piece, piece))
            self.joins[token] = known
        return known

    def follows(self, before: int, token: int) -> bool:
        """Can `token` stand behind `before` (-1: at the start)? The joins inside each of the two happen by rank; the pair
        stands unless the last part of the one and the first part of the other can be joined before the next of those."""
        key = (before + 1) << 32 | token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 2 * self.max_states:
                self.pairs.clear()
            right = self._steps(token)
            known = right[-1][1] == self.tokens[token]
            if known and before >= 0:
                left, ranks, i, j = self._steps(before), self.ranks, 0, 0
                while True:
                    (a, _, tail), (b, head, _) = left[i], right[j]
                    across = ranks.get(tail + head, NEVER)
                    if across < a and across <= b:
                        known = False
                        break
                    if a == b == NEVER:
                        break
                    if a <= b:
                        i += 1
                    else:
                        j += 1
            self.pairs[key] = known
        return known

    def _move(self, key: int) -> int:
        next_, ends, inner, byte, open_, ended = self.next, self.ends, self.inner, key & 255, [], None
        flat, at = memoryview(self.members[key >> 8]).cast("i").tolist(), 0
        while at < len(flat):
            node, before, begin = flat[at], flat[at + 1], at + 3
            at = begin + flat[at + 2]
            child = next_.get(node << 8 | byte)
            if child is not None:
                if ended is None and ends[child] >= 0 and self.follows(before, ends[child]):
                    ended = (0, ends[child], [*flat[begin:at], ends[child]])
                if inner[child]:
                    open_.append((child, before, flat[begin:at]))
        open_.append(ended)
        agreed = open_[0][2]
        same = len(agreed)
        if same:
            for _, _, pending in open_:
                same = min(same, len(pending))
                while same and pending[:same] != agreed[:same]:
                    same -= 1
        packed: list[int] = []
        for node, before, pending in open_:
            packed += (node, before, len(pending) - same)
            packed += pending[same:]
        state = self.moves[key] = self._state(array("i", packed).tobytes(), tuple(open_[-1][2][same:]))
        if same:
            self.outs[key] = self._one(tuple(agreed[:same]))
        return state

    def encode(self, piece: bytes) -> list[int]:
        state, out, moves, outs = self.start, [], self.moves, self.outs
        for byte in piece:
            key = state << 8 | byte
            state = moves.get(key, -1)
            if state < 0:
                if len(self.members) > self.max_states:
                    key = self._forget(key >> 8) << 8 | byte
                state = self._move(key)
            if key in outs:
                out += outs[key]
        out += self.finals[state]
        return out


# --- decoding ---------------------------------------------------------------------------------------------------------
def _utf8_steps() -> list[list[int]]:
    """Transitions of a UTF-8 reader by state and byte. 0: between characters; -1: the byte cannot stand here."""
    # States: 1, 2, 3 continuation bytes to come; 4 and 5 behind E0 and ED, 6 and 7 behind F0 and F4, whose next is narrower.
    table = [[-1] * 256 for _ in range(8)]

    def put(state: int, low: int, high: int, to: int) -> None:
        table[state][low : high + 1] = [to] * (high + 1 - low)

    put(0, 0x00, 0x7F, 0), put(0, 0xC2, 0xDF, 1), put(0, 0xE0, 0xEF, 2), put(0, 0xF0, 0xF4, 3)
    put(0, 0xE0, 0xE0, 4), put(0, 0xED, 0xED, 5), put(0, 0xF0, 0xF0, 6), put(0, 0xF4, 0xF4, 7)
    put(1, 0x80, 0xBF, 0), put(2, 0x80, 0xBF, 1), put(3, 0x80, 0xBF, 2)
    put(4, 0xA0, 0xBF, 1), put(5, 0x80, 0x9F, 1), put(6, 0x90, 0xBF, 2), put(7, 0x80, 0x8F, 2)
    return table


_STEPS = _utf8_steps()


class Utf8Stream:
    """Bytes in, text out, holding back an unfinished character until the bytes that complete it arrive."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes, last: bool = False) -> str:
        data = self.held + data
        cut = len(data)
        if not last:
            state, begun = 0, cut
            at = max(0, cut - 3)
            while at < cut and 0x80 <= data[at] < 0xC0:  # find where a character begins
                at += 1
            for k in range(at, cut):
                if state == 0:
                    begun = k
                state = _STEPS[state][data[k]]
                if state < 0:
                    state, begun = max(0, _STEPS[0][data[k]]), k
            if state:
                cut = begun
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")


# --- on tables --------------------------------------------------------------------------------------------------------
def read_ranks(lines: Iterable[bytes]) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


class Codec:
    """A rank table with its transducer and a bounded memory of pieces already encoded, as text of comma-joined ids."""

    def __init__(self, ranks: dict[bytes, int], pieces: int | None = None):
        self.pieces = pieces or MAX_PIECES
        self.transducer = Transducer(ranks)
        self.wide, self.narrow = piece_pattern(), piece_pattern(wide=False)
        self.bytes_of = {str(i): t for t, i in ranks.items()}
        self.known: dict[str, str] = {}

    def _ids(self, pieces: list[str]) -> str:
        known = self.known
        try:
            return ",".join([known[p] for p in pieces])
        except KeyError:
            if len(known) > self.pieces:  # forget the oldest, down to three quarters
                for p in list(islice(known, len(known) - self.pieces * 3 // 4)):
                    del known[p]
            encode = self.transducer.encode
            for p in pieces:
                if p not in known:
                    known[p] = ",".join(map(str, encode(p.encode())))
            return ",".join([known[p] for p in pieces])

    def encode(self, text: str) -> Iterator[str]:
        """The ids of a text as comma-joined decimals, in blocks."""
        pattern = self.narrow if is_narrow(text) else self.wide
        if len(text) <= 4 * BLOCK_PIECES:
            if text:
                yield self._ids(pattern.findall(text))
            return
        matches = pattern.finditer(text)
        while pieces := [m[0] for m in islice(matches, BLOCK_PIECES)]:
            yield self._ids(pieces)

    def decode(self, blocks: Iterable[str]) -> Iterator[str]:
        """The text of blocks of ids."""
        stream, bytes_of = Utf8Stream(), self.bytes_of
        for block in blocks:
            yield stream.feed(b"".join([bytes_of[i] for i in block.split(",")]))
        yield stream.feed(b"", last=True)


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], text: str = "text", keep_ids: bool = True, pieces: int | None = None) -> DataFrame:
    """The columns of `docs` (but for `text`) plus n_tokens, ids (array of int, where asked for), ids_sha256 (of the decimal
    ids joined by commas) and decoded_sha256 (of the bytes that the ids decode to).

    NULL and empty texts have no tokens; special tokens do not exist, their names are ordinary text. Columns of `docs` named
    like a result column are replaced. The rank table is bounded (a vocabulary) and broadcast. `pieces`: encoded pieces that a
    worker remembers, MAX_PIECES by default; fewer take less memory and more time, the result is the same.
    """
    result = [StructField("n_tokens", LongType())]
    result += [StructField("ids", ArrayType(IntegerType()))] if keep_ids else []
    result += [StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    names = [c for c in docs.columns if c != text and c not in {f.name for f in result}]
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    rows = docs.select(*names, text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_cache(f"bpe-{key}-{pieces}", lambda: Codec(shared.value, pieces))
        for batch in batches:
            counts, ids_digest, text_digest = [], [], []
            own, ends = array("i"), [0]  # the ids of all texts, and where each text's end
            for t in texts_of(batch.column(len(names))):
                ids, back = hashlib.sha256(), hashlib.sha256()
                count = 0

                def watched() -> Iterator[str]:
                    nonlocal count
                    for block in codec.encode((t or b"").decode()):
                        ids.update(f",{block}".encode() if count else block.encode())
                        count += block.count(",") + 1
                        if keep_ids:
                            own.extend(map(int, block.split(",")))
                        yield block

                for part in codec.decode(watched()):
                    back.update(part.encode())
                counts.append(count)
                ends.append(len(own))
                ids_digest.append(ids.hexdigest())
                text_digest.append(back.hexdigest())
            made = [pa.array(counts, pa.int64())]
            made += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.asarray(own)))] if keep_ids else []
            made += [pa.array(ids_digest, pa.string()), pa.array(text_digest, pa.string())]
            yield pa.RecordBatch.from_arrays(batch.columns[: len(names)] + made, [*names, *(f.name for f in result)])

    return rows.mapInArrow(run, StructType([*(rows.schema[c] for c in names), *result]))


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file at `path`, a file of the driver's installation (a vocabulary, some hundred kilobytes)."""
    with open(path, "rb") as f:
        return read_ranks(f)
