"""Language of a text: a bidirectional gated recurrent network over its bytes.

Every byte of a text is labelled. Texts are cut into segments of `SEGMENT` bytes that are run side by side, forwards and
backwards; each position gets a probability for each language, and a document's probabilities are their mean over all its
bytes. The network is trained in numpy by backpropagation through time on a bounded sample of labelled rows outside the
held-out fold; it sees bytes and nothing else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from cohortspark.llm.common import texts_of

FOLDS = 5
SAMPLE = 300  # documents of each language that the network is fitted on: those of the smallest key hashes
PIECES = 8  # segments taken of each, spread over its length
HIDDEN = 8
SEGMENT = 64  # bytes run in one piece, in training and prediction
LANES = 4096  # segments run side by side
STEPS, BATCH, RATE = 150, 512, 0.02
UNKNOWN = "und"
MANY = 4 << 20  # bytes of texts handled at a time

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m[0].isalpha() for m in _LETTER.finditer(text))  # the pattern also matches a few numerals


@dataclass
class Net:
    """Per direction (0 forwards, 1 backwards): input tables (3, 256, H) and recurrent matrices (3, H, H) of the gates update,
    reset and candidate; output matrices (2, H, L) and bias (L)."""

    languages: list[str]
    tables: np.ndarray
    inner: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 0) -> Net:
        rng = np.random.default_rng(seed)
        width = len(languages)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return cls(languages, draw(2, 3, 256, hidden, scale=0.3), draw(2, 3, hidden, hidden, scale=0.3), draw(2, hidden, width, scale=0.3), np.zeros(width, np.float32))

    def parameters(self) -> list[np.ndarray]:
        return [self.tables, self.inner, self.out, self.bias]


def squash(x: np.ndarray) -> np.ndarray:
    """x / (1 + |x|) in place: an S-curve from -1 to 1 in three plain operations, much cheaper than a tanh."""
    size = np.abs(x)
    size += 1
    x /= size
    return x


def gate(x: np.ndarray) -> np.ndarray:
    """The same curve from 0 to 1."""
    x = squash(x)
    x *= 0.5
    x += 0.5
    return x


def slope(y: np.ndarray) -> np.ndarray:
    """Derivative of `squash` where it has the value y."""
    return (1 - np.abs(y)) ** 2


def step(net: Net, way: int, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One byte further: the new state, and what the way back needs."""
    table, inner = net.tables[way], net.inner[way]
    z = gate(table[0].take(x, 0) + h @ inner[0])
    r = gate(table[1].take(x, 0) + h @ inner[1])
    u = h @ inner[2]
    n = r * u
    n += table[2].take(x, 0)
    squash(n)
    new = h - n
    new *= z
    new += n
    return new, z, r, u, n


def soft(logits: np.ndarray) -> np.ndarray:
    """Softmax over the first axis."""
    logits -= logits.max(0)
    np.exp(logits, out=logits)
    logits /= logits.sum(0)
    return logits


def run(net: Net, bytes_: np.ndarray, real: np.ndarray) -> np.ndarray:
    """Sums over the real positions of the language probabilities: bytes (T, B), real (T, B) -> (L, B)."""
    length, lanes = bytes_.shape
    hidden = net.inner.shape[-1]
    ahead = np.empty((length, lanes, hidden), np.float32)
    h = np.zeros((lanes, hidden), np.float32)
    for t in range(length):
        h = step(net, 0, bytes_[t], h)[0]
        ahead[t] = h
    h = np.zeros((lanes, hidden), np.float32)
    total = np.zeros((len(net.languages), lanes), np.float32)
    left, right = np.ascontiguousarray(net.out[0].T), np.ascontiguousarray(net.out[1].T)
    for t in range(length - 1, -1, -1):
        h = step(net, 1, bytes_[t], h)[0]
        p = soft(left @ ahead[t].T + right @ h.T + net.bias[:, None])
        p *= real[t]
        total += p
    return total


def loss_and_slopes(net: Net, bytes_: np.ndarray, real: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of all real positions, and its derivatives by backpropagation through time."""
    length, lanes = bytes_.shape
    width = net.inner.shape[-1]
    kept: list[list] = [[], []]
    states = np.zeros((2, length, lanes, width), net.inner.dtype)
    for way, order in ((0, range(length)), (1, range(length - 1, -1, -1))):
        h = np.zeros((lanes, width), net.inner.dtype)
        for t in order:
            new, *gates = step(net, way, bytes_[t], h)
            kept[way].append((t, h, *gates))
            states[way, t] = h = new
    logits = states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias
    logits -= logits.max(-1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(-1, keepdims=True)
    count = max(real.sum(), 1)
    lanes_ = np.arange(lanes)
    loss = -(np.log(np.maximum(p[:, lanes_, label], 1e-30)) * real).sum() / count
    g = p.copy()
    g[:, lanes_, label] -= 1
    g *= (real / count)[:, :, None]
    slopes = [np.zeros_like(x) for x in net.parameters()]
    slopes[3] += g.sum((0, 1))
    flat = bytes_.ravel()
    for way in (0, 1):
        slopes[2][way] = states[way].reshape(-1, width).T @ g.reshape(-1, g.shape[-1])
        d_out = g @ net.out[way].T
        inner, d_inner = net.inner[way], slopes[1][way]
        d_in = np.zeros((3, length, lanes, width), net.inner.dtype)
        back = np.zeros((lanes, width), net.inner.dtype)
        for t, h, z, r, u, n in reversed(kept[way]):
            d = d_out[t] + back
            d_n = d * (1 - z) * slope(n)
            d_u = d_n * r
            d_r = d_n * u * 0.5 * slope(2 * r - 1)
            d_z = d * (h - n) * 0.5 * slope(2 * z - 1)
            d_in[0, t], d_in[1, t], d_in[2, t] = d_z, d_r, d_n
            d_inner[0] += h.T @ d_z
            d_inner[1] += h.T @ d_r
            d_inner[2] += h.T @ d_u
            back = d * z + d_z @ inner[0].T + d_r @ inner[1].T + d_u @ inner[2].T
        for k in range(3):
            own = d_in[k].reshape(-1, width)
            for c in range(width):
                slopes[0][way, k, :, c] = np.bincount(flat, own[:, c], 256)
    return float(loss), slopes


def segments(texts: list[bytes], length: int = SEGMENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, real, owner): segments of all texts as columns, padded with zeros; owner is the text of each."""
    counts = np.array([-(-len(t) // length) for t in texts], np.int64)
    data = np.zeros((int(counts.sum()), length), np.uint8)
    real = np.zeros(data.shape, np.float32)
    at = 0
    for t, n in zip(texts, counts.tolist()):
        if n:
            data[at : at + n].reshape(-1)[: len(t)] = np.frombuffer(t, np.uint8)
            real[at : at + n].reshape(-1)[: len(t)] = 1
        at += n
    return np.ascontiguousarray(data.T), np.ascontiguousarray(real.T), np.repeat(np.arange(len(texts)), counts)


def probabilities(net: Net, texts: list[bytes]) -> np.ndarray:
    """Mean over all bytes of each text of the language probabilities: (texts, L); zeros for an empty text."""
    out = np.zeros((len(texts), len(net.languages)))
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) <= MANY):
            size += len(texts[to])
            to += 1
        own = texts[at:to]
        parts = [(k, t[x : x + MANY]) for k, t in enumerate(own) for x in range(0, len(t), MANY)]
        for a in range(0, len(parts), 1 if len(own) == 1 else max(1, len(parts))):
            some = parts[a : a + 1] if len(own) == 1 else parts
            data, real, owner = segments([t for _, t in some])
            names = np.array([k for k, _ in some])
            for b in range(0, data.shape[1], LANES):
                sums = run(net, np.ascontiguousarray(data[:, b : b + LANES]), np.ascontiguousarray(real[:, b : b + LANES]))
                np.add.at(out, at + names[owner[b : b + LANES]], sums.T)
        at = to
    return out / np.maximum([[len(t)] for t in texts], 1) if texts else out


def train(rows: list[tuple[bytes, str]], steps: int = STEPS) -> Net:
    """A network fitted on (text, language) rows: `PIECES` segments of each, Adam steps on batches balanced by language."""
    languages = sorted({lang for _, lang in rows})
    net = Net.fresh(languages)
    pieces: list[list[bytes]] = [[] for _ in languages]
    for text, lang in rows:
        last = max(0, len(text) - SEGMENT)
        for k in range(PIECES if last else 1):
            pieces[languages.index(lang)].append(text[last * k // PIECES :][:SEGMENT])
    if not languages:
        return net
    rng = np.random.default_rng(1)
    first = [np.zeros_like(x) for x in net.parameters()]
    second = [np.zeros_like(x) for x in net.parameters()]
    for k in range(1, steps + 1):
        label = rng.integers(len(languages), size=BATCH)
        batch = [pieces[y][rng.integers(len(pieces[y]))] or b" " for y in label]
        data, real, _ = segments(batch)
        _, slopes = loss_and_slopes(net, data, real, label)
        norm = np.sqrt(sum(float((s**2).sum()) for s in slopes))
        for x, s, m, v in zip(net.parameters(), slopes, first, second):
            s = s * min(1, 1 / max(norm, 1e-9))
            m += 0.1 * (s - m)
            v += 0.01 * (s * s - v)
            rate = RATE * (1 - 0.9 * k / steps)
            x -= (rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)).astype(x.dtype)
    return net


# --- on tables --------------------------------------------------------------------------------------------------------
def held_out(key: Column) -> Column:
    """Is the row in the fold that nothing is learned from? CRC-32 of the key as text, modulo 5, is 0."""
    return F.crc32(key.cast("string").cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Net:
    """Train on at most `sample` documents of each language, those of the smallest key hashes outside the held-out fold.

    Two passes: languages with their counts (a row for each language), then the rows below a hash limit that lets about
    twice the sample through. Rows without key, text or language teach nothing.
    """
    usable = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    usable = usable.filter(F.col("k").isNotNull() & F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("k")))
    counts = {r["l"]: r["c"] for r in usable.groupBy("l").agg(F.count(F.lit(1)).alias("c")).collect()}
    part = F.pmod(F.xxhash64("k"), F.lit(1 << 30)) / float(1 << 30)
    limit = F.lit(1.0)
    for name, count in counts.items():
        limit = F.when(F.col("l") == name, min(1.0, (2 * sample + 20) / count)).otherwise(limit)
    rows = usable.filter(part < limit).select(F.xxhash64("k").alias("h"), "k", "t", "l").collect() if counts else []
    chosen: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["h"] % (1 << 30), r["k"], r["t"])):
        if len(own := chosen.setdefault(r["l"], [])) < sample:
            own.append((r["t"].encode(), r["l"]))
    return train([x for name in sorted(chosen) for x in chosen[name]])


def predict(docs: DataFrame, net: Net, text: str = "text") -> DataFrame:
    """The rows and columns of `docs` plus lang_pred and score (0 to 1, the mean probability of that language).

    NULL texts, texts without a letter, and all texts where no language was learned are `und` with score 0. Repeated rows
    are labelled alike; columns of `docs` named like a result column are replaced.
    """
    result = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    names = [c for c in docs.columns if c not in {f.name for f in result}]
    rows = docs.select(*names)
    shared, at = docs.sparkSession.sparkContext.broadcast(net), names.index(text)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            texts = texts_of(batch.column(at))
            known = [k for k, t in enumerate(texts) if t and net.languages and has_letter(t.decode())]
            best: list[str] = [UNKNOWN] * len(texts)
            score = [0.0] * len(texts)
            for k, p in zip(known, probabilities(net, [texts[k] for k in known])):
                best[k], score[k] = net.languages[int(p.argmax())], float(min(1.0, p.max()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(score, pa.float64())], [*names, "lang_pred", "score"])

    return rows.mapInArrow(label, StructType([*rows.schema.fields, *result]))
