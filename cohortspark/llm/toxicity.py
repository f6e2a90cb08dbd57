"""Toxicity scores of texts after undoing disguises with a noisy-channel model.

A disguised word ("1d10t", "s t u p i d", "cl*wn", "moooron") is a lattice of letters it may stand for. Viterbi finds the
reading that is likeliest under a trigram model of letters, which is counted over all documents, and the channel's costs.
A logistic model over the words of the restored text and their beginnings gives the score. It is fitted on a bounded sample
of labelled rows outside the held-out fold; everything else covers all rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from cohortspark.llm.common import share_of, texts_of, worker_cache
from cohortspark.llm.sketch import slices, total

FOLDS = 5
SAMPLE_PER_CLASS = 2000  # bound of the fitted sample: labelled rows taken of each class, those of the smallest hashes
MAX_FEATURES = 10_000
MIN_TEXTS = 4  # texts of the sample a feature must be in
STEPS, RATE, DECAY = 300, 1.0, 1e-5
LASSO = 4  # texts whose error a feature must account for
KNOWN = 300_000  # words a worker remembers
BLOCK = 1 << 20  # characters of a text handled at a time
SYMBOLS = 64
LM_BITS = 18

# Letters that a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "aeiou",
}
BETWEEN = "._-~*'`’·"
READ_COST, WILD_COST, DROP_COST, TWICE_COST, KEEP_COST = -1.0, -2.5, -0.5, -1.0, -9.0

_EDGE = ".,;:!?\"'()[]{}<>«»„“”…¿¡"
_JUNK = re.compile(r"^([!$*#&%@_=~^+|-])\1{2,}|([!$*#&%@_=~^+|-])\2{2,}$")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_LETTER = re.compile(r"[^\W\d_]")
_SIGN = re.compile(r"[\d@$!|+(€£¡*#._~'`’·-]")
_LEADING = re.compile(r"[\d@$!|+(€£¡*#][^\W_]*[^\W\d_]")
_CLOSING = re.compile(r"[\d@$|+(€£*#]")
_PLAIN = re.compile(r"[^\W_]*")
SPACED = re.compile(r"(?<!\S)[^\W_](?:[ ._*~-][^\W_]){2,}(?!\S)")
_LATTICE = 48  # characters of a word after which letters that no longer depend on what follows are put aside


def symbol_table() -> np.ndarray:
    """Symbol of each code point below 0x180 and of all above: 0 no letter, 1 a rarer letter, then a-z and ß-ÿ."""
    table = np.zeros(0x181, np.uint8)
    for code in range(0x180):
        if chr(code).isalpha():
            table[code] = 2 + code - 97 if 97 <= code < 123 else 28 + code - 0xDF if 0xDF <= code <= 0xFF else 1
    table[0x180] = 1
    return table


_TABLE = symbol_table()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    return _TABLE[np.minimum(codes, 0x180)]


def letter_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of letter trigrams over the whole texts of all documents; 2 ** 18 counts whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << LM_BITS, np.int64)
        for batch in batches:
            texts = [t.decode("utf-8", "replace") for t in texts_of(batch.column(0)) if t]
            parts, size = [], 0
            for k, t in enumerate(texts):
                for at in range(0, len(t), BLOCK):  # a cut in a very long text gets a word's end
                    parts.append(t[at : at + BLOCK])
                    size += len(parts[-1])
                    if size > BLOCK:
                        add(counts, parts)
                        parts, size = [], 0
            add(counts, parts)
        rows = list(slices(np.minimum(counts, 2**32 - 1)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["slot", "counts"])

    def add(counts: np.ndarray, parts: list[str]) -> None:
        s = symbols(" ".join(["", "", *parts, ""])).astype(np.int64)
        counts += np.bincount((s[:-2] << 12) | (s[1:-1] << 6) | s[2:], minlength=1 << LM_BITS)

    return total(docs.select(text).mapInArrow(run, "slot int, counts binary"), LM_BITS)


def letter_model(counts: np.ndarray) -> np.ndarray:
    """Log probability of a symbol behind two others, interpolated with the shorter contexts. Shape (64, 64, 64)."""
    three = counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS).astype(np.float64)
    two, one = three.sum(0), three.sum((0, 1))
    share = lambda x: x / np.maximum(x.sum(-1, keepdims=True), 1)
    p = 0.7 * share(three) + 0.2 * share(two)[None] + 0.09 * share(one)[None, None] + 0.01 / SYMBOLS
    return np.log(p).astype(np.float32)


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each stretch of a word the letters it may stand for and their costs; "" drops it."""
    out, k = [], 0
    while k < len(word):
        c, run = word[k], 1
        while k + run < len(word) and word[k + run] == c:
            run += 1
        if c.isalpha():
            if run >= 3:
                out.append([(c, 0.0), (c + c, TWICE_COST)])
            else:
                out += [[(c, 0.0)]] * run
        else:
            wild = c in "*#"
            own = [(x, WILD_COST if wild else READ_COST) for x in STANDS_FOR.get(c, "")]
            if run >= 3 or c in BETWEEN or c.isspace():
                own.append(("", DROP_COST))
                run_used = run
            else:
                run_used = 1
            out.append(own or [("", KEEP_COST)])
            if c.isdigit():
                out[-1] = out[-1] + [("", KEEP_COST)]
            k += run_used
            continue
        k += run
    return out


def read(word: str, model: np.ndarray) -> str:
    """The likeliest letters of a disguised word (Viterbi; a state is the last two symbols)."""
    done = []
    best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    at = 0
    while at < len(word):
        to = min(len(word), at + _LATTICE)
        while to < len(word) and word[to] == word[to - 1]:  # a run is one stretch of the lattice
            to += 1
        for options in lattice(word[at:to]):
            after: dict[tuple[int, int], tuple[float, str]] = {}
            for (a, b), (score, path) in best.items():
                for letters, cost in options:
                    s, x, y = score + cost, a, b
                    for c in letters:
                        z = int(_TABLE[min(ord(c), 0x180)])
                        s += float(model[x, y, z])
                        x, y = y, z
                    if (x, y) not in after or s > after[x, y][0]:
                        after[x, y] = (s, path + letters)
            best = after
        at = to
        if at < len(word):  # what all open readings agree on is settled
            same = commonprefix([path for _, path in best.values()])
            done.append(same)
            best = {state: (score, path[len(same) :]) for state, (score, path) in best.items()}
    done.append(max((s + float(model[a, b, 0]), p) for (a, b), (s, p) in best.items())[1])
    return "".join(done)


def odd(word: str) -> bool:
    """Does a token look disguised: a sign between letters, in front of them, or behind them? Linear in its length."""
    if not (first := _LETTER.search(word)):
        return False
    backwards = word[::-1]
    last = len(word) - 1 - _LETTER.search(backwards).start()
    if _SIGN.search(word, first.start() + 1, last) or _LEADING.match(word):
        return True
    return bool(_CLOSING.match(backwards) and _LETTER.search(_PLAIN.match(backwards, 1)[0]))


def trimmed(token: str) -> str:
    """A lower-cased token without punctuation at its ends and without runs of one sign there."""
    token = token.strip(_EDGE)
    if token and not (token[0].isalnum() and token[-1].isalnum()):
        token = _JUNK.sub("", token).strip(_EDGE)
    return token


def restored(token: str, model: np.ndarray) -> str:
    """The plain word that a lower-cased token stands for; a token without signs of disguise is itself."""
    word = token if token.isalpha() else trimmed(token)
    if word.isalpha():
        return read(word, model) if _TRIPLE.search(word) else word
    return read(word, model) if odd(word) else word


def restore(text: str | None, model: np.ndarray) -> str | None:
    """A text in lower case with every disguised word restored."""
    if text is None:
        return None
    text = SPACED.sub(lambda m: read(m[0], model), text.lower())
    return re.sub(r"\S+", lambda m: restored(m[0], model), text)


def features(word: str) -> tuple[str, ...]:
    """What the score sees of a word: itself, and how it begins."""
    return (word, f"{word[:4]}-", f"{word[:5]}-") if len(word) > 3 else (word,) if word else ()


@dataclass
class Model:
    """Letter model, feature weights and bias; `folds` of which number 0 was held out."""

    letters: np.ndarray
    weights: dict[str, float]
    bias: float
    name: str = field(init=False)

    def __post_init__(self) -> None:
        body = repr(sorted(self.weights.items())) + repr(self.bias)
        self.name = hashlib.sha256(body.encode() + self.letters.tobytes()).hexdigest()


class Scorer:
    """A model with a bounded memory of words: the weighted features of each (mostly none)."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[tuple[str, ...], bool]] = {}

    def word(self, token: str) -> tuple[tuple[str, ...], bool]:
        if len(self.known) >= KNOWN:
            self.known.clear()
        plain = restored(token, self.model.letters)
        found = tuple([f for f in features(plain) if f in self.model.weights]), plain != token and plain != trimmed(token)
        self.known[token] = found
        return found

    def text(self, text: str) -> tuple[float, int]:
        """Score of a whole text, and how many different disguised words were restored."""
        seen: set[str] = set()
        changed: set[str] = set()
        known = self.known
        for part in blocks(text):
            part = part.lower()
            tokens = set(part.split())
            if spaced := SPACED.findall(part):
                changed.update(spaced)
                tokens.update(read(s, self.model.letters) for s in spaced)
            for token in tokens:
                found = known.get(token) or self.word(token)
                if found[0]:
                    seen.update(found[0])
                if found[1]:
                    changed.add(token)
        z = self.model.bias + sum(self.model.weights[f] for f in sorted(seen))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500)))), len(changed)


def blocks(text: str) -> Iterator[str]:
    """A text in parts of bounded length, cut at blanks where there are any."""
    at = 0
    while len(text) - at > BLOCK:
        to = max(text.rfind(" ", at + BLOCK // 2, at + BLOCK), text.rfind("\n", at + BLOCK // 2, at + BLOCK))
        to = to if to > 0 else at + BLOCK
        yield text[at:to]
        at = to
    yield text[at:]


def held_out(key: Column) -> Column:
    """Is the row in the fold that nothing is learned from? CRC-32 of the key as text, modulo 5, is 0."""
    return F.crc32(key.cast("string").cast("binary")) % FOLDS == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int) -> list[tuple[str, int]]:
    """Different texts outside the held-out fold with their labels: at most `per_class` labelled rows of each class, those of
    the smallest key hashes. The two key lists are bounded by that, hence the broadcast."""
    usable = labels.filter(F.col(key).isNotNull() & ~held_out(F.col(key)) & F.col(label).isin(0, 1)).select(key, label).distinct()
    counts = {r[0]: r[1] for r in usable.groupBy(label).agg(F.count(F.lit(1))).collect()}
    parts = [usable.filter((F.col(label) == c) & share_of(F.col(key), per_class, counts.get(c, 0))) for c in (0, 1)]
    picked = parts[0].union(parts[1]).withColumnRenamed(key, "_key").withColumnRenamed(label, "_label")
    found = docs.select(F.col(key).alias("_id"), F.col(text).alias("_text")).filter(F.col("_text").isNotNull())
    # Different keys are bounded by their hashes; texts of one key, of which a frequent key may have many, by theirs.
    joined = found.join(F.broadcast(picked), F.col("_id") == F.col("_key"))
    name = F.xxhash64("_id", "_text")
    several = joined.agg(F.approx_count_distinct(name)).first()[0]
    few = joined.filter(share_of(name, 4 * per_class, several))
    rows = few.select(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)).alias("h"), "_text", "_label").distinct().collect()
    chosen: dict[tuple[str, int], None] = {}
    taken = Counter()
    for r in sorted(rows, key=lambda r: (r["h"], r["_text"], r["_label"])):
        if taken[r["_label"]] < per_class and (r["_text"], int(r["_label"])) not in chosen:
            taken[r["_label"]] += 1
            chosen[r["_text"], int(r["_label"])] = None
    return list(chosen)


def fit(sample: list[tuple[str, int]], letters: np.ndarray, share: float) -> Model:
    """Logistic model on the features of restored texts. `share` of all labelled rows is toxic: the bias is set to it."""
    numbers: dict[str, int] = {}  # of the features; a text's bag is an array of them, a fraction of what sets of strings take
    plain: dict[str, tuple[int, ...]] = {}
    bags: list[np.ndarray] = []
    for text, _ in sample:
        lower = text.lower()
        bag: set[int] = set()
        for t in set(lower.split()) | {read(s, letters) for s in SPACED.findall(lower)}:
            own = plain.get(t)
            if own is None:
                own = plain[t] = tuple(numbers.setdefault(f, len(numbers)) for f in features(restored(t, letters)))
            bag.update(own)
        bags.append(np.array(sorted(bag), np.int32))
    y = np.array([label for _, label in sample], np.float64)
    positive, negative = max(y.sum(), 1), max(len(y) - y.sum(), 1)
    sizes = np.array([len(bag) for bag in bags], np.int64)
    row = np.repeat(np.arange(len(bags)), sizes)
    column = np.concatenate([*bags, np.zeros(0, np.int32)])
    toxic, clean = (np.bincount(column[y[row] == label], minlength=len(numbers)) for label in (1, 0))
    names = list(numbers)
    gain = {k: abs(np.log((toxic[k] + 0.5) / positive) - np.log((clean[k] + 0.5) / negative)) for k in np.flatnonzero(toxic + clean >= MIN_TEXTS).tolist()}
    chosen = sorted(gain, key=lambda k: (-gain[k] * np.sqrt(toxic[k] + clean[k]), names[k]))[:MAX_FEATURES]
    place = np.full(len(numbers), -1)
    place[chosen] = np.arange(len(chosen))
    used = place[column] >= 0
    row, column = row[used], place[column[used]]
    w, b = descend(row, column, y, len(chosen), LASSO / max(len(y), 1), 0.0)
    kept = np.flatnonzero(np.abs(w) > 1e-6)  # what several texts speak for; those weights are fitted again, unshrunk
    again = np.full(len(chosen), -1)
    again[kept] = np.arange(len(kept))
    inside = again[column] >= 0
    w, b = descend(row[inside], again[column[inside]], y, len(kept), 0.0, DECAY)
    chosen = [names[chosen[k]] for k in kept.tolist()]
    prior = np.log(np.clip(share, 1e-6, 1 - 1e-6) / np.clip(1 - share, 1e-6, 1)) - np.log(positive / negative)
    return Model(letters, {f: float(x) for f, x in zip(chosen, w) if abs(x) > 1e-3}, float(b + prior))


def descend(row: np.ndarray, column: np.ndarray, y: np.ndarray, width: int, lasso: float, decay: float) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model of 0/1 features given as (row, column): full gradient steps, each weight at a
    rate of its own; `lasso` pulls weights to 0 and `decay` towards it."""
    w, b, n = np.zeros(width), 0.0, max(len(y), 1)
    slope_w, slope_b = np.full(width, 1e-8), 1e-8
    for _ in range(STEPS):
        z = np.bincount(row, w[column], len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(column, error[row], width) / n + decay * w
        g_b = error.sum() / n
        slope_w += g * g
        slope_b += g_b * g_b
        rate = RATE / np.sqrt(slope_w.max(initial=1e-8)) if lasso else RATE / np.sqrt(slope_w)
        w = w - rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * lasso, 0)
        b -= RATE * g_b / np.sqrt(slope_b)
    return w, b


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Letter model of all documents, classifier of a bounded labelled sample outside the held-out fold.

    NULL keys, labels and texts teach nothing. Without labelled rows every text gets the score one half at most.
    """
    letters = letter_model(letter_counts(docs, text))
    sample = labelled_sample(docs, labels, key, text, label, per_class)
    usable = labels.filter(F.col(key).isNotNull() & ~held_out(F.col(key)))
    share = usable.agg(F.avg(F.when(F.col(label) == 1, 1.0).when(F.col(label) == 0, 0.0))).first()[0]
    return fit(sample, letters, 0.5 if share is None else share)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows and columns of `docs` plus score (double, 0 to 1), predicted (1 from one half) and n_restored (different
    disguised words). NULL and empty texts get the score of a text without words. Repeated rows score alike; columns of
    `docs` named like a result column are replaced."""
    result = [StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("n_restored", LongType())]
    names = [c for c in docs.columns if c not in {f.name for f in result}]
    rows = docs.select(*names)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = worker_cache(f"toxicity-{shared.value.name}", lambda: Scorer(shared.value))
        for batch in batches:
            own = [scorer.text((t or b"").decode("utf-8", "replace")) for t in texts_of(batch.column(at))]
            made = [
                pa.array([s for s, _ in own], pa.float64()),
                pa.array([int(s >= 0.5) for s, _ in own], pa.int32()),
                pa.array([n for _, n in own], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*names, *(f.name for f in result)])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *result]))
