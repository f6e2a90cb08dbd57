"""Personal data: base rules, and a semi-Markov conditional random field that adds what the rules miss.

The field works on regions of a text that hold digits or at-signs. A region is cut into runs of letters, digits and single
signs; a segmentation joins up to `MAX_RUNS` of them to an entity or leaves a run outside. Features look at the whole span of
a candidate (digit count, check sum, dotted parts, what stands around it). It is trained on a bounded sample of texts whose
spans the rules give, each also with its spans in disguise. Decoding picks boundaries and kinds of a region together, in time
linear in its length. The rules' spans always stay; the field's are added where they touch none of those.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from cohortspark.llm.common import share_of, texts_of

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 800  # texts the field is fitted on: those of the smallest hashes that hold a digit or an at-sign
MAX_RUNS = 37  # runs of a candidate span: the longest entity is a card of 19 digits with a sign between all of them
LEARNED = 400  # characters of a region the field learns from: longer ones teach nothing, but are decoded like all others
EPOCHS, RATE, DECAY = 4, 0.2, 1e-3
REACH = 64  # characters a region is extended to either side

# The base rules.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # matches only begin where digits begin: linear in a run of them
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

_SIGN = re.compile(r"[0-9@]+")
_SPELLED = re.compile(r"\S{1,64}\s?[\[(]?\bat\b[\])]?\s?\S{1,64}?\s?[\[(]?\bdot\b[\])]?\s?[A-Za-z]{2,4}\b")
_RUN = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.DOTALL)
Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from the at-signs outwards."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) in code points by the rules: by kind, then start. A match that fails its test is dropped."""
    out: list[Span] = [("email", a, b) for a, b in emails(text)]
    if not any(d in text for d in "0123456789"):
        return out
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    if "+" in text:
        out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return out


# --- regions and features ---------------------------------------------------------------------------------------------
def regions(text: str) -> list[tuple[int, int]]:
    """Stretches worth decoding: around digits and at-signs out to the next blanks, and spelled-out addresses."""
    found = []
    for m in _SIGN.finditer(text):
        if found and m.end() <= found[-1][1]:
            continue
        a, b = m.start(), m.end()
        if found and a < found[-1][1]:  # a run of signs is never cut: the region goes on behind it
            a = found.pop()[0]
        while a > 0 and a > m.start() - REACH and not text[a - 1].isspace():
            a -= 1
        while b < len(text) and b - m.end() < REACH and not text[b].isspace():
            b += 1
        found.append((a, b))
    if " dot " in text or "[dot]" in text or "(dot)" in text:
        found = sorted([*found, *(m.span() for m in _SPELLED.finditer(text))])
    out: list[tuple[int, int]] = []
    for a, b in found:
        if out and a <= out[-1][1] + 2:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def runs_of(text: str, a: int, b: int) -> list[int]:
    """Borders of the runs of a region, both ends included."""
    return [m.start() for m in _RUN.finditer(text, a, b)] + [b]


def bucket(n: int, *steps: int) -> int:
    return sum(n >= s for s in steps)


def span_features(text: str, a: int, b: int) -> tuple[str, ...]:
    """What is true of text[a:b] as a whole and of its surroundings."""
    s = text[a:b]
    digits = digits_of(s)
    letters = sum(c.isalpha() for c in s)
    others = "".join(sorted({c for c in s if not c.isalnum()}))
    parts = s.replace("[.]", ".").split(".")
    before, after = text[a - 1 : a], text[b : b + 1]
    lower = s.lower()
    ats = s.count("@") or len(re.findall(r"[\s\[(]at[\s\])]", lower))
    dots = s.count(".") or len(re.findall(r"[\s\[(]dot[\s\])]", lower))
    out = [
        "1",
        f"digits{bucket(len(digits), 1, 4, 8, 12, 16, 20)}",
        f"letters{bucket(letters, 1, 3, 8)}",
        f"at{bucket(ats, 1, 2)}dot{bucket(dots, 1, 2, 3, 4)}",
        f"groups{bucket(len(re.findall('[0-9]+', s)), 1, 2, 3, 4, 5, 7)}",
        f"left{before.isalnum() * 2 + (before in '.-+@_' and before != '')}",
        f"right{after.isalnum() * 2 + (after in '-@_(' and after != '')}",
        f"starts{s[0] if not s[0].isalnum() else 'd' if s[0].isdigit() else 'l'}",
        f"ends{s[-1] if not s[-1].isalnum() else 'd' if s[-1].isdigit() else 'l'}",
    ]
    if not letters:
        out.append(f"only{others if len(others) <= 4 else 'many'}")
        if 16 <= len(digits) <= 19:
            out.append("luhn" if luhn(digits) else "noluhn")
        if len(parts) == 4 and all(p.isdigit() and len(p) <= 3 for p in parts):
            out.append("quad" if all(int(p) <= 255 for p in parts) else "noquad")
        if 8 <= len(digits) <= 15 and (s[0] == "+" or "(" in s):
            out.append("dial")
    elif ats == 1 and dots and re.search(r"[A-Za-z]{2,}$", s):
        out.append("address")
    return tuple(out)


class Field:
    """Weights of (feature, kind), of kinds behind each other, and of a run left outside."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.weights = np.zeros((4096, len(KINDS)))
        self.outside = np.zeros(4)
        self.after = np.zeros((len(KINDS) + 1, len(KINDS) + 1))  # the last is: outside

    def lattice(self, text: str, a: int, b: int, learn: bool) -> tuple[list[int], list[tuple[int, int, np.ndarray]], np.ndarray]:
        """Borders, candidate segments (first and last border, feature numbers), and the class of each run."""
        borders = runs_of(text, a, b)
        n = len(borders) - 1
        heads = [text[x] for x in borders[:-1]]
        kind = np.array([0 if c.isspace() else 1 if c.isdigit() else 2 if c.isalpha() else 3 for c in heads])
        out = []
        for i in range(n):
            if kind[i] == 0 or (kind[i] == 3 and heads[i] not in "+("):
                continue
            signs = False
            for j in range(i + 1, min(n, i + MAX_RUNS) + 1):
                last = j - 1
                signs = signs or kind[last] == 1 or heads[last] == "@"
                if kind[last] in (0, 3) or (not signs and j - i < 5) or j - i < 1:
                    continue
                if borders[j] - borders[i] < 6:
                    continue
                names = span_features(text, borders[i], borders[j])
                if learn:
                    ids = [self.index.setdefault(f, len(self.index)) for f in names if f in self.index or len(self.index) < len(self.weights)]
                else:
                    ids = [self.index[f] for f in names if f in self.index]
                out.append((i, j, np.array(ids, np.int64)))
        return borders, out, kind

    def scores(self, segments: list) -> list[np.ndarray]:
        return [self.weights[ids].sum(0) for _, _, ids in segments]

    def decode(self, text: str, a: int, b: int) -> list[Span]:
        """The best segmentation of a region: best[j][k] ends at border j with kind k."""
        borders, segments, kind = self.lattice(text, a, b, learn=False)
        if not segments:
            return []
        n, width = len(kind), len(KINDS) + 1
        ending: dict[int, list] = {}
        for (i, j, _), s in zip(segments, self.scores(segments)):
            ending.setdefault(j, []).append((i, s))
        best = np.full((n + 1, width), -np.inf)
        best[0, -1] = 0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            step = best[j - 1] + self.after[:, -1]
            p = int(step.argmax())
            best[j, -1] = step[p] + self.outside[kind[j - 1]]
            back[j, width - 1] = (j - 1, p)
            for i, s in ending.get(j, ()):
                into = best[i][:, None] + self.after[:, :-1] + s
                top = into.argmax(0)
                for k in range(len(KINDS)):
                    if into[top[k], k] > best[j, k]:
                        best[j, k] = into[top[k], k]
                        back[j, k] = (i, int(top[k]))
        out, j, k = [], n, int(best[n].argmax())
        while j > 0:
            i, before = back[j, k]
            if k < len(KINDS):
                out.append((KINDS[k], borders[i], borders[j]))
            j, k = i, before
        return out[::-1]

    def learn(self, text: str, a: int, b: int, gold: dict[tuple[int, int], int], rate: float) -> None:
        """One gradient step on the log-likelihood of a region's segmentation, by the forward and backward sums."""
        borders, segments, kind = self.lattice(text, a, b, learn=True)
        n, width = len(kind), len(KINDS) + 1
        place = {x: k for k, x in enumerate(borders)}
        wanted = {(place[x], place[y]): k for (x, y), k in gold.items() if x in place and y in place}
        wanted = {key: k for key, k in wanted.items() if any(key == (i, j) for i, j, _ in segments)}
        values = self.scores(segments)
        starting: dict[int, list] = {}
        ending: dict[int, list] = {}
        for m, (i, j, _) in enumerate(segments):
            starting.setdefault(i, []).append(m)
            ending.setdefault(j, []).append(m)
        ahead = np.full((n + 1, width), -np.inf)
        ahead[0, -1] = 0
        for j in range(1, n + 1):
            ahead[j, -1] = np.logaddexp.reduce(ahead[j - 1] + self.after[:, -1]) + self.outside[kind[j - 1]]
            for m in ending.get(j, ()):
                into = np.logaddexp.reduce(ahead[segments[m][0]][:, None] + self.after[:, :-1], axis=0) + values[m]
                ahead[j, :-1] = np.logaddexp(ahead[j, :-1], into)
        rest = np.full((n + 1, width), -np.inf)
        rest[n] = 0
        for i in range(n - 1, -1, -1):
            rest[i] = self.after[:, -1] + self.outside[kind[i]] + rest[i + 1, -1]
            for m in starting.get(i, ()):
                out = np.logaddexp.reduce(self.after[:, :-1] + (values[m] + rest[segments[m][1], :-1])[None], axis=1)
                rest[i] = np.logaddexp(rest[i], out)
        whole = rest[0, -1]
        g_after, g_outside = np.zeros_like(self.after), np.zeros_like(self.outside)
        for j in range(n):
            p = np.exp(ahead[j] + self.after[:, -1] + self.outside[kind[j]] + rest[j + 1, -1] - whole)
            g_after[:, -1] -= p
            g_outside[kind[j]] -= p.sum()
        for m, (i, j, ids) in enumerate(segments):
            p = np.exp(ahead[i][:, None] + self.after[:, :-1] + values[m] + rest[j, :-1] - whole)
            g_after[:, :-1] -= p
            g = -p.sum(0)
            if (i, j) in wanted:
                g[wanted[i, j]] += 1
            np.add.at(self.weights, ids, rate * g)
        at, before = 0, width - 1
        ends = {i: (j, k) for (i, j), k in wanted.items()}
        while at < n:
            if at in ends:
                j, k = ends[at]
                g_after[before, k] += 1
                at, before = j, k
            else:
                g_after[before, -1] += 1
                g_outside[kind[at]] += 1
                at, before = at + 1, width - 1
        self.after += rate * g_after
        self.outside += rate * g_outside
        self.weights *= 1 - rate * DECAY * 0.01


def disguises(kind: str, s: str, turn: int) -> str:
    """The span as people write it to get round the rules (fixed list, one of three by `turn`)."""
    if kind == "email":
        return (s.replace("@", " at ").replace(".", " dot "), s.replace("@", "(at)").replace(".", "(dot)"), s.replace("@", "[at]").replace(".", "[dot]"))[turn % 3]
    if kind == "ip":
        return (s.replace(".", "[.]"), s.replace(".", " . "), s)[turn % 3]
    if kind == "card":
        d = digits_of(s)
        return (".".join(d[k : k + 4] for k in range(0, len(d), 4)), "/".join(d[k : k + 4] for k in range(0, len(d), 4)), s)[turn % 3]
    return (s[1:], "00" + digits_of(s), s.replace(" ", "/"))[turn % 3]


def train(texts: list[str]) -> Field:
    """A field fitted on the rules' spans in `texts`, plain and disguised."""
    field = Field()
    examples = []
    for turn, text in enumerate(texts):
        spans = sorted(base_spans(text), key=lambda s: (s[1], -s[2]))
        kept: list[Span] = []
        for s in spans:
            if not kept or s[1] >= kept[-1][2]:
                kept.append(s)
        for a, b in regions(text):
            gold = {(x, y): KINDS.index(k) for k, x, y in kept if a <= x and y <= b}
            examples.append((text[max(0, a - 1) : b + 2], min(a, 1), min(a, 1) + b - a, {(x - a + min(a, 1), y - a + min(a, 1)): k for (x, y), k in gold.items()}))
        for kind, x, y in kept:
            other = disguises(kind, text[x:y], turn)
            examples.append((f" {other} ", 1, 1 + len(other), {(1, 1 + len(other)): KINDS.index(kind)}))
    order = sorted(range(len(examples)), key=lambda k: hashlib.sha256(f"{k}{examples[k][0]}".encode()).digest())[: 2 * SAMPLE]
    for epoch in range(EPOCHS):
        for k in order:
            text, a, b, gold = examples[k]
            if len(text) <= LEARNED:
                field.learn(text, a, b, gold, RATE / (1 + epoch))
    return field


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), both by kind and start."""
    base = base_spans(text)
    begins: list[int] = []  # the base spans merged to stretches, in order
    ends: list[int] = []
    for a, b in sorted((a, b) for _, a, b in base):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            begins.append(a)
            ends.append(b)
    added = []
    for a, b in regions(text):
        for kind, x, y in field.decode(text, a, b):
            k = bisect_left(begins, y) - 1  # the last stretch that begins before the span ends
            if k < 0 or ends[k] <= x:
                added.append((kind, x, y))
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1], s[2]))


def named(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Field:
    """Train on the `sample` texts of the smallest hashes of key and text among those with a digit or an at-sign.

    Rows that repeat key and text count once, so that the driver gets a bounded number of texts whatever keys repeat.
    """
    some = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).filter(F.col("t").rlike("[0-9@]"))
    hashed = F.xxhash64("k", "t")
    few = some.filter(share_of(hashed, sample, some.select(hashed).distinct().count()))
    rows = few.select(F.pmod(F.xxhash64(hashed), F.lit(1 << 30)).alias("h"), "t").distinct().collect()
    return train([r["t"] for r in sorted(rows, key=lambda r: (r["h"], r["t"]))[:sample]])


def find_spans(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """The rows and columns of `docs` plus n_email, n_ip, n_card, n_phone (long, the rules' spans), base_sha256 (of the rules'
    spans as kind:start:end, comma-joined by kind and start), spans (all spans, joined likewise) and n_added (long).

    Offsets are code points, ends exclusive. NULL is an empty text; bytes that are no UTF-8 count as U+FFFD. Repeated rows give the same; columns of `docs` named like
    a result column are replaced.
    """
    result = [StructField(f"n_{k}", LongType()) for k in KINDS]
    result += [StructField("base_sha256", StringType()), StructField("spans", StringType()), StructField("n_added", LongType())]
    names = [c for c in docs.columns if c not in {f.name for f in result}]
    rows = docs.select(*names)
    shared, at = docs.sparkSession.sparkContext.broadcast(field), names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in KINDS}
            digests, spans, extra = [], [], []
            for t in texts_of(batch.column(at)):
                base, every = all_spans((t or b"").decode("utf-8", "replace"), shared.value)
                for k in KINDS:
                    counts[k].append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(named(base).encode()).hexdigest())
                spans.append(named(every))
                extra.append(len(every) - len(base))
            made = [pa.array(counts[k], pa.int64()) for k in KINDS]
            made += [pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(extra, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*names, *(f.name for f in result)])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *result]))
