"""Spelling variants: words one letter apart, found by a trie of letter-group counts, grouped under their frequent form.

A word's vector is its length and how many of its letters fall in each of `GROUPS` groups. One inserted, deleted or
replaced letter adds at most one to one count and takes at most one from another, so of two near words the one has a surplus of one
at most and a deficit of one at most. The vectors are arranged in a trie, one level per count. A search goes down depth first
and spends that budget; only words of the leaves it reaches are compared letter by letter.

Each pair is searched for once: by the shorter word, and among words of one length by the word whose first differing count is
the smaller one (of equal vectors, the smaller word). Running sums of the differences are then 0 or 1 all the way.

The upper part of the trie is shared out: nodes with more than `NODE` words are opened, all others are each a group of rows
in Spark, to which a word sends itself as a member once, and as a searcher wherever its budget leads. Opened nodes, at most
words / NODE a level, are all that the driver and the workers hold in common. Words of one and the same vector that are too many
are dealt to parts that every searcher visits; nodes with too many searchers are repeated and share them.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortspark.llm.common import settle, texts_of

MIN_LETTERS = 6
MIN_COUNT = 5
FACTOR = 5  # a form occurs at least so many times as often as its variant
GROUPS = 16  # a letter's group is its code modulo this
NODE = 8192  # words of an unopened node
SEARCHERS = 131_072  # of a node, before it is repeated
BUCKET = 64  # words of a leaf within a node
LEVELS_A_JOB = 4
HELD = 400_000  # different words a worker counts before it hands them on
CHUNK = 1 << 20  # letters of a text that are split into words at a time
WIDE = 64  # letters of words that are compared as rows of a matrix
SEARCH = 4096  # searchers handled at a time
STEP = 4  # bytes of a count in the name of a node

# A-Z are lower-cased, a-z and U+00C0 to U+00FF are kept, all else parts words.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)


# --- words of texts ---------------------------------------------------------------------------------------------------
def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Lower-cased runs of letters, one byte a letter (Latin-1), in lists of bounded length."""
    letters = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(LETTERS)
    if len(letters) <= CHUNK:
        yield letters.split()
        return
    at = 0
    while at < len(letters):
        end = letters.find(b" ", at + CHUNK)
        end = len(letters) if end < 0 else end
        yield letters[at:end].split()
        at = end


def misspelt(name: bytes, words: list[bytes], every: int) -> Iterator[tuple[bytes, int, bytes]]:
    """Words that lose a letter in the text of this name, how often they occur, and what is left of them.

    A word does so if `every` divides the CRC-32 h of "name:word" in UTF-8; its letter number h % length (from 0) goes.
    """
    base = zlib.crc32(name + b":")
    hit = {}
    for w in set(words):
        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), base)
        if not h % every:
            hit[w] = h % len(w)
    if hit:
        for w, n in Counter(filter(hit.__contains__, words)).items():
            yield w, n, w[: hit[w]] + w[hit[w] + 1 :]


def word_counts(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, misspell: int | None = None
) -> DataFrame:
    """(word, n) of all words of enough letters that occur often enough in all texts; counted in the workers first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            kept = [(w, n) for w, n in counts.items() if n > 0 and len(w) >= min_letters]
            counts.clear()
            names = pa.array([w.decode("latin-1") for w, _ in kept], pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array([n for _, n in kept], pa.int64())], ["word", "n"])

        for batch in batches:
            for name, t in zip(texts_of(batch.column(0)), texts_of(batch.column(1))):
                for words in words_of(t or b""):
                    words = [w for w in words if len(w) >= min_letters]
                    counts.update(words)
                    if misspell is not None:
                        for w, n, rest in misspelt(name or b"", words, misspell):
                            counts[w] -= n
                            counts[rest] += n
                    if len(counts) > HELD:
                        yield out()
        if counts:
            yield out()

    parts = docs.select(F.col(key).cast("string").alias("name"), F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- the trie ---------------------------------------------------------------------------------------------------------
def vectors_of(words: list[bytes]) -> np.ndarray:
    """Length and letter-group counts, a row a word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    groups = np.frombuffer(b"".join(words), np.uint8) % GROUPS
    rows = np.repeat(np.arange(len(words)), sizes)
    counts = np.bincount(rows * GROUPS + groups, minlength=len(words) * GROUPS).reshape(-1, GROUPS)
    return np.concatenate([sizes[:, None], counts], 1).astype(np.int32)


def names_of(vectors: np.ndarray) -> list[bytes]:
    """Vectors as node names of full depth: a node's name begins with its parent's."""
    raw, step = vectors.astype(">u4").tobytes(), STEP * vectors.shape[1]
    return [raw[k : k + step] for k in range(0, len(raw), step)]


def visits(name: bytes, opened: dict[bytes, int]) -> Iterator[bytes]:
    """Unopened nodes in which a word with the vector `name` searches, from the root down."""
    own = np.frombuffer(name, ">u4").tolist()

    def down(node: bytes, level: int, running: int, left: int) -> Iterator[bytes]:
        """`running`: sum of the differences so far (0 or 1); `left`: differences that may still come."""
        if node not in opened or len(node) == len(name):
            yield node
            return
        count = own[level]
        yield from down(node + count.to_bytes(STEP), level + 1, running, left)
        if left and not running:
            yield from down(node + (count + 1).to_bytes(STEP), level + 1, 1, left - 1)
        if left and running and count:
            yield from down(node + (count - 1).to_bytes(STEP), level + 1, 0, left - 1)

    if b"" not in opened:
        yield b""
        return
    yield from down(own[0].to_bytes(STEP), 1, 0, 2)
    yield from down((own[0] + 1).to_bytes(STEP), 1, 0, 1)


class Node:
    """The words of one node with the trie below it; keeps what its members have been told."""

    def __init__(self, depth: int, words: list[bytes], counts: np.ndarray, bucket: int = BUCKET):
        vectors = vectors_of(words)
        order = np.lexsort([np.array(words, object).argsort().argsort(), *vectors.T[::-1]]) if len(words) > 1 else np.zeros(len(words), int)
        self.words = [words[k] for k in order]
        self.vectors, self.counts = vectors[order], counts[order]
        self.depth, self.bucket = depth, bucket
        self.ranks = np.empty(len(words), np.int64)
        self.ranks[sorted(range(len(words)), key=self.words.__getitem__)] = np.arange(len(words))
        self.found = np.zeros(len(words), np.int64)
        self.best: dict[int, tuple[int, bytes]] = {}
        self.forward, self.backward = rows_of(self.words)

    def search(self, words: list[bytes], counts: np.ndarray) -> list[tuple[bytes, int, int, bytes]]:
        """Near words of each searcher: (word, how many, largest count, the first word of that count)."""
        own = vectors_of(words)
        longer = np.zeros(len(words), np.int64)
        sums = np.zeros(len(words), np.int64)
        used = np.zeros(len(words), np.int64)
        if self.depth:
            prefix = self.vectors[0, : self.depth].astype(np.int64) - own[:, : self.depth]
            longer = prefix[:, 0]
            sums, used = prefix[:, 1:].sum(1), np.abs(prefix[:, 1:]).sum(1)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        self._down(0, len(self.words), self.depth, np.arange(len(words)), longer, sums, used, own, pairs)
        if not pairs:
            return []
        q, m = (np.concatenate(x) for x in zip(*pairs))
        near = self._near(words, q, m)
        return self._tell(words, counts, q[near], m[near])

    def _down(self, a: int, b: int, level: int, rows: np.ndarray, longer, sums, used, own, pairs) -> None:
        if a == b or not len(rows):
            return
        if b - a <= self.bucket or level == self.vectors.shape[1]:
            step = max(1, (1 << 22) // ((b - a) * self.vectors.shape[1]))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                away = self.vectors[a:b, level:][None].astype(np.int32) - own[part, level:][:, None]
                more = np.broadcast_to(longer[part][:, None], (len(part), b - a))
                if level == 0:
                    more, away = away[:, :, 0], away[:, :, 1:]
                running = away.cumsum(2) + sums[part][:, None, None]
                fine = (more >= 0) & (more <= 1) & (running >= 0).all(2) & (running <= 1).all(2)
                fine &= np.abs(away).sum(2) + used[part][:, None] <= 2 - more
                at, member = np.nonzero(fine)
                pairs.append((part[at], a + member))
            return
        column = self.vectors[a:b, level]
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(column)) + 1, [b - a]])
        for first, last in zip(cuts[:-1], cuts[1:]):
            away = int(column[first]) - own[rows, level].astype(np.int64)
            if level == 0:
                some = (away >= 0) & (away <= 1)
                left = rows[some]
                longer[left] = away[some]
                self._down(a + first, a + last, 1, left, longer, sums, used, own, pairs)
                continue
            running, spent = sums[rows] + away, used[rows] + np.abs(away)
            some = (running >= 0) & (running <= 1) & (spent <= 2 - longer[rows])
            left = rows[some]
            before = sums[left], used[left]
            sums[left], used[left] = running[some], spent[some]
            self._down(a + first, a + last, level + 1, left, longer, sums, used, own, pairs)
            sums[left], used[left] = before

    def _near(self, words: list[bytes], q: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Do searcher and member differ by exactly one letter? Members are as long or one longer. Equal vectors count once."""
        forward, backward = rows_of(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(q), bool)
        step = 1 << 16
        for k in range(0, len(q), step):
            a, b = q[k : k + step], m[k : k + step]
            size, other = sizes[a], self.vectors[b, 0]
            unlike = forward[a] != self.forward[b]
            same = (size == other) & (unlike.sum(1) == 1)
            ahead = unlike.argmax(1)
            behind = (backward[a] != self.backward[b]).argmax(1)
            out[k : k + step] = same | ((size + 1 == other) & (ahead + behind >= size))
            for j in np.flatnonzero(np.maximum(size, other) > WIDE):
                out[k + j] = one_apart(words[a[j]], self.words[b[j]])
        alike = np.flatnonzero(out & (sizes[q] == self.vectors[m, 0]))
        if len(alike):
            own = vectors_of(words)
            for j in alike[(own[q[alike]] == self.vectors[m[alike]]).all(1)]:
                out[j] = words[q[j]] < self.words[m[j]]
        return out

    def _tell(self, words, counts, q, m) -> list[tuple[bytes, int, int, bytes]]:
        """Answers for the searchers; members keep theirs."""
        order = np.lexsort((self.ranks[m], -self.counts[m], q))
        who, first, many = np.unique(q[order], return_index=True, return_counts=True)
        out = []
        for w, k, n in zip(who.tolist(), m[order][first].tolist(), many.tolist()):
            out.append((words[w], n, int(self.counts[k]), self.words[k]))
        ranks = np.empty(len(words), np.int64)
        ranks[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((ranks[q], -counts[q], m))
        who, first, many = np.unique(m[order], return_index=True, return_counts=True)
        self.found[who] += many
        for k, w in zip(who.tolist(), q[order][first].tolist()):
            told = (-int(counts[w]), words[w])
            self.best[k] = min(self.best.get(k, told), told)
        return out

    def told(self) -> list[tuple[bytes, int, int, bytes]]:
        """What the members have been told, as `search` gives it for searchers."""
        return [(self.words[k], int(self.found[k]), -n, w) for k, (n, w) in self.best.items()]


def rows_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of bytes, from the front and from the back; longer ones are cut at `WIDE` letters."""
    width = WIDE + 2
    forward = np.array([w[:WIDE] for w in words], f"S{width}").view(np.uint8).reshape(-1, width)
    backward = np.array([w[::-1][:WIDE] for w in words], f"S{width}").view(np.uint8).reshape(-1, width)
    return forward, backward


def one_apart(a: bytes, b: bytes) -> bool:
    """Is `b`, as long as `a` or longer, exactly one inserted or replaced letter away?"""
    at = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) == len(b):
        return at < len(a) and a[at + 1 :] == b[at + 1 :]
    return len(a) + 1 == len(b) and a[at:] == b[at + 1 :]


# --- the search on Spark ----------------------------------------------------------------------------------------------
def opened_nodes(words: DataFrame, node: int) -> dict[bytes, int]:
    """Names of nodes with more than `node` words, and in how many parts those of full depth are dealt."""
    total = words.count()
    if total <= node:
        return {}
    levels = GROUPS + 1
    opened = {b"": 1}
    for first in range(0, levels, LEVELS_A_JOB):
        last = min(first + LEVELS_A_JOB, levels)
        top = frozenset(n for n in opened if len(n) == STEP * first)
        if not top:
            break

        def run(batches: Iterator[pa.RecordBatch], first=first, last=last, top=top) -> Iterator[pa.RecordBatch]:
            counts: Counter[bytes] = Counter()

            def out() -> pa.RecordBatch:
                made = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
                counts.clear()
                return pa.RecordBatch.from_arrays(made, ["node", "n"])

            for batch in batches:
                own = [w.decode().encode("latin-1") for w in texts_of(batch.column(0))]
                for name in names_of(vectors_of(own)):
                    if name[: STEP * first] in top:
                        for level in range(first + 1, last + 1):
                            counts[name[: STEP * level]] += 1
                if len(counts) > HELD:
                    yield out()
            if counts:
                yield out()

        found = words.select("word").mapInArrow(run, "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))
        for r in found.filter(F.col("n") > node).collect():
            name = bytes(r["node"])
            opened[name] = math.ceil(r["n"] / node) if len(name) == STEP * levels else 1
    return opened


def near_words(words: DataFrame, node: int = NODE, searchers: int = SEARCHERS) -> DataFrame:
    """(word, n_near, best_n, best) of all words that have a near word: how many, the largest n among them, the first word of it.

    `words` (word, n) holds different words of the letters a-z and U+00C0 to U+00FF; it is read several times.
    """
    opened = words.sparkSession.sparkContext.broadcast(opened_nodes(words, node))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each word as a member (searcher 0) of its node, and as a searcher."""
        tree = opened.value
        full = STEP * (GROUPS + 1)
        for batch in batches:
            own = [w.decode().encode("latin-1") for w in texts_of(batch.column(0))]
            nodes, parts, places, roles = [], [], [], []
            for k, (word, name) in enumerate(zip(own, names_of(vectors_of(own)))):
                level = 0
                while STEP * level < full and name[: STEP * level] in tree:
                    level += 1
                nodes.append(name[: STEP * level])
                parts.append(zlib.crc32(word) % tree.get(name, 1) if STEP * level == full else 0)
                places.append(k)
                roles.append(0)
                for target in visits(name, tree):
                    many = tree.get(target, 1) if len(target) == full else 1
                    nodes += [target] * many
                    parts += range(many)
                    places += [k] * many
                    roles += [1] * many
            rows = batch.take(pa.array(places, pa.int64()))
            columns = [pa.array(nodes, pa.binary()), pa.array(parts, pa.int32()), pa.array(roles, pa.int32()), *rows.columns]
            yield pa.RecordBatch.from_arrays(columns, ["node", "part", "searcher", "word", "n"])

    kind = "node binary, part int, searcher int, word string, n long"
    placed = settle(words.select("word", "n").mapInArrow(place, kind), "spelling-places")
    # Nodes that more words search than a task should read: their members are repeated, the searchers dealt. At most
    # rows / searchers of them.
    crowded = placed.groupBy("node", "part").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > searchers)
    crowded = settle(crowded.select("node", "part", F.ceil(F.col("rows") / searchers).cast("int").alias("copies")), "spelling-crowded")
    dealt = placed.join(F.broadcast(crowded), ["node", "part"], "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    own = F.pmod(F.xxhash64("word"), F.col("copies")).cast("int")
    copy = F.when(F.col("searcher") == 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.array(own))
    dealt = dealt.select("node", "part", F.explode(copy).alias("copy"), "searcher", "word", "n")
    ordered = dealt.repartition("node", "part", "copy").sortWithinPartitions("node", "part", "copy", "searcher")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Members of a node come first, then its searchers."""
        current, tree = None, None
        members: list[tuple[bytes, int]] = []
        asking: list[tuple[bytes, int]] = []

        def answers(told: list[tuple[bytes, int, int, bytes]]) -> Iterator[pa.RecordBatch]:
            if told:
                word, many, n, best = zip(*told)
                made = [pa.array([w.decode("latin-1") for w in word]), pa.array(many, pa.int64()), pa.array(n, pa.int64()), pa.array([w.decode("latin-1") for w in best])]
                yield pa.RecordBatch.from_arrays(made, ["word", "n_near", "best_n", "best"])

        def ask() -> Iterator[pa.RecordBatch]:
            nonlocal tree
            if asking and members:
                if tree is None:
                    tree = Node(len(current[0]) // STEP, [w for w, _ in members], np.array([n for _, n in members], np.int64))
                yield from answers(tree.search([w for w, _ in asking], np.array([n for _, n in asking], np.int64)))
            asking.clear()

        def end() -> Iterator[pa.RecordBatch]:
            nonlocal tree
            yield from ask()
            if tree is not None:
                yield from answers(tree.told())
            tree = None
            members.clear()

        for batch in batches:
            words_ = [w.decode().encode("latin-1") for w in texts_of(batch.column(4))]
            columns = [batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5)]
            for node_, part, copy_, role, n, word in zip(*columns, words_):
                if (node_, part, copy_) != current:
                    if current is not None:
                        yield from end()
                    current = node_, part, copy_
                (asking if role else members).append((word, n))
                if len(asking) >= SEARCH:
                    yield from ask()
        if current is not None:
            yield from end()

    found = ordered.mapInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")))
    total = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return total.select("word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.word").alias("best"))


def with_roots(formed: DataFrame) -> DataFrame:
    """Add `root`: from each word, `form` followed to its end. Counts grow by a factor along the way, so ways are short and
    have no rings; each round doubles what has been followed."""
    links = settle(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ends = links.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = links.join(ends, F.col("root") == F.col("_at"), "left")
        further = settle(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        links = further.select("word", "root")
        if not further.filter("moved").take(1):
            break
    ends = links.select(F.col("word").alias("_at"), "root")
    return formed.join(ends, F.col("word") == F.col("_at"), "left").withColumn("root", F.coalesce("root", "word")).drop("_at")


def group_variants(words: DataFrame, factor: int = FACTOR, node: int = NODE, searchers: int = SEARCHERS) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of (word, n).

    Near words differ by exactly one inserted, deleted or replaced letter; n_near is their number. A word's form is its near
    word of largest n (ties: the first in code-point order) if that is at least `factor` (2 or more) times its own n, else NULL.
    The root is where following forms ends, the word itself if it has none.
    """
    if factor < 2:
        raise ValueError("a form must occur more often than its variants")
    words = settle(words.select("word", "n"), "spelling-words")
    near = near_words(words, node, searchers).withColumnRenamed("word", "_word")
    both = words.join(near, F.col("word") == F.col("_word"), "left")
    fits = F.col("best_n") >= factor * F.col("n")
    formed = both.select(
        "word", F.when(fits, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best_n")).alias("form_n"),
    )
    formed = settle(formed, "spelling-forms")
    return with_roots(formed).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(
    docs: DataFrame, text: str = "text", key: str = "doc_id", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
    factor: int = FACTOR, misspell: int | None = None, node: int = NODE, searchers: int = SEARCHERS,
) -> DataFrame:
    """The words of all texts (runs of A-Z, a-z, U+00C0 to U+00FF; only A-Z are lower-cased) with their forms, as `group_variants` gives them.

    NULL and empty texts have no words, an empty table gives no rows, repeated rows count each. Bytes that are no UTF-8 part words. Texts are
    read in chunks, words of any length are compared whole. Only `key` and `text` are read, so other columns cannot clash.
    With `misspell`, a word loses a letter in some texts, chosen by the checksum of key and word (`misspelt`; a NULL key counts as
    the empty string): planted variants.
    """
    return group_variants(word_counts(docs, text, key, min_letters, min_count, misspell), factor, node, searchers)
