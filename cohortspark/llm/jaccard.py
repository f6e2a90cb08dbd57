"""N-gram Jaccard join: size-banded tiles, bitmap signatures, exact intersection of sorted arrays.

1. Texts with equal shingle sets form a class; from here on only classes are compared.
2. Two sets that meet the threshold share one of the first few shingles of each, in any order common to all sets. The order
   puts shingles first that are rare by a fixed-size count over the whole corpus, so shared passages come last.
   Of shingles that exactly the same classes share, one stands for all.
3. Each class is compared with a few hubs, classes that share most of those shingles with it. A group of copies becomes a few
   stars around its hubs instead of all its pairs.
4. What remains are pairs of classes that the stars have not joined. They meet in tiles of one shingle and one band of set
   sizes, where the shingle's place in either set bounds what they can have in common, and mostly in one tile only: the rows
   name the tiles just before, and a pair that shares one of those has met there. In both steps the bits set in one 1024-bit
   signature and not in the other bound the overlap from above, and only what the bounds leave goes to the exact intersection.
5. The links of both steps give the components.

Every step is a join or a map-side combined aggregate, none emits the pairs of a group, and the only things that reach the
driver are counts of fixed size. Texts are moved for classes that have a partner to be compared with, and no others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortspark.llm.common import release, settle, texts_of
from cohortspark.llm.graph import components
from cohortspark.llm.shingles import WordHasher, common, mix, shingle_sets
from cohortspark.llm.sketch import SLICES, bit_slices, either, slices, total

WORDS = 5
PERCENT = 80
ORDER_BITS = 20  # slots of the corpus-wide count that orders shingles
PICK_BITS = 23  # slots of the filter on documents whose text is needed
TOKEN_BITS = 26  # slots of the filter on shared shingles, at most; fewer where `PER_TOKEN` for each of them are fewer
PER_TOKEN = 16
SIGNATURE_WORDS = 16  # 64-bit words of a signature
TILE_WORDS = 4  # words it is folded to in the rows of small tiles; pairs that these let through meet the whole ones
SMALL = 32  # classes that share a shingle, at most, for its tile to be small
EARLIER_NAMES = ("e0", "e1", "e2")  # columns of a tile row that name the tiles in which its node is just before
HUB_KEYS = (0, 0x2545F4914F6CDD1D, 0x1B03738712FAD5C9, 0x5851F42D4C957F2D)  # orders in which the first class is the hub
HUBS = 3  # hubs each class is compared with
PER_HUB = 256  # texts compared with one copy of a hub's text in one group


def fingerprint(hashes: np.ndarray) -> bytes:
    """128 bits that name a set: two sums over differently mixed members."""
    a = mix(hashes).sum(dtype=np.uint64)
    b = mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return a.tobytes() + b.tobytes()


def least_common(size: int, percent: int) -> int:
    """The smallest overlap that a set of `size` can have with a partner at the threshold."""
    return -(-percent * size // 100)


def linked(overlap: int, a: int, b: int, percent: int) -> bool:
    return 100 * overlap >= percent * (a + b - overlap)


def sizes_and_counts(docs: DataFrame, words: int) -> DataFrame:
    """First pass: rows (id, n, fp) of the texts and rows (slot, counts) of the partitions. A third column (string) goes along."""
    further = docs.columns[2:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hasher, counts, any_ = WordHasher(), np.zeros(1 << ORDER_BITS, np.int64), False
        for batch in batches:
            sizes, prints, held = [], [], []
            for s in shingle_sets(texts_of(batch.column(1)), hasher, words):
                sizes.append(len(s))
                prints.append(fingerprint(s))
                held.append(s)
            if held:
                slots = np.concatenate(held) >> np.uint64(64 - ORDER_BITS)
                counts += np.bincount(slots.astype(np.int64), minlength=1 << ORDER_BITS)
                any_ = True
            n = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), *batch.columns[2:]],
                ["id", "n", "fp", "slot", "counts", *further],
            )
        if any_:
            rows = list(slices(np.minimum(counts, 2**32 - 1)))
            k = len(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), *[pa.nulls(k, pa.string()) for _ in further]],
                ["id", "n", "fp", "slot", "counts", *further],
            )

    return docs.mapInArrow(run, ", ".join(["id long, n long, fp binary, slot int, counts binary", *(f"{c} string" for c in further)]))


def signatures(docs: DataFrame, order: np.ndarray, words: int, percent: int) -> DataFrame:
    """Second pass: (n, fp, prefix, bits) of every text that has words."""
    # Counts in 65,536 logarithmic steps: enough to tell rare from common, and quick to sort.
    ranks = (np.log1p(order.astype(np.float64)) * (65535 / np.log(2.0**32))).astype(np.uint16)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hasher, rank = WordHasher(), shared.value
        for batch in batches:
            sizes, prints, heads, bits = [], [], [], []
            for s in shingle_sets(texts_of(batch.column(0)), hasher, words):
                n = len(s)
                if n:
                    by = np.argsort(rank[s >> np.uint64(64 - ORDER_BITS)], kind="stable")
                    heads.append(s[by[: n - least_common(n, percent) + 1]].view(np.int64))
                    flags = np.zeros(64 * SIGNATURE_WORDS, np.uint8)
                    flags[((s * np.uint64(0x9FB21C651E98DF25)) >> np.uint64(54)).astype(np.int64) % len(flags)] = 1
                    bits.append(np.packbits(flags, bitorder="little").view(np.int64))
                    sizes.append(n)
                    prints.append(fingerprint(s))
            ends = np.cumsum([0, *map(len, heads)]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.zeros(0, np.int64)
            packed = np.concatenate(bits) if bits else np.zeros(0, np.int64)
            stops = (np.arange(len(bits) + 1) * SIGNATURE_WORDS).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sizes, pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(stops), pa.array(packed)),
                ],
                ["n", "fp", "prefix", "bits"],
            )

    return docs.select("text").mapInArrow(run, "n long, fp binary, prefix array<long>, bits array<long>")


def slots_of(keys: pa.Array, bits: int) -> np.ndarray:
    """A slot of 2 ** bits for each long; NULL has one too."""
    longs = keys.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return (mix(longs) >> np.uint64(64 - bits)).astype(np.int64)


def passes(slots: np.ndarray, marks: np.ndarray) -> np.ndarray:
    return (marks[slots >> 3] >> (7 - (slots & 7))) & 1 == 1


def marks_of(keys: DataFrame, bits: int) -> np.ndarray:
    """A filter of 2 ** bits packed flags that lets the values of a single long column through, and few others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros(1 << bits, np.uint8)
        for batch in batches:
            flags[slots_of(batch.column(0), bits)] = 1
        rows = list(bit_slices(flags))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["slot", "marks"])

    return either(keys.mapInArrow(count, "slot int, marks binary"), bits)


def with_texts(docs: DataFrame, routes: DataFrame) -> DataFrame:
    """`routes` with column text of the document that their id names. A filter of fixed size on the ids keeps most texts of
    other documents from being moved; the join is on the ids themselves."""
    shared = docs.sparkSession.sparkContext.broadcast(marks_of(routes.select("id"), PICK_BITS))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(passes(slots_of(batch.column(0), PICK_BITS), shared.value)))

    few = docs.mapInArrow(keep, "id long, text string").alias("d")
    return few.join(routes.alias("r"), F.col("d.id").eqNullSafe(F.col("r.id"))).select("r.*", "d.text")


def verified(docs: DataFrame, pairs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (hub, node) whose sets meet the threshold, by exact intersection. `nodes`: node, id, fp."""
    pairs = settle(pairs.select("hub", "node").distinct(), "pairs")
    # The end that is in more pairs becomes the hub: its text is moved once for many others.
    ends = pairs.select(F.col("hub").alias("end")).union(pairs.select("node")).groupBy("end").agg(F.count(F.lit(1)).alias("c"))
    ends = settle(ends, "ends")
    sized = pairs.join(ends.select(F.col("end").alias("hub"), F.col("c").alias("a")), "hub")
    sized = sized.join(ends.select(F.col("end").alias("node"), F.col("c").alias("b")), "node")
    turn = (F.col("b") > F.col("a")) | ((F.col("b") == F.col("a")) & (F.col("node") < F.col("hub")))
    turned = sized.select(F.when(turn, F.col("node")).otherwise(F.col("hub")).alias("hub"), F.when(turn, F.col("hub")).otherwise(F.col("node")).alias("node"))
    pairs = settle(turned.distinct(), "pairs")
    groups = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PER_HUB).cast("int").alias("parts"))
    copies = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    hubs = groups.join(nodes, groups["hub"] == nodes["node"]).select("hub", copies, F.lit(None).cast("long").alias("node"), "fp", "id")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    others = pairs.join(groups, "hub").select("hub", part, "node").join(nodes, "node").select("hub", "part", "node", "fp", "id")
    routes = settle(hubs.union(others), "routes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        hasher, hub, against = WordHasher(), None, None
        for batch in batches:
            rows = batch.to_pydict()
            found: tuple[list, list] = ([], [])
            sets = shingle_sets([t.encode() if t is not None else None for t in rows["text"]], hasher, words)
            for key, part, node, fp, own in zip(rows["hub"], rows["part"], rows["node"], rows["fp"], sets):
                if fingerprint(own) != fp:
                    continue  # another text under the same id
                if node is None:
                    hub, against = (key, part), own
                elif hub == (key, part) and linked(common(against, own), len(against), len(own), percent):
                    found[0].append(key)
                    found[1].append(node)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["hub", "node"])

    tiles = with_texts(docs, routes).repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("node").asc_nulls_first())
    return tiles.mapInArrow(run, "hub long, node long").distinct()


def tile_signature(small: Column) -> list[Column]:
    """The words of a signature in a tile row. In small tiles word k, of `TILE_WORDS`, is the union of every `TILE_WORDS`-th one from
    k on and the rest are 0, which take next to no room; a bit still stands for different members than any other."""
    unions = [reduce(Column.bitwiseOR, [F.col(f"s{j}") for j in range(k, SIGNATURE_WORDS, TILE_WORDS)]) for k in range(TILE_WORDS)]
    unions += [F.lit(0).cast("long")] * (SIGNATURE_WORDS - TILE_WORDS)
    return [F.when(small, union).otherwise(F.col(f"s{k}")).alias(f"s{k}") for k, union in enumerate(unions)]


def bound(left: str, right: str) -> Column:
    """Members of `left` that are certainly not in `right`: bits set in the one signature and not in the other."""
    terms = [F.bit_count(F.col(f"{left}.s{k}").bitwiseAND(F.bitwise_not(F.col(f"{right}.s{k}")))) for k in range(SIGNATURE_WORDS)]
    return sum(terms[1:], terms[0])


def possible(percent: int) -> Column:
    """Can sets `l` and `r` meet the threshold, by size and signature? An overlap o of sizes a and b meets it when
    (100 + percent) * o >= percent * (a + b)."""
    need = percent * (F.col("l.n") + F.col("r.n"))
    sizes = (100 * F.col("l.n") >= percent * F.col("r.n")) & (100 * F.col("r.n") >= percent * F.col("l.n"))
    left, right = F.col("l.n") - bound("l", "r"), F.col("r.n") - bound("r", "l")
    return sizes & ((100 + percent) * left >= need) & ((100 + percent) * right >= need)


def tokens_among(reps: DataFrame, owners: DataFrame) -> DataFrame:
    """(node, at, token) of the prefix shingles, without most that `owners` (token) lacks: a filter takes them out before
    anything is moved. It grows with the owners up to a fixed size."""
    bits = max(SLICES.bit_length() + 2, min(TOKEN_BITS, (PER_TOKEN * owners.count()).bit_length()))
    shared = reps.sparkSession.sparkContext.broadcast(marks_of(owners, bits))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            tokens = lists.flatten()
            here = np.flatnonzero(passes(slots_of(tokens, bits), shared.value))
            row = np.repeat(np.arange(len(sizes)), sizes)[here]
            at = (here - (np.cumsum(sizes) - sizes)[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(at), tokens.take(pa.array(here))], ["node", "at", "token"])

    return reps.select("node", "prefix").mapInArrow(keep, "node long, at int, token long")


def shared_tokens(reps: DataFrame) -> DataFrame:
    """(token, node, at, weight): who shares prefix shingles, `at` being the shingle's place in the node's order; one token, the
    first in the order, for all `weight` that the same nodes share."""
    tokens = reps.select(F.explode("prefix").alias("token"))
    owners = settle(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("token"), "owners")
    shared = settle(tokens_among(reps, owners).join(owners, "token").select("token", "node", "at"), "shared")
    who = [F.count(F.lit(1)).alias("c"), F.min(F.struct("node", "at")).alias("a"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("y")]
    # The order is common to all nodes: what comes first in one of them comes first in all.
    sets = shared.groupBy("token").agg(*who).groupBy("c", "a.node", "x", "y")
    kept = settle(sets.agg(F.min_by("token", "a.at").alias("token"), F.count(F.lit(1)).alias("weight")).select("token", "weight"), "tokens")
    return settle(shared.join(kept, "token"), "shared")


def star_pairs(shared: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, node): for each node the hubs that share most with it, as far as size and signature allow a link."""
    first = shared.groupBy("token").agg(*[F.min(F.col("node").bitwiseXOR(F.lit(k))).alias(f"h{i}") for i, k in enumerate(HUB_KEYS)])
    hubs = F.array_distinct(F.array(*[F.col(f"h{i}").bitwiseXOR(F.lit(k)) for i, k in enumerate(HUB_KEYS)]))
    seen = shared.join(settle(first.select("token", hubs.alias("hubs")), "hubs"), "token").select("node", "weight", F.explode("hubs").alias("hub"))
    votes = seen.filter("node <> hub").groupBy("node", "hub").agg(F.sum("weight").alias("votes"))
    turn = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("votes"), "hub"))
    best = votes.withColumn("turn", turn).filter(F.col("turn") <= HUBS).select("node", "hub").alias("p")
    with_hub = best.join(bits.alias("l"), F.col("p.hub") == F.col("l.node")).select("p.node", "l.*", F.col("p.hub").alias("hub")).toDF("to", *bits.columns, "hub")
    both = with_hub.alias("l").join(bits.alias("r"), F.col("l.to") == F.col("r.node"))
    return both.filter(possible(percent)).select("l.hub", F.col("l.to").alias("node"))


def tile_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that meet in a tile and may be linked; few come twice."""
    # Behind the first shingle that two sets have in common lies all the rest of their overlap, so a linked pair meets in the tile
    # of that shingle with enough behind it on both sides. The smaller set needs it behind its own place for any partner; those
    # rows are fewer, so they go to the two bands in which a partner may be.
    small = rows.filter((100 + percent) * (F.col("n") - F.col("at")) >= 2 * percent * F.col("n"))
    small = small.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1))).alias("l")
    tile = (F.col("l.token") == F.col("r.token")) & (F.col("l.band") == F.col("r.band")) & (F.col("l.root") != F.col("r.root"))
    order = (F.col("l.n") < F.col("r.n")) | ((F.col("l.n") == F.col("r.n")) & (F.col("l.node") < F.col("r.node")))
    behind = F.least(F.col("l.n") - F.col("l.at"), F.col("r.n") - F.col("r.at"))
    enough = (100 + percent) * behind >= percent * (F.col("l.n") + F.col("r.n"))
    # A linked pair passes all this in the first tile that it shares, so a tile behind another one of both has nothing to add.
    met = reduce(Column.__or__, [F.coalesce(F.col(f"l.{a}") == F.col(f"r.{b}"), F.lit(False)) for a in EARLIER_NAMES for b in EARLIER_NAMES])
    found = small.join(rows.alias("r"), tile & order & enough & ~met & possible(percent))
    return found.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))


def crossing(shared: DataFrame, roots: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """Pairs (hub, node) of different components that share a token and that places, sizes and signatures do not rule out."""
    placed = shared.join(roots, "node", "left").select("token", "node", "at", F.coalesce("root", "node").alias("root"))
    placed = settle(placed, "placed")
    mixed = placed.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count(F.lit(1)).alias("c"))
    mixed = settle(mixed.filter("a <> b").select("token", (F.col("c") <= SMALL).alias("small")), "mixed")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    before = Window.partitionBy("node").orderBy("at")
    earlier = [F.lag("token", k + 1).over(before).alias(e) for k, e in enumerate(EARLIER_NAMES)]
    rows = placed.join(mixed, "token").select("*", *earlier).join(bits, "node")
    rows = settle(rows.select("token", "node", "at", "root", "n", *EARLIER_NAMES, band.alias("band"), *tile_signature(F.col("small"))), "tiles")
    pairs = settle(tile_pairs(rows, percent).distinct(), "candidates")
    both = pairs.join(bits.alias("l"), F.col("a") == F.col("l.node")).join(bits.alias("r"), F.col("b") == F.col("r.node"))
    return both.filter(possible(percent)).select(F.col("a").alias("hub"), F.col("b").alias("node"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row of `docs`: the key (long), n_shingles (size of the set), component_id (smallest key of the component).

    Texts are lower-cased (A-Z) and split at ASCII blanks. NULL, empty and blank texts have no shingles, are linked with
    nothing and have their own key as component; a text of fewer than `words` words is one shingle. Equal sets are linked.
    Repeated rows are returned as often as they occur; rows of equal key with different texts are compared as the different
    texts they are. A NULL key is never the smallest unless the component has no other. Further columns are not used.
    """
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    return grouped(rows, words, percent).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id")


def marked_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """As `near_duplicates`, with mark (MD5 of the text) and top (names the component, NULL without shingles): doc_id, n_shingles,
    component_id, mark, top."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", F.md5(F.col("text")).alias("mark"))
    return grouped(rows, words, percent).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", "mark", "top")


def grouped(marked_rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(id, n, component_id) of rows (id, text), also (mark, top) of rows (id, text, mark)."""
    rows = marked_rows.select("id", "text")
    further = marked_rows.columns[2:]
    top = ["top"] if further else []
    first = settle(sizes_and_counts(marked_rows, words), "sizes")
    order = total(first.filter(F.col("slot").isNotNull()).select("slot", "counts"), ORDER_BITS)
    sized = first.filter(F.col("slot").isNull()).select("id", "n", "fp", *further)
    least = sized.filter("n > 0").groupBy("fp").agg(F.min("id").alias("id"))
    marked = signatures(rows, order, words, percent)
    once = marked.groupBy("fp").agg(F.max("n").alias("n"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    reps = settle(once.join(least, "fp").withColumn("node", F.monotonically_increasing_id()), "classes")
    nodes = reps.select("node", "id", "fp")

    bits = reps.select("node", "n", *[F.col("bits")[k].alias(f"s{k}") for k in range(SIGNATURE_WORDS)])
    shared = shared_tokens(reps)
    stars = settle(verified(rows, star_pairs(shared, bits, percent), nodes, words, percent), "stars")
    tree_of = components(stars.select(F.col("hub").alias("u"), F.col("node").alias("v")))
    rest = settle(verified(rows, crossing(shared, tree_of, bits, percent), nodes, words, percent), "rest")
    links = rest.join(tree_of.withColumnRenamed("node", "hub"), "hub", "left").select(F.coalesce("root", "hub").alias("u"), "node")
    links = links.join(tree_of, "node", "left").select("u", F.coalesce("root", "node").alias("v"))
    above = components(links).select(F.col("node").alias("root"), F.col("root").alias("top"))
    placed = nodes.join(tree_of, "node", "left").select("fp", "id", F.coalesce("root", "node").alias("root"))
    placed = settle(placed.join(above, "root", "left").select("fp", "id", F.coalesce("top", "root").alias("top")), "tops")
    named = placed.groupBy("top").agg(F.min("id").alias("component_id"))
    classes = settle(placed.join(named, "top").select("fp", "component_id", *top), "components")
    out = sized.filter("n > 0").join(classes, "fp").select("id", "n", "component_id", *further, *top)
    alone = sized.filter("n = 0").select("id", "n", F.col("id").alias("component_id"), *further, *[F.lit(None).cast("long").alias(c) for c in top])
    return out.union(alone)
