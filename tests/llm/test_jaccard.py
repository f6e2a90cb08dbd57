"""The n-gram Jaccard join against all pairs of small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import jaccard
from cohortspark.llm.common import prepare
from cohortspark.llm.graph import components
from cohortspark.llm.queries import QUERIES
from cohortspark.llm.shingles import WordHasher, common, shingle_sets


def sets(text, size=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        w = w.replace(c, " ")
    w = [x for x in w.split(" ") if x]
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)}


def brute(rows):
    own = [(k, sets(t)) for k, t in rows]
    root = list(range(len(own)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(own):
        for j in range(i):
            b = own[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (k, _) in enumerate(own):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    return sorted(((k, len(s), least.get(top(i)) if s else k) for i, (k, s) in enumerate(own)), key=str)


def run(spark, rows):
    df = prepare(spark).createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, node string")
    return sorted(map(tuple, jaccard.near_duplicates(df.repartition(5)).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)] + ["É", "日本", " nb"]
    passage = " ".join(rng.choices(vocab, k=60))
    texts = [None, "", " \n", "one two", "One\ttwo", "a b c d e", "a b c d e f", "A B c d e"]
    for _ in range(25):
        base = rng.choices(vocab, k=rng.choice([6, 30, 80, 400]))
        if rng.random() < 0.3:
            base = base[:20] + passage.split() + base[20:]
        for _ in range(rng.choice([1, 1, 4, 12])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1])] = rng.choices(vocab, k=rng.choice([0, 1]))
            texts.append(rng.choice([" ", "\n"]).join(copy))
    texts += texts[10:14]
    keys = list(range(len(texts)))
    rng.shuffle(keys)
    return [(k + 5, t) for k, t in zip(keys, texts)]


@pytest.mark.parametrize("seed", range(3))
def test_all_pairs(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_no_keys_repeats_and_long_texts(spark, monkeypatch):
    long = " ".join(f"t{k % 7919}" for k in range(200_000))
    rows = [(1, long), (2, long + " end"), (None, "a b c d e f g h"), (None, "a b c d e f g h"), (3, "q"), (3, "q"), (3, "other text")]
    assert run(spark, rows) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1)]


def test_sets_do_not_depend_on_blocks(monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["aa", "b", "ccc", "é"], k=rng.choice([0, 1, 4, 5, 90]))).encode() for _ in range(50)] + [None]
    want = [s.tolist() for s in shingle_sets(texts, WordHasher())]
    monkeypatch.setattr("cohortspark.llm.shingles.BLOCK", 30)
    assert [s.tolist() for s in shingle_sets(texts, WordHasher())] == want
    assert [len(s) for s in want] == [len(sets((t or b"").decode())) for t in texts]
    a, b = np.array([1, 4, 9], np.uint64), np.array([4, 5, 9, 11], np.uint64)
    assert common(a, b) == common(b, a) == 2 and common(a[:0], b) == 0


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(200 + k, 201 + k) for k in range(40)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in found} == {(x, top(x)) for x in root}


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op4_ngram_jaccard"](spark, folder).collect()), key=str) == brute(rows)


def classes(spark, texts):
    """The classes of texts as the join sees them, and a link table without links."""
    docs = prepare(spark).createDataFrame(list(enumerate(texts)), "id long, text string")
    order = np.zeros(1 << jaccard.ORDER_BITS, np.uint32)
    reps = jaccard.signatures(docs, order, 5, 80).withColumn("node", F.monotonically_increasing_id()).localCheckpoint()
    return reps, spark.createDataFrame([], "node long, root long")


def test_pairs_meet_in_few_tiles(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(20):
        copy = list(base)
        for at in rng.sample(range(300), 3):
            copy[at] = f"x{k}-{at}"
        texts.append(" ".join(copy))
    reps, roots = classes(spark, texts)
    seen = []
    real = jaccard.tile_pairs
    monkeypatch.setattr(jaccard, "tile_pairs", lambda rows, percent: seen.append(real(rows, percent)) or seen[0])
    bits = reps.select("node", "n", *[F.col("bits")[k].alias(f"s{k}") for k in range(jaccard.SIGNATURE_WORDS)])
    found = jaccard.crossing(jaccard.shared_tokens(reps), roots, bits, 80)
    pairs = {frozenset(r) for r in found.collect()}
    node = {r["fp"]: r["node"] for r in reps.collect()}
    own = [node[jaccard.fingerprint(next(shingle_sets([t.encode()], WordHasher())))] for t in texts]
    links = {frozenset((own[i], own[j])) for i in range(20) for j in range(i) if 100 * len(sets(texts[i]) & sets(texts[j])) >= 80 * len(sets(texts[i]) | sets(texts[j]))}
    assert links and links <= pairs
    assert seen[0].count() <= 1.5 * seen[0].distinct().count()


def test_only_shared_shingles_are_moved(spark):
    texts = [" ".join(f"t{k}-{j}" for j in range(100)) for k in range(60)]
    texts += [" ".join([*(f"s{j}" for j in range(30)), *(f"u{k}-{j}" for j in range(4))]) for k in range(3)]
    reps, _ = classes(spark, [*texts, "one", ""])
    tokens = reps.select("node", F.posexplode("prefix").alias("at", "token"))
    owners = tokens.groupBy("token").count().filter("count > 1").select("token").localCheckpoint()
    moved = jaccard.tokens_among(reps, owners)
    names = ["node", "at", "token"]
    assert sorted(map(tuple, moved.join(owners, "token").select(names).collect())) == sorted(map(tuple, tokens.join(owners, "token").select(names).collect()))
    assert 0 < moved.count() < tokens.count() / 4
    assert jaccard.tokens_among(reps, owners.limit(0)).count() == 0
