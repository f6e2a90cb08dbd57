"""FM-index and benchmark decontamination against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from cohortspark.llm import decontaminate as dec
from cohortspark.llm.common import prepare
from cohortspark.llm.fm_index import FmIndex, suffix_order
from cohortspark.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench, window=13):
    """(n_words, n_hit, items) of each text, by comparing every window at every place."""
    windows = {}
    for item, text in bench:
        if item is None or text is None:
            continue
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for text in docs:
        w, hit, items = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                own = windows.get(tuple(w[k : k + n]))
                if own:
                    hit.update(range(k, k + n))
                    items |= own
        out.append((len(w), len(hit), sorted(items)))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_index(seed):
    rng = np.random.default_rng(seed)
    seq = rng.integers(0, 4, 500)
    seq[100:200] = seq[200:300]
    seq[-1] = 0
    places = np.flatnonzero(seq == 0)
    unique = {p: k for k, p in enumerate(places)}  # each break a symbol of its own
    full = [unique[i] if s == 0 else len(places) + s for i, s in enumerate(seq)]
    assert suffix_order(seq).tolist() == sorted(range(len(seq)), key=lambda i: full[i:])
    index = FmIndex(seq, 4, sample=5)
    for length in (1, 2, 5):
        phrases = rng.integers(1, 4, (20, length))
        low, high = index.search(phrases)
        for p, a, b in zip(phrases, low, high):
            want = [i for i in range(len(seq) - length + 1) if (seq[i : i + length] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def cases():
    rng = random.Random(5)
    vocab = [f"w{k}" for k in range(40)] + ["Ä", "straße", "日本"]
    bench = [(k, " ".join(rng.choices(vocab, k=rng.choice([1, 5, 12, 13, 14, 40])))) for k in range(12)]
    bench += [(3, bench[7][1]), (50, None), (None, "w1 w2"), (51, ""), (52, "?!"), (53, bench[7][1].upper())]
    docs = [None, "", "...", "w1"]
    for _ in range(60):
        text = rng.choices(vocab + [f"x{k}" for k in range(10)], k=rng.choice([3, 30, 200]))
        for _ in range(rng.choice([0, 1, 3])):
            at = rng.randrange(len(text))
            text[at:at] = rng.choice([b[1] or "" for b in bench]).split()
        docs.append(rng.choice([" ", ", ", "\n"]).join(text))
    return docs + docs[-3:] + [" ".join(docs[4:30]) * 20], bench


@pytest.mark.parametrize("shard,block", [(1 << 20, 200_000), (50, 60)])
def test_brute_force(spark, shard, block):
    """One shard and block, or many of both."""
    docs, bench = cases()
    left = prepare(spark).createDataFrame([(k, t, "x") for k, t in enumerate(docs)], "id long, text string, items string")
    right = spark.createDataFrame(bench, "item_id long, text string")
    rows = dec.find_contamination(left, right, shard_words=shard, block_words=block).orderBy("id").collect()
    want = brute(docs, bench)
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in rows] == want
    assert any(w[1] for w in want)
    for r, (n, hit, items) in zip(rows, want):
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n) and r["n_items"] == len(items)
        inside = " ".join((r["text"] or "")[s["start"] : s["end"]] for s in r["spans"])
        assert len(words(inside)) == hit
        assert len(words(dec.cut_spans(r["text"], r["spans"]))) == n - hit


def test_empty_tables(spark):
    docs = prepare(spark).createDataFrame([(1, "a b")], "id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in dec.find_contamination(docs, bench).collect()] == [0]
    assert dec.find_contamination(docs.limit(0), bench).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in QUERIES["op1_decontaminate"](spark, folder).collect()}
    for r, (n, hit, items) in zip(docs, brute([r["text"] for r in docs], bench)):
        own = got[r["doc_id"]]
        assert (own["n_words"], own["n_hit"], own["n_items"]) == (n, hit, len(items))
        assert own["items_sha256"] == hashlib.sha256(",".join(items).encode()).hexdigest()
