"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cohortspark.llm import spelling
from cohortspark.llm.common import prepare

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counted(docs, min_letters, min_count, misspell):
    out = Counter()
    for key, text in docs:
        for w, n in Counter(x.translate(UPPER) for x in re.findall("[A-Za-zÀ-ÿ]+", text or "")).items():
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if misspell and h % misspell == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            out[w] += n
    return {w: n for w, n in out.items() if len(w) >= min_letters and n >= min_count}


def grouped(words, factor=spelling.FACTOR):
    form, many = {}, {}
    for a, n in words.items():
        close = [b for b in words if near(a, b)]
        many[a] = len(close)
        best = min(close, key=lambda b: (-words[b], b), default=None)
        form[a] = best if best is not None and words[best] >= factor * n else None
    out = set()
    for a in words:
        root = a
        while form[root] is not None:
            root = form[root]
        out.add((a, form[a], root, words[a], many[a], words[form[a]] if form[a] is not None else None))
    return out


def rows(df):
    found = [tuple(r) for r in df.collect()]
    assert len(found) == len(set(found))
    return set(found)


def some_words(seed, count, alphabet="abcdeé", least=2, most=7):
    rng = random.Random(seed)
    words = {"".join(rng.choices(alphabet, k=rng.randrange(least, most))): rng.choice([1, 2, 5, 30, 200, 1000]) for _ in range(count)}
    return dict(sorted(words.items()))


@pytest.mark.parametrize("node,searchers", [(10_000, 10_000), (40, 10_000), (5, 10_000), (2, 3), (1, 1)])
def test_shared_out_in_any_way(spark, node, searchers):
    words = some_words(node, 150)
    words |= {"anagram": 3, "anagrma": 3, "nagaram": 50, "q" * 70: 5, "q" * 71: 40, "q" * 69 + "r": 300, "r" + "q" * 69: 1}
    words |= {a + b: 7 for a in "pac" for b in "pbs"} | {"aq": 9, "qa": 9}  # letters of one group: p and a share none, q and a do
    df = prepare(spark).createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows(spelling.group_variants(df, node=node, searchers=searchers)) == grouped(words)


def test_one_vector_for_all_words(spark):
    """Letters of one group only: no count tells the words apart."""
    rng = random.Random(1)
    words = {"".join(rng.choices("aqAQ".lower() + "á", k=8)): rng.randrange(1, 500) for _ in range(120)}
    df = prepare(spark).createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling.group_variants(df, node=10)) == grouped(words)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("abqrsé", min_size=1, max_size=6), st.integers(1, 9), min_size=1, max_size=40), st.integers(1, 6))
def test_node(words, bucket):
    """A node's members and searchers are the same words: each pair is told once to each side."""
    names, counts = [w.encode("latin-1") for w in words], np.array(list(words.values()))
    node = spelling.Node(0, names, counts, bucket)
    told = Counter()
    best = {}
    for w, n, c, b in node.search(names, counts) + node.told():
        told[w.decode("latin-1")] += n
        key = (-c, b.decode("latin-1"))
        best[w] = min(best.get(w, key), key)
    for w in words:
        close = [x for x in words if near(w, x)]
        assert told[w] == len(close)
        if close:
            assert best[w.encode("latin-1")] == min((-words[x], x) for x in close)


@pytest.mark.parametrize("misspell", [None, 1, 3])
def test_texts(spark, misspell):
    rng = random.Random(7)
    vocabulary = ["Straße", "strasse", "colour", "color", "COLOR", "naïve", "naive", "Ünter", "unter", "abc", "ÀÉÿ", "x"]
    docs = [(k % 50, " ".join(rng.choices(vocabulary, k=30)) + rng.choice([" don't", "日本color語", "—unter—", "İx"])) for k in range(120)]
    docs += [(None, "color color"), (None, None), (1, ""), (2, "color\u0000unter\tß" * 40)]
    df = prepare(spark).createDataFrame([(k, t, "clash", 1) for k, t in docs], "doc_id long, text string, word string, n int")
    out = spelling.spelling_variants(df, min_letters=3, min_count=2, factor=2, misspell=misspell)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(out) == grouped(counted(docs, 3, 2, misspell), 2)


def test_chains_ties_and_no_rows(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "abbbbb": 15625, "zzzzzz": 1, "zzzzzy": 5, "zzzzzx": 5}
    df = prepare(spark).createDataFrame(list(words.items()), "word string, n long")
    out = rows(spelling.group_variants(df))
    assert out == grouped(words)
    assert ("aaaaaa", "aaaaab", "abbbbb", 5, 1, 25) in out and ("zzzzzz", "zzzzzx", "zzzzzx", 1, 2, 5) in out
    assert rows(spelling.group_variants(df.limit(0))) == set()
    docs = spark.createDataFrame([(1, None)], "doc_id long, text string")
    assert rows(spelling.spelling_variants(docs)) == rows(spelling.spelling_variants(docs.limit(0))) == set()


def test_long_texts_are_read_in_chunks(monkeypatch):
    text = ("Größe und Maß, " * 500 + "y" * 5000 + " z").encode()
    whole = [w for part in spelling.words_of(text) for w in part]
    monkeypatch.setattr(spelling, "CHUNK", 100)
    parts = list(spelling.words_of(text))
    assert len(parts) > 50 and [w for part in parts for w in part] == whole
    assert [w.decode("latin-1") for w in whole] == [w.translate(UPPER) for w in re.findall("[A-Za-zÀ-ÿ]+", text.decode())]


def test_long_words():
    a = b"x" * 100_000
    assert spelling.one_apart(a, a + b"x") and spelling.one_apart(a, b"y" + a[1:])
    assert not spelling.one_apart(a, a) and not spelling.one_apart(a, b"yy" + a[2:])


def test_small_memory(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    docs = [(k, "alpha beta gamma delta alphas betas") for k in range(20)]
    df = prepare(spark).createDataFrame(docs, "doc_id long, text string")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df, min_letters=1, misspell=5).collect()}
    assert got == counted(docs, 1, 5, 5)
