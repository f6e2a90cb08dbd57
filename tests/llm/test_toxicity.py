"""Disguises undone, the lattice against all readings, and held-out accuracy."""

import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest

from cohortspark.llm import toxicity as tox
from cohortspark.llm.common import prepare
from cohortspark.llm.queries import QUERIES
from cohortspark.llm.sketch import SLICES

FOLDER = "/root/testdata/sf0.1"
CLEAN = "the weather is good and people walk along the river in a small town with trees houses gardens".split()
BAD = ["stupid", "idiot", "worthless", "moron", "clown"]
DISGUISED = {
    "1d10t": "idiot", "st*pid": "stupid", "m-o-r-o-n": "moron", "w0rthle$$": "worthless", "mooooron": "moron",
    "cl0wn!!": "clown", "s t u p i d": "stupid", "i.d.i.o.t,": "idiot",
}


def counted(texts):
    s = tox.symbols(" ".join(["", "", *texts, ""])).astype(np.int64)
    return np.bincount((s[:-2] << 12) | (s[1:-1] << 6) | s[2:], minlength=1 << tox.LM_BITS)


@pytest.fixture(scope="module")
def letters():
    rng = random.Random(0)
    return tox.letter_model(counted([" ".join(rng.choices(CLEAN * 3 + BAD, k=2000))]))


def test_restore(letters):
    for disguised, plain in DISGUISED.items():
        assert tox.restore(f"you {disguised} there", letters) == f"you {plain} there"
    assert tox.restore("The good people, walk!", letters) == "the good people walk"
    assert tox.restore(None, letters) is None and tox.restore("", letters) == ""


def test_viterbi_finds_the_best_reading(letters):
    def worth(options):
        s, a, b = sum(cost for _, cost in options), 0, 0
        for c in "".join(x for x, _ in options):
            z = int(tox._TABLE[min(ord(c), 0x180)])
            s, a, b = s + letters[a, b, z], b, z
        return s + letters[a, b, 0]

    for word in ["1d10t", "st*p1d", "m.0.r0n", "aaa4bbb", "c1l|o"]:
        best = max(itertools.product(*tox.lattice(word)), key=worth)
        assert tox.read(word, letters) == "".join(x for x, _ in best)


def table(spark):
    rng, rows, labels = random.Random(1), [], []
    for k in range(400):
        words = rng.choices(CLEAN, k=rng.choice([5, 60]))
        if k % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((k, " ".join(words), 9.0))
        labels.append((k, int(k % 4 == 0)))
    rows += [(1000, None, 0.0), (1001, "", 0.0), (1002, "you " + "nice " * 400_000 + " 1d10t", 0.0), (None, "a moron", 0.0), (3, rows[3][1], 9.0)]
    labels += [(None, 1), (1, None), (5000, 1)]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, score double").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_table(spark):
    docs, labels = table(spark)
    model = tox.train(docs, labels)
    out = tox.score(docs, model)
    assert out.columns == ["doc_id", "text", "score", "predicted", "n_restored"]
    rows = {r["doc_id"]: r for r in out.collect()}
    wrong = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 0 and rows[k]["predicted"] != int(k % 4 == 0)]
    assert not wrong
    assert rows[1000]["score"] == rows[1001]["score"] < 0.5
    assert rows[1002]["predicted"] == 1 and rows[1002]["n_restored"] == 1 and rows[None]["predicted"] == 1
    assert out.filter("doc_id = 3").select("score").distinct().count() == 1


def test_counts_do_not_depend_on_partitions(spark):
    docs, _ = table(spark)
    want = tox.letter_counts(docs.repartition(1))
    got = tox.letter_counts(docs.repartition(7))
    assert abs(int(want.sum()) - int(got.sum())) <= 3 * 7 and (1 << tox.LM_BITS) % SLICES == 0


def test_no_labels_and_no_rows(spark):
    docs, labels = table(spark)
    model = tox.train(docs, labels.limit(0))
    assert all(r["score"] <= 0.5 for r in tox.score(docs, model).collect())
    assert tox.score(docs.limit(0), tox.train(docs.limit(0), labels)).collect() == []


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    tested = [(r["toxic"], rows[r["doc_id"]]) for r in labels if rows.get(r["doc_id"]) and rows[r["doc_id"]]["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0) for k, r in rows.items())
    caught = [r["predicted"] for y, r in tested if y == 1]
    false = [r["predicted"] for y, r in tested if y == 0]
    assert sum(caught) / len(caught) > 0.8 and sum(false) / len(false) < 0.01


OLD_ODD = re.compile(r"[^\W\d_].*[\d@$!|+(€£¡*#._~'`’·-].*[^\W\d_]|^[\d@$!|+(€£¡*#][^\W_]*[^\W\d_]|[^\W\d_][^\W_]*[\d@$|+(€£*#]$")


def test_odd_words_by_the_pattern():
    rng = random.Random(3)
    for _ in range(20_000):
        word = "".join(rng.choices("abé1_@$!.-*²Ⅷ/%", k=rng.randrange(7)))
        assert tox.odd(word) == bool(OLD_ODD.search(word)), word


@pytest.mark.parametrize("text", ["a/" * 500_000, "a" * 1_000_000 + "/", "a." * 20_000, "1" * 500_000 + "/"])
def test_long_tokens_take_linear_time(text):
    model = tox.letter_model(np.ones(1 << tox.LM_BITS, np.int64))
    begin = time.perf_counter()
    tox.restored(text, model)
    assert time.perf_counter() - begin < 10


def test_long_words_are_read_as_one(monkeypatch):
    """The state goes on from stretch to stretch: any length of them gives the same reading."""
    rng = random.Random(8)
    counts = np.array([rng.randrange(50) for _ in range(1 << tox.LM_BITS)])
    model = tox.letter_model(counts)
    for _ in range(20):
        word = "".join(rng.choices("abcde013$@.*", k=200))
        monkeypatch.setattr(tox, "_LATTICE", 10_000)
        whole = tox.read(word, model)
        monkeypatch.setattr(tox, "_LATTICE", 7)
        assert tox.read(word, model) == whole


def test_sample_is_bounded_for_a_frequent_key(spark):
    docs = spark.range(20_000).selectExpr("1 AS doc_id", "concat('text ', id) AS text")
    labels = spark.createDataFrame([(1, 1)] * 50 + [(1, 0)] * 50 + [(None, 1), (1, None)], "doc_id int, toxic int")
    rows = tox.labelled_sample(docs, labels, "doc_id", "text", "toxic", 20)
    assert 20 <= len(rows) <= 40 and {label for _, label in rows} == {0, 1}
