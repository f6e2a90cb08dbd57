"""Removal of repeated strings against a plain count of all strings."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortspark.llm import suffix_dedup
from cohortspark.llm.common import prepare
from cohortspark.llm.phrases import Rolling, triggers
from cohortspark.llm.queries import QUERIES


def brute(texts, size):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[k : k + size] for d in data for k in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for k in range(len(d) - size + 1):
            if seen[d[k : k + size]] > 1:
                gone[k : k + size] = b"\1" * size
        left = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(d), sum(gone), spans, left))
    return out


@pytest.mark.parametrize("reach", [1, 3, 10])
def test_triggers_depend_on_the_string_alone(reach):
    rng = random.Random(reach)
    text = bytes(rng.choices(b"abc", k=300)) + b"a" * 60 + bytes(rng.choices(b"ab", k=200))
    rolling = Rolling()
    rolling.load(text)
    count = len(text) - 40 + 1
    place, first, last = triggers(rolling, len(text), reach, count)
    assert first[0] == 0 and last[-1] == count - 1 and (first[1:] == last[:-1] + 1).all()
    of = {s: p - s for p, a, b in zip(place, first, last) for s in range(a, b + 1)}
    where = {}
    for s in range(count):
        assert 0 <= of[s] < reach
        assert where.setdefault(text[s : s + 40], of[s]) == of[s]


def corpus(seed):
    rng = random.Random(seed)

    def some(n):
        return "".join(rng.choices(["ab", "c", "é", "the ", "日", "x"], k=n))

    passages = [some(40), some(25), some(120)]
    texts = [None, "", "short", "z" * 300, "zz" * 100, "ab " * 90]
    for _ in range(60):
        t = some(rng.choice([5, 60, 200]))
        for _ in range(rng.choice([0, 1, 2])):
            at = rng.randrange(len(t) + 1)
            p = rng.choice(passages)
            a = rng.randrange(0, 10)
            t = t[:at] + p[a : a + rng.choice([30, 60, 500])] + t[at:]
        texts.append(t)
    return texts + texts[-4:] + texts[-2:] + [texts[-9][:-1] + "!", passages[2] * 3]


@pytest.mark.parametrize("seed,size", [(0, 40), (1, 64), (2, 33)])
def test_brute_force(spark, seed, size, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LONG", 150)
    texts = corpus(seed)
    df = prepare(spark).createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, n_bytes string, h1 int")
    out = suffix_dedup.remove_repeats(df.repartition(4), size=size)
    assert out.columns == ["doc_id", "h1", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in out.collect()}
    want = brute(texts, size)
    assert [got[k] for k in range(len(texts))] == want
    assert any(0 < w[1] < w[0] for w in want)


def test_a_frequent_name_is_not_sent_to_one_task(spark, monkeypatch):
    prepare(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(0, 800, 1, 8).selectExpr("id", "if(id % 10 < 7, 5, id) as whole")
        names = rows.groupBy("whole").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("owner"))
        want = sorted(map(tuple, rows.join(names, "whole").select("id", "whole", "c", "owner").collect()))
        for limit, most in ((559, 70), (560, 560)):  # the name 5 has 560 rows, 70 in each task
            monkeypatch.setattr(suffix_dedup, "HOT_ROWS", limit)
            out = suffix_dedup.with_counts(rows, names, "whole").select("id", "whole", "c", "owner")
            assert sorted(map(tuple, out.collect())) == want
            tasks = out.filter("whole = 5").groupBy(F.spark_partition_id()).count().collect()
            assert max(r["count"] for r in tasks) == most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_brute_force_with_frequent_names(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 3)
    texts = [*corpus(3), *(f"{k} " + "the same line over and over " * 9 + f" {k * k}" for k in range(8))]
    df = prepare(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(df.repartition(4), size=40).collect()}
    assert [got[k] for k in range(len(texts))] == brute(texts, 40)


def test_empty_and_long(spark):
    df = prepare(spark).createDataFrame([(1, None)], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df.limit(0)).collect() == []
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(df).collect()] == [0]
    rng = random.Random(0)
    part = "".join(rng.choices("abcdefgh", k=3000))
    text = "".join(rng.choices("abcdefgh", k=200_000)) + part + "".join(rng.choices("abcdefgh", k=100_000)) + part
    out = suffix_dedup.remove_repeats(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert 6000 <= out["n_removed"] <= 6010 and out["n_spans"] == 2


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = {r["doc_id"]: r for r in QUERIES["op6_repeats"](spark, folder).collect()}
    for r, (n, removed, spans, left) in zip(rows, brute([r["text"] for r in rows], 400)):
        own = got[r["doc_id"]]
        assert (own["n_bytes"], own["n_removed"], own["n_spans"]) == (n, removed, spans)
        assert own["kept_sha256"] == hashlib.sha256(left).hexdigest()


def test_planted_passages_go_from_400_bytes_on(spark, tmp_path):
    rng = random.Random(6)

    def prose(words):
        return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(4, 7))) for _ in range(words))

    whole, shorter = prose(90)[:400], prose(90)[:399]
    assert min(len(whole.split()), len(shorter.split())) > 50
    # What stands next to a passage differs, so that no longer string is shared.
    rows = [(k, f"{prose(200)} {k}{p}{k} {prose(200)}") for k, p in enumerate([whole, shorter, "", whole, shorter, "", whole])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in QUERIES["op6_repeats"](spark, str(tmp_path)).collect()}
    for k, text in rows:
        gone = whole in text
        left = text.replace(whole, "")
        assert (got[k]["n_bytes"], got[k]["n_removed"], got[k]["n_spans"], got[k]["repeated"]) == (len(text), 400 * gone, int(gone), gone)
        assert got[k]["kept_sha256"] == hashlib.sha256(left.encode()).hexdigest()
