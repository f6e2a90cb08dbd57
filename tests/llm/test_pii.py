"""The rules against plain regular expressions, the field against enumeration, and whole tables."""

import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortspark.llm import pii
from cohortspark.llm.common import prepare
from cohortspark.llm.queries import QUERIES

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def n(s):
        return len(re.findall("[0-9]", s))

    def check(s):
        d = [int(c) for c in s if c in "0123456789"][::-1]
        return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0

    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= n(m[0]) <= 19 and check(m[0])]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= n(m[0]) <= 15]


def number(rng):
    d = [rng.randrange(10) for _ in range(15)]
    total = sum(x if k % 2 else sum(divmod(2 * x, 10)) for k, x in enumerate(d))
    return "".join(map(str, [*d, -total % 10]))


def sample(seed, n=150):
    rng, out = random.Random(seed), []
    for k in range(n):
        words = rng.choices(["the", "Straße", "version 2.0", "12", "in 2024", "été", "x_1"], k=12)
        words[3] = f"{rng.choice('abc')}{k}.m@mail{k % 7}.example.com"
        words[5] = ".".join(str(rng.randrange(256)) for _ in range(4))
        words[7] = number(rng)
        words[9] = f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(10000):04d}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def field():
    return pii.train(sample(1))


def test_rules():
    rng = random.Random(0)
    fixed = ["a@b@c.d", "..@x.y", "a@b.c.@d.e", "@x.y", "é.a@b.c-d.", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.4", "+1 (2", "4111 1111-1111 1111"]
    for text in fixed + ["".join(rng.choices("a1.@+-() 05é\n", k=40)) for _ in range(4000)] + sample(2):
        assert pii.base_spans(text) == brute(text), text


def test_field_finds_spans_and_disguises(field):
    right = total = 0
    for text in sample(7, 60):
        want = set(pii.base_spans(text))
        right += len(want & {s for a, b in pii.regions(text) for s in field.decode(text, a, b)})
        total += len(want)
    assert right > 0.9 * total
    text = "write to jo.doe at example dot com or anna(at)site(dot)org, call (265) 555-8108"
    assert {text[a:b] for _, a, b in pii.all_spans(text, field)[1]} == {"jo.doe at example dot com", "anna(at)site(dot)org", "(265) 555-8108"}
    for clean in ["", "version 2.0 of the book has 12 parts", "in 2024 the Straße", "a x_1 b", "look at the dot there"]:
        assert pii.all_spans(clean, field) == ([], [])


def test_decode_is_the_best_segmentation(field):
    text = " 10.1.2.3 +1 (265) 555-8108 "
    borders, segments, kind = field.lattice(text, 1, len(text) - 1, learn=False)
    values = {(i, j): v for (i, j, _), v in zip(segments, field.scores(segments))}
    n, width = len(kind), len(pii.KINDS)
    best = {(0, width): 0.0}
    for at in range(n):  # every path, the best score for each place and kind
        for k in range(width + 1):
            if (at, k) not in best:
                continue
            s = best[at, k]
            steps = [((at + 1, width), s + field.after[k, -1] + field.outside[kind[at]])]
            steps += [((j, y), s + field.after[k, y] + v[y]) for (i, j), v in values.items() if i == at for y in range(width)]
            for key, x in steps:
                best[key] = max(best.get(key, -np.inf), x)
    want = max(best[n, k] for k in range(width + 1) if (n, k) in best)
    path, at, score, before = field.decode(text, 1, len(text) - 1), 0, 0.0, width
    place = {x: k for k, x in enumerate(borders)}
    ends = {place[a]: (place[b], pii.KINDS.index(k)) for k, a, b in path}
    while at < n:
        if at in ends:
            j, y = ends[at]
            score, before, at = score + field.after[before, y] + values[at, j][y], y, j
        else:
            score, before, at = score + field.after[before, -1] + field.outside[kind[at]], width, at + 1
    assert abs(score - want) < 1e-9


def test_table(spark, field):
    rows = [(1, None, "a"), (2, "", "b"), (3, sample(3)[0], "c"), (3, sample(3)[0], "c"), (None, "7 " * 200_000 + "a@b.cd", "d")]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string, spans string")
    out = pii.find_spans(df, field)
    for r, (key, text, _) in zip(out.collect(), rows):
        want = brute(text or "")
        assert r["doc_id"] == key and [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(pii.named(want).encode()).hexdigest()
        assert set(filter(None, pii.named(want).split(","))) <= set(r["spans"].split(","))
    assert pii.find_spans(df.limit(0), pii.fit(df.limit(0))).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op9_pii"](spark, folder).collect():
        assert r["base_sha256"] == hashlib.sha256(pii.named(brute(texts[r["doc_id"]])).encode()).hexdigest()


def test_repeated_keys_do_not_fill_the_driver(spark, monkeypatch):
    taken, plain = [], type(spark.range(0)).collect
    monkeypatch.setattr(type(spark.range(0)), "collect", lambda self: taken.append(plain(self)) or taken[-1])
    monkeypatch.setattr(pii, "train", lambda texts: texts)
    few = 20
    most = 2 * (few + 5 * few**0.5 + 20)  # the limit of share_of, with room for chance
    docs = prepare(spark).range(6000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.format_string("no. %d", "id").alias("text"))
    texts = pii.fit(docs, sample=few)
    assert len(texts) == few and 0 < len(taken[-1]) < most
    keyed = sum(int(t.split()[1]) % 3 > 0 for t in texts)
    assert 0 < keyed  # rows with a key are not crowded out
    copies = docs.select("doc_id", F.lit("no. 7").alias("text")).filter("doc_id IS NULL").union(docs.filter("doc_id IS NOT NULL"))
    pii.fit(copies, sample=few)
    assert len(taken[-1]) < most


def test_regions_do_not_cut_numbers():
    text = "x=1" + "k" * 60 + "00491701234567"
    assert pii.regions(text) == [(0, 77)]
    chain = "".join(f"1{'k' * 60}" for _ in range(30)) + "4" * 200 + "z" * 100
    (a, b), *rest = pii.regions(chain)
    assert not any(c.isdigit() for c in chain[b:]) and not rest


@pytest.mark.parametrize("text", ["1" * 1_000_000, "1." * 400_000, "a1" * 100_000, "+1" * 300_000, "a@" * 300_000, "1 " * 300_000])
def test_long_texts_take_linear_time(text):
    begin = time.perf_counter()
    pii.base_spans(text)
    pii.regions(text)
    assert time.perf_counter() - begin < 10


def test_added_spans_touch_no_base_span():
    class Every:
        def decode(self, text, a, b):
            return [("phone", k, k + 3) for k in range(a, b - 2)]

    text = "a@b.cd 1.2.3.4 x@y.zz 5 and 77777"
    base, every = pii.all_spans(text, Every())
    taken = {k for _, a, b in base for k in range(a, b)}
    added = [s for s in every if s not in base]
    assert added and not any(taken & set(range(a, b)) for _, a, b in added)
    free = [(x, x + 3) for a, b in pii.regions(text) for x in range(a, b - 2) if not taken & set(range(x, x + 3))]
    assert sorted(free) == sorted((a, b) for _, a, b in added)


def test_bytes_that_are_no_text(spark):
    df = spark.range(1).selectExpr("id AS doc_id", "cast(unhex('61ff40622e636f') as string) AS text")
    row = pii.find_spans(df, pii.train(["mail a@b.co now"])).first()
    assert row["n_email"] == 0 and row["n_ip"] == 0
