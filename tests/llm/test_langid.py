"""The network's derivatives against differences, prediction against a plain loop, held-out accuracy."""

import zlib

import numpy as np

from cohortspark.llm import langid
from cohortspark.llm.common import prepare
from cohortspark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def test_backpropagation_through_time():
    net = langid.Net.fresh(["a", "b", "c"], hidden=3, seed=4)
    net = langid.Net(net.languages, *[x.astype(np.float64) for x in net.parameters()])
    rng = np.random.default_rng(0)
    data = rng.integers(97, 101, (6, 5)).astype(np.uint8)
    real = np.ones((6, 5))
    real[4:, 1] = 0
    label = np.array([0, 1, 2, 0, 1])
    _, slopes = langid.loss_and_slopes(net, data, real, label)
    for x, s in zip(net.parameters(), slopes):
        for _ in range(25):
            at = tuple(rng.integers(n) for n in x.shape)
            if x.shape[-3:] == (3, 256, 3):  # bytes that occur
                at = (at[0], at[1], int(rng.integers(97, 101)), at[-1])
            old, eps = x[at], 1e-6
            x[at] = old + eps
            up = langid.loss_and_slopes(net, data, real, label)[0]
            x[at] = old - eps
            down = langid.loss_and_slopes(net, data, real, label)[0]
            x[at] = old
            assert abs((up - down) / (2 * eps) - s[at]) < 1e-6


def plain(net, text):
    """Mean over all bytes of one text, one byte and one segment at a time."""
    total = np.zeros(len(net.languages))
    for a in range(0, len(text), langid.SEGMENT):
        piece = text[a : a + langid.SEGMENT].ljust(langid.SEGMENT, b"\0")
        hs = []
        for way, order in ((0, range(len(piece))), (1, range(len(piece) - 1, -1, -1))):
            h, states = np.zeros((1, net.inner.shape[-1]), np.float32), {}
            for t in order:
                h = langid.step(net, way, np.array([piece[t]]), h)[0]
                states[t] = h[0]
            hs.append(states)
        for t in range(min(langid.SEGMENT, len(text) - a)):
            z = hs[0][t] @ net.out[0] + hs[1][t] @ net.out[1] + net.bias
            total += np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    return total / max(1, len(text))


def test_every_byte_counts(monkeypatch):
    net = langid.Net.fresh(["a", "b"], seed=2)
    texts = [b"", b"x", "Straße, und weiter".encode() * 9, b"y" * 64, b"z" * 130]
    want = np.array([plain(net, t) for t in texts])
    assert np.allclose(langid.probabilities(net, texts), want, atol=1e-5)
    monkeypatch.setattr(langid, "MANY", 128)
    monkeypatch.setattr(langid, "LANES", 2)
    assert np.allclose(langid.probabilities(net, texts), want, atol=1e-5)


def test_table(spark):
    words = {"en": "the house and that river with this", "de": "der Fluß und das Haus mit dieser"}
    rows = [(k, (words["en" if k % 2 else "de"] + " ") * (1 + k % 5), "en" if k % 2 else "de", 0.5) for k in range(300)]
    rows += [(300, None, "en", 0.0), (301, "", "de", 0.0), (302, "123 ½ !?", None, 0.0), (None, words["de"], "en", 0.0), (3, rows[3][1], "en", 0.5), (303, words["en"] * 30_000, None, 0.0)]
    df = prepare(spark).createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(3)
    net = langid.fit(df)
    out = langid.predict(df, net)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    assert all(got[k]["lang_pred"] == ("en" if k % 2 else "de") for k in range(300))
    assert [got[k]["lang_pred"] for k in (300, 301, 302)] == ["und"] * 3 and got[303]["lang_pred"] == "en" and got[None]["lang_pred"] == "de"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    nothing = langid.fit(df.limit(0))
    assert {r["lang_pred"] for r in langid.predict(df, nothing).collect()} == {"und"}
    assert langid.predict(df.limit(0), net).collect() == []


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    rows = QUERIES["op5_language"](spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    tested = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"] and truth[r["doc_id"]]]
    assert sum(tested) / len(tested) > 0.95
