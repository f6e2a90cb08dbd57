"""Rank-synchronous counts against the public library and the plain definition."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from cohortspark.llm import token_counts  # noqa: E402
from cohortspark.llm.common import prepare  # noqa: E402
from cohortspark.llm.queries import QUERIES, VOCABULARY  # noqa: E402

FILE = token_counts.load_vocabulary(public.path(VOCABULARY))
MERGES = token_counts.Merges(FILE["vocabulary"], FILE["merges"])
LIBRARY = tokenizers.Tokenizer.from_file(public.path(VOCABULARY))


def counter():
    return token_counts.Counter(MERGES, FILE["special"])


def library(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_texts(texts):
    assert counter().count(texts) == library(texts)


def test_every_character():
    """Classes of all characters, those that Python's own tables do not know yet among them."""
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1!{chr(c)} {chr(c)}\n" for c in codes[k : k + 64]) for k in range(0, len(codes), 64)]
    assert counter().count(texts) == library(texts)


def test_hard_pieces():
    rng = random.Random(0)
    texts = ["a" * 700, "=" * 1000, "aaab" * 99, " \n\t  \n x", "don't I'LL we'd", "x 　y", "１２Ⅷ½", "\x1c\x1d é\x85", "ab" * 400, ""]
    texts += ["x<|endoftext|>  <|endoftext|>y  ", "<|endoftext|>" * 5, "<|endoftext|", "  <|endoftext|>'s"]
    texts += ["".join(rng.choices("abcdeinrstäöüßé日本 '\n.0123<|>", k=rng.randrange(60))) for _ in range(2000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randrange(200, 900))) for _ in range(50)]
    assert counter().count(texts) == library(texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40).map(bytes))
def test_own_merges_both_ways(piece):
    """Overlapping pairs of equal symbols, by rounds and by the sweep, against one merge at a time."""
    letters = token_counts.byte_letters()
    a, b, c = letters[0], letters[1], letters[2]
    pairs = [(a, a), (b, a), (a + a, a), (a + a, a + a), (b + a, b), (c, c), (a, c), (c + c, a + a)]
    vocabulary = {s: k for k, s in enumerate([*letters, *(x + y for x, y in pairs)])}
    merges = token_counts.Merges(vocabulary, pairs)
    parts = [letters[x] for x in piece]
    while True:
        found = [(pairs.index(p), k) for k, p in enumerate(zip(parts, parts[1:])) if p in pairs]
        if not found:
            break
        _, at = min(found)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    assert merges.count([piece, piece + piece[:0]]).tolist() == [len(parts)] * 2
    if len(piece) > 1:
        assert merges._sweep(merges.base[np.frombuffer(piece, np.uint8)]) == len(parts)


@pytest.mark.parametrize("alphabet", ["abcdefghijklmnopqrstuvwxyz", "a", "7", "=-"])
def test_a_megabyte_in_one_piece(alphabet):
    text = "".join(random.Random(1).choices(alphabet, k=1_000_000))
    assert counter().count([text]) == library([text])


def test_small_memory(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_PIECES", 7)
    monkeypatch.setattr(token_counts, "BLOCK_PIECES", 5)
    rng = random.Random(3)
    texts = ["".join(rng.choices("abc de", k=100)) + "z" * 80 for _ in range(40)]
    own = counter()
    assert own.count(texts) == library(texts)
    assert len(own.known) <= 7 and max(map(len, own.known)) <= token_counts.KEPT_LENGTH


def test_refused_vocabularies(tmp_path):
    letters = token_counts.byte_letters()
    vocabulary = {s: k for k, s in enumerate([*letters, "ab", "abc"])}
    with pytest.raises(ValueError, match="not made yet"):
        token_counts.Merges(vocabulary, [("ab", "c"), ("a", "b")])
    with pytest.raises(ValueError, match="no symbol"):
        token_counts.Merges({"a": 0}, [])
    with pytest.raises(ValueError, match="only plain"):
        token_counts.load_vocabulary(public.path("word_bpe_49k.json"))


def test_table(spark):
    rows = [(1, None, 5), (2, "", None), (2, "Straße", 7), (2, "Straße", 7), (None, "x " * 300_000, 1), (3, "é<|endoftext|>", 2)]
    df = prepare(spark).createDataFrame(rows, "id long, text string, n_tokens int")
    out = token_counts.count_tokens(df, FILE, limit=3)
    assert out.columns == ["id", "n_bytes", "n_tokens", "over_limit"]
    for r, (key, text, _) in zip(out.collect(), rows):
        want = library([text or ""])[0]
        assert tuple(r) == (key, len((text or "").encode()), want, want > 3)
    assert token_counts.count_tokens(df.limit(0), FILE).collect() == []


def test_bytes_that_are_no_text(spark):
    df = prepare(spark).range(1).select(F.expr("cast(unhex('61ff62') as string)").alias("text"))
    assert [tuple(r) for r in token_counts.count_tokens(df, FILE).collect()] == [(3, library(["a�b"])[0], False)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_token_counts"](spark, folder).collect()}
    want = dict(zip(texts, library(list(texts.values()))))
    assert got == {k: (len(t.encode()), want[k], want[k] > 512) for k, t in texts.items()}
