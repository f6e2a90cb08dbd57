"""The transducer against the public library, and round trips."""

import hashlib
import random
import tracemalloc

import pytest
from hypothesis import given, settings, strategies as st

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")

from cohortspark.llm import bpe  # noqa: E402
from cohortspark.llm.common import prepare  # noqa: E402
from cohortspark.llm.queries import QUERIES, ranks_path  # noqa: E402

RANKS = bpe.load_ranks(ranks_path())
CODEC = bpe.Codec(RANKS)
LIBRARY = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return [int(i) for block in CODEC.encode(text) for i in block.split(",")]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert "".join(CODEC.decode(CODEC.encode(text) if text else [])) == text


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=24))
def test_any_bytes(piece):
    """Pieces of bytes that are no text, where the plain definition is the measure."""
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((RANKS.get(parts[k] + parts[k + 1], 1 << 40), k) for k in range(len(parts) - 1))
        if rank == 1 << 40:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    assert CODEC.transducer.encode(piece) == [RANKS[p] for p in parts]


def test_hard_pieces():
    rng = random.Random(0)
    for text in ("a" * 500, "aaab" * 99, "=" * 77, " \n\t  \n x", "don't I'LL we'd", "x 　y", "１２Ⅷ½", "\x1c\x1d é\x85"):
        assert ids(text) == LIBRARY.encode_ordinary(text)
    for _ in range(2000):
        text = "".join(rng.choices("abcdeinrstäöüßé日本 '\n.0123", k=rng.randrange(40)))
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_long_texts_go_in_blocks(monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_PIECES", 7)
    text = "Straße und Weg, l'été! " * 50 + "日本語" * 30
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert "".join(CODEC.decode(CODEC.encode(text))) == text


def test_small_tables_forget_and_stay_right(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    small = bpe.Codec(RANKS)
    small.transducer.max_states = 20
    text = "one two three four five six seven eight nine ten eleven twelve " * 3
    assert [int(i) for b in small.encode(text) for i in b.split(",")] == LIBRARY.encode_ordinary(text)


def test_states_are_small():
    rng, machine = random.Random(1), bpe.Codec(RANKS).transducer
    words = ["".join(rng.choices("abcdefghijklmnoprstuvwxyzäöüé", k=9)).encode() for _ in range(4000)]
    tracemalloc.start()
    for word in words:
        machine.encode(word)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(machine.members) > 15_000 and held < 600 * len(machine.members)


def test_few_pieces_are_remembered_and_ids_stay_right():
    small, rng = bpe.Codec(RANKS, pieces=50), random.Random(3)
    for _ in range(100):
        text = " ".join("".join(rng.choices("abcdeinrst", k=5)) for _ in range(20))
        assert [int(i) for b in small.encode(text) for i in b.split(",")] == LIBRARY.encode_ordinary(text)
        assert len(small.known) <= 51 + 20


def test_a_long_piece_does_not_add_states_without_end():
    machine = bpe.Transducer(RANKS, max_states=500)
    piece = "".join(random.Random(2).choices("abcdefghijklmnoprstuvwxyz", k=20_000))
    assert machine.encode(piece.encode()) == LIBRARY.encode_ordinary(piece)
    assert len(machine.members) <= 501


@given(st.text(max_size=30), st.integers(1, 5))
def test_stream(text, step):
    data, stream = text.encode(), bpe.Utf8Stream()
    parts = [stream.feed(data[k : k + step]) for k in range(0, len(data), step)]
    assert "".join([*parts, stream.feed(b"", last=True)]) == text


def test_stream_with_broken_bytes():
    stream = bpe.Utf8Stream()
    out = "".join([stream.feed(b"a\xff\xe2\x82"), stream.feed(b"\xac\xed\xa0"), stream.feed(b"\x80z\xf0\x9f"), stream.feed(b"", last=True)])
    assert out == b"a\xff\xe2\x82\xac\xed\xa0\x80z\xf0\x9f".decode("utf-8", "replace")


def test_table(spark):
    rows = [(1, None, 5), (2, "", None), (2, "Straße", 7), (2, "Straße", 7), (None, "x " * 300_000, 1)]
    df = prepare(spark).createDataFrame(rows, "id long, text string, n_tokens int")
    out = bpe.encode_texts(df, RANKS)
    assert out.columns == ["id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    for r, (key, text, _) in zip(out.collect(), rows):
        want = LIBRARY.encode_ordinary(text or "")
        assert (r["id"], r["ids"], r["n_tokens"]) == (key, want, len(want))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.encode_texts(df.limit(0), RANKS).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op2_bpe"](spark, folder).collect():
        want = LIBRARY.encode_ordinary(texts[r["doc_id"]] or "")
        assert r["n_tokens"] == len(want)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
