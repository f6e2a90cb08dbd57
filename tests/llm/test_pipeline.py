"""The pipeline against brute force: every stage from the rows that its predecessor keeps."""

import hashlib

import pytest

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from cohortspark.llm import bpe, toxicity  # noqa: E402
from cohortspark.llm.common import prepare  # noqa: E402
from cohortspark.llm.queries import ranks_path  # noqa: E402
from tests.llm.test_decontaminate import brute as contamination  # noqa: E402
from tests.llm.test_jaccard import brute as groups  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard", "decontaminate", "bpe"]


def test_brute_force(spark):
    docs = prepare(spark).read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.train(docs, labels)
    scorer = toxicity.Scorer(model)
    rows = [r.asDict() for r in docs.collect() if scorer.text(r["text"] or "")[0] < 0.5]
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        seen = {}
        for r in own:
            for line in {x for x in (r["text"] or "").split("\n") if x.strip(" ")}:
                seen[line] = seen.get(line, 0) + 1
        bad = {x for x, n in seen.items() if n >= 3 and n > 0.1 * len(own)}
        for r in own:
            r["text"] = "\n".join(x for x in r["text"].split("\n") if x not in bad)
    kept = {k for k, _, c in groups([(r["doc_id"], r["text"]) for r in rows]) if k == c}
    rows = [r for r in rows if r["doc_id"] in kept]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = contamination([r["text"] for r in rows], bench)
    rows = [r for r, (n, hit, _) in zip(rows, found) if not (hit > 0 and 20 * hit >= n)]
    library = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(ranks_path()), special_tokens={})
    want = {r["doc_id"]: library.encode_ordinary(r["text"]) for r in rows}
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got.keys() == want.keys() and 0 < len(want) < docs.count()
    for k, ids in want.items():
        assert got[k]["ids"] == ids and got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_empty(spark):
    docs = prepare(spark).read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
    assert corpus_pipeline.tokenize(spark, docs, FOLDER).collect() == []


def test_documents_without_id(spark):
    def text(tag):
        return " ".join(f"{tag}{k}" for k in range(60))

    near = text("c") + " end"
    rows = [(1, text("a"), "x"), (None, text("a"), "x"), (None, text("b"), "x"), (None, text("c"), "x"), (None, text("c"), "y"), (None, near, "x")]
    rows += [(None, None, "x"), (None, "", "x"), (5, text("d"), "x"), (3, text("d"), "x"), (5, text("e"), "x"), (7, text("f"), "x"), (7, text("f"), "x")]
    docs = prepare(spark).createDataFrame(rows, "doc_id long, text string, source string")
    kept = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect()]
    third = [r for r in kept if r[1] in (text("c"), near)]
    assert len(third) == 1 and third[0] in rows
    others = [r for r in kept if r not in third]
    want = [(1, text("a"), "x"), (None, text("b"), "x"), (None, None, "x"), (None, "", "x"), (3, text("d"), "x"), (5, text("e"), "x"), (7, text("f"), "x"), (7, text("f"), "x")]
    assert sorted(others, key=str) == sorted(want, key=str)
