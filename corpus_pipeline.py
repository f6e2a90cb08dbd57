"""From raw documents to token ids: toxicity, line dedup, near-duplicates, benchmark decontamination, byte-level BPE.

Each stage works on all rows its predecessor kept, written as Parquet in between, so that a lost executor costs one stage at
most. All stages but the last return the columns of documents. doc_id names a document: rows that repeat one with the same text
stay or go together, other texts under it are decided on their own. NULL names no document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortspark.llm import bpe, decontaminate, jaccard, line_dedup, toxicity
from cohortspark.llm.common import prepare, settle
from cohortspark.llm.queries import ranks_path
from cohortspark.sources.tables import load

PIECES = 200_000  # remembered by the tokenizer: its workers share an executor with a heap that earlier stages have filled
ORACLE_SQL = None  # a fitted score, a component search and a tokenizer are beyond SQL; tests/llm/test_pipeline.py checks it


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity score rejects (one half or more)."""
    prepare(spark)
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the boilerplate lines of each source; n_chars follows the text."""
    prepare(spark)
    clean = line_dedup.drop_boilerplate(docs)
    chars = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")
    return clean.withColumn("n_chars", chars).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id, of a group without any doc_id one row.

    Texts are told apart by doc_id and MD5. Of rows without doc_id that are copies of one text the least row is kept.
    """
    prepare(spark)
    found = settle(jaccard.marked_groups(docs), "duplicates").filter("top IS NOT NULL")
    later = found.filter(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    unnamed = found.filter("component_id IS NULL").groupBy("top", "mark").agg(F.count(F.lit(1)).alias("copies"))
    unnamed = settle(unnamed, "unnamed")
    texts = unnamed.join(unnamed.groupBy("top").agg(F.min("mark").alias("least")), "top")
    chosen = F.col("mark") == F.col("least")
    dropped = texts.filter(~chosen | (F.col("copies") > 1)).select(F.lit(None).cast("long").alias("doc_id"), "mark")
    gone = later.select("doc_id", "mark").union(dropped).distinct().select(F.col("doc_id").alias("_gone"), F.col("mark").alias("_text"))
    marked = docs.withColumn("_mark", F.md5(F.col("text")))
    rest = marked.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone")) & (F.col("_mark") == F.col("_text")), "left_anti")
    copied = texts.filter(chosen & (F.col("copies") > 1)).select(F.col("mark").alias("_mark"))
    # Copies are put together before the join, on the map side first: a text with many copies does not gather.
    least = marked.filter(F.col("doc_id").isNull()).groupBy("_mark").agg(F.min(F.struct(*docs.columns)).alias("_row"))
    one = least.join(copied, "_mark", "left_semi").select("_row.*")
    return rest.select(*docs.columns).union(one.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents of whose words a twentieth or more are benchmark phrases; all others stay as they are."""
    prepare(spark)
    found = decontaminate.find_contamination(docs, load(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, ids_sha256, decoded_sha256."""
    prepare(spark)
    ranks = bpe.load_ranks(ranks_path())
    return bpe.encode_texts(docs.select("doc_id", "lang", "source", "text"), ranks, pieces=PIECES)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_site_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
