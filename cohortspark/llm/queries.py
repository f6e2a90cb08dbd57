"""The operators on the driver's tables, with the SQL that states the expected rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortspark.llm import bpe, decontaminate, jaccard, langid, line_dedup, pii, spelling, suffix_dedup, token_counts, toxicity, va_file, vptree, warc
from cohortspark.llm.common import prepare
from cohortspark.sources.tables import load

# Base 32 of a hexadecimal SHA-1: eight groups of five hexadecimal digits, four characters each.
BASE32_SQL = """array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b:
substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha, (5 * i + 1)::INT, 5))::BIGINT >> b) & 31)::INT + 1, 1)), '')), '')"""
RANKS = "byte_bpe_multi_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
PIECES = 900_000  # remembered by a worker of op2, which has an executor to itself

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn

    return add


@query(
    f"""WITH pages AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
totals AS (SELECT source, count(*) AS pages FROM pages GROUP BY source),
seen AS (SELECT source, unnest(list_distinct(lines)) AS line FROM pages),
bad AS (SELECT s.source, s.line FROM (SELECT source, line, count(*) AS n FROM seen WHERE trim(line) <> '' GROUP BY ALL) s
        JOIN totals t ON s.source IS NOT DISTINCT FROM t.source
        WHERE s.n >= {line_dedup.MIN_PAGES} AND s.n > {line_dedup.RATIO} * t.pages),
sets AS (SELECT source, list(line) AS bad FROM bad GROUP BY source),
kept AS (SELECT p.doc_id, p.lines, list_filter(p.lines, lambda x: NOT list_contains(coalesce(s.bad, []), x)) AS kept
         FROM pages p LEFT JOIN sets s ON p.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, (coalesce(len(lines), 0) - coalesce(len(kept), 0))::BIGINT AS n_dropped,
       CASE WHEN lines IS NOT NULL THEN sha256(coalesce(array_to_string(kept, chr(10)), '')) END AS kept_sha256 FROM kept"""
)
def op10_site_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines cut out of each document: doc_id, n_lines, n_dropped, kept_sha256 (of the remaining text)."""
    out = line_dedup.drop_boilerplate(load(spark, folder, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def words_sql(column: str, word: str = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") -> str:
    lower = f"translate({column}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({lower}, '{word}')"


@query(
    f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql('text')} AS w FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {words_sql('text')} AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item, least({decontaminate.WINDOW}, len(w)) AS k, array_to_string(w[p:p + least({decontaminate.WINDOW}, len(w)) - 1], ' ') AS phrase
       FROM b, unnest(range(1, len(w) - least({decontaminate.WINDOW}, len(w)) + 2)) t(p) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, p, k, array_to_string(w[p:p + k - 1], ' ') AS phrase FROM (SELECT * FROM d, ks), unnest(range(1, len(w) - k + 2)) t(p)),
m AS (SELECT r, p, k, item FROM dw JOIN bw USING (k, phrase)),
h AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT r, p, k FROM m)) GROUP BY r),
i AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(i.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(h.n > 0 AND {decontaminate.SHARE} * h.n >= len(w), FALSE) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN i USING (r)"""
)
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark phrases in each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    docs, items = load(spark, folder, "documents", ["doc_id", "text"]), load(spark, folder, "benchmark")
    out = decontaminate.find_contamination(docs, items)
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256")
    return out.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def ranks_path() -> str:
    """The public rank file's place on the driver; its content is broadcast."""
    import public_tokenizers

    return public_tokenizers.path(RANKS)


@query()
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = load(spark, folder, "documents", ["doc_id", "text"])
    return bpe.encode_texts(docs, bpe.load_ranks(ranks_path()), keep_ids=False, pieces=PIECES)


@query(
    f"""WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {words_sql('text', r'[^\x20\x09-\x0D]+')} AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[p:p + 4], ' ') AS shingle FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(p) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
o AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b USING (shingle) WHERE a.r <> b.r GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n a ON a.r = x JOIN n b ON b.r = y WHERE 100 * c >= {jaccard.PERCENT} * (a.n + b.n - c)),
reach AS (SELECT r, r AS t FROM d UNION SELECT reach.r, l.y FROM reach JOIN l ON l.x = reach.t),
least_ AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY reach.r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM d JOIN least_ USING (r) LEFT JOIN n USING (r)"""
)
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents: doc_id, n_shingles, component_id."""
    return jaccard.near_duplicates(load(spark, folder, "documents", ["doc_id", "text"]))


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents: doc_id, held_out, score, predicted, n_restored."""
    docs = load(spark, folder, "documents", ["doc_id", "text"])
    model = toxicity.train(docs, load(spark, folder, "labels"))
    fold = F.coalesce(toxicity.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return toxicity.score(docs, model).select("doc_id", fold, "score", "predicted", "n_restored")


@query()
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in all documents: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    docs = load(spark, folder, "documents", ["doc_id", "text"])
    return pii.find_spans(docs, pii.fit(docs)).drop("text")


@query(
    f"""WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS sha, strlen(coalesce(html, ''))::BIGINT AS size FROM pages),
f AS (SELECT sha, size, min(page_id) AS first FROM p GROUP BY ALL)
SELECT page_id, size AS payload_bytes, {BASE32_SQL} AS payload_digest,
       CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p JOIN f USING (sha, size)"""
)
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages written to WARC archives and read back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    out = warc.archive_and_read(load(spark, folder, "pages"))
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op8_nearest(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20: query_id, rank, vec_id, score."""
    return vptree.nearest(load(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query()
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents: doc_id, held_out, lang_pred, score."""
    docs = load(spark, folder, "documents", ["doc_id", "text", "lang"])
    net = langid.fit(docs)
    fold = F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False)).alias("held_out")
    return langid.predict(docs.select("doc_id", "text"), net).select("doc_id", fold, "lang_pred", "score")


@query()
def op6_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Strings of 400 bytes that occur more than once cut out: doc_id, n_bytes, n_removed, n_spans, kept_sha256, repeated."""
    out = suffix_dedup.remove_repeats(load(spark, folder, "documents", ["doc_id", "text"]), keep=False)
    return out.withColumn("repeated", F.col("n_removed") > 0)


@query()
def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every text: doc_id, n_bytes, n_tokens, over_limit."""
    import public_tokenizers

    vocabulary = token_counts.load_vocabulary(public_tokenizers.path(VOCABULARY))
    return token_counts.count_tokens(load(spark, folder, "documents", ["doc_id", "text"]), vocabulary)


def rounds_sql(rounds: int) -> str:
    """Tables c1, c2, ... of centroids (j, q) from c0, each by one round over v (r, v)."""
    far = "list_sum(list_transform(list_zip(v.v, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = []
    for t in range(rounds + 1):
        parts.append(f"a{t} AS MATERIALIZED (SELECT r, m[2]::INT AS j, m[1] AS d FROM (SELECT r, min([d, j]) AS m FROM (SELECT v.r, c.j, {far} AS d FROM v, c{t} c) GROUP BY r))")
        if t < rounds:
            mean = f"SELECT j, list(q ORDER BY i) AS q FROM (SELECT j, i, (sum(x)::BIGINT // count(*) - CASE WHEN sum(x)::BIGINT % count(*) < 0 THEN 1 ELSE 0 END)::BIGINT AS q FROM (SELECT j, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM a{t} JOIN v USING (r)) GROUP BY ALL) GROUP BY j"
            parts.append(f"c{t + 1} AS MATERIALIZED (SELECT c.j, coalesce(m.q, c.q) AS q FROM c{t} c LEFT JOIN ({mean}) m USING (j))")
    return ",\n".join(parts)


@query(
    f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({va_file.SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {va_file.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {va_file.DIMENSIONS}),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{va_file.SEED}:' || vec_id), v) - 1)::INT AS j, v AS q FROM v QUALIFY j < {va_file.CLUSTERS}),
{rounds_sql(va_file.ROUNDS)}
SELECT vec_id, j AS cluster, d AS distance, sum(d) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(q, ',')) AS centroid_sha256
FROM v JOIN a{va_file.ROUNDS} USING (r) JOIN c{va_file.ROUNDS} USING (j)"""
)
def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of all vectors: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    return va_file.cluster(load(spark, folder, "embeddings"))


# CRC-32 of a list of bytes: reflected division by the fixed polynomial 0xEDB88320, a bit at a time.
CRC_SQL = """xor(list_reduce(list_transform(range(strlen(s)), lambda k: ('0x' || substr(hex(encode(s)), (2 * k + 1)::INT, 2))::BIGINT),
lambda c, b: list_reduce(range(8), lambda x, k: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), 4294967295), 4294967295)"""
MISSPELT = 199  # in one of so many (document, word) pairs the word loses a letter


@query(
    f"""WITH RECURSIVE runs AS (SELECT doc_id, unnest({words_sql('text', '[a-zÀ-ÿ]+')}) AS w FROM documents),
g AS (SELECT w, coalesce(doc_id::VARCHAR, '') || ':' || w AS s, count(*) AS n FROM runs WHERE length(w) >= {spelling.MIN_LETTERS} GROUP BY doc_id, w),
h AS (SELECT w, n, {CRC_SQL} AS h FROM g),
x AS (SELECT CASE WHEN h % {MISSPELT} = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM x GROUP BY word HAVING length(word) >= {spelling.MIN_LETTERS} AND sum(n) >= {spelling.MIN_COUNT}),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest FROM v, unnest(range(1, length(word) + 1)) t(i)),
near AS (SELECT a.word, b.word AS other, b.n AS m FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
         UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(m := -m, other := other)) AS b FROM near GROUP BY word),
f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.m >= {spelling.FACTOR} * n THEN b.other END AS form,
                          CASE WHEN -b.m >= {spelling.FACTOR} * n THEN (-b.m)::BIGINT END AS form_n FROM v LEFT JOIN best USING (word)),
way AS (SELECT word, word AS place FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.place WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.place AS root, f.n, f.n_near, f.form_n FROM f JOIN way USING (word) JOIN f e ON e.word = way.place WHERE e.form IS NULL"""
)
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Words of all texts with their forms: word, form, root, n, n_near, form_n."""
    return spelling.spelling_variants(load(spark, folder, "documents", ["doc_id", "text"]), misspell=MISSPELT)
