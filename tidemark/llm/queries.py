"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, fingerprint, html_mincut, ngram_join, packing, pii_crf, quality_gam, quality_rules, shard_lp, source_audit, sp_sampling, url_cascade, whitening
from .common import table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality_gam.fit_labelled(docs, labels.where(~held))
    return quality_gam.score(docs.withColumn("held_out", F.coalesce(held, F.lit(False))), model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_sampling.encode(table(spark, sf_dir, "documents", "doc_id", "text"), digest=True)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_lp.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, url_cascade.RULE_SCHEMA)
    return url_cascade.judge_urls(table(spark, sf_dir, "pages", "page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = """
WITH rules(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cuts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM cuts),
fits AS (SELECT page_id, host, path, rh || rp AS rule, verdict FROM parts LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, max_by(rule, length(rule)) AS rule, coalesce(max_by(verdict, length(rule)), 'allow') AS verdict FROM fits GROUP BY page_id, host, path
"""


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_mincut.extract(pages, html_mincut.fit_pages(pages)).select("page_id", "url", "text", "n_chars")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source")
    return quality_rules.apply_rules(docs).select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM k JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS root, b AS doc_id FROM e UNION SELECT r.root, e.b FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, min(r.root)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id
"""


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii_crf.find(docs, pii_crf.fit_spans(docs))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(number, pii_crf.KINDS), F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    back = byte_bpe.decode(byte_bpe.encode(docs).drop("text"))
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT id, lang, source, translate(unnest(ws), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS q FROM w GROUP BY 1, 2 HAVING count(DISTINCT id) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v, sum(q) AS total FROM k GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY 1, 2, 3),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.q, v.v, v.total, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS own FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, term, n, 1 + CAST(1000000000 * CAST(n + 5 AS HUGEINT) // (own + 5 * v) AS BIGINT) AS p, 1 + CAST(1000000000 * CAST(q + 5 AS HUGEINT) // (total + 5 * v) AS BIGINT) AS q FROM f),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3) x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source)
SELECT lang, source, 'pair' AS part, item, value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
UNION ALL SELECT * FROM (SELECT lang, source, 'term' AS part, term AS item, p - q AS value, CAST(row_number() OVER (PARTITION BY lang, source ORDER BY p - q DESC, term) AS INTEGER) AS rank FROM s WHERE n > 0 AND p > q) WHERE rank <= 50
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier, "op2_sentencepiece_sampling": op2_sentencepiece_sampling, "op3_sharding": op3_sharding, "op4_url_filters": op4_url_filters,
    "op5_html_extraction": op5_html_extraction, "op6_quality_rules": op6_quality_rules,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join, "op8_document_fingerprints": op8_document_fingerprints, "op9_best_fit_packing": op9_best_fit_packing,
    "op10_pii": op10_pii, "op11_byte_bpe": op11_byte_bpe, "op12_embedding_whitening": op12_embedding_whitening, "op13_source_divergence": op13_source_divergence,
}
ORACLES: dict[str, str] = {"op4_url_filters": OP4_SQL, "op7_ngram_jaccard_join": OP7_SQL, "op13_source_divergence": OP13_SQL}
