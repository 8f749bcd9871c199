"""The training-data operators as queries over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlift.llm import bpe, exact_dedup, hard_negatives, html_extract, mixing, near_embeddings, ngram_join, packing, quality, secret_scan, spelling, toxicity, url_filter
from ledgerlift.llm.common import table


def op1_near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings.near_embeddings(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.listed_hosts(pages))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.span_digests(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


OP5_SQL = """
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents
), hashed AS (SELECT doc_id, sha256(norm) AS text_sha256 FROM norm),
sized AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, hashed.text_sha256 AS text_sha256
FROM hashed JOIN sized ON hashed.text_sha256 = sized.text_sha256
"""

OP1_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), walk AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT walk.node, links.b FROM walk JOIN links ON walk.seen = links.a
), component AS (SELECT node, min(seen) AS component_id FROM walk GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT component.node AS vec_id, coalesce(counted.n, 0) AS n_links, component_id, component.node = component_id AS kept
FROM component LEFT JOIN counted ON counted.a = component.node
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = (
        op1_near_embeddings, op2_url_filter, op3_ngram_join, op4_secret_scan, op5_exact_dedup, op6_bpe, op7_html_extract,
        op8_quality, op9_toxicity, op10_packing, op11_hard_negatives, op12_spelling_variants, op13_source_mix, pipeline,
    )
    return {op.__name__: op for op in ops}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_embeddings": OP1_SQL,
        "op2_url_filter": url_filter.ORACLE_SQL,
        "op5_exact_dedup": OP5_SQL,
        "op11_hard_negatives": hard_negatives.ORACLE_SQL,
        "op12_spelling_variants": spelling.ORACLE_SQL,
        "op13_source_mix": mixing.ORACLE_SQL,
    }
