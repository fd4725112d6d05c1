"""The registered queries opN_<name>: each operator over its whole table, and SQL
for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.llm import columnar, html, imatch, kmtree, licenses, minhash, mixing, packing, periodic, quality, suffixes, warc, whitening
from tablepipe.llm.common import table
from tablepipe.session import checkpoint_root

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids (concatenate and cut)."""
    docs = table(spark, sf_dir, "documents")
    return packing.digest(packing.pack(docs, VOCABULARY))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document."""
    docs = table(spark, sf_dir, "documents")
    return licenses.scan_licenses(docs).withColumn("n_spans", F.size("spans").cast("long")).drop("spans")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.drop("source")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html.extract_text(table(spark, sf_dir, "pages"))


def op5_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return kmtree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality posterior and decision of every document."""
    found = quality.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc.doc_id", "evidence", "host_posterior", "path_posterior", "score", "keep")


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without repeated 200-byte strings."""
    return suffixes.digest(suffixes.removed(table(spark, sf_dir, "documents")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to compressed archives and read back."""
    pages = table(spark, sf_dir, "pages")
    return warc.archive_round_trip(pages, checkpoint_root(spark)).drop("payload", "url")


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return imatch.edited_likeness(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (similarity 0.85, five words)."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every twentieth vector."""
    return columnar.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, every tenth of which gets a periodic tail."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return periodic.digest(periodic.collapse_runs(table(spark, sf_dir, "documents"), hashes=h))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_licenses": op2_licenses,
    "op3_mixing": op3_mixing,
    "op4_html": op4_html,
    "op5_kmeans_tree": op5_kmeans_tree,
    "op6_quality": op6_quality,
    "op7_suffixes": op7_suffixes,
    "op8_warc": op8_warc,
    "op9_imatch": op9_imatch,
    "op10_minhash": op10_minhash,
    "op11_topk": op11_topk,
    "op12_runs": op12_runs,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op3_mixing": r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('17:' || coalesce(doc_id::VARCHAR, 'null')) AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight FROM sources),
capped AS (
  SELECT *, 3.0 * source_size AS cap, 3.0 * source_size / weight AS ratio FROM weighted),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - coalesce(sum(cap) OVER before, 0))
          / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM capped WINDOW before AS (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
final AS (
  SELECT source, source_size, weight, cap,
         coalesce((SELECT arg_min(level, ratio) FROM levels WHERE ratio > level), 0) AS level FROM capped),
targets AS (
  SELECT source, source_size, least(cap, level * weight) AS target FROM final),
placed AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start FROM sized)
SELECT p.doc_id, p.size, t.source_size, t.target,
       CASE WHEN p.size = 0 THEN 0 ELSE
         (round(t.target)::BIGINT // t.source_size) * p.size
         + greatest(least(p.start + p.size, round(t.target)::BIGINT % t.source_size) - p.start, 0) END::BIGINT AS taken
FROM placed p JOIN targets t ON p.source IS NOT DISTINCT FROM t.source
""",
    "op11_topk": """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v, list_transform(embedding, lambda x: x::DOUBLE) AS original
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
asked AS (
  SELECT vec_id, arg_min(v, original) AS v FROM usable WHERE vec_id % 20 = 0 GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM asked q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
""",
}
