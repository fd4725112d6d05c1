"""The corpus pipeline: quality filter, near duplicates, repeated passages, mix to
target weights, packing.  Each stage takes (spark, docs, sf_dir), calls one
operator of ``tablepipe.llm`` and returns documents (the last one pieces); its
result is written as Parquet and read again as the next stage's docs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepipe.llm import minhash, mixing, packing, quality, suffixes
from tablepipe.llm.common import table, written
from tablepipe.llm.queries import VOCABULARY


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.  Every row is judged on its own,
    null and empty texts by their site alone; without labels all stay; an empty
    table gives no rows."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


# The stage's similarity; 36 bands of 5 miss a pair at 0.8 with a chance of 6e-7.
SIMILAR = (80, 100)
BANDS, ROWS = 36, 5


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (that of the smallest id;
    five words, similarity 0.8 or more).  Rows that share this id stay if their
    texts differ; of equal texts under one id, the row whose other columns come
    first stays.  Rows without an id stay; null and empty texts are like nothing;
    an empty table gives no rows."""
    found = minhash.near_duplicates(docs, threshold=SIMILAR, bands=BANDS, rows=ROWS).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    stays = docs.join(found, F.col("doc_id") == F.col("kept_id"), "left_semi")
    repeated = written(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("r_id")).count().where("count > 1").select("r_id"), "repeated-ids")
    if repeated.limit(1).count():
        again = stays.join(repeated, F.col("doc_id") == F.col("r_id"), "left_semi")
        order = Window.partitionBy("doc_id", "text").orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
        first = again.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")
        stays = stays.join(repeated, F.col("doc_id") == F.col("r_id"), "left_anti").unionByName(first)
    return stays.unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of 200-byte strings; the first copy stays."""
    found = suffixes.removed(docs, keep="first")
    return suffixes.kept_text(found, docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights take them; a part of one at most
    once a source.  Null and empty texts have no words and are not taken; equal
    ids are told apart by row; a null source is a source of its own."""
    taken, _ = mixing.mix(docs)
    return mixing.mixed_documents(docs, taken)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length sequences; a null or empty text is its end id alone,
    copies that the mix made are documents of their own."""
    return packing.digest(packing.pack(docs, VOCABULARY))


STAGES = [("quality", classify), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("mix", mix), ("pack", pack)]
# The classifier is fitted, so SQL cannot express the rows; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
