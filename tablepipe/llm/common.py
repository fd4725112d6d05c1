"""Helpers the operators share: written cuts of the lineage and a global order
computed without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablepipe.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts the lineage at a place every executor can reach, so lost tasks rerun
    from the files and several readers do not recompute ``df``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``written`` tables that nothing reads any more.

    Whatever was computed from them has itself been written, so no lost task
    ever asks for them again."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_global_rank(df: DataFrame, keys: list[str], rank: str = "rank", value: str | None = None, before: str = "before", name: str = "ranked") -> DataFrame:
    """Rows of ``df`` with their 0-based rank by ``keys`` (nulls first) and, when
    ``value`` is given, the sum of ``value`` over all earlier rows.

    Range partitions are written with their number; each is ranked on its own
    and only one row per partition meets in the prefix over partitions."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    parts = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), name)
    amount = F.col(value) if value else F.lit(0)
    totals = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"), F.sum(amount).alias("_sum"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows0"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum0"))
    inside = Window.partitionBy("_part").orderBy(*order)
    ahead = inside.rowsBetween(Window.unboundedPreceding, -1)
    out = parts.join(F.broadcast(base), "_part")  # one row per partition
    out = out.withColumn(rank, (F.col("_rows0") + F.row_number().over(inside) - 1).cast("long"))
    if value:
        out = out.withColumn(before, F.col("_sum0") + F.coalesce(F.sum(value).over(ahead), F.lit(0)))
    return out.drop("_part", "_rows0", "_sum0")


def ascii_words(text: Column) -> Column:
    """Words between ASCII white space (space, tab to carriage return)."""
    return F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
