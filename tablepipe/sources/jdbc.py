"""Read tables of a JDBC database (partitioned reads, pushdown by Spark)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, **options: str) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower_bound))
             .option("upperBound", str(upper_bound)).option("numPartitions", str(num_partitions or 8)))
    return r.options(**options).load()
