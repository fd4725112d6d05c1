"""Q1-Q3: SQL over loaded tables.

``register_tables`` names tables once per session (idempotent);
``run_sql`` returns a lazy DataFrame (nothing is collected) and logs then
re-raises analysis errors.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import read_table

log = logging.getLogger(__name__)

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def register_tables(spark: SparkSession, tables: dict[str, str | DataFrame]) -> dict[str, DataFrame]:
    """Register paths or DataFrames as temp views under the given names."""
    out = {}
    for name, src in tables.items():
        df = src if isinstance(src, DataFrame) else read_table(spark, src)
        df.createOrReplaceTempView(name)
        out[name] = df
    return out


def register_dir(spark: SparkSession, sf_dir: str, names=TEST_TABLES) -> dict[str, DataFrame]:
    """Register ``<sf_dir>/<name>.parquet`` for each name."""
    return register_tables(spark, {n: f"{sf_dir.rstrip('/')}/{n}.parquet" for n in names})


def run_sql(spark: SparkSession, sql: str) -> DataFrame:
    try:
        return spark.sql(sql)
    except Exception:
        log.exception("query failed: %s", sql)
        raise


def register_jdbc_catalog(spark: SparkSession, name: str, url: str, driver: str, **options: str) -> None:
    """Expose a JDBC database as catalog ``name`` (``name.schema.table``
    in SQL), with filter / aggregate pushdown through the V2 JDBC catalog."""
    prefix = f"spark.sql.catalog.{name}"
    spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
    spark.conf.set(f"{prefix}.url", url)
    spark.conf.set(f"{prefix}.driver", driver)
    for k, v in options.items():
        spark.conf.set(f"{prefix}.{k}", v)


# Q3 shape: the one published query (average of a measure per group, best first).
def avg_by_group(df: DataFrame, group: str, measure: str, alias: str = "avg_value") -> DataFrame:
    from pyspark.sql import functions as F
    return (df.groupBy(group).agg(F.avg(measure).alias(alias))
            .orderBy(F.col(alias).desc(), F.col(group)))
