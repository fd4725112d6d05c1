"""Read CSV / Parquet tables and count their records.

One lazy reader serves the "eager", "lazy" and chunked cases: Spark
DataFrames are deferred anyway and the scan is split by
``spark.sql.files.maxPartitionBytes``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV options: header, RFC-4180 quoting, bad rows kept (PERMISSIVE).
# ``multiLine`` (quoted newlines inside a record) is opt-in: files are then read
# twice, once for the quotes of each byte range (csv_records.py).
# Timestamps keep microseconds (the CSV default would cut them to millis).
TS_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
}
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    # An unquoted empty field is null, a quoted one the empty text; only \\N is null as text.
    "nullValue": "\\N",
    **TS_OPTIONS,
}
# The writer's default would trim text.
CSV_WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                     "ignoreTrailingWhiteSpace": "false", **TS_OPTIONS}
CORRUPT = "_corrupt_record"


def table_format(path: str, fmt: str | None = None) -> str:
    if fmt:
        return fmt.lower()
    return "csv" if path.rstrip("/").lower().endswith(".csv") else "parquet"


def read_table(spark: SparkSession, path: str | list[str], fmt: str | None = None,
               schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """Read one CSV or Parquet table (file or folder of files; a list of files with its format)."""
    fmt = table_format(path, fmt)
    if fmt == "csv":
        return read_csv(spark, path, schema=schema, **options)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).parquet(*([path] if isinstance(path, str) else path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             keep_corrupt: bool = False, multiline: bool = False, **options: str) -> DataFrame:
    """CSV with header.  Without a schema every column is read as text, so the
    clean step (casts, date detection) decides types, not the CSV inference.
    With ``keep_corrupt`` a ``_corrupt_record`` column holds rows that did not
    fit the schema.  Records are counted as records, not lines, once
    ``multiline`` is on: byte ranges of a file are then read in parallel
    (compressed files, and inference of types, by Spark's own ``multiLine``,
    a file a task)."""
    opts = {**CSV_OPTIONS, "multiLine": str(multiline).lower(), **options}
    if str(opts["multiLine"]).lower() == "true" and str(opts.get("inferSchema", "false")).lower() != "true" and plain_text(spark, path):
        return read_multiline(spark, path, schema, keep_corrupt, opts)
    reader = spark.read.options(**opts)
    if schema is None:
        return spark.read.options(**{"inferSchema": "false", **opts}).csv(path)
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if keep_corrupt:
        st = with_corrupt(st)
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.schema(st).csv(path)


def with_corrupt(st: T.StructType) -> T.StructType:
    return st if CORRUPT in st.fieldNames() else T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType(), True)])


def plain_text(spark: SparkSession, path: str | list[str]) -> bool:
    """Whether no file of the input is compressed (by its suffix)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    packed = F.lower(F.element_at(F.split("path", r"\."), -1)).isin("gz", "bz2", "zst", "lz4", "snappy", "deflate", "xz")
    return files.where(packed).limit(1).count() == 0


def read_multiline(spark: SparkSession, path: str | list[str], schema: T.StructType | str | None, keep_corrupt: bool,
                   options: dict[str, str]) -> DataFrame:
    from .csv_records import read_records
    if schema is None:
        # the first record names the columns
        names = spark.read.options(**{**options, "inferSchema": "false"}).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    if keep_corrupt:
        st, options = with_corrupt(st), {**options, "columnNameOfCorruptRecord": CORRUPT}
    return read_records(spark, path, st, **options)


def head(df: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """First n rows; reproducible only with keys (top-k by key)."""
    if keys:
        return df.orderBy(*keys).limit(n)
    return df.limit(n)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table (table_name, n_rows).  Each branch is a
    footer-answerable count for Parquet; all branches run in one job."""
    parts = [df.select().groupBy().count().select(F.lit(name).alias("table_name"),
                                                  F.col("count").alias("n_rows"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header and RFC-4180 quoting, readable back by ``read_csv``."""
    df.write.mode(mode).options(**CSV_WRITE_OPTIONS).csv(path)
