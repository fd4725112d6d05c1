"""String lengths of a growing folder, profiled file by file.

The store holds one row per file and string column: values, bytes and a KLL
quantile sketch of the byte lengths (Spark's ``kll_sketch_agg_bigint``; a few
kilobytes, whatever the file's size).  A profile lists the source, reads only
files that the store does not hold (by path, size and modification time), adds
their rows, and merges the sketches of all files that are there now, so files
that were deleted or rewritten no longer count.  Counts and means are exact; a
median is a value of the column whose rank is within ``rank_error(k)`` of one half.

Reading is one aggregate in place, with no row per value: a task sends one row
per file it has read.  Merging reads the store alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import types as TY
from ..functions.exprs import col
from ..sinks.tables import target_exists
from ..sources.files import read_table, table_format
from .profile import ROWS_MARK

STORE_SCHEMA = "path string, bytes bigint, modified timestamp, column_name string, n_values bigint, total_len bigint, max_len bigint, sketch binary"
IDENTITY = ["path", "bytes", "modified"]
K = 2048                    # size of a sketch: about 2,048 kept lengths


def rank_error(k: int = K) -> float:
    """The normalised rank error that a KLL sketch of size ``k`` keeps with a
    confidence of 99 % (the published fit for single ranks); merged sketches keep it too."""
    return 2.296 / k ** 0.9723


def _listed(spark: SparkSession, source: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    return files.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time", F.col("path").alias("_read")).toDF(*IDENTITY, "_read")


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """The kept rows; an empty frame when there are none.  Two profiles that ran
    at once may both have added a file: it counts once."""
    if not target_exists(spark, store):
        return spark.createDataFrame([], STORE_SCHEMA)
    kept = spark.read.schema(STORE_SCHEMA).parquet(store)
    figures = [c for c in kept.columns if c not in (*IDENTITY, "column_name")]
    return kept.groupBy(*IDENTITY, "column_name").agg(F.collect_list(F.struct(*figures))[0].alias("f")).select(*IDENTITY, "column_name", "f.*")


def sketch_rows(df: DataFrame, k: int = K) -> DataFrame:
    """The store's rows of a frame read from files: one per file and string column,
    and one per file under ``ROWS_MARK`` that counts its rows."""
    strings = [f.name for f in df.schema.fields if TY.type_kind(f.dataType) == "string"]
    sized = df.select(*[F.octet_length(col(c)).cast("bigint").alias(f"l{i}") for i, c in enumerate(strings)],
                      F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"),
                      F.col("_metadata.file_modification_time").alias("modified"))
    figures = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(strings)):
        figures += [F.count(f"l{i}").alias(f"n{i}"), F.sum(f"l{i}").alias(f"s{i}"), F.max(f"l{i}").alias(f"m{i}"),
                    F.kll_sketch_agg_bigint(f"l{i}", F.lit(k)).alias(f"k{i}")]
    nothing = F.lit(None)
    rows = [F.struct(F.lit(ROWS_MARK).alias("column_name"), F.col("rows").alias("n_values"), nothing.cast("bigint").alias("total_len"),
                     nothing.cast("bigint").alias("max_len"), nothing.cast("binary").alias("sketch"))]
    rows += [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_values"), F.col(f"s{i}").alias("total_len"),
                      F.col(f"m{i}").alias("max_len"), F.when(F.col(f"n{i}") > 0, F.col(f"k{i}")).alias("sketch"))
             for i, c in enumerate(strings)]
    return sized.groupBy(*IDENTITY).agg(*figures).select(*IDENTITY, F.inline(F.array(*rows)))


def profile_new_files(spark: SparkSession, source: str, store: str, fmt: str | None = None, k: int = K, **options: str) -> int:
    """Sketch the files below ``source`` that ``store`` does not hold; returns how
    many were read.  They are recorded by one committed append: a run cut short
    records none of them.  A file without rows is recorded with 0 rows.  CSV files
    are read as text, header and quotes as everywhere, without line breaks in fields."""
    if options.get("multiline"):
        raise ValueError("a file whose records span lines is not read file by file here")
    known = read_store(spark, store).select(*IDENTITY).distinct()
    new = _listed(spark, source).join(known, IDENTITY, "left_anti")
    paths = sorted(r["_read"] for r in new.select("_read").collect())          # file names, as any read lists them
    if not paths:
        return 0
    fmt = table_format(source, fmt)
    if fmt == "parquet":
        options = {"mergeSchema": "true"} | options                            # files may differ in their columns
    found = sketch_rows(read_table(spark, paths, fmt, **options), k)
    found.write.mode("append").parquet(store)
    # files without a single row give no group
    empty = new.select(*IDENTITY).join(read_store(spark, store).select(*IDENTITY).distinct(), IDENTITY, "left_anti")
    marks = empty.select(*IDENTITY, F.lit(ROWS_MARK).alias("column_name"), F.lit(0).cast("bigint").alias("n_values"))
    marks = marks.selectExpr("*", "CAST(NULL AS BIGINT) AS total_len", "CAST(NULL AS BIGINT) AS max_len", "CAST(NULL AS BINARY) AS sketch")
    if marks.limit(1).count():
        marks.write.mode("append").parquet(store)
    return len(paths)


def merged_lengths(spark: SparkSession, source: str, store: str) -> DataFrame:
    """One row per string column over the files that are there now (and one under
    ``ROWS_MARK``): files, n_values, total_len, max_len, median_len, avg_len, sketch."""
    here = read_store(spark, store).join(_listed(spark, source).select(*IDENTITY), IDENTITY, "left_semi")
    merged = here.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n_values").alias("n_values"), F.sum("total_len").alias("total_len"),
        F.max("max_len").alias("max_len"), F.kll_merge_agg_bigint("sketch").alias("sketch"))
    some = (F.col("n_values") > 0) & (F.col("column_name") != ROWS_MARK)
    return (merged.withColumn("sketch", F.when(some, F.col("sketch")))
            .withColumn("median_len", F.when(some, F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5))).cast("double"))
            .withColumn("avg_len", F.col("total_len") / F.nullif("n_values", F.lit(0))))


def length_profile(spark: SparkSession, inputs: dict[str, str], store: str, formats: dict[str, str] | None = None, k: int = K) -> DataFrame:
    """``string_length_stats`` of many folders from their sketches, after reading
    their new files: table_name, column_name, n_values, median_len, avg_len."""
    frames = []
    for name, source in inputs.items():
        profile_new_files(spark, source, f"{store}/{name}", (formats or {}).get(name), k)
        frames.append(merged_lengths(spark, source, f"{store}/{name}").select(F.lit(name).alias("table_name"), "column_name", "n_values", "median_len", "avg_len"))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
