"""Chunks inside Parquet files.

A chunk is a range of row groups of one file, cut by row counts from the footers
(``row_group_index``), so one large file is read, loaded and restarted in parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import scratch_path

CHUNK = "_chunk"
PROGRESS = "path string, first_group int, last_group int, num_rows bigint, file_rows bigint"


def row_group_chunks(index: DataFrame, chunk_rows: int) -> DataFrame:
    """(path, chunk, first_group, last_group, num_rows, file_rows): consecutive row
    groups of a file.  A chunk ends with the row group that fills it up to
    ``chunk_rows``; a single row group larger than that is a chunk of its own.
    The window orders the row groups of one file, which its footer already lists."""
    groups = index.groupBy("path", "row_group").agg(F.max("num_rows").alias("n")).where("n > 0")
    file = Window.partitionBy("path")
    ahead = file.orderBy("row_group").rowsBetween(Window.unboundedPreceding, -1)
    placed = groups.withColumn("chunk", F.floor(F.coalesce(F.sum("n").over(ahead), F.lit(0)) / chunk_rows)).withColumn("file_rows", F.sum("n").over(file))
    return placed.groupBy("path", "chunk").agg(F.min("row_group").alias("first_group"), F.max("row_group").alias("last_group"),
                                               F.sum("n").alias("num_rows"), F.max("file_rows").alias("file_rows"))


def read_chunks(chunks: DataFrame, schema: T.StructType, tasks: int | None = None) -> DataFrame:
    """Rows of the given chunks, with ``path`` and ``first_group`` of their chunk as
    ``_path`` and ``_first``.  Tasks open the files themselves and read only their
    row groups and the columns of ``schema``, batch by batch.  Chunks are dealt in
    order to ``tasks`` tasks, by default one each: the list is so short that Spark
    would otherwise join its partitions, and one task would read every chunk."""
    out = T.StructType([T.StructField("_path", T.StringType()), T.StructField("_first", T.IntegerType()), *schema.fields])
    wanted = to_arrow_schema(schema)

    def run(batches):
        from urllib.parse import urlparse as _parse

        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        for batch in batches:
            for row in batch.to_pylist():
                u = _parse(row["path"])
                if u.scheme in ("", "file"):
                    fs, inner = pafs.LocalFileSystem(), (u.path if u.scheme else row["path"])
                else:
                    fs, inner = pafs.FileSystem.from_uri(row["path"])
                with fs.open_input_file(inner) as fh:
                    ranges = list(range(row["first_group"], row["last_group"] + 1))
                    for part in pq.ParquetFile(fh).iter_batches(batch_size=16_384, row_groups=ranges, columns=wanted.names):
                        cols = [part.column(part.schema.get_field_index(f.name)).cast(f.type) for f in wanted]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["path"]] * part.num_rows, pa.string()), pa.array([row["first_group"]] * part.num_rows, pa.int32()), *cols],
                            names=["_path", "_first", *wanted.names])

    dealt = chunks.select("path", "first_group", "last_group")
    return dealt.repartitionByRange(tasks or max(dealt.count(), 1), "path", "first_group").mapInArrow(run, out)


def load_chunks(spark: SparkSession, index: DataFrame, schema: T.StructType, target: str, progress: str, chunk_rows: int,
                batch_rows: int, after_batch=None) -> int:
    """Append the rows of all chunks that ``progress`` does not list to the folder
    ``target``, about ``batch_rows`` rows a batch; the number of batches run.

    Each batch overwrites just its own chunks' partitions and is then listed, so a
    run cut short goes on with the next range and a batch written but not listed is
    written over, not twice.  A file is known by path and row count; one that
    changed must come under a new path."""
    from ..sinks.tables import _fs
    fs, p = _fs(spark, progress)
    done = spark.read.schema(PROGRESS).parquet(progress) if fs.exists(p) else spark.createDataFrame([], PROGRESS)
    keys = ["path", "first_group", "last_group", "file_rows"]
    pending = row_group_chunks(index, chunk_rows).join(done.select(*keys), keys, "left_anti")
    ahead = Window.orderBy("path", "first_group").rowsBetween(Window.unboundedPreceding, -1)
    # One row a chunk (names and counts only) is put in order, as for a list of files.
    pending = pending.withColumn("batch", F.floor(F.coalesce(F.sum("num_rows").over(ahead), F.lit(0)) / batch_rows)).drop("chunk")
    # Written, so that the entries added below do not change the list that is being worked off.
    listed = scratch_path(spark, "chunk-list")
    pending.write.parquet(listed)
    pending = spark.read.schema(pending.schema).parquet(listed)
    batches = [(r["batch"], r["chunks"]) for r in pending.groupBy("batch").agg(F.count(F.lit(1)).alias("chunks")).orderBy("batch").collect()]
    for batch, tasks in batches:
        now = pending.where(F.col("batch") == batch)
        # A task sorts its rows by chunk before it writes them: no more than one chunk's.
        rows = read_chunks(now, schema, tasks).withColumn(CHUNK, F.concat_ws("-", F.substring(F.sha2("_path", 256), 1, 16), "_first")).drop("_path", "_first")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(CHUNK).parquet(target)
        if after_batch:
            after_batch(batch)
        now.select("path", "first_group", "last_group", "num_rows", "file_rows").coalesce(1).write.mode("append").parquet(progress)
    return len(batches)
