"""Kept and rejected rows written by one job.

The frame is written once, partitioned by a verdict, so the source is read once
whatever is wrong with it.  The two folders are then committed apart: the kept
side by a rename where its columns are already those of the target, the
rejected side by a read of its own (usually few) rows.  Two writers are open in
a task, so the rows are not sorted by their verdict.
"""

from __future__ import annotations

from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import _fs, target_exists

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


class Split(NamedTuple):
    folder: str
    verdict: str               # the partition column
    schema: T.StructType
    rows: int
    rejected: int


@contextmanager
def _unsorted(spark: SparkSession):
    """A writer per verdict in a task, instead of a sort of all rows by it."""
    before = spark.conf.get(WRITERS, None)
    spark.conf.set(WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.unset(WRITERS) if before is None else spark.conf.set(WRITERS, before)


def write_split(df: DataFrame, broken: Column, folder: str) -> Split:
    """Write every row of ``df`` below ``folder``, once, by whether it is ``broken``
    (null counts as not broken).  Files hold the frame's own columns; what an
    earlier, cut-off attempt left in the folder is replaced."""
    spark = df.sparkSession
    verdict = "_broken"
    while verdict.lower() in {c.lower() for c in df.columns}:
        verdict += "_"
    flag = F.coalesce(broken, F.lit(False))
    seen = Observation()
    flagged = df.withColumn(verdict, flag)
    flagged = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(verdict)).alias("rejected"))
    with _unsorted(spark):
        flagged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(verdict).parquet(folder)
    return Split(folder, verdict, df.schema, int(seen.get["rows"]), int(seen.get["rejected"]))


def side_folder(split: Split, broken: bool) -> str:
    return f"{split.folder.rstrip('/')}/{split.verdict}={str(broken).lower()}"


def side(spark: SparkSession, split: Split, broken: bool) -> DataFrame:
    """The rows of one verdict, as they were written; a side without rows is empty."""
    folder = side_folder(split, broken)
    if not target_exists(spark, folder):
        return spark.createDataFrame([], split.schema)
    return spark.read.schema(split.schema).parquet(folder)


def take_side(spark: SparkSession, split: Split, broken: bool, folder: str) -> bool:
    """Make the files of one verdict the content of ``folder`` by a rename;
    False, and nothing done, where the side has no rows."""
    fs, source = _fs(spark, side_folder(split, broken))
    if not fs.exists(source):
        return False
    _, place = _fs(spark, folder)
    fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(source, place):
        raise RuntimeError(f"could not move {source} to {folder}")
    return True
