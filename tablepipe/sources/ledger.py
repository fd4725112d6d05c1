"""The load ledger: which files a target already holds.

One row per loaded file (path, bytes, modification time) in a Parquet folder
with one partition per load.  A load lists its source (names and sizes only, no
content) and anti-joins the ledger before it reads anything, so loading the
same files again adds nothing; a file that changed since counts as a new file.
Writing a load's partition again replaces it, so a restarted commit records
every file once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profile import qualified
from ..sinks.tables import _fs, target_exists

LEDGER_SCHEMA = "target string, path string, bytes bigint, modified timestamp, loaded_at timestamp, load string"


def listed_files(spark: SparkSession, source: str) -> DataFrame:
    """path, bytes, modified of every data file below ``source`` (a file or a folder)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """All recorded files; an empty frame when nothing is recorded yet."""
    if not target_exists(spark, ledger):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger)


def ledger_key(spark: SparkSession, target: str) -> str:
    """A target as the ledger spells it (paths qualified, table names as they are)."""
    return qualified(spark, target) if "/" in target else target


def new_files(spark: SparkSession, source: str, ledger: str, target: str) -> DataFrame:
    """The files below ``source`` that the ledger does not hold for ``target``."""
    known = read_ledger(spark, ledger).where(F.col("target") == ledger_key(spark, target))
    return listed_files(spark, source).join(known, ["path", "bytes", "modified"], "left_anti")


def record_load(files: DataFrame, ledger: str, target: str, load: str, replaces: bool = False) -> None:
    """Record ``files`` (path, bytes, modified) as what ``load`` brought to
    ``target``; with ``replaces`` the target's earlier loads are forgotten."""
    spark = files.sparkSession
    key = ledger_key(spark, target)
    rows = files.select(F.lit(key).alias("target"), "path", "bytes", "modified", F.current_timestamp().alias("loaded_at"))
    earlier = []
    if replaces:
        earlier = [r["load"] for r in read_ledger(spark, ledger).where((F.col("target") == key) & (F.col("load") != load)).select("load").distinct().collect()]
    rows.write.mode("overwrite").parquet(f"{ledger}/load={load}")
    for name in earlier:
        fs, path = _fs(spark, f"{ledger}/load={name}")
        fs.delete(path, True)
