"""Incremental ingest of a folder of files with Structured Streaming.

    readStream (file source, fixed schema) -> clean (frozen plan) ->
    foreachBatch(contract check, quarantine, idempotent write) -> availableNow

* The micro-batch is a set of whole files (``maxFilesPerTrigger``); a file is
  never split across batches.
* The schema and the date columns are fixed before the stream starts (I2): a
  stream needs a static plan, so date detection runs once on a batch read.
* Every batch is checked against the contract (I4) and written to the
  ``_stream=<checkpoint hash>/_batch=<id>`` partition of the target with
  dynamic partition overwrite, so a replayed batch replaces its own rows
  instead of adding them again, while another stream appending to the same
  target never touches them (I3).
* The exists-mode is applied once, before the stream starts (I5).
* The checkpoint folder is the restart boundary: a rerun picks up only new
  files, and a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import hashlib
import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean, date_columns_from_contract
from ..operators.contract import (CONTRACT_SCHEMA, REPORT_SCHEMA, _contract_rows, check_contract, load_contracts,
                                  observe_capture, observe_contract, save_contract, split_by_contract)
from ..operators.dates import detect_date_columns
from ..session import scratch_path, shared_root
from ..operators.profile import qualified
from ..sources.files import CSV_OPTIONS
from ..sinks.tables import check_target, target_exists

BATCH_COL = "_batch"
STREAM_COL = "_stream"


class JobSpecLike:
    """The two settings the pre-date cleaning needs."""

    def __init__(self, column_naming, data_type):
        self.column_naming = column_naming
        self.data_type = data_type


def frozen_plan(spark: SparkSession, source_dir: str, fmt: str, schema: T.StructType | None,
                date_format: bool, column_naming: str | None, data_type: dict | None,
                multiline: bool = False):
    """Schema of the source and the date columns, fixed from a batch read."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema)
    sample = reader.load(source_dir)          # footers / header only until an action
    schema = sample.schema
    dates: list[str] = []
    if date_format:
        pre = clean(sample, column_naming=column_naming, data_type=data_type, date_format=False)
        dates = detect_date_columns(pre)
    return schema, dates


def incremental_ingest(spark: SparkSession, source_dir: str, target: str, *, fmt: str = "parquet",
                       schema: T.StructType | None = None, column_naming: str | None = "lower",
                       data_type: dict[str, str] | None = None, date_format: bool = True,
                       decimal_precision: int | None = None, mode: str = "fail",
                       contract: DataFrame | None = None, table_name: str = "table",
                       on_violation: str = "report", report_target: str | None = None,
                       quarantine_target: str | None = None, checkpoint: str | None = None,
                       max_files_per_trigger: int = 1, date_columns: list[str] | None = None,
                       multiline: bool = False, trigger: str | None = None, wait: bool = True,
                       contract_location: str | None = None, settings: dict[str, str] | None = None,
                       csv_options: dict[str, str] | None = None):
    """Run the stream to the end of the available files (``availableNow``)
    and return the progress figures.  With ``trigger`` (a processing-time
    interval such as ``"1 minute"``) the stream keeps watching the folder;
    with ``wait=False`` the running ``StreamingQuery`` is returned instead.

    With ``contract_location`` (and no ``contract``) the stored contract of
    ``table_name`` is used; when there is none yet, the first micro-batch is
    the first load: its contract is captured as an observation of its own
    write, stored, and the later batches are checked against it."""
    if mode not in ("fail", "append", "replace"):
        raise ValueError("mode must be fail, append or replace")
    if on_violation == "quarantine" and not quarantine_target:
        raise ValueError("on_violation 'quarantine' needs a quarantine target for the rejected rows")
    if not checkpoint and mode == "append":
        # the same source and target go on where they stopped: a rerun adds new files only
        name = hashlib.sha1(f"{qualified(spark, source_dir)}\n{qualified(spark, target)}".encode()).hexdigest()[:16]
        checkpoint = f"{shared_root(spark)}/tablepipe/stream-{name}"
    ckpt = checkpoint or scratch_path(spark, "stream-ckpt")
    resumed = target_exists(spark, ckpt)      # the exists-mode was applied when this checkpoint began
    if not resumed:
        check_target(spark, target, mode)
    contract_types = None
    if contract is None and contract_location is not None:
        stored = load_contracts(spark, contract_location)
        if stored is not None:
            rows = _contract_rows(stored, table_name)
            contract = spark.createDataFrame(rows, CONTRACT_SCHEMA) if rows else None
    capture_first = contract is None and contract_location is not None
    if contract is not None:
        # pin the contract rows once (metadata: one row per column / setting)
        rows = contract.collect()
        contract = rows                       # checks take the collected rows: no job per batch
        contract_types = {r["name"]: r["value"] for r in rows if r["kind"] == "column"}
    # The contract fixes the date columns; only without one (or a given list)
    # does the existing data get a detection pass.
    detect = date_format and date_columns is None and contract_types is None
    src_schema, dates = frozen_plan(spark, source_dir, fmt, schema, detect, column_naming, data_type, multiline)
    if date_columns is not None:
        dates = date_columns
    elif date_format and contract_types is not None:
        empty = spark.createDataFrame([], src_schema)
        dates = date_columns_from_contract(
            empty, JobSpecLike(column_naming, data_type), contract_types)
    reader = (spark.readStream.format(fmt).schema(src_schema)
              .option("maxFilesPerTrigger", str(max_files_per_trigger)))
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).option("multiLine", str(multiline).lower()).options(**(csv_options or {}))
    stream = clean(reader.load(source_dir), column_naming=column_naming, data_type=data_type,
                   date_format=date_format, decimal_precision=decimal_precision, date_columns=dates)
    if mode == "replace" and not resumed and target_exists(spark, target):
        empty = spark.createDataFrame([], stream.schema.add(STREAM_COL, T.StringType()).add(BATCH_COL, T.LongType()))
        empty.write.mode("overwrite").partitionBy(STREAM_COL, BATCH_COL).parquet(target)

    # Batch ids restart with every checkpoint: the stream id keeps two streams
    # appending to one target apart, the batch id makes a replay overwrite
    # only what that batch wrote before.
    stream_id = hashlib.sha1(qualified(spark, ckpt).encode()).hexdigest()[:12]

    def write_parts(df: DataFrame, path: str, batch_id: int) -> int:
        counted = Observation()
        (df.observe(counted, F.count(F.lit(1)).alias("n")).withColumn(STREAM_COL, F.lit(stream_id)).withColumn(BATCH_COL, F.lit(batch_id).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(STREAM_COL, BATCH_COL).parquet(path))
        return int(counted.get["n"])

    # Figures of this run, added up batch by batch (the query's own progress keeps 100 batches only).
    state = {"contract": contract, "batches": 0, "input_rows": 0, "rows_written": 0, "rows_rejected": 0, "findings": 0}

    def add(**figures: int) -> None:
        for k, n in figures.items():
            state[k] += n

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        contract = state["contract"]
        if contract is None and capture_first:
            # first load: capture the contract in this batch's write, store it
            observed, finish = observe_capture(batch, table_name, 1, settings)
            n = write_parts(observed, target, batch_id)
            add(batches=n > 0, input_rows=n, rows_written=n)
            captured = finish()
            save_contract(captured, contract_location)
            state["contract"] = captured.collect()
            return
        if contract is None:
            n = write_parts(batch, target, batch_id)
            add(batches=n > 0, input_rows=n, rows_written=n)
            return
        if on_violation == "report":
            # one pass: the check is an Observation of the write job
            observed, finish = observe_contract(batch, contract, table_name, settings)
            n = write_parts(observed, target, batch_id)
            found = finish()
            add(batches=n > 0, input_rows=n, rows_written=n, findings=found.count())
            if report_target:
                write_parts(found, report_target, batch_id)
            return
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows = check_contract(batch, contract, table_name, settings).collect()    # one row per finding
            if report_target and rows:
                write_parts(spark.createDataFrame(rows, REPORT_SCHEMA), report_target, batch_id)
            blocking = [r for r in rows if r["blocking"]]
            good, rejected = batch, 0
            if blocking and on_violation == "fail":
                raise ValueError(f"batch {batch_id} breaks the contract: {blocking}")
            if blocking and on_violation == "quarantine":
                good, bad = split_by_contract(batch, contract, table_name)
                rejected = write_parts(bad, quarantine_target, batch_id)
            n = write_parts(good, target, batch_id)
            add(batches=n + rejected > 0, input_rows=n + rejected, rows_written=n, rows_rejected=rejected, findings=len(rows))
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    q = writer.start()
    if not wait:
        return q
    q.awaitTermination()
    return {k: int(n) for k, n in state.items() if k != "contract"} | {"checkpoint": ckpt}


def read_ingested(spark: SparkSession, target: str, keep_batch: bool = False) -> DataFrame:
    df = spark.read.parquet(target)
    return df if keep_batch else df.drop(STREAM_COL, BATCH_COL)


# Bytes of a table's files that one task rewrites, about.
PART_BYTES = 64 << 20


def files_per_trigger(n_files: int, chunk_fraction: float) -> int:
    """P13 turned into a stream setting: files per micro-batch."""
    return max(1, math.ceil(n_files * chunk_fraction))


def split_into_files(df: DataFrame, path: str, files: int) -> int:
    """Write a table as ``files`` Parquet files (to feed a file stream).

    One task writes a file.  When the table's own files hold more than
    ``PART_BYTES`` for each of them, every file comes in so many parts of equal
    size that a task's share does not grow with the table; returns that number."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    read = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in df.inputFiles()]
    held = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in read)
    parts = max(1, math.ceil(held / (files * PART_BYTES)))
    df.repartition(files * parts).write.mode("overwrite").parquet(path)
    return parts
