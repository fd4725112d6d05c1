"""File stream ingest: batches, reruns, new files, replays."""

import pytest
from pyspark.sql import functions as F

from tablepipe.operators.clean import clean
from tablepipe.operators.contract import capture_contract
from tablepipe.sinks import TargetExists
from tablepipe.streaming import BATCH_COL, incremental_ingest, read_ingested


@pytest.fixture
def events(spark):
    return spark.read.parquet("/root/testdata/sf0.001/events.parquet")


def _files(events, path, n, part):
    events.where(F.col("event_id") % n == part).coalesce(1).write.mode("append").parquet(path)


def test_batches_rerun_and_new_files(spark, events, tmp_dir):
    src, tgt, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/tgt", f"{tmp_dir}/ckpt"
    for p in range(3):
        _files(events, src, 4, p)
    args = dict(data_type={"user_id": "int32"}, mode="append", checkpoint=ckpt, max_files_per_trigger=1)
    r1 = incremental_ingest(spark, src, tgt, **args)
    assert r1["batches"] == 3
    first = read_ingested(spark, tgt).count()
    assert first == events.where(F.col("event_id") % 4 < 3).count()
    r2 = incremental_ingest(spark, src, tgt, **args)            # nothing new: adds nothing
    assert r2["input_rows"] == 0 and read_ingested(spark, tgt).count() == first
    _files(events, src, 4, 3)                                    # one more file: only its rows
    incremental_ingest(spark, src, tgt, **args)
    out = read_ingested(spark, tgt)
    assert out.count() == events.count()
    batch = clean(events, column_naming="lower", data_type={"user_id": "int32"}, date_format=True)
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_replayed_batch_is_idempotent(spark, events, tmp_dir):
    import glob
    import os
    src, tgt, ckpt = f"{tmp_dir}/src", f"{tmp_dir}/tgt", f"{tmp_dir}/c1"
    for p in range(2):
        _files(events, src, 2, p)
    incremental_ingest(spark, src, tgt, mode="fail", checkpoint=ckpt)
    n = read_ingested(spark, tgt).count()
    # lose the commit of the last batch: the restarted query runs it again
    last = max(glob.glob(f"{ckpt}/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{ckpt}/commits/.{os.path.basename(last)}.crc"):
        os.remove(crc)
    r = incremental_ingest(spark, src, tgt, mode="append", checkpoint=ckpt)
    assert r["input_rows"] > 0                                  # the batch did run again
    assert read_ingested(spark, tgt).count() == n
    assert read_ingested(spark, tgt, keep_batch=True).select(BATCH_COL).distinct().count() == 2
    # a different stream appending to the same target adds its rows
    incremental_ingest(spark, src, tgt, mode="append", checkpoint=f"{tmp_dir}/c2")
    assert read_ingested(spark, tgt).count() == 2 * n


def test_fail_mode_refuses_before_start(spark, events, tmp_dir):
    src, tgt = f"{tmp_dir}/src", f"{tmp_dir}/tgt"
    _files(events, src, 1, 0)
    incremental_ingest(spark, src, tgt, mode="fail", checkpoint=f"{tmp_dir}/c1")
    with pytest.raises(TargetExists):
        incremental_ingest(spark, src, tgt, mode="fail", checkpoint=f"{tmp_dir}/c2")
    incremental_ingest(spark, src, tgt, mode="replace", checkpoint=f"{tmp_dir}/c3")
    assert read_ingested(spark, tgt).count() == events.count()


def test_each_batch_is_checked(spark, events, tmp_dir):
    src, tgt, rep, quar = (f"{tmp_dir}/{x}" for x in ("src", "tgt", "rep", "quar"))
    contract = capture_contract(events, "events")
    bad = events.withColumn("value", F.when(F.col("event_id") % 5 == 0, None).otherwise(F.col("value")))
    for p in range(2):
        bad.where(F.col("event_id") % 2 == p).coalesce(1).write.mode("append").parquet(src)
    incremental_ingest(spark, src, tgt, mode="fail", contract=contract, table_name="events",
                       on_violation="quarantine", report_target=rep, quarantine_target=quar,
                       checkpoint=f"{tmp_dir}/c")
    n_bad = bad.where("value IS NULL").count()
    assert spark.read.parquet(quar).count() == n_bad
    assert read_ingested(spark, tgt).count() == events.count() - n_bad
    assert spark.read.parquet(rep).where("finding = 'null_values'").count() == 2
    with pytest.raises(Exception):
        incremental_ingest(spark, src, f"{tmp_dir}/tgt2", mode="fail", contract=contract,
                           table_name="events", on_violation="fail", checkpoint=f"{tmp_dir}/c9")


def test_date_columns_from_contract(spark, events, tmp_dir):
    src, tgt = f"{tmp_dir}/src", f"{tmp_dir}/tgt"
    text = events.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    contract = capture_contract(clean(text, column_naming="lower"), "events")   # ts -> timestamp_ntz
    bad = text.withColumn("ts", F.when(F.col("event_id") == 5, "later").otherwise(F.col("ts")))
    bad.coalesce(1).write.parquet(src)
    incremental_ingest(spark, src, tgt, mode="fail", contract=contract, table_name="events",
                       on_violation="report", report_target=f"{tmp_dir}/rep", checkpoint=f"{tmp_dir}/c")
    out = read_ingested(spark, tgt)
    # detection on the data would have left ts as text (one bad value); the contract keeps it a date
    assert out.schema["ts"].dataType.simpleString() == "timestamp_ntz"
    assert spark.read.parquet(f"{tmp_dir}/rep").where("finding = 'null_values'").first().bad_rows == 1


def test_continuous_trigger_picks_up_new_files(spark, events, tmp_dir):
    src, tgt = f"{tmp_dir}/src", f"{tmp_dir}/tgt"
    _files(events, src, 2, 0)
    q = incremental_ingest(spark, src, tgt, mode="fail", checkpoint=f"{tmp_dir}/c", trigger="1 second",
                           wait=False)
    try:
        q.processAllAvailable()
        _files(events, src, 2, 1)
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_ingested(spark, tgt).count() == events.count()


def test_first_batch_is_the_first_load(spark, events, tmp_dir):
    from tablepipe.operators.contract import load_contracts
    src, tgt, loc = f"{tmp_dir}/src", f"{tmp_dir}/tgt", f"{tmp_dir}/contracts"
    _files(events, src, 2, 0)
    later = events.where(F.col("event_id") % 2 == 1).withColumn(
        "value", F.when(F.col("event_id") % 7 == 0, None).otherwise(F.col("value")))
    later.coalesce(1).write.mode("append").parquet(src)
    incremental_ingest(spark, src, tgt, mode="fail", table_name="events", contract_location=loc,
                       on_violation="report", report_target=f"{tmp_dir}/rep", checkpoint=f"{tmp_dir}/c")
    stored = load_contracts(spark, loc)
    assert stored.where("kind = 'column'").count() == 6
    rep = spark.read.parquet(f"{tmp_dir}/rep")
    assert rep.where("finding = 'null_values'").first().bad_rows == later.where("value IS NULL").count()
    assert read_ingested(spark, tgt).count() == events.count()


def test_resumed_replace_and_fail_keep_what_was_loaded(spark, tmp_dir):
    from tablepipe.streaming import incremental_ingest, read_ingested, split_into_files
    src = f"{tmp_dir}/src"
    split_into_files(spark.range(100), src, 4)
    for mode in ("replace", "fail"):
        for _ in range(2):
            incremental_ingest(spark, src, f"{tmp_dir}/{mode}", mode=mode, checkpoint=f"{tmp_dir}/ck-{mode}", max_files_per_trigger=2)
            assert read_ingested(spark, f"{tmp_dir}/{mode}").count() == 100


def test_figures_count_every_batch(spark, tmp_dir):
    from tablepipe.streaming import incremental_ingest
    src = f"{tmp_dir}/src"
    spark.range(1120).repartition(112).write.parquet(src)
    out = incremental_ingest(spark, src, f"{tmp_dir}/t", mode="append", max_files_per_trigger=1, date_format=False)
    assert out["input_rows"] == out["rows_written"] == 1120 and out["batches"] > 100
