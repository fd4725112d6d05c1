"""Chunks inside Parquet files: ranges, reading and restarted loads."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablepipe.operators.profile import row_group_index
from tablepipe.sources.row_groups import load_chunks, read_chunks, row_group_chunks

SCHEMA = "n bigint, s string"


def files(folder):
    for name, size, group in (("a", 100, 10), ("b", 25, 10), ("none", 0, 10)):
        n = list(range(size))
        pq.write_table(pa.table({"s": pa.array([None if i % 7 == 0 else f"{name}{i}" for i in n], pa.string()), "n": pa.array(n, pa.int64()),
                                 "rest": pa.array(n, pa.int32())}), f"{folder}/{name}.parquet", row_group_size=group)


def test_chunks_cover_each_row_group_once(spark, tmp_dir):
    files(tmp_dir)
    index = row_group_index(spark, tmp_dir)
    got = sorted((r.path[-9], r.first_group, r.last_group, r.num_rows) for r in row_group_chunks(index, 30).collect())
    assert got == [("a", 0, 2, 30), ("a", 3, 5, 30), ("a", 6, 8, 30), ("a", 9, 9, 10), ("b", 0, 2, 25)]
    assert row_group_chunks(index, 1).count() == 13  # a row group larger than a chunk is one of its own
    schema = spark.createDataFrame([], SCHEMA).schema
    rows = read_chunks(row_group_chunks(index, 30).where("first_group = 3"), schema).collect()
    assert sorted((r.n, r.s) for r in rows) == [(i, None if i % 7 == 0 else f"a{i}") for i in range(30, 60)]


@pytest.mark.parametrize("at", [0, 1])
def test_restarted_load_has_every_row_once(spark, tmp_dir, at):
    source = f"{tmp_dir}/in"
    os.mkdir(source)
    files(source)
    index = row_group_index(spark, source)
    schema = spark.createDataFrame([], SCHEMA).schema
    target, progress = f"{tmp_dir}/out", f"{tmp_dir}/progress"

    def cut(batch):
        if batch == at:
            raise InterruptedError

    with pytest.raises(InterruptedError):
        load_chunks(spark, index, schema, target, progress, 20, 50, after_batch=cut)
    load_chunks(spark, index, schema, target, progress, 20, 50)
    out = spark.read.parquet(target)
    assert out.count() == 125 and out.where("s is not null").agg(F.count_distinct("s")).first()[0] == 125 - 15 - 4
    assert load_chunks(spark, index, schema, target, progress, 20, 50) == 0


def test_a_task_reads_one_chunk(spark, tmp_dir):
    files(tmp_dir)
    chunks = row_group_chunks(row_group_index(spark, tmp_dir), 30)
    rows = read_chunks(chunks, spark.createDataFrame([], SCHEMA).schema)
    tasks = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count_distinct("_path", "_first").alias("chunks")).collect()
    assert len(tasks) == 5 and {r.chunks for r in tasks} == {1}


def test_chunk_query_over_several_files(spark, tmp_dir, monkeypatch):
    from tablepipe.plans import catalog

    lines = spark.range(4000).selectExpr("id as l_orderkey", "1 as l_linenumber", "if(id % 3 = 0, 'A', 'N') as l_returnflag", "id % 50 as l_quantity",
                                         "date_add(date'1995-01-01', int(id % 900)) as l_shipdate")
    lines.repartition(3).write.parquet(f"{tmp_dir}/lineitem.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda _, name: f"{tmp_dir}/{name}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    monkeypatch.setattr(catalog, "TASK_ROWS", 100, raising=False)
    try:
        got = {r.l_returnflag: r for r in catalog.row_group_chunks_q(spark, tmp_dir).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {k: (r.n_rows, r.n_keys, r.resumed, r.batches_left) for k, r in got.items()} == {"A": (1334, 1334, True, 0), "N": (2666, 2666, True, 0)}
    assert len(spark.read.parquet(f"{tmp_dir}/chunks-source").inputFiles()) > 1
