"""CSV reading, counts, sinks and modes."""

import pytest

from tablepipe.sinks import TargetExists, read_target, write_table
from tablepipe.sources import read_csv, row_counts, write_csv


def test_quoted_newline_csv_counts_records(spark, tmp_dir):
    path = f"{tmp_dir}/q.csv"
    with open(path, "w") as f:
        f.write('id,txt\n1,"x\ny"\n2,\n3,""\n')
    df = read_csv(spark, path, schema="id int, txt string", multiline=True)
    assert df.count() == 3
    # without multiline a quoted newline splits the record (4 "records")
    assert read_csv(spark, path, schema="id int, txt string").count() == 4
    rows = {r.id: r.txt for r in df.collect()}
    assert rows[1] == "x\ny"


def test_bad_rows_kept_in_corrupt_column(spark, tmp_dir):
    path = f"{tmp_dir}/bad.csv"
    with open(path, "w") as f:
        f.write("id,d\n1,2024-01-01\nx,2024-01-02\n3,2024-13-45\n4\n")
    df = read_csv(spark, path, schema="id int, d date", keep_corrupt=True).cache()
    assert df.count() == 4
    assert df.where("_corrupt_record IS NOT NULL").count() == 3


def test_text_read_without_schema_keeps_strings(spark, tmp_dir):
    path = f"{tmp_dir}/s.csv"
    with open(path, "w") as f:
        f.write("a,b\n1,2024-01-01\n")
    df = read_csv(spark, path)
    assert [f.dataType.simpleString() for f in df.schema.fields] == ["string", "string"]


def test_csv_roundtrip_documents(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    write_csv(docs, f"{tmp_dir}/docs")
    back = read_csv(spark, f"{tmp_dir}/docs", schema=docs.schema, multiline=True)
    assert back.count() == docs.count()
    assert back.exceptAll(docs).count() == 0


def test_row_counts(spark):
    t = {n: spark.read.parquet(f"/root/testdata/sf0.001/{n}.parquet") for n in ("nation", "region")}
    assert {r.table_name: r.n_rows for r in row_counts(t).collect()} == {"nation": 25, "region": 5}


def test_modes_on_paths(spark, tmp_dir):
    df = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    target = f"{tmp_dir}/nation_out"
    write_table(df, target, "fail")
    with pytest.raises(TargetExists):
        write_table(df, target, "fail")
    write_table(df, target, "append")
    assert read_target(spark, target).count() == 50
    write_table(df, target, "replace")
    assert read_target(spark, target).count() == 25


def test_modes_on_catalog(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/region.parquet")
    spark.sql("DROP TABLE IF EXISTS tp_region")
    write_table(df, "tp_region", "fail")
    with pytest.raises(TargetExists):
        write_table(df, "tp_region", "fail")
    write_table(df, "tp_region", "append")
    assert spark.table("tp_region").count() == 10
    write_table(df, "tp_region", "replace")
    assert spark.table("tp_region").count() == 5
    spark.sql("DROP TABLE tp_region")


def test_csv_keeps_microseconds(spark, tmp_dir):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5, 123456),)], "t timestamp_ntz")
    write_csv(df, f"{tmp_dir}/ts")
    assert read_csv(spark, f"{tmp_dir}/ts", schema="t timestamp_ntz").first().t == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)


def test_failed_replace_keeps_old_table(spark, tmp_dir):
    from pyspark.sql import functions as F
    df = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    target = f"{tmp_dir}/nation_t"
    write_table(df, target, "fail")
    boom = df.withColumn("n_nationkey", F.when(F.col("n_nationkey") == 3, F.raise_error("boom"))
                         .otherwise(F.col("n_nationkey")))
    with pytest.raises(Exception):
        write_table(boom, target, "replace")
    assert read_target(spark, target).count() == 25
    write_table(df.limit(5), target, "replace")
    assert read_target(spark, target).count() == 5
    import os
    assert not [p for p in os.listdir(tmp_dir) if "__staging" in p or "__retired" in p]


def test_staged_append_keeps_partition_folders(spark, tmp_dir):
    import os
    from tablepipe.sinks import write_table
    from tablepipe.sinks.tables import commit_staged, stage
    df = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    target = f"{tmp_dir}/by_region"
    write_table(df, target, "fail", partition_by=["n_regionkey"])
    staging = stage(df, target, partition_by=["n_regionkey"])
    commit_staged(spark, staging, target, "append")
    back = spark.read.parquet(target)
    assert back.count() == 50
    assert back.groupBy("n_regionkey").count().where("count = 10").count() == 5
    assert not os.path.exists(staging)
