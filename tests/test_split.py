"""One-pass split writes: the source is read once, sides commit apart, sums add up."""

import os

import pytest
from pyspark.sql import functions as F

from tablepipe.plans.load import run_load
from tablepipe.plans.staged import staged_load
from tablepipe.sinks.split import side, take_side, write_split
from tablepipe.spec import JobSpec

SPEC = dict(table_name="t", if_table_exists="append", on_violation="quarantine", date_format=False)


def data(spark, broken=3):
    rows = [(i, None if i < broken else i * 10, f"v{i}") for i in range(200)]
    return spark.createDataFrame(rows, "k int, n int, t string").repartition(4)


def counting(spark, df):
    """The frame, and an accumulator of how often its rows are read."""
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for b in batches:
            read.add(len(b))
            yield b
    return df.mapInPandas(passing, df.schema), read


def first_load(spark, tmp_dir, target):
    run_load(spark, JobSpec(**SPEC), f"{tmp_dir}/c", target=target, source=data(spark, 0), quarantine_target=f"{tmp_dir}/q")


def test_sides_of_a_split(spark, tmp_dir):
    df = data(spark).withColumn("_broken", F.lit("mine"))
    split = write_split(df, F.col("n").isNull() & F.when(F.col("k") > 0, True), f"{tmp_dir}/s")
    assert (split.rows, split.rejected, split.verdict) == (200, 2, "_broken_")          # a null verdict is kept
    assert side(spark, split, True).columns == df.columns
    assert sorted(r.k for r in side(spark, split, True).collect()) == [1, 2]
    assert side(spark, split, False).unionByName(side(spark, split, True)).exceptAll(df).count() == 0
    again = write_split(df.where("k > 5"), F.lit(False), f"{tmp_dir}/s")                 # replaces the cut-off attempt
    assert side(spark, again, True).count() == 0 and side(spark, again, False).count() == 194
    assert not take_side(spark, again, True, f"{tmp_dir}/none") and take_side(spark, again, False, f"{tmp_dir}/kept")
    assert spark.read.parquet(f"{tmp_dir}/kept").count() == 194
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


@pytest.mark.parametrize("broken", [0, 3, 200])
def test_quarantine_reads_the_source_once(spark, tmp_dir, broken):
    target = f"{tmp_dir}/target"
    first_load(spark, tmp_dir, target)
    source, read = counting(spark, data(spark, broken))
    report = run_load(spark, JobSpec(**SPEC), f"{tmp_dir}/c", target=target, source=source, quarantine_target=f"{tmp_dir}/q").first()
    assert read.value == 200
    assert (report.rows_in, report.rows_written, report.rows_rejected) == (200, 200 - broken, broken)
    assert spark.read.parquet(target).count() == 400 - broken
    assert spark.read.parquet(target).columns == ["k", "n", "t"]
    if broken:
        bad = spark.read.parquet(f"{tmp_dir}/q")
        assert sorted(r.k for r in bad.collect()) == list(range(broken))
        assert {r._violations for r in bad.collect()} == {"n:null"}
    assert not [p for p in os.listdir(tmp_dir) if "__" in p]


def test_types_that_need_coercion(spark, tmp_dir):
    target = f"{tmp_dir}/target"
    first_load(spark, tmp_dir, target)
    texts = data(spark, 0).withColumn("n", F.when(F.col("k") % 50 == 0, "x").otherwise(F.col("n").cast("string")))
    source, read = counting(spark, texts)
    report = run_load(spark, JobSpec(**SPEC), f"{tmp_dir}/c", target=target, source=source, quarantine_target=f"{tmp_dir}/q").first()
    assert read.value == 200 and (report.rows_written, report.rows_rejected) == (196, 4)
    rows = spark.read.parquet(target)
    assert rows.schema["n"].dataType.simpleString() == "int" and rows.count() == 396
    bad = spark.read.parquet(f"{tmp_dir}/q").collect()
    assert {(r.n, r._violations) for r in bad} == {("x", "n:type")}


def test_replace_by_a_load_without_good_rows(spark, tmp_dir):
    target = f"{tmp_dir}/target"
    first_load(spark, tmp_dir, target)
    spec = JobSpec(**{**SPEC, "if_table_exists": "replace"})
    run_load(spark, spec, f"{tmp_dir}/c", target=target, source=data(spark, 200), quarantine_target=f"{tmp_dir}/q")
    assert spark.read.parquet(target).count() == 0 and spark.read.parquet(target).columns == ["k", "n", "t"]
    run_load(spark, spec, f"{tmp_dir}/c", target=target, source=data(spark, 0).limit(0), quarantine_target=f"{tmp_dir}/q")
    assert spark.read.parquet(target).count() == 0


def test_catalog_target(spark, tmp_dir):
    spark.sql("DROP TABLE IF EXISTS split_target")
    spec = JobSpec(**SPEC)
    run_load(spark, spec, f"{tmp_dir}/c", target="split_target", source=data(spark, 0), quarantine_target=f"{tmp_dir}/q")
    source, read = counting(spark, data(spark))
    report = run_load(spark, spec, f"{tmp_dir}/c", target="split_target", source=source, quarantine_target=f"{tmp_dir}/q").first()
    assert read.value == 200 and report.rows_rejected == 3 and spark.table("split_target").count() == 397
    spark.sql("DROP TABLE split_target")


def test_staged_batches_split_once(spark, tmp_dir):
    data(spark, 0).write.parquet(f"{tmp_dir}/first")
    data(spark, 5).write.parquet(f"{tmp_dir}/second")
    target = f"{tmp_dir}/target"
    staged_load(spark, JobSpec(input_path=f"{tmp_dir}/first", **SPEC), f"{tmp_dir}/c", target, quarantine_target=f"{tmp_dir}/q")
    report = staged_load(spark, JobSpec(input_path=f"{tmp_dir}/second", **SPEC), f"{tmp_dir}/c", target, 0.4, quarantine_target=f"{tmp_dir}/q")
    assert (report["rows_in"], report["rows_written"], report["rows_rejected"]) == (200, 195, 5) and report["batches"] > 1
    assert spark.read.parquet(target).count() == 395 and spark.read.parquet(f"{tmp_dir}/q").count() == 5
    assert not [p for p in os.listdir(tmp_dir) if "__" in p]
