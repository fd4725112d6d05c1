"""Staged loads and the ledger: resumed runs, failed runs, commits cut short,
files loaded once."""

import os

import pytest
from pyspark.sql import functions as F

from tablepipe.operators.contract import ContractViolation, load_contracts
from tablepipe.plans import staged
from tablepipe.plans.load import run_load
from tablepipe.plans.staged import batch_list, staged_load
from tablepipe.sinks import TargetExists
from tablepipe.sources.ledger import listed_files, new_files, read_ledger, record_load
from tablepipe.spec import JobSpec


class Cut(Exception):
    pass


@pytest.fixture
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")


@pytest.fixture
def files(orders, tmp_dir):
    orders.repartition(5).write.parquet(f"{tmp_dir}/files")
    return f"{tmp_dir}/files"


def spec_of(files, **settings):
    return JobSpec(input_path=files, input_format="parquet", table_name="orders", **settings)


def leftovers(tmp_dir):
    return [p for p in os.listdir(tmp_dir) if "__" in p]


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_batches_by_bytes(spark, files):
    found = listed_files(spark, files)
    assert found.count() == 5 and {r.batch for r in batch_list(found, 1.0).collect()} == {0}
    rows = sorted(batch_list(found, 0.4).collect(), key=lambda r: r.path)
    assert [r.batch for r in rows] == sorted(r.batch for r in rows) and 2 <= len({r.batch for r in rows}) <= 3
    assert len({r.batch for r in batch_list(found, 0.01).collect()}) == 5
    assert batch_list(found.limit(0), 0.4).count() == 0


def test_cut_and_resumed(spark, orders, files, tmp_dir):
    target, contracts = f"{tmp_dir}/t", f"{tmp_dir}/c"

    def cut(batch):
        if batch >= 2:
            raise Cut

    with pytest.raises(Cut):
        staged_load(spark, spec_of(files), contracts, target, 0.1, ledger=f"{tmp_dir}/l", on_batch=cut)
    assert not os.path.exists(target) and not os.path.exists(contracts) and not os.path.exists(f"{tmp_dir}/l")
    staging = f"{target}.__load"
    before = {p: os.stat(f"{staging}/rows/0/{p}").st_mtime_ns for p in os.listdir(f"{staging}/rows/0")}
    done = len(os.listdir(f"{staging}/done"))
    again = []

    def watch(batch):
        again.append(batch)
        assert {p: os.stat(f"{staging}/rows/0/{p}").st_mtime_ns for p in os.listdir(f"{staging}/rows/0")} == before

    report = staged_load(spark, spec_of(files), contracts, target, 0.1, ledger=f"{tmp_dir}/l", on_batch=watch)
    assert report["resumed"] and report["batches"] == len(again) and min(again) > 2 and done >= 3
    assert report["rows_written"] == orders.count() and same_rows(spark.read.parquet(target), orders)
    assert read_ledger(spark, f"{tmp_dir}/l").count() == 5 and not leftovers(tmp_dir)


def test_contract_and_rows_equal_one_batch(spark, orders, tmp_dir):
    # nulls in one file only, a text column that looks like dates until the last file
    odd = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 7, None).otherwise(F.col("o_totalprice")))
    odd = odd.withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")).withColumn("late", F.when(F.col("o_orderkey") == F.lit(orders.agg(F.max("o_orderkey")).first()[0]), "soon").otherwise(F.col("day")))
    odd.repartitionByRange(6, "o_orderkey").write.parquet(f"{tmp_dir}/f")
    frames, contracts = [], []
    for k, fraction in enumerate((1.0, 0.1)):
        report = staged_load(spark, spec_of(f"{tmp_dir}/f"), f"{tmp_dir}/c{k}", f"{tmp_dir}/t{k}", fraction)
        assert report["batches"] == (1 if fraction == 1.0 else 6)
        frames.append(spark.read.parquet(f"{tmp_dir}/t{k}"))
        contracts.append(sorted(tuple(r) for r in load_contracts(spark, f"{tmp_dir}/c{k}").collect()))
    run_load(spark, spec_of(f"{tmp_dir}/f"), f"{tmp_dir}/c2", target=f"{tmp_dir}/t2")
    contracts.append(sorted(tuple(r) for r in load_contracts(spark, f"{tmp_dir}/c2").collect()))
    frames.append(spark.read.parquet(f"{tmp_dir}/t2"))
    assert contracts[0] == contracts[1] == contracts[2]
    assert frames[0].schema == frames[1].schema == frames[2].schema and frames[0].schema["day"].dataType.simpleString() == "timestamp_ntz"
    assert frames[0].schema["late"].dataType.simpleString() == "string"
    assert same_rows(frames[0], frames[1]) and same_rows(frames[0], frames[2])


def test_failed_load_changes_nothing(spark, orders, files, tmp_dir):
    target, contracts, ledger = f"{tmp_dir}/t", f"{tmp_dir}/c", f"{tmp_dir}/l"
    append = spec_of(files, if_table_exists="append")
    staged_load(spark, append, contracts, target, 0.3, ledger)
    bad = orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, None).otherwise(F.col("o_totalprice")))
    bad.repartition(3).write.mode("append").parquet(files)
    with pytest.raises(ContractViolation):
        staged_load(spark, append, contracts, target, 0.3, ledger)
    assert same_rows(spark.read.parquet(target), orders) and read_ledger(spark, ledger).count() == 5 and not leftovers(tmp_dir)
    n_bad = bad.where("o_totalprice is null").count()
    report = staged_load(spark, spec_of(files, if_table_exists="append", on_violation="quarantine"), contracts, target, 0.3, ledger, f"{tmp_dir}/q", f"{tmp_dir}/findings")
    assert (report["rows_in"], report["rows_rejected"], report["findings"], report["blocking"]) == (orders.count(), n_bad, 1, 1)
    assert spark.read.parquet(target).count() == 2 * orders.count() - n_bad and spark.read.parquet(f"{tmp_dir}/q").count() == n_bad
    assert spark.read.parquet(f"{tmp_dir}/findings").first().bad_rows == n_bad
    assert read_ledger(spark, ledger).count() == 8
    with pytest.raises(TargetExists):
        staged_load(spark, spec_of(files), contracts, target, 0.3, ledger)


@pytest.mark.parametrize("mode", ["append", "replace"])
@pytest.mark.parametrize("place", ["save_contract", "record_load", "_delete"])
def test_commit_cut_short_is_finished(spark, orders, files, tmp_dir, monkeypatch, mode, place):
    target, contracts, ledger = f"{tmp_dir}/t", f"{tmp_dir}/c", f"{tmp_dir}/l"
    orders.limit(3).write.parquet(target)
    spec = spec_of(files, if_table_exists=mode, date_format=False)
    real, calls = getattr(staged, place), []

    def broken(*a, **k):
        if place != "_delete" or os.path.exists(f"{target}.__load/COMMIT"):
            calls.append(1)
            raise Cut
        return real(*a, **k)

    monkeypatch.setattr(staged, place, broken)
    with pytest.raises(Cut):
        staged_load(spark, spec, contracts, target, 0.3, ledger)
    monkeypatch.setattr(staged, place, real)
    report = staged_load(spark, spec, contracts, target, 0.3, ledger)
    assert calls and report["resumed"] and report["batches"] == 0 and report["rows_written"] == orders.count()
    assert spark.read.parquet(target).count() == orders.count() + (3 if mode == "append" else 0)
    assert load_contracts(spark, contracts).where("kind = 'column'").count() == 6
    assert read_ledger(spark, ledger).count() == 5 and not leftovers(tmp_dir)
    nothing = staged_load(spark, spec_of(files, if_table_exists="append", date_format=False), contracts, target, 0.3, ledger)
    assert nothing["rows_in"] == 0


def test_ledger_keys(spark, files, tmp_dir):
    ledger = f"{tmp_dir}/l"
    assert new_files(spark, files, ledger, f"{tmp_dir}/t").count() == 5
    record_load(listed_files(spark, files), ledger, f"{tmp_dir}/t", "one")
    record_load(listed_files(spark, files), ledger, f"{tmp_dir}/t", "one")      # a commit run twice
    assert read_ledger(spark, ledger).count() == 5
    assert new_files(spark, files, ledger, f"{tmp_dir}/t").count() == 0
    assert new_files(spark, files, ledger, f"{tmp_dir}/other").count() == 5
    record_load(listed_files(spark, files).limit(2), ledger, f"{tmp_dir}/t", "two", replaces=True)
    assert new_files(spark, files, ledger, f"{tmp_dir}/t").count() == 3
    name = next(p for p in os.listdir(files) if p.endswith(".parquet"))
    os.utime(f"{files}/{name}", (1, 1))                                         # a changed file is a new one
    record_load(listed_files(spark, files), ledger, f"{tmp_dir}/u", "three")
    os.utime(f"{files}/{name}", (2, 2))
    assert [os.path.basename(r.path) for r in new_files(spark, files, ledger, f"{tmp_dir}/u").collect()] == [name]


def test_catalog_target_and_csv(spark, orders, tmp_dir):
    orders.repartition(3).write.option("header", True).csv(f"{tmp_dir}/csv")
    spec = JobSpec(input_path=f"{tmp_dir}/csv", input_format="csv", table_name="staged_orders", if_table_exists="append",
                   data_type={"o_orderkey": "int64", "o_custkey": "int64", "o_totalprice": "float64"})
    try:
        for _ in range(2):
            staged_load(spark, spec, f"{tmp_dir}/c", fraction=0.4, ledger=f"{tmp_dir}/l")
        assert same_rows(spark.table("staged_orders"), orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")).select(spark.table("staged_orders").columns))
    finally:
        spark.sql("DROP TABLE IF EXISTS staged_orders")


def test_resumed_query_has_five_batches_when_files_come_in_parts(spark, tmp_dir, monkeypatch):
    from tablepipe.plans import catalog
    from tablepipe.streaming import incremental

    orders = spark.range(1, 3001).selectExpr("id as o_orderkey", "id % 50 as o_custkey", "'O' as o_orderstatus", "id / 7 as o_totalprice",
                                             "timestamp'1995-01-01 00:00:00' + make_dt_interval(int(id % 900)) as o_orderdate", "'1-URGENT' as o_orderpriority")
    orders.coalesce(1).write.parquet(f"{tmp_dir}/orders.parquet")
    monkeypatch.setattr(incremental, "PART_BYTES", 1500)
    got = catalog.staged_load_resumed(spark, tmp_dir).first()
    assert (got.batches, got.rows_in, got.in_target, got.in_quarantine) == (5, 3000, 2971, 29)
