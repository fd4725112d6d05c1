"""Whole loads: first load captures the contract in the write job; later
loads by on_violation mode; the run report (M1)."""

import pytest
from pyspark.sql import functions as F

from tablepipe.operators.contract import ContractViolation, load_contracts
from tablepipe.plans.load import run_load
from tablepipe.sinks import TargetExists
from tablepipe.spec import JobSpec


@pytest.fixture
def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")


def _planted(orders):
    return orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") % 7 == 0, None)
                             .otherwise(F.col("o_totalprice")))


def test_first_load_then_modes(spark, orders, tmp_dir):
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    n = orders.count()
    first = run_load(spark, JobSpec(table_name="orders", if_table_exists="fail"), contracts,
                     target=target, source=orders).first()
    assert (first.rows_written, first.contract_created, first.findings) == (n, True, 0)
    stored = load_contracts(spark, contracts)
    assert stored.where("kind = 'column'").count() == 6 and stored.where("kind = 'setting'").count() == 4
    with pytest.raises(TargetExists):
        run_load(spark, JobSpec(table_name="orders", if_table_exists="fail"), contracts, target=target,
                 source=orders)
    bad = _planted(orders)
    n_bad = bad.where("o_totalprice IS NULL").count()
    with pytest.raises(ContractViolation):
        run_load(spark, JobSpec(table_name="orders", if_table_exists="append"), contracts,
                 target=target, source=bad)
    assert spark.read.parquet(target).count() == n               # nothing written on failure
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="append", on_violation="report"),
                   contracts, target=target, source=bad, findings_target=f"{tmp_dir}/findings").first()
    assert (rep.rows_written, rep.findings, rep.blocking) == (n, 1, 1)
    assert spark.read.parquet(f"{tmp_dir}/findings").first().bad_rows == n_bad
    q = run_load(spark, JobSpec(table_name="orders", if_table_exists="append", on_violation="quarantine"),
                 contracts, target=target, source=bad, quarantine_target=f"{tmp_dir}/quar").first()
    assert (q.rows_in, q.rows_written, q.rows_rejected) == (n, n - n_bad, n_bad)
    assert spark.read.parquet(f"{tmp_dir}/quar").count() == n_bad
    assert spark.read.parquet(target).count() == 3 * n - n_bad


def test_settings_change_blocks(spark, orders, tmp_dir):
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    run_load(spark, JobSpec(table_name="orders", if_table_exists="replace"), contracts, target=target,
             source=orders)
    with pytest.raises(ContractViolation, match="decimal_precision"):
        run_load(spark, JobSpec(table_name="orders", if_table_exists="replace", decimal_precision=2),
                 contracts, target=target, source=orders)


def test_sampled_validation(spark, orders, tmp_dir):
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    run_load(spark, JobSpec(table_name="orders", if_table_exists="replace"), contracts, target=target,
             source=orders)
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="replace", on_violation="report",
                                  sample_size=0.5, sample_keys=["o_orderkey"]),
                   contracts, target=target, source=_planted(orders)).first()
    assert rep.rows_written == orders.count() and rep.blocking == 1


def test_date_columns_fixed_by_first_load(spark, orders, tmp_dir):
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    text = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    run_load(spark, JobSpec(table_name="orders", if_table_exists="replace"), contracts, target=target,
             source=text)
    assert spark.read.parquet(target).schema["o_orderdate"].dataType.simpleString() == "timestamp_ntz"
    # a later load with one unparsable date keeps parsing the column (frozen) and reports it
    bad = text.withColumn("o_orderdate", F.when(F.col("o_orderkey") == 3, "soon").otherwise(F.col("o_orderdate")))
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="replace", on_violation="report"),
                   contracts, target=target, source=bad).first()
    assert rep.blocking == 1 and rep.rows_written == orders.count()
    out = spark.read.parquet(target)
    assert out.schema["o_orderdate"].dataType.simpleString() == "timestamp_ntz"
    assert out.where("o_orderdate IS NULL").count() == 1


def test_replace_reading_its_own_target(spark, orders, tmp_dir):
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    run_load(spark, JobSpec(table_name="orders", if_table_exists="replace"), contracts, target=target,
             source=orders)
    again = spark.read.parquet(target).where("o_orderstatus = 'F'")
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="replace", on_violation="report"),
                   contracts, target=target, source=again).first()
    assert spark.read.parquet(target).count() == rep.rows_written == orders.where("o_orderstatus = 'F'").count()


def test_orchestrate_batch_and_incremental(spark, orders, tmp_dir):
    from tablepipe.plans.load import orchestrate
    from tablepipe.streaming import read_ingested
    src = f"{tmp_dir}/orders_files"
    orders.repartition(5).write.parquet(src)
    spec = JobSpec(input_path=src, table_name="orders", if_table_exists="replace", on_violation="report")
    big = orchestrate(spark, spec, f"{tmp_dir}/c1", budget_bytes=1e12, target=f"{tmp_dir}/t1")
    assert big["path"] == "batch" and big["plan"]["decision"] == "eager"
    assert big["report"]["rows_written"] == orders.count()
    small = orchestrate(spark, spec, f"{tmp_dir}/c2", budget_bytes=100, target=f"{tmp_dir}/t2")
    assert small["path"] == "incremental" and small["plan"]["decision"] == "streaming"
    assert small["files_per_trigger"] == 1                 # ratio > 5: 15% of 5 files, at least 1
    assert small["progress"]["batches"] == 5 and small["progress"]["input_rows"] == orders.count()
    # the size decides how rows are gathered, not what is loaded or reported
    assert {k: v for k, v in small["report"].items() if k != "seconds"} == {k: v for k, v in big["report"].items() if k != "seconds"}
    one, two = spark.read.parquet(f"{tmp_dir}/t1"), spark.read.parquet(f"{tmp_dir}/t2")
    assert one.schema == two.schema and one.exceptAll(two).count() == 0 == two.exceptAll(one).count()


@pytest.mark.parametrize("budget", [1e15, 100])
def test_orchestrate_checks_settings_on_both_paths(spark, orders, tmp_dir, budget):
    from tablepipe.plans.load import orchestrate
    src = f"{tmp_dir}/files"
    orders.repartition(3).write.parquet(src)
    first = JobSpec(input_path=src, table_name="orders", if_table_exists="append")
    orchestrate(spark, first, f"{tmp_dir}/c", budget, target=f"{tmp_dir}/t")
    again = orchestrate(spark, first, f"{tmp_dir}/c", budget, target=f"{tmp_dir}/t")
    assert again["report"]["rows_written"] == 0                                # the ledger knows the files
    assert spark.read.parquet(f"{tmp_dir}/t").count() == orders.count()
    drifted = JobSpec(input_path=src, table_name="orders", if_table_exists="append", decimal_precision=1)
    before = spark.read.parquet(f"{tmp_dir}/t").count()
    with pytest.raises(ContractViolation):
        orchestrate(spark, drifted, f"{tmp_dir}/c", budget, target=f"{tmp_dir}/t")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == before
    with pytest.raises(ValueError, match="quarantine"):
        orchestrate(spark, JobSpec(input_path=src, table_name="orders", if_table_exists="append", on_violation="quarantine"),
                    f"{tmp_dir}/c", budget, target=f"{tmp_dir}/t")


def test_csv_settings_of_a_spec(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('a,b\n" x ",""\n"two\nlines",\n')
    spec = JobSpec(input_path=f"{tmp_dir}/a.csv", table_name="a", multiline=True, date_format=False)
    run_load(spark, spec, f"{tmp_dir}/c", target=f"{tmp_dir}/t")
    assert sorted((r.a, r.b) for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [(" x ", ""), ("two\nlines", None)]
    with open(f"{tmp_dir}/bad.csv", "w") as f:
        f.write("a,b\n1,2\n4,5,6\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        run_load(spark, JobSpec(input_path=f"{tmp_dir}/bad.csv", table_name="bad"), f"{tmp_dir}/c", target=f"{tmp_dir}/bad")


def test_staged_append_keeps_underscore_partitions(spark, orders, tmp_dir):
    from tablepipe.sinks.tables import commit_staged, stage
    df = orders.selectExpr("o_orderkey", "o_orderkey % 2 AS _day")
    df.write.partitionBy("_day").parquet(f"{tmp_dir}/t")
    commit_staged(spark, stage(df, f"{tmp_dir}/t", partition_by=["_day"]), f"{tmp_dir}/t", "append")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 2 * orders.count()


def test_fail_mode_is_one_staged_pass(spark, orders, tmp_dir):
    import os
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    spec = JobSpec(table_name="orders", if_table_exists="append")
    run_load(spark, spec, contracts, target=target, source=orders)
    n = orders.count()
    rep = run_load(spark, spec, contracts, target=target, source=orders).first()
    assert rep.rows_written == n and spark.read.parquet(target).count() == 2 * n
    with pytest.raises(ContractViolation):
        run_load(spark, spec, contracts, target=target, source=_planted(orders))
    assert spark.read.parquet(target).count() == 2 * n
    assert not [p for p in os.listdir(tmp_dir) if "__staging" in p or "__retired" in p]
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="replace"), contracts, target=target,
                   source=orders).first()
    assert rep.rows_written == n and spark.read.parquet(target).count() == n


def test_quarantine_clean_data_commits_staged(spark, orders, tmp_dir):
    import os
    contracts, target = f"{tmp_dir}/contracts", f"{tmp_dir}/orders"
    run_load(spark, JobSpec(table_name="orders", if_table_exists="append"), contracts, target=target, source=orders)
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="append", on_violation="quarantine"),
                   contracts, target=target, source=orders, quarantine_target=f"{tmp_dir}/q").first()
    assert (rep.rows_written, rep.rows_rejected, rep.blocking) == (orders.count(), 0, 0)
    assert spark.read.parquet(target).count() == 2 * orders.count()
    assert not os.path.exists(f"{tmp_dir}/q")
    assert not [p for p in os.listdir(tmp_dir) if "__staging" in p]


def test_first_load_dates_checked_in_the_write(spark, tmp_dir):
    import os
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    text = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).coalesce(1)
    good = run_load(spark, JobSpec(table_name="orders", if_table_exists="fail"), f"{tmp_dir}/c1",
                    target=f"{tmp_dir}/t1", source=text).first()
    out = spark.read.parquet(f"{tmp_dir}/t1")
    assert good.rows_written == 15000 and out.schema["o_orderdate"].dataType.simpleString() == "timestamp_ntz"
    # one bad value after the probe rows: the column is proven not a date and the load is rewritten
    late_bad = text.withColumn("o_orderdate", F.when(F.col("o_orderkey") == 14000, "soon")
                               .otherwise(F.col("o_orderdate")))
    rep = run_load(spark, JobSpec(table_name="orders", if_table_exists="fail"), f"{tmp_dir}/c2",
                   target=f"{tmp_dir}/t2", source=late_bad).first()
    out2 = spark.read.parquet(f"{tmp_dir}/t2")
    assert rep.rows_written == 15000 and out2.schema["o_orderdate"].dataType.simpleString() == "string"
    assert out2.where("o_orderdate = 'soon'").count() == 1
    assert not [p for p in os.listdir(tmp_dir) if "__staging" in p]
