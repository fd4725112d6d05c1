"""Contract capture, drift, value checks, quarantine, settings."""

import pytest
from pyspark.sql import functions as F

from tablepipe.operators.contract import (ContractViolation, capture_contract, catalog_schema_drift,
                                          check_contract, enforce, ensure_contract, observed_schema,
                                          settings_drift, settings_rows, split_by_contract)
from tablepipe.spec import JobSpec

BASE_SCHEMA = "id bigint, name string, qty int, price double"


def _base(spark):
    return spark.createDataFrame([(i, f"n{i}", i % 7, i * 1.5) for i in range(50)], BASE_SCHEMA)


def _findings(report):
    return {(r["column_name"], r["finding"]): (r["bad_rows"], r["blocking"]) for r in report.collect()}


def test_capture_then_check_same_table_is_clean(spark):
    df = _base(spark)
    c = capture_contract(df, "t")
    assert check_contract(df, c, "t").count() == 0
    rows = {r["name"]: r for r in c.collect()}
    assert rows["qty"]["value"] == "int" and rows["qty"]["nullable"] is False


def test_drift_cases(spark):
    df = _base(spark)
    c = capture_contract(df, "t")
    assert _findings(check_contract(df.drop("qty"), c, "t")) == {("qty", "missing_column"): (50, True)}
    assert _findings(check_contract(df.withColumn("x", F.lit(1)), c, "t")) == {
        ("x", "unexpected_column"): (50, True)}
    assert check_contract(df.select("price", "qty", "name", "id"), c, "t").count() == 0   # order ignored
    as_text = df.withColumn("qty", F.col("qty").cast("string"))
    assert _findings(check_contract(as_text, c, "t")) == {("qty", "type_changed"): (0, False)}
    wider = df.withColumn("qty", F.col("qty").cast("bigint"))
    assert _findings(check_contract(wider, c, "t")) == {("qty", "type_changed"): (0, False)}
    bad_text = as_text.withColumn("qty", F.when(F.col("id") < 3, "x").otherwise(F.col("qty")))
    assert _findings(check_contract(bad_text, c, "t")) == {("qty", "type_changed"): (3, True)}
    nulls = df.withColumn("price", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("price")))
    assert _findings(check_contract(nulls, c, "t")) == {("price", "null_values"): (5, True)}


def test_nullable_captured_from_first_load(spark):
    df = _base(spark).withColumn("price", F.when(F.col("id") == 1, None).otherwise(F.col("price")))
    c = capture_contract(df, "t")
    more_nulls = df.withColumn("price", F.when(F.col("id") < 10, None).otherwise(F.col("price")))
    assert check_contract(more_nulls, c, "t").count() == 0


def test_quarantine_adds_up(spark):
    df = _base(spark)
    c = capture_contract(df, "t")
    drift = (df.withColumn("qty", F.when(F.col("id") % 4 == 0, "bad").otherwise(F.col("qty").cast("string")))
               .withColumn("price", F.when(F.col("id") % 5 == 0, None).otherwise(F.col("price"))))
    good, bad = split_by_contract(drift, c, "t")
    assert good.count() + bad.count() == drift.count()
    assert good.schema == df.schema.__class__([f for f in df.schema.fields]) or \
        [f.dataType for f in good.schema.fields] == [f.dataType for f in df.schema.fields]
    reasons = {r["id"]: r["_violations"] for r in bad.collect()}
    assert reasons[0] == "qty:type,price:null"
    assert reasons[4] == "qty:type" and reasons[5] == "price:null"


def test_enforce_modes(spark):
    df = _base(spark)
    c = capture_contract(df, "t")
    with pytest.raises(ContractViolation):
        enforce(df.drop("name"), c, "t", "fail")
    same, report = enforce(df.drop("name"), c, "t", "report")
    assert report.count() == 1
    good, bad, _ = enforce(df.drop("name"), c, "t", "quarantine")
    assert bad.count() == 50 and good.count() == 0


def test_settings_drift_each_setting(spark):
    first = JobSpec(column_naming="lower", date_format=True, data_type={}, decimal_precision=2)
    contract = settings_rows(spark, "t", first.settings())
    assert settings_drift(contract, settings_rows(spark, "t", first.settings())).count() == 0
    changes = [JobSpec(column_naming="upper", decimal_precision=2),
               JobSpec(date_format=False, decimal_precision=2),
               JobSpec(data_type={"a": "int8"}, decimal_precision=2),
               JobSpec(decimal_precision=3)]
    seen = set()
    for spec in changes:
        d = settings_drift(contract, settings_rows(spark, "t", spec.settings())).collect()
        assert len(d) == 1
        seen.add(d[0]["column_name"])
    assert seen == {"column_naming", "date_format", "data_type", "decimal_precision"}
    both = JobSpec(column_naming="upper", decimal_precision=3)
    assert settings_drift(contract, settings_rows(spark, "t", both.settings())).count() == 2


def test_check_reports_setting_changes(spark):
    df = _base(spark)
    c = capture_contract(df, "t", settings=JobSpec().settings())
    rep = check_contract(df, c, "t", settings=JobSpec(column_naming="upper").settings())
    assert _findings(rep) == {("column_naming", "setting_changed"): (50, True)}


def test_catalog_drift_and_versions(spark, tmp_dir):
    a, b = _base(spark), spark.createDataFrame([(1, "x")], "k int, v string")
    contracts = capture_contract(a, "a").unionByName(capture_contract(b, "b"))
    observed = observed_schema(spark, "a", a.drop("qty").schema).unionByName(
        observed_schema(spark, "b", b.withColumn("k", F.col("k").cast("string")).schema))
    got = {(r["table_name"], r["column_name"], r["finding"]) for r in catalog_schema_drift(contracts, observed).collect()}
    assert got == {("a", "qty", "missing_column"), ("b", "k", "type_changed")}
    # newer versions win
    v2 = capture_contract(a.drop("qty"), "a", version=2)
    got2 = catalog_schema_drift(contracts.unionByName(v2), observed).collect()
    assert {(r["table_name"], r["finding"]) for r in got2} == {("b", "type_changed")}


def test_ensure_contract_first_load_then_reuse(spark, tmp_dir):
    loc = f"{tmp_dir}/contracts"
    df = _base(spark)
    c1, created1 = ensure_contract(df, loc, "t")
    c2, created2 = ensure_contract(df.drop("qty"), loc, "t")
    assert created1 and not created2
    assert c2.where("kind = 'column'").count() == 4


def test_uncastable_type_change(spark):
    df = _base(spark)
    c = capture_contract(df, "t")
    arr = df.withColumn("qty", F.when(F.col("id") < 5, F.array(F.col("qty"))))
    assert _findings(check_contract(arr, c, "t")) == {("qty", "type_changed"): (5, True),
                                                      ("qty", "null_values"): (45, True)}
    good, bad = split_by_contract(arr, c, "t")
    assert good.count() == 0 and bad.count() == 50


def test_evolve_contract(spark, tmp_dir):
    from tablepipe.operators.contract import evolve_contract, load_contracts, latest
    loc = f"{tmp_dir}/contracts"
    df = _base(spark)
    ensure_contract(df, loc, "t")
    wider = df.withColumn("extra", F.lit("x"))
    assert check_contract(wider, latest(load_contracts(spark, loc), "t"), "t").count() == 1
    assert evolve_contract(wider, loc, "t") == 2
    assert check_contract(wider, latest(load_contracts(spark, loc), "t"), "t").count() == 0
