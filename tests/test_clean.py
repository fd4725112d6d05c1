"""Rename, casts, dates, rounding, the composed clean step."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe.functions.exprs import try_cast
from tablepipe.functions.naming import rename_map, target_name
from tablepipe.operators import (cast_columns, cast_probe, clean, date_detection_report,
                                 detect_date_columns, rename_columns, round_floats, safe_cast,
                                 widen_date_columns)
from tablepipe.spec import JobSpec


def test_rename_rules(spark):
    df = spark.createDataFrame([(1, "a", 2)], ["Id", "FULL Name", "o_Key"])
    assert rename_columns(df, "lower").columns == ["id", "full name", "o_key"]
    assert rename_columns(df, "upper").columns == ["ID", "FULL NAME", "O_KEY"]
    # capitalize is str.capitalize: the rest is lower case, not initcap
    assert rename_columns(df, "capitalize").columns == ["Id", "Full name", "O_key"]


def test_rename_refuses_collisions(spark):
    with pytest.raises(ValueError):
        rename_map(["A", "a"], "lower")
    df = spark.createDataFrame([(1, 2)], ["x", "y"])
    with pytest.raises(ValueError):
        rename_columns(df, "title")


def test_cast_map_accepts_both_spellings(spark):
    df = spark.createDataFrame([(1, 2)], ["O_CUSTKEY", "b"])
    a = clean(df, column_naming="lower", data_type={"O_CUSTKEY": "int32"}, date_format=False)
    b = clean(df, column_naming="lower", data_type={"o_custkey": "INT32"}, date_format=False)
    assert a.schema["o_custkey"].dataType == T.IntegerType()
    assert b.schema["o_custkey"].dataType == T.IntegerType()
    with pytest.raises(ValueError):
        cast_columns(df, {"nope": "int8"})
    with pytest.raises(ValueError):
        cast_columns(df, {"b": "int128"})


def test_strict_cast_fails_on_overflow(spark):
    df = spark.createDataFrame([(300,)], "x bigint")
    with pytest.raises(Exception, match="cannot cast column 'x'"):
        cast_columns(df, {"x": "int8"}).collect()
    ok = cast_columns(spark.createDataFrame([(100,)], "x bigint"), {"x": "int8"})
    assert ok.collect()[0][0] == 100 and ok.schema["x"].dataType == T.ByteType()


def test_float32_overflow_is_a_failure(spark):
    df = spark.createDataFrame([(1e300,), (1.5,), (float("inf"),)], "x double")
    good, bad = safe_cast(df, {"x": "float32"})
    assert sorted(r[0] for r in good.collect()) == [1.5, float("inf")]
    assert [r[0] for r in bad.collect()] == [1e300]


def test_safe_cast_text_to_int64(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (" 7 ",), (None,), ("-3",)], "s string")
    good, bad = safe_cast(df, {"s": "int64"})
    assert sorted((r[0] for r in good.collect()), key=lambda v: (v is None, v)) == [-3, 7, None]
    assert sorted(r[0] for r in bad.collect()) == ["1.5", "x"]
    assert good.count() + bad.count() == df.count()


def test_cast_probe_counts_failures(spark):
    df = spark.createDataFrame([(300, "a"), (5, "7")], "n bigint, s string")
    rows = {r["column_name"]: r["failures"] for r in cast_probe(df, {"N": "int8", "s": "int32"}).collect()}
    assert rows == {"n": 1, "s": 1}


_TEXTS = st.one_of(
    st.text(alphabet=" \t\n+-.0123456789eEdDfFxXinfaINFA", max_size=12),
    st.integers(min_value=-(10 ** 20), max_value=10 ** 20).map(str),
    st.floats(allow_nan=True, allow_infinity=True).map(repr),
)


@settings(max_examples=40, deadline=None)
@given(values=st.lists(_TEXTS, min_size=1, max_size=30))
def test_fast_try_cast_matches_spark_on_text(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    for t in (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()):
        got = df.select(try_cast(F.col("s"), t, T.StringType()).alias("a"),
                        F.col("s").try_cast(t).alias("b")).collect()
        for r in got:
            assert (r.a == r.b) or (r.a != r.a and r.b != r.b), (t, r)


@settings(max_examples=30, deadline=None)
@given(values=st.lists(st.one_of(st.floats(allow_nan=True, allow_infinity=True),
                                 st.floats(min_value=-3e4, max_value=3e4)), min_size=1, max_size=30),
       big=st.lists(st.integers(min_value=-(2 ** 63), max_value=2 ** 63 - 1), min_size=1, max_size=20))
def test_fast_try_cast_matches_spark_on_numbers(spark, values, big):
    d = spark.createDataFrame([(v,) for v in values], "x double")
    n = spark.createDataFrame([(v,) for v in big], "x bigint")
    for df, src in ((d, T.DoubleType()), (n, T.LongType())):
        for t in (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()):
            got = df.select(try_cast(F.col("x"), t, src).alias("a"), F.col("x").try_cast(t).alias("b")).collect()
            for r in got:
                assert r.a == r.b, (src, t, r)


def _string_dates(spark):
    rows = [(i, f"2024-01-{i + 1:02d}", "2024", None, f"2023/02/{i + 1:02d}") for i in range(20)]
    rows[11] = (11, "not a date", "2024", None, "2023/02/12")
    return spark.createDataFrame(rows, "id int, d string, y string, empty string, slashed string")


def test_date_detection_whole_column(spark):
    df = _string_dates(spark)
    rep = {r["column_name"]: r for r in date_detection_report(df).collect()}
    assert rep["d"]["failures"] == 1 and not rep["d"]["is_date"]      # one bad value in row 11
    assert not rep["y"]["is_date"]                                     # a year alone is not a date
    assert rep["empty"]["non_null"] == 0 and not rep["empty"]["is_date"]
    assert rep["slashed"]["is_date"]
    assert detect_date_columns(df) == ["slashed"]
    out = clean(df, column_naming=None, date_format=True)
    assert out.schema["slashed"].dataType == T.TimestampNTZType()
    assert out.schema["d"].dataType == T.StringType()
    assert out.where("id = 1").first()["slashed"] == dt.datetime(2023, 2, 2)


def test_date_switch_off_leaves_text(spark):
    df = _string_dates(spark)
    out = clean(df, column_naming="lower", date_format=False)
    assert out.schema == df.schema


def test_widen_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 3, 1),)], "d date")
    out = widen_date_columns(df)
    assert out.schema["d"].dataType == T.TimestampNTZType()
    assert out.first()[0] == dt.datetime(2024, 3, 1)


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5, 1.0005, -2.5, 0.285, 2.675)], "a double, b double, c double, d double, e double")
    r = round_floats(df, 2).first()
    assert (r.a, r.c) == (2.5, -2.5)
    assert round_floats(df, 0).first().a == 3.0
    assert round_floats(df, 0).first().c == -3.0
    assert round_floats(df, 3).first().b == 1.001
    # binary value of 0.285 is below the tie, that of 2.675 rounds up when scaled
    assert (r.d, r.e) == (0.28, 2.68)


def test_clean_is_idempotent(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    txt = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    once = clean(txt, column_naming="upper", data_type={"o_custkey": "int32"}, decimal_precision=2)
    twice = clean(once, column_naming="upper", data_type={"o_custkey": "int32"}, decimal_precision=2)
    assert once.schema == twice.schema
    assert once.exceptAll(twice).count() == 0
    assert once.schema["O_ORDERDATE"].dataType == T.TimestampNTZType()


def test_clean_collapses_to_one_projection(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    out = clean(li, column_naming="upper", data_type={"l_quantity": "int32"}, date_format=False,
                decimal_precision=2).select("L_QUANTITY", "L_TAX").where("L_RETURNFLAG = 'R'")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the filter reaches the scan through the rename; only three columns are read
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in plan
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in plan
    assert plan.count("Project") == 1


def test_target_names():
    assert target_name("") == "new_table"
    assert target_name("", "/data/My-File 1.parquet") == "my_file1"
    assert target_name(" My-Table 1 ") == "my_table1"
    assert target_name("12abc") == "abc"
    assert target_name("1a1b") == "a1b"
    assert target_name("000") == "new_table"


def test_spec_validates():
    with pytest.raises(ValueError):
        JobSpec(column_naming="title")
    with pytest.raises(ValueError):
        JobSpec(data_type={"a": "int16"})
    with pytest.raises(ValueError):
        JobSpec(sample_size=0)
    with pytest.raises(ValueError):
        JobSpec(if_table_exists="truncate")
    s = JobSpec(data_type={"B": "INT8", "a": "utf8"}, decimal_precision=3)
    assert s.settings() == {"column_naming": "lower", "date_format": "true",
                            "data_type": "a:utf8,b:int8", "decimal_precision": "3"}
    # the documented but formerly refused name
    assert JobSpec(data_type={"x": "datetime"}).data_type == {"x": "datetime"}


def test_odd_column_names(spark):
    df = spark.createDataFrame([("2024-01-02", 1.234, "7")], ["a.b", "c d", "e`f"])
    out = clean(df, column_naming="upper", data_type={"e`f": "int8"}, decimal_precision=1)
    assert out.columns == ["A.B", "C D", "E`F"]
    r = out.first()
    assert (r[1], r[2]) == (1.2, 7)
    assert out.schema["A.B"].dataType == T.TimestampNTZType()


@settings(max_examples=10, deadline=None)
@given(decs=st.lists(st.decimals(min_value=-10 ** 7, max_value=10 ** 7, places=2, allow_nan=False),
                     min_size=1, max_size=20),
       floats=st.lists(st.floats(width=32, allow_nan=True, allow_infinity=True), min_size=1, max_size=20),
       ints=st.lists(st.integers(min_value=-(2 ** 31), max_value=2 ** 31 - 1), min_size=1, max_size=20),
       edges=st.sampled_from([127, 128, -128, -129, 127.99, 128.0, -128.99, -129.0, 32767.5, 32768.0]))
def test_fast_try_cast_matches_spark_other_sources(spark, decs, floats, ints, edges):
    frames = [
        (spark.createDataFrame([(d,) for d in decs] + [(None,)], "x decimal(12,2)"), T.DecimalType(12, 2)),
        (spark.createDataFrame([(f,) for f in floats] + [(float(edges),)], "x float"), T.FloatType()),
        (spark.createDataFrame([(i,) for i in ints] + [(int(edges),)], "x int"), T.IntegerType()),
        (spark.createDataFrame([(max(-32768, min(32767, int(edges))),), (-32768,), (32767,)], "x smallint"),
         T.ShortType()),
    ]
    for df, src in frames:
        for t in (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType()):
            got = df.select(try_cast(F.col("x"), t, src).alias("a"), F.col("x").try_cast(t).alias("b")).collect()
            for r in got:
                assert (r.a == r.b) or (r.a != r.a and r.b != r.b), (src, t, r)


def test_date_probe_then_whole_column(spark):
    from tablepipe.operators.dates import detect_date_columns
    rows = [(f"2024-01-{(i % 28) + 1:02d}", f"2023-05-{(i % 28) + 1:02d}", f"x{i}") for i in range(300)]
    rows[250] = ("2024-01-05", "late bad value", "x")          # fails only after the probe
    df = spark.createDataFrame(rows, "a string, b string, c string").coalesce(1)
    assert detect_date_columns(df, probe_rows=100) == ["a"]       # b caught by the full pass, c by the probe
    assert detect_date_columns(df, probe_rows=0) == ["a"]
