"""Size profile edges and exactness."""

import datetime as dt
import decimal
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablepipe.operators.profile import (ROWS_MARK, decide, footer_totals, parquet_footers,
                                         size_factors, string_length_stats)


def test_exact_median_and_mean(spark):
    rnd = random.Random(5)
    vals = ["x" * rnd.randint(0, 40) for _ in range(1001)] + [None] * 7
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    for data in (vals, vals[:-8]):  # odd and even counts of non-null values
        d = spark.createDataFrame([(v,) for v in data], "s string")
        st = {r.column_name: r for r in string_length_stats({"t": d}).collect()}
        lens = sorted(len(v) for v in data if v is not None)
        n = len(lens)
        med = (lens[(n - 1) // 2] + lens[n // 2]) / 2
        assert st["s"].median_len == med
        assert st["s"].avg_len == pytest.approx(sum(lens) / n)
        assert st["s"].n_values == n
        assert st[ROWS_MARK].n_values == len(data)
    assert df.count() == 1008


def test_no_strings_no_rows_no_division_by_zero(spark):
    nums = spark.createDataFrame([(1, 2.0)], "a int, b double")
    empty = spark.createDataFrame([], "s string, n bigint")
    nothing = spark.range(3).select()
    f = {r.table_name: r for r in size_factors(spark, {"nums": nums, "empty": empty, "none": nothing}).collect()}
    assert f["nums"].text_string_factor == 1.0 and f["nums"].string_width == 32.0
    assert f["nums"].parquet_string_factor == 1.0
    assert f["nums"].text_type_factor == pytest.approx((1.5 + 1.65) / 2)
    assert f["empty"].n_rows == 0 and f["empty"].text_string_factor == 1.0
    assert f["none"].n_cols == 0 and f["none"].text_type_factor == 1.0 and f["none"].row_bytes == 0.0


def test_all_types(spark):
    schema = ("b tinyint, s smallint, i int, l bigint, f float, d double, o boolean, dt date, "
              "ts timestamp_ntz, a array<int>, st struct<x:int>, dec decimal(10,2), m map<string,int>, t string")
    row = (1, 2, 3, 4, 1.0, 2.0, True, dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), [1], (1,),
           decimal.Decimal("1.00"), {"k": 1}, "abcdef")
    f = size_factors(spark, {"t": spark.createDataFrame([row], schema)}).first()
    n = 14
    p2 = 1.6                   # median length 6 -> (5, 10]
    text = [1.4, 1.45, 1.5, 1.55, 1.6, 1.65, 2.5, 1.8, 1.85, 2.5, 2.8, 1.7, 1.7, p2]
    assert f.text_type_factor == pytest.approx(sum(text) / n)
    p4 = 32.0
    sized = [1, 2, 4, 8, 4, 8, 1, 4, 8]
    p5 = (sum(sized) + p4 + 4 * 16) / n      # array, struct, decimal, map are "other"
    assert f.mean_value_bytes == pytest.approx(p5)
    assert f.row_bytes == pytest.approx(sum(sized) + p4 + 4 * p5)
    a = 6.0
    p7 = 1 + 4 / a + 0.2
    pq8 = [1.2, 1.25, 1.3, 1.35, 1.4, 1.45, 2.0, 1.5, 1.55, 2.2, 2.5, 1.7, 1.7, p7]
    p8 = sum(pq8) / n
    assert f.parquet_type_factor == pytest.approx(p8)
    pq9 = [1.3, 1.3, 1.3, 1.3, 1.4, 1.4, 2.0, 1.5, 1.5, 2.2, p8, p8, p8, p7]
    assert f.parquet_coarse_factor == pytest.approx(sum(pq9) / n)


@pytest.mark.parametrize("ratio,decision,fraction", [
    (0.5, "eager", 0.70), (0.65, "eager", 0.40), (0.6500001, "lazy", 0.40),
    (2.0, "lazy", 0.40), (2.0000001, "streaming", 0.25), (5.0, "streaming", 0.25),
    (5.0000001, "streaming", 0.15), (0.5000001, "eager", 0.40)])
def test_ratio_edges(spark, ratio, decision, fraction):
    df = spark.createDataFrame([(ratio * 1000.0, 50000)], "estimated_bytes double, n_rows bigint")
    r = decide(df, 1000.0).first()
    assert (r.decision, r.chunk_fraction) == (decision, fraction)
    assert r.load_mode == ("incremental" if decision == "streaming" else "batch")
    assert r.chunk_rows == max(int(50000 * fraction), 10000)


def test_chunk_rows_capped_by_rows(spark):
    df = spark.createDataFrame([(10.0, 500)], "estimated_bytes double, n_rows bigint")
    assert decide(df, 1000.0).first().chunk_rows == 500


def test_footers_match_pyarrow(spark):
    path = "/root/testdata/sf0.001/orders.parquet"
    md = pq.ParquetFile(path).metadata
    unc = sum(md.row_group(g).column(c).total_uncompressed_size
              for g in range(md.num_row_groups) for c in range(md.num_columns))
    r = parquet_footers(spark, path).first()
    assert (r.num_rows, r.uncompressed_bytes) == (md.num_rows, unc)
    t = footer_totals(spark, {"orders": path}).first()
    assert t.files == 1 and t.uncompressed_bytes == unc


def test_footer_scan_does_not_read_content(spark):
    files = spark.read.format("binaryFile").load("/root/testdata/sf0.001/orders.parquet").select("path", "length")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[1]
    _ = F


def test_load_plan_csv_and_sampled(spark, tmp_dir):
    from tablepipe.operators.profile import load_plan
    from tablepipe.sources import write_csv
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    write_csv(orders, f"{tmp_dir}/orders_csv")
    inputs = {"o_csv": f"{tmp_dir}/orders_csv", "o_pq": "/root/testdata/sf0.001/orders.parquet"}
    plan = {r.table_name: r for r in load_plan(spark, inputs, 1e6, formats={"o_csv": "csv"}).collect()}
    assert plan["o_csv"].format == "csv" and plan["o_csv"].n_rows == 1500
    # numbers and the timestamp inferred (keys as int), only the 2 texts sized as strings:
    # (int 1.5 * 2 + double 1.65 + timestamp 1.85 + 2 * P2) / 6, P2 = 1.8 (median lengths 1 and 8)
    assert plan["o_csv"].text_type_factor == pytest.approx((1.5 * 2 + 1.65 + 1.85 + 2 * 1.8) / 6)
    assert plan["o_pq"].text_type_factor == pytest.approx((1.55 * 2 + 1.65 + 1.85 + 2 * 1.8) / 6)
    assert plan["o_csv"].uncompressed_bytes is None and plan["o_csv"].file_bytes > 0
    sampled = {r.table_name: r for r in load_plan(spark, inputs, 1e6, formats={"o_csv": "csv"},
                                                  sample_fraction=0.5).collect()}
    assert sampled["o_pq"].n_rows == 1500                      # exact from the footers
    assert abs(sampled["o_csv"].n_rows - 1500) < 300           # scaled from the sample
