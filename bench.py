"""Headline benchmark: prints ONE JSON line.

    BENCH_SF_DIR  (default /root/testdata/sf0.1)
    BENCH_CPUS    (default 8)

Every query is run to completion through the ``noop`` sink (all rows are
produced, none are collected), after one warm-up round of the same queries on
the smallest test scale (JIT / codegen warm-up, reported times are steady
state).  Besides the per-query seconds, the line
carries the load throughput the reference publishes: rows per second of
clean + contract check + write of lineitem.
"""

from __future__ import annotations

import json
import os
import sys
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tablepipe.plans import catalog  # noqa: E402
from tablepipe.plans.load import run_load  # noqa: E402
from tablepipe.session import local_session, scratch_path  # noqa: E402
from tablepipe.sources import write_csv  # noqa: E402
from tablepipe.spec import JobSpec  # noqa: E402

HEADLINE = [
    "q3_avg_by_segment", "clean_all", "cast_strict", "cast_safe_rejects", "date_parse",
    "round_floats", "contract_value_check", "contract_quarantine", "sample_keyed",
    "sample_head_ranged", "size_factors", "load_plan", "csv_roundtrip", "incremental_ingest",
    "sql_join_lineitem", "sql_window", "sql_asof", "sql_band_join", "sql_cube", "sql_subquery_cte",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def bench_load(spark, sf_dir: str, on_violation: str = "fail") -> tuple[float, int]:
    """First load captures the contract and writes; the second is checked
    against it and appended.  Returns (seconds of the checked load, rows).
    Both check inside the write job (one pass): ``fail`` writes to a staging
    folder and commits it when nothing blocks, ``report`` writes directly."""
    contracts = scratch_path(spark, "bench-contracts")
    target = scratch_path(spark, "bench-target")
    src = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    spec = JobSpec(table_name="lineitem", if_table_exists="replace", data_type={"l_quantity": "int32"},
                   decimal_precision=2, date_format=True)
    run_load(spark, spec, contracts, target=target, source=src).collect()
    spec2 = JobSpec(table_name="lineitem", if_table_exists="append", data_type={"l_quantity": "int32"},
                    decimal_precision=2, date_format=True, on_violation=on_violation)
    t0 = time.time()
    rep = run_load(spark, spec2, contracts, target=target, source=src).first()
    return time.time() - t0, int(rep["rows_written"])


LINEITEM_TYPES = {"l_orderkey": "int64", "l_partkey": "int64", "l_suppkey": "int64", "l_linenumber": "int32",
                  "l_quantity": "float64", "l_extendedprice": "float64", "l_discount": "float64",
                  "l_tax": "float64"}


def bench_csv_load(spark, sf_dir: str) -> tuple[float, int]:
    """The reference's CSV figure: a CSV file read as text, cleaned back to
    types (casts + date detection and parsing), contract captured, written.
    The CSV copy is made before the clock starts."""
    src = scratch_path(spark, "bench-csv")
    write_csv(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), src)
    spec = JobSpec(input_path=src, input_format="csv", table_name="lineitem_csv",
                   if_table_exists="replace", data_type=LINEITEM_TYPES, date_format=True)
    t0 = time.time()
    rep = run_load(spark, spec, scratch_path(spark, "bench-csv-contracts"),
                   target=scratch_path(spark, "bench-csv-target")).first()
    return time.time() - t0, int(rep["rows_written"])


def bench_multi_file_load(spark, sf_dir: str, copies: int = 8, files: int = 32) -> tuple[float, int]:
    """The layout a cluster reads: many files.  ``copies`` key-shifted copies
    of lineitem written by Spark as ``files`` files (setup, untimed), then a
    checked load (fail mode: staged write with the check in it) of all of them."""
    base = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    shifted = [base.withColumn("l_orderkey", F.col("l_orderkey") + F.lit(i * 10_000_000_000))
               for i in range(copies)]
    path = scratch_path(spark, "bench-multi")
    reduce(DataFrame.unionByName, shifted).repartition(files).write.parquet(path)
    src = spark.read.parquet(path)
    contracts, target = scratch_path(spark, "bench-multi-contracts"), scratch_path(spark, "bench-multi-target")
    spec = JobSpec(table_name="lineitem", if_table_exists="replace", data_type={"l_quantity": "int32"},
                   decimal_precision=2)
    run_load(spark, spec, contracts, target=target, source=src).collect()      # first load: contract
    t0 = time.time()
    rep = run_load(spark, spec, contracts, target=target, source=src).first()
    return time.time() - t0, int(rep["rows_written"])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * cpus), app="tablepipe-bench")
    sf = sf_dir.rsplit("sf", 1)[-1]
    qs = catalog.QUERIES
    # Warm-up round on the smallest scale factor present: JVM start, JIT and
    # codegen caches are paid once per query shape, not per data size.
    warm_dir = next((d for d in ("/root/testdata/sf0.001", "/root/testdata/sf0.01")
                     if os.path.isdir(d) and d != sf_dir), None)
    if warm_dir:
        for name in HEADLINE:
            run_noop(qs[name](spark, warm_dir))
        bench_load(spark, warm_dir)
        bench_load(spark, warm_dir, "report")
        bench_csv_load(spark, warm_dir)
        bench_multi_file_load(spark, warm_dir, copies=2, files=4)
    run_noop(spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        """Run one step; a failure is recorded, not fatal (the line is always printed)."""
        t0 = time.time()
        try:
            out = fn()
            times[name] = round(time.time() - t0, 3)
            return out
        except Exception as e:  # pragma: no cover - reported in the JSON line
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
            return None

    for name in HEADLINE:
        timed(name, lambda: run_noop(qs[name](spark, sf_dir)))

    def load_figure(name, fn):
        res = timed(name, fn)
        if res is None:
            return None, 0
        seconds, rows = res
        times[name] = round(seconds, 3)
        return seconds, rows

    load_s, load_rows = load_figure("load_lineitem", lambda: bench_load(spark, sf_dir))
    load1_s, _ = load_figure("load_lineitem_one_pass", lambda: bench_load(spark, sf_dir, "report"))
    csv_s, csv_rows = load_figure("load_lineitem_csv", lambda: bench_csv_load(spark, sf_dir))
    multi_s, multi_rows = load_figure("load_lineitem_8x_32_files", lambda: bench_multi_file_load(spark, sf_dir))
    total = round(sum(v for v in times.values() if v is not None), 3)

    def rate(rows, seconds):
        return round(rows / seconds, 1) if seconds else None
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "load_rows": load_rows,
        "load_rows_per_sec": rate(load_rows, load_s),
        "load_rows_per_sec_one_pass": rate(load_rows, load1_s),
        "csv_load_rows_per_sec": rate(csv_rows, csv_s),
        "multi_file_load_rows": multi_rows,
        "multi_file_load_rows_per_sec": rate(multi_rows, multi_s),
        "errors": errors,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
