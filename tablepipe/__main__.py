"""Command line: ``python -m tablepipe <command> ...`` (or under spark-submit).

    load CONFIG [--contracts DIR] [--target T] [--quarantine DIR] [--on-violation M] [--budget BYTES]
    check CONFIG --contracts DIR      (dry run: findings only, exit 1 when blocking)
    sql  "SELECT ..." --table name=path [--table ...] [--rows N]
    plan --budget BYTES name=path [name=path ...]

CONFIG is YAML (when PyYAML is importable), JSON or TOML in the nested layout
of ``JobSpec.from_config``.  Output is bounded: the one-row load report, at
most N query rows, one plan row per input.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def read_config(path: str) -> dict:
    text = open(path, "rb").read()
    if path.endswith((".yml", ".yaml")):
        try:
            import yaml
        except ImportError as e:  # pragma: no cover
            raise SystemExit("YAML configs need PyYAML; use JSON or TOML") from e
        return yaml.safe_load(text) or {}
    if path.endswith(".toml"):
        import tomllib
        return tomllib.loads(text.decode())
    return json.loads(text)


def _pairs(items):
    out = {}
    for item in items:
        name, _, path = item.partition("=")
        out[name] = path
    return out


def main(argv=None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="tablepipe")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_load = sub.add_parser("load")
    p_load.add_argument("config")
    p_load.add_argument("--contracts", default=None)
    p_load.add_argument("--target", default=None)
    p_load.add_argument("--quarantine", default=None)
    p_load.add_argument("--on-violation", default=None, choices=["fail", "report", "quarantine"])
    p_load.add_argument("--budget", type=float, default=None,
                        help="memory budget in bytes: size the input first and stream it when too big")
    p_check = sub.add_parser("check")
    p_check.add_argument("config")
    p_check.add_argument("--contracts", required=True)
    p_sql = sub.add_parser("sql")
    p_sql.add_argument("query")
    p_sql.add_argument("--table", action="append", default=[])
    p_sql.add_argument("--rows", type=int, default=20)
    p_plan = sub.add_parser("plan")
    p_plan.add_argument("--budget", type=float, required=True)
    p_plan.add_argument("inputs", nargs="+")
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName("tablepipe").getOrCreate()
    if args.cmd == "load":
        from .plans.load import run_load
        from .session import scratch_path
        from .spec import JobSpec
        spec = JobSpec.from_config(read_config(args.config))
        if args.on_violation:
            spec.on_violation = args.on_violation
        contracts = args.contracts or scratch_path(spark, "contracts")
        if args.budget is not None:
            from .plans.load import orchestrate
            print(json.dumps(orchestrate(spark, spec, contracts, args.budget, target=args.target,
                                         quarantine_target=args.quarantine), default=str))
        else:
            report = run_load(spark, spec, contracts, target=args.target, quarantine_target=args.quarantine)
            for row in report.collect():
                print(json.dumps(row.asDict(), default=str))
    elif args.cmd == "check":
        from .operators.clean import clean_with, date_columns_from_contract
        from .operators.contract import check_contract
        from .plans.load import stored_contract_rows
        from .sources.files import read_table
        from .spec import JobSpec
        spec = JobSpec.from_config(read_config(args.config))
        rows = stored_contract_rows(spark, args.contracts, spec.target)
        if not rows:
            print(json.dumps({"table_name": spec.target, "finding": "no_contract_yet"}))
            return 0
        raw = read_table(spark, spec.input_path, spec.input_format)
        dates = None
        if spec.date_format and spec.date_columns is None:
            dates = date_columns_from_contract(raw, spec, {r["name"]: r["value"] for r in rows if r["kind"] == "column"})
        report = check_contract(clean_with(raw, spec, dates), rows, spec.target, spec.settings())
        found = report.collect()                      # one row per finding
        for row in found:
            print(json.dumps(row.asDict(), default=str))
        return 1 if any(r["blocking"] for r in found) else 0
    elif args.cmd == "sql":
        from .plans.query import register_tables, run_sql
        register_tables(spark, _pairs(args.table))
        run_sql(spark, args.query).show(args.rows, truncate=False)
    elif args.cmd == "plan":
        from .operators.profile import load_plan
        for row in load_plan(spark, _pairs(args.inputs), args.budget).collect():
            print(json.dumps(row.asDict(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
