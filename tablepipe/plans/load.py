"""A whole batch load: clean -> contract -> write -> run report (M1).

Passes over the source, beyond a probe of the first rows for date columns
(first load only: later loads take the date columns from the contract;
skipped when ``date_format`` is off or ``date_columns`` is given):

* first load: one — the write; the contract (null presence per column), the
  row count and, for a path target, the whole-column check of the probed date
  columns are ``Observation`` metrics of the (staged) write job; only when a
  probed column fails later is the load written again with the proven ones;
* ``report``: one — the check's aggregates ride along in the write job;
* ``fail``: one for path targets — the write goes to a staging folder with
  the check observed in the same job, and is committed by renames only when
  nothing blocks (else the staging folder is dropped); two for catalog
  tables or sampled checks (check first, then write);
* ``quarantine``: one — kept and rejected rows are written to staging by one
  job under a verdict partition, with the check observed in it, and committed
  apart (a sampled check reads the source once more).
"""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean, clean_with, date_columns_from_contract
from ..operators.dates import clean_dates, observe_date_check, probe_date_columns
from ..operators.rounding import round_floats
from ..operators.contract import CONTRACT_SCHEMA
from ..operators.contract import REPORT_SCHEMA as FINDINGS_SCHEMA
from ..operators.contract import _contract_rows
from ..operators.contract import (ContractViolation, check_contract, keeps_shape, load_contracts,
                                  observe_capture, observe_contract, row_checks, save_contract, split_by_contract)
from ..operators.sample import validation_rows
from ..session import scratch_path
from ..sinks.split import side, take_side, write_split
from ..sinks.tables import check_target, commit_staged, discard_staged, is_path, stage, write_table
from ..sources.files import read_table, table_format
from ..spec import JobSpec

REPORT_SCHEMA = ("table_name string, rows_in bigint, rows_written bigint, rows_rejected bigint, "
                 "findings bigint, blocking bigint, contract_created boolean, seconds double")


@contextmanager
def step(spark: SparkSession, text: str):
    """Label the jobs of one step (shown in event logs and the Spark UI)."""
    sc = spark.sparkContext
    before = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"tablepipe: {text}")
    try:
        yield
    finally:
        sc.setJobDescription(before)


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def stored_contract_rows(spark: SparkSession, location: str, table: str) -> list:
    """The latest contract rows of ``table`` (one per column / setting)."""
    stored = load_contracts(spark, location)
    return [] if stored is None else _contract_rows(stored, table)


def stored_contract(spark: SparkSession, location: str, table: str) -> DataFrame | None:
    """The latest contract of ``table`` pinned as a small frame; None if absent."""
    rows = stored_contract_rows(spark, location, table)
    return spark.createDataFrame(rows, CONTRACT_SCHEMA) if rows else None


def _write_split(spark: SparkSession, cleaned: DataFrame, contract, spec: JobSpec, target: str,
                 quarantine_target: str | None, finish=None) -> tuple[int, int, list]:
    """Quarantine: rows that keep the contract to the target, the others (as they
    came, with their violations) to the quarantine.  One job reads the source and
    writes both by one row predicate; the sides are then committed apart, the
    rejected one first.  ``finish`` gives the findings observed in that job; without
    a blocking one all rows are kept as they came.  Returns (written, rejected, findings)."""
    aside = target if is_path(target) else scratch_path(spark, "split")
    folder = f"{aside.rstrip('/')}.__split-{uuid.uuid4().hex[:12]}"
    _, _, reason = row_checks(cleaned, contract, spec.target)
    try:
        with step(spark, "write kept and rejected rows to staging (contract checked in the job)"):
            split = write_split(cleaned, reason != "", folder)
        found = finish().collect() if finish else []
        blocked = finish is None or any(r["blocking"] for r in found)
        if split.rejected:
            with step(spark, "write quarantine"):
                split_by_contract(side(spark, split, True), contract, spec.target)[1].write.mode("append").parquet(quarantine_target)
        as_staged = not blocked or keeps_shape(cleaned, contract, spec.target)
        kept = side(spark, split, False) if as_staged else split_by_contract(side(spark, split, False), contract, spec.target)[0]
        staging = f"{target.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
        if as_staged and is_path(target) and take_side(spark, split, False, staging):
            with step(spark, "commit staged files"):
                commit_staged(spark, staging, target, spec.if_table_exists)
        else:
            with step(spark, "write"):
                write_table(kept, target, spec.if_table_exists)
    finally:
        discard_staged(spark, folder)
    return split.rows - split.rejected, split.rejected, found


def read_source(spark: SparkSession, spec: JobSpec) -> DataFrame:
    """The spec's input, CSV with its settings."""
    csv = table_format(spec.input_path, spec.input_format) == "csv"
    return read_table(spark, spec.input_path, spec.input_format, **(spec.csv_options() if csv else {}))


def run_load(spark: SparkSession, spec: JobSpec, contract_location: str, target: str | None = None,
             source: DataFrame | None = None, quarantine_target: str | None = None,
             findings_target: str | None = None) -> DataFrame:
    """Load one table by its spec and return the run report (one row)."""
    t0 = time.time()
    target = target or spec.target
    check_target(spark, target, spec.if_table_exists)          # refuse early on 'fail'
    if spec.on_violation == "quarantine" and not quarantine_target:
        raise ValueError("on_violation 'quarantine' needs a quarantine target for the rejected rows")
    raw = source if source is not None else read_source(spark, spec)
    settings = spec.settings()
    with step(spark, "read contract"):
        rows = stored_contract_rows(spark, contract_location, spec.target)
    created = not rows
    contract = None if created else rows          # collected rows: the checks need no further job
    dates = spec.date_columns
    if not created and spec.date_format and dates is None:
        # date columns are fixed by the first load: no detection pass
        cols = {r["name"]: r["value"] for r in rows if r["kind"] == "column"}
        dates = date_columns_from_contract(raw, spec, cols)
    candidates: list[str] = []
    if created and spec.date_format and dates is None and is_path(target):
        # First load into a path: the probe proposes date columns, the write
        # parses them and checks the whole columns in the same job (staged).
        pre = clean(raw, column_naming=spec.column_naming, data_type=spec.data_type, date_format=False)
        with step(spark, "date probe"):
            candidates = probe_date_columns(pre)
        if not candidates:
            dates = []
    if candidates:
        pre, confirmed = observe_date_check(pre, candidates)
        cleaned = clean_dates(pre, candidates)
        if spec.decimal_precision is not None:
            cleaned = round_floats(cleaned, spec.decimal_precision)
    else:
        with step(spark, "date detection"):
            cleaned = clean_with(raw, spec, dates)
    report_rows: list | None = None
    rows_written, rows_rejected = None, 0
    if created and candidates:
        out, finish = observe_capture(cleaned, spec.target, 1, settings)
        out, written = _counted(out, "rows_written")
        with step(spark, "write to staging (dates and contract checked in the job)"):
            staging = stage(out, target)
        proven = confirmed()
        if set(proven) == set(candidates):
            with step(spark, "commit staged files"):
                commit_staged(spark, staging, target, spec.if_table_exists)
            with step(spark, "save contract"):
                save_contract(finish(), contract_location)
        else:
            # a candidate failed beyond the probe: write again with the proven ones
            discard_staged(spark, staging)
            cleaned = clean_with(raw, spec, proven)
            out, finish = observe_capture(cleaned, spec.target, 1, settings)
            out, written = _counted(out, "rows_written")
            with step(spark, "write (contract captured in the job)"):
                write_table(out, target, spec.if_table_exists)
            with step(spark, "save contract"):
                save_contract(finish(), contract_location)
    elif created:
        out, finish = observe_capture(cleaned, spec.target, 1, settings)
        out, written = _counted(out, "rows_written")
        with step(spark, "write (contract captured in the job)"):
            write_table(out, target, spec.if_table_exists)
        with step(spark, "save contract"):
            save_contract(finish(), contract_location)
    elif spec.on_violation == "quarantine" and spec.sample_size >= 1.0:
        # One pass whatever is wrong: the check is observed in the job that
        # writes the rows by verdict.
        out, finish = observe_contract(cleaned, contract, spec.target, settings)
        rows_written, rows_rejected, report_rows = _write_split(spark, out, contract, spec, target, quarantine_target, finish)
    elif spec.on_violation == "fail" and is_path(target) and spec.sample_size >= 1.0:
        # One pass: stage the write with the check observed in the same job,
        # then commit by renames, or drop the staging folder and raise.
        out, finish = observe_contract(cleaned, contract, spec.target, settings)
        out, written = _counted(out, "rows_written")
        with step(spark, "write to staging (contract checked in the job)"):
            staging = stage(out, target)
        report_rows = finish().collect()
        blocking_rows = [r.asDict() for r in report_rows if r["blocking"]]
        if not blocking_rows:
            with step(spark, "commit staged files"):
                commit_staged(spark, staging, target, spec.if_table_exists)
        else:
            discard_staged(spark, staging)
            raise ContractViolation(blocking_rows)
    elif spec.on_violation == "report" and spec.sample_size >= 1.0:
        out, finish = observe_contract(cleaned, contract, spec.target, settings)
        out, written = _counted(out, "rows_written")
        with step(spark, "write (contract checked in the job)"):
            write_table(out, target, spec.if_table_exists)
        report_rows = finish().collect()
    else:
        checked = validation_rows(cleaned, spec.sample_size, spec.sample_keys)
        with step(spark, "contract check"):
            report_rows = check_contract(checked, contract, spec.target, settings).collect()   # one row per finding
        blocking = sum(1 for r in report_rows if r["blocking"])
        if spec.on_violation == "fail" and blocking:
            raise ContractViolation([r.asDict() for r in report_rows if r["blocking"]])
        if spec.on_violation == "quarantine" and blocking:
            rows_written, rows_rejected, _ = _write_split(spark, cleaned, contract, spec, target, quarantine_target)
        else:
            out, written = _counted(cleaned, "rows_written")
            with step(spark, "write"):
                write_table(out, target, spec.if_table_exists)
    if rows_written is None:
        rows_written = int(written.get["n"])
    n_findings = n_blocking = 0
    if report_rows is not None:
        n_findings, n_blocking = len(report_rows), sum(1 for r in report_rows if r["blocking"])
        if findings_target and report_rows:
            (spark.createDataFrame(report_rows, FINDINGS_SCHEMA).withColumn("loaded_at", F.current_timestamp())
             .write.mode("append").parquet(findings_target))
    return spark.createDataFrame(
        [(spec.target, rows_written + rows_rejected, rows_written, rows_rejected, n_findings, n_blocking,
          created, round(time.time() - t0, 3))], REPORT_SCHEMA)


def orchestrate(spark: SparkSession, spec: JobSpec, contract_location: str, budget_bytes: float,
                target: str | None = None, ledger: str | None = None,
                quarantine_target: str | None = None, findings_target: str | None = None) -> dict:
    """Size the input against a memory budget, then load it: as one batch
    (decision eager / lazy) or in as many as the plan's chunk fraction gives
    (streaming).  Either way ``staged_load`` cleans, checks, splits and commits
    once, so schema, checks, kept and rejected rows do not depend on the size.

    The ``ledger`` (by default beside the contracts) names the files a target
    holds: after an ``append`` a rerun loads new files only, whatever the size;
    ``fail`` and ``replace`` load the whole input."""
    from ..operators.profile import decide, load_plan
    from ..sources.ledger import listed_files, new_files
    from ..streaming.incremental import files_per_trigger
    from .staged import staged_load
    target = target or spec.target
    check_target(spark, target, spec.if_table_exists)
    ledger = ledger or f"{contract_location.rstrip('/')}-ledger"
    if spec.if_table_exists == "append":
        files = new_files(spark, spec.input_path, ledger, target)
    else:
        files = listed_files(spark, spec.input_path)
    pending = files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    plan: dict = {}
    if pending["files"]:
        fmt = table_format(spec.input_path, spec.input_format)
        csv = spec.csv_options() if fmt == "csv" else None
        plan = load_plan(spark, {spec.target: spec.input_path}, budget_bytes, {spec.target: fmt}, csv_options=csv).first().asDict()
        if pending["bytes"] < plan["file_bytes"]:             # decided by what there is still to load
            share = pending["bytes"] / plan["file_bytes"]
            left = spark.createDataFrame([(plan["estimated_bytes"] * share, int(plan["n_rows"] * share))], "estimated_bytes double, n_rows bigint")
            plan |= decide(left, budget_bytes).first().asDict()
    whole = plan.get("load_mode", "batch") == "batch"
    fraction = 1.0 if whole else float(plan["chunk_fraction"])
    report = staged_load(spark, spec, contract_location, target, fraction, ledger, quarantine_target, findings_target)
    progress = {k: report.pop(k) for k in ("batches", "resumed")} | {"input_rows": report["rows_in"]}
    out = {"plan": plan, "path": "batch" if whole else "incremental", "report": report, "progress": progress}
    if not whole:
        out["files_per_trigger"] = files_per_trigger(pending["files"], fraction)
    return out
