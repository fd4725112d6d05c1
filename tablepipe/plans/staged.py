"""Staged loads: a table is cleaned, checked and written batch by batch into a
staging folder and committed once, after the last batch.

    list files -> (anti-join the ledger) -> batch list -> per batch: read, clean,
    check, write to staging -> one commit: data, rejects, contract, ledger

* The batch list is written before the first batch; every finished batch leaves
  a marker with its figures.  A run that was cut short reads both and goes on
  with the first batch that has no marker, so no finished batch is read again
  and no source row is written twice.
* The target is not touched until all batches are staged.  A batch that breaks
  the contract under ``fail`` drops the staging folder and leaves the target,
  the contract and the ledger as they were.
* The commit begins with a marker of its own and every step of it can be
  repeated, so a run cut short in the commit finishes it when it is started again.
* What is loaded does not depend on the number of batches: types, date columns,
  contract, findings, kept and rejected rows are those of the whole input.

Staging lies next to a path target, so the commit is renames: one for a new or
replaced target, one a file for ``append``.  A catalog table is filled from the
staging folder by one Spark write.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import clean, clean_with, date_columns_from_contract
from ..operators.contract import (CONTRACT_SCHEMA, ContractViolation, check_contract, observe_capture,
                                  keeps_shape, observe_contract, row_checks, save_contract, split_by_contract)
from ..operators.contract import REPORT_SCHEMA as FINDINGS_SCHEMA
from ..operators.dates import detect_date_columns
from ..operators.profile import qualified
from ..operators.sample import validation_rows
from ..session import shared_root
from ..sinks.split import side, take_side, write_split
from ..sinks.tables import _fs, check_target, is_path, target_exists, write_table
from ..sources.files import CSV_OPTIONS, read_csv, read_table, table_format
from ..sources.ledger import listed_files, new_files, record_load
from ..spec import JobSpec

REPORT_SCHEMA = ("table_name string, rows_in bigint, rows_written bigint, rows_rejected bigint, "
                 "findings bigint, blocking bigint, contract_created boolean, seconds double")
BATCHES_SCHEMA = "batch bigint, path string, bytes bigint, modified timestamp"


# -- small state files -------------------------------------------------------
def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all (written aside, renamed)."""
    fs, final = _fs(spark, path)
    _, aside = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}.tmp")
    fs.mkdirs(final.getParent())
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(final, False)
    if not fs.rename(aside, final):
        raise RuntimeError(f"could not write {path}")


def _get(spark: SparkSession, path: str) -> str | None:
    fs, final = _fs(spark, path)
    if not fs.exists(final):
        return None
    stream = fs.open(final)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _data_files(spark: SparkSession, folder: str) -> list:
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        file = found.next().getPath()
        if not file.getName().startswith(("_", ".")):
            out.append(file)
    return out


def job_folder(spark: SparkSession, spec: JobSpec, target: str) -> str:
    """Where a load of ``target`` keeps its staging; a rerun finds it there."""
    if is_path(target):
        return f"{target.rstrip('/')}.__load"
    name = hashlib.sha1(target.encode()).hexdigest()[:16]
    return f"{shared_root(spark)}/tablepipe/load-{name}"


# -- the batch list ----------------------------------------------------------
def batch_list(files: DataFrame, fraction: float) -> DataFrame:
    """Files in batches of about ``fraction`` of all bytes, whole files, by path.

    One row a file (names and sizes, which the driver lists anyway), so the
    prefix sum over all of them stays small."""
    total = files.agg(F.sum("bytes")).first()[0] or 0
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    sized = files.withColumn("_before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    batch = F.floor(F.col("_before") / F.lit(max(fraction * total, 1.0))).cast("bigint")
    return sized.select(batch.alias("batch"), "path", "bytes", "modified")


def read_files(spark: SparkSession, spec: JobSpec, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """The given files of the spec's input."""
    fmt = table_format(spec.input_path, spec.input_format)
    fs, root = _fs(spark, spec.input_path)
    options = dict(spec.csv_options()) if fmt == "csv" else {}
    if fs.exists(root) and fs.getFileStatus(root).isDirectory():
        options["basePath"] = spec.input_path            # partition folders stay columns
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        if spec.multiline:
            return read_csv(spark, paths, schema, **spec.csv_options())
        return reader.options(**{**CSV_OPTIONS, **options}).csv(paths)
    return reader.options(**options).parquet(*paths)


def _counted(df: DataFrame) -> tuple[DataFrame, Callable[[], int]]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), lambda: int(seen.get["n"])


# -- the load ----------------------------------------------------------------
def staged_load(spark: SparkSession, spec: JobSpec, contract_location: str, target: str | None = None,
                fraction: float = 1.0, ledger: str | None = None, quarantine_target: str | None = None,
                findings_target: str | None = None, on_batch: Callable[[int], None] | None = None) -> dict:
    """Load the spec's input in batches of ``fraction`` of its bytes and commit
    once.  With a ``ledger`` the files it holds for this target are left out
    under ``append``, and every load is recorded in it.

    Returns the run report with ``batches`` (run by this call) and ``resumed``.
    ``on_batch`` is called after every batch (progress; an exception in it ends
    the run as any other would, to be resumed by the next call)."""
    from .load import step, stored_contract_rows
    t0 = time.time()
    target = target or spec.target
    job = job_folder(spark, spec, target)
    finished = _finish(spark, job)                          # a commit that was cut short goes first
    same = hashlib.sha1(json.dumps([qualified(spark, spec.input_path), spec.settings(), spec.if_table_exists, spec.on_violation,
                                    spec.sample_size, spec.date_columns, fraction]).encode()).hexdigest()
    if finished and finished["same"] == same:
        return finished["report"] | {"batches": 0, "resumed": True}
    check_target(spark, target, spec.if_table_exists)
    if spec.on_violation == "quarantine" and not quarantine_target:
        raise ValueError("on_violation 'quarantine' needs a quarantine target for the rejected rows")
    with step(spark, "read contract"):
        contract = stored_contract_rows(spark, contract_location, spec.target)
    text = _get(spark, f"{job}/plan.json")
    plan = json.loads(text) if text else None
    resumed = plan is not None and plan["same"] == same and plan["created"] == (not contract)
    if not resumed:
        _delete(spark, job)
        plan = _planned(spark, spec, job, target, contract, fraction, ledger, quarantine_target, findings_target, contract_location)
        plan["same"] = same
        _put(spark, f"{job}/plan.json", json.dumps(plan))
    schema = T.StructType.fromJson(plan["schema"])
    run = 0
    for batch in range(plan["batches"]):
        if _get(spark, f"{job}/done/{batch}.json") is not None:
            continue
        paths = [r["path"] for r in spark.read.schema(BATCHES_SCHEMA).parquet(f"{job}/batches").where(F.col("batch") == batch).select("path").orderBy("path").collect()]
        if not paths:
            continue                                        # a file larger than a batch leaves numbers out
        cleaned = clean_with(read_files(spark, spec, paths, schema), spec, plan["dates"])
        try:
            with step(spark, f"stage batch {batch}"):
                done = _stage_batch(spark, spec, cleaned, contract, f"{job}/rows/{batch}", f"{job}/rejects/{batch}")
        except ContractViolation:
            _delete(spark, job)
            raise
        _put(spark, f"{job}/done/{batch}.json", json.dumps(done))
        run += 1
        if on_batch:
            on_batch(batch)
    if not plan["files"]:
        try:
            _check_nothing(spark, spec, schema, plan, contract)
        except ContractViolation:
            _delete(spark, job)
            raise
    report = _report(spark, spec, job, plan, time.time() - t0)
    _put(spark, f"{job}/COMMIT", json.dumps(report))
    with step(spark, "commit"):
        _finish(spark, job)
    return report | {"batches": run, "resumed": resumed}


def _planned(spark, spec, job, target, contract, fraction, ledger, quarantine_target, findings_target, contract_location) -> dict:
    """The batch list, written, and what is fixed for all batches."""
    if ledger and spec.if_table_exists == "append":
        files = new_files(spark, spec.input_path, ledger, target)
    else:
        files = listed_files(spark, spec.input_path)
    batch_list(files, fraction).write.mode("overwrite").parquet(f"{job}/batches")
    listed = spark.read.schema(BATCHES_SCHEMA).parquet(f"{job}/batches")
    got = listed.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.max("batch") + 1, F.lit(0)).alias("batches")).first()
    fmt = table_format(spec.input_path, spec.input_format)
    source = read_table(spark, spec.input_path, spec.input_format, **(spec.csv_options() if fmt == "csv" else {}))
    dates = spec.date_columns if spec.date_format else []
    if spec.date_format and dates is None:
        if contract:
            dates = date_columns_from_contract(source, spec, {r["name"]: r["value"] for r in contract if r["kind"] == "column"})
        else:
            # Fixed before the first batch is written: the plausible text columns alone are read once.
            dates = detect_date_columns(clean(source, column_naming=spec.column_naming, data_type=spec.data_type, date_format=False))
    return {"load": uuid.uuid4().hex[:12], "table": spec.target, "target": target, "mode": spec.if_table_exists,
            "schema": json.loads(source.schema.json()), "dates": dates, "files": int(got["files"]), "batches": int(got["batches"]),
            "created": not contract, "settings": spec.settings(), "ledger": ledger, "contract": contract_location,
            "quarantine": quarantine_target, "findings_to": findings_target}


def _stage_batch(spark, spec: JobSpec, cleaned: DataFrame, contract: list, rows: str, rejects: str) -> dict:
    """Write one batch; its figures: rows, rejected, capture (columns that held a
    null) or findings."""
    if not contract:
        out, finish = observe_capture(cleaned, spec.target, 1, spec.settings())
        out, n = _counted(out)
        out.write.mode("overwrite").parquet(rows)
        return {"rows": n(), "rejected": 0, "capture": [list(r) for r in finish().collect()], "findings": []}
    if spec.on_violation == "quarantine":
        return _stage_split(spark, spec, cleaned, contract, rows, rejects)
    if spec.sample_size < 1.0:
        checked = validation_rows(cleaned, spec.sample_size, spec.sample_keys)
        found = check_contract(checked, contract, spec.target, spec.settings()).collect()
        out, n = _counted(cleaned)
    else:
        out, finish = observe_contract(cleaned, contract, spec.target, spec.settings())
        out, n = _counted(out)
        out.write.mode("overwrite").parquet(rows)
        found = finish().collect()
    blocking = [r.asDict() for r in found if r["blocking"]]
    if blocking and spec.on_violation == "fail":
        raise ContractViolation(blocking)
    if spec.sample_size < 1.0:
        out.write.mode("overwrite").parquet(rows)
    return {"rows": n(), "rejected": 0, "capture": [], "findings": [list(r) for r in found]}


def _stage_split(spark, spec: JobSpec, cleaned: DataFrame, contract: list, rows: str, rejects: str) -> dict:
    """One batch whose rejected rows go aside: its rows are read and written once,
    by verdict.  The kept side becomes the batch by a rename, or by a read of the
    staged files where the contract's types ask for a coercion."""
    found = None
    if spec.sample_size < 1.0:
        checked = validation_rows(cleaned, spec.sample_size, spec.sample_keys)
        found = check_contract(checked, contract, spec.target, spec.settings()).collect()
        if not any(r["blocking"] for r in found):           # the sample decides: all rows stay
            out, n = _counted(cleaned)
            out.write.mode("overwrite").parquet(rows)
            return {"rows": n(), "rejected": 0, "capture": [], "findings": [list(r) for r in found]}
        out = cleaned
    else:
        out, finish = observe_contract(cleaned, contract, spec.target, spec.settings())
    _, _, reason = row_checks(cleaned, contract, spec.target)
    split = write_split(out, reason != "", f"{rows}.split")
    found = finish().collect() if found is None else found
    blocked = any(r["blocking"] for r in found)
    if split.rejected:
        _, bad = split_by_contract(side(spark, split, True), contract, spec.target)
        bad.write.mode("overwrite").parquet(rejects)
    if blocked and not keeps_shape(cleaned, contract, spec.target):
        good, _ = split_by_contract(side(spark, split, False), contract, spec.target)
        good.write.mode("overwrite").parquet(rows)
    elif not take_side(spark, split, False, rows):
        side(spark, split, False).write.mode("overwrite").parquet(rows)      # no row: an empty table
    _delete(spark, split.folder)
    return {"rows": split.rows - split.rejected, "rejected": split.rejected, "capture": [], "findings": [list(r) for r in found]}


def _check_nothing(spark, spec, schema, plan, contract) -> None:
    """No file to load: changed settings and columns are still found."""
    if contract and spec.on_violation == "fail":
        empty = clean_with(spark.createDataFrame([], schema), spec, plan["dates"])
        found = [r.asDict() for r in check_contract(empty, contract, spec.target, spec.settings()).collect() if r["blocking"]]
        if found:
            raise ContractViolation(found)


def _done(spark, job: str, plan: dict) -> list[dict]:
    texts = [_get(spark, f"{job}/done/{b}.json") for b in range(plan["batches"])]
    return [json.loads(t) for t in texts if t]


def _findings(done: list[dict]) -> list[tuple]:
    """The findings of all batches as of one input: counts added up."""
    merged: dict[tuple, list] = {}
    for d in done:
        for *key, bad, blocking in d["findings"]:
            at = merged.setdefault(tuple(key), [None, False])
            at[0] = at[0] if bad is None else (at[0] or 0) + bad
            at[1] = at[1] or blocking
    return [(*key, bad, blocking) for key, (bad, blocking) in merged.items()]


def _contract(done: list[dict]) -> list[tuple]:
    """The contract of all batches as of one input: nullable where any held a null."""
    merged: dict[tuple, list] = {}
    for d in done:
        for r in d["capture"]:
            at = merged.setdefault((r[2], r[3]), list(r))
            at[6] = at[6] or r[6]
    return [tuple(r) for r in merged.values()]


def _report(spark, spec, job, plan, seconds) -> dict:
    done = _done(spark, job, plan)
    found = _findings(done)
    written, rejected = sum(d["rows"] for d in done), sum(d["rejected"] for d in done)
    return {"table_name": spec.target, "rows_in": written + rejected, "rows_written": written, "rows_rejected": rejected,
            "findings": len(found), "blocking": sum(1 for r in found if r[-1]),
            "contract_created": bool(plan["created"] and done), "seconds": round(seconds, 3)}


# -- the commit --------------------------------------------------------------
def _move(spark, files: list, folder: str) -> None:
    if not files:
        return
    fs, to = _fs(spark, folder)
    fs.mkdirs(to)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for file in files:
        if not fs.rename(file, path(to, file.getName())):   # part names are unique
            raise RuntimeError(f"could not move {file} into {folder}")


def _finish(spark: SparkSession, job: str) -> dict | None:
    """Carry out (or finish) the commit of a staged load, if it was decided on.
    Every step leaves what it has done recognisable, so all can run again."""
    decided = _get(spark, f"{job}/COMMIT")
    if decided is None:
        return None
    plan = json.loads(_get(spark, f"{job}/plan.json"))
    target, done = plan["target"], _done(spark, job, plan)
    if not is_path(target):
        if _data_files(spark, f"{job}/rows") and _get(spark, f"{job}/INSERTED") is None:
            folders = [f"{job}/rows/{b}" for b in range(plan["batches"]) if target_exists(spark, f"{job}/rows/{b}")]
            write_table(spark.read.parquet(*folders), target, "append" if plan["mode"] == "append" else "replace")
            _put(spark, f"{job}/INSERTED", "")
    elif plan["mode"] == "append" and target_exists(spark, target):
        _move(spark, _data_files(spark, f"{job}/rows"), target)
    elif _get(spark, f"{job}/SWAPPED") is None:
        _move(spark, _data_files(spark, f"{job}/rows"), f"{job}/all")
        fs, whole = _fs(spark, f"{job}/all")
        _, old = _fs(spark, f"{job}/old")
        _, place = _fs(spark, target)
        if plan["files"] and fs.exists(whole):
            if fs.exists(place) and not fs.exists(old):
                fs.rename(place, old)
            fs.mkdirs(place.getParent())
            if not fs.rename(whole, place):
                raise RuntimeError(f"could not move {whole} into place")
        _put(spark, f"{job}/SWAPPED", "")
    if plan["quarantine"]:
        _move(spark, _data_files(spark, f"{job}/rejects"), plan["quarantine"])
    if plan["created"] and done:
        from .load import stored_contract_rows
        if not stored_contract_rows(spark, plan["contract"], plan["table"]):
            save_contract(spark.createDataFrame(_contract(done), CONTRACT_SCHEMA), plan["contract"])
    found = _findings(done)
    if plan["findings_to"] and found and _get(spark, f"{job}/REPORTED") is None:
        rows = spark.createDataFrame(found, FINDINGS_SCHEMA).withColumn("loaded_at", F.current_timestamp())
        rows.coalesce(1).write.mode("append").parquet(plan["findings_to"])
        _put(spark, f"{job}/REPORTED", "")
    if plan["ledger"] and plan["files"]:
        record_load(spark.read.schema(BATCHES_SCHEMA).parquet(f"{job}/batches"), plan["ledger"], target, plan["load"], plan["mode"] == "replace")
    _delete(spark, job)
    return {"same": plan["same"], "report": json.loads(decided)}
