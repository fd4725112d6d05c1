"""tablepipe: config-driven table ingest on Spark.

Read CSV / Parquet (batch or incremental), clean (rename, casts, dates,
rounding), check against a stored schema + settings contract, profile size to
plan loads, write with fail / append / replace, and query with SQL.

    from tablepipe import JobSpec, run_load, orchestrate, clean, check_contract
"""

from .spec import JobSpec  # noqa: F401

__version__ = "0.1.0"

_API = {
    "clean": "tablepipe.operators.clean",
    "rename_columns": "tablepipe.operators.rename",
    "cast_columns": "tablepipe.operators.cast",
    "safe_cast": "tablepipe.operators.cast",
    "cast_probe": "tablepipe.operators.cast",
    "detect_date_columns": "tablepipe.operators.dates",
    "round_floats": "tablepipe.operators.rounding",
    "capture_contract": "tablepipe.operators.contract",
    "check_contract": "tablepipe.operators.contract",
    "split_by_contract": "tablepipe.operators.contract",
    "enforce": "tablepipe.operators.contract",
    "evolve_contract": "tablepipe.operators.contract",
    "catalog_schema_drift": "tablepipe.operators.contract",
    "size_factors": "tablepipe.operators.profile",
    "load_plan": "tablepipe.operators.profile",
    "parquet_footers": "tablepipe.operators.profile",
    "head_rows": "tablepipe.operators.sample",
    "keyed_sample": "tablepipe.operators.sample",
    "read_table": "tablepipe.sources.files",
    "read_csv": "tablepipe.sources.files",
    "write_table": "tablepipe.sinks.tables",
    "incremental_ingest": "tablepipe.streaming.incremental",
    "run_load": "tablepipe.plans.load",
    "orchestrate": "tablepipe.plans.load",
    "register_tables": "tablepipe.plans.query",
    "run_sql": "tablepipe.plans.query",
}


def __getattr__(name):
    """Import the public functions on first use (keeps ``import tablepipe`` light)."""
    if name in _API:
        import importlib
        return getattr(importlib.import_module(_API[name]), name)
    raise AttributeError(name)


__all__ = ["JobSpec", *_API]
