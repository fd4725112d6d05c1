"""T5: rename -> cast -> dates -> rounding, each step switchable.

Every step is a projection; Catalyst collapses them into one Project over the
pruned scan, so cleaning adds no pass over the data.  Date detection is the
only step that runs a job (one aggregate), and it can be frozen by passing
``date_columns``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .cast import cast_columns
from .dates import clean_dates
from .rename import rename_columns
from .rounding import round_floats


def clean(df: DataFrame, *, column_naming: str | None = "lower",
          data_type: dict[str, str] | None = None, date_format: bool = True,
          decimal_precision: int | None = None,
          date_columns: list[str] | None = None) -> DataFrame:
    out = df
    if column_naming:
        out = rename_columns(out, column_naming)
    if data_type:
        out = cast_columns(out, data_type, column_naming)
    if date_format:
        out = clean_dates(out, date_columns)
    if decimal_precision is not None:
        out = round_floats(out, decimal_precision)
    return out


def clean_with(df: DataFrame, spec, date_columns: list[str] | None = None) -> DataFrame:
    """``clean`` driven by a JobSpec (``date_columns`` overrides the spec's)."""
    frozen = date_columns if date_columns is not None else spec.date_columns
    return clean(df, column_naming=spec.column_naming, data_type=spec.data_type,
                 date_format=spec.date_format, decimal_precision=spec.decimal_precision,
                 date_columns=frozen)


def date_columns_from_contract(df: DataFrame, spec, contract_columns: dict[str, str]) -> list[str]:
    """After the first load the contract fixes which text columns are dates:
    those it records as timestamp_ntz that are still text before T3."""
    pre = clean(df, column_naming=spec.column_naming, data_type=spec.data_type, date_format=False)
    text = {f.name for f in pre.schema.fields if f.dataType.simpleString() == "string"}
    return [c for c in pre.columns if c in text and contract_columns.get(c) == "timestamp_ntz"]
