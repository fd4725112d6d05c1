"""Find string columns that hold dates and parse them; widen dates.

Detection is one aggregate over the whole column (not a 10-row peek): a
string column is a date column when it has at least one non-null value and no
value that fails to parse.  The aggregate is partial per task, so only one row
per task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col, not_date_text, parse_date_text
from ..functions.types import type_kind


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if type_kind(f.dataType) == "string"]


def date_detection_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per string column: non_null, failures, is_date."""
    cols = string_columns(df) if columns is None else list(columns)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column_name string, non_null bigint, failures bigint, is_date boolean")
    aggs = []
    for c in cols:
        aggs.append(F.count_if(col(c).isNotNull()).alias(f"n{len(aggs)}"))
        aggs.append(F.count_if(not_date_text(col(c))).alias(f"n{len(aggs)}"))
    counts = df.agg(*aggs)
    stacked = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"n{2 * i}").alias("non_null"),
                 F.col(f"n{2 * i + 1}").alias("failures"))
        for i, c in enumerate(cols)
    ]))
    return (counts.select(stacked)
            .withColumn("is_date", (F.col("non_null") > 0) & (F.col("failures") == 0)))


PROBE_ROWS = 10_000


def probe_date_columns(df: DataFrame, columns: list[str] | None = None,
                       probe_rows: int = PROBE_ROWS) -> list[str]:
    """Candidate date columns: string columns without a failing value among
    ``probe_rows`` rows.  Candidates still need the whole-column check
    (``detect_date_columns`` or ``observe_date_check``).

    One flag per column and row reaches the driver, taken split by split until
    there are enough: no task gathers rows of every split, and wide texts stay
    on the executors."""
    cols = string_columns(df) if columns is None else list(columns)
    if not cols:
        return []
    flags = F.array(*[F.coalesce(not_date_text(col(c)), F.lit(False)) for c in cols]).alias("failed")
    failed = [r["failed"] for r in df.select(flags).take(probe_rows)]
    return [c for i, c in enumerate(cols) if not any(row[i] for row in failed)]


def observe_date_check(df: DataFrame, columns: list[str]):
    """The whole-column date check of ``columns`` as an Observation of the job
    that consumes the returned frame.  Returns (frame, confirmed) where
    ``confirmed()`` lists the columns with values and no failure."""
    from pyspark.sql import Observation
    obs = Observation("date_check")
    aggs = [F.count(F.lit(0)).alias("_rows")]
    for i, c in enumerate(columns):
        aggs.append(F.count_if(col(c).isNotNull()).alias(f"n{i}"))
        aggs.append(F.count_if(not_date_text(col(c))).alias(f"f{i}"))
    out = df.observe(obs, *aggs)

    def confirmed() -> list[str]:
        m = obs.get
        return [c for i, c in enumerate(columns) if int(m[f"n{i}"]) > 0 and int(m[f"f{i}"]) == 0]
    return out, confirmed


def detect_date_columns(df: DataFrame, columns: list[str] | None = None,
                        probe_rows: int = PROBE_ROWS) -> list[str]:
    """Names of the date columns (a single row per string column reaches the driver).

    A probe of the first ``probe_rows`` rows rules out every column that
    already fails there (exact: a failure is a failure).  Only the remaining
    candidates get the whole-column check, so with column pruning the full
    pass reads the few plausible date columns, not every string column."""
    cols = probe_date_columns(df, columns, probe_rows) if probe_rows else (
        string_columns(df) if columns is None else list(columns))
    if not cols:
        return []
    rows = date_detection_report(df, cols).where("is_date").select("column_name").collect()
    found = {r[0] for r in rows}
    return [c for c in cols if c in found]


def parse_date_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Parse the named string columns to timestamp_ntz (null where not a date)."""
    if not columns:
        return df
    return df.withColumns({c: parse_date_text(col(c)) for c in columns})


def widen_date_columns(df: DataFrame) -> DataFrame:
    """T4: every DateType column becomes timestamp_ntz (midnight)."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    if not dates:
        return df
    return df.withColumns({c: col(c).cast(T.TimestampNTZType()) for c in dates})


def clean_dates(df: DataFrame, date_columns: list[str] | None = None) -> DataFrame:
    """T3 + T4.  ``date_columns`` freezes the detection result (streams need a
    static plan); when None the columns are detected with one aggregate."""
    cols = detect_date_columns(df) if date_columns is None else date_columns
    return widen_date_columns(parse_date_columns(df, cols))
