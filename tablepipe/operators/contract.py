"""Schema and settings contract.

The contract is a table of rows, not a pickle:

    table_name, version, kind ('column' | 'setting'), name, ordinal, value, nullable

``value`` is the Spark type (``simpleString``) of a column or the text of a
setting.  The first load captures it (V3), later loads are checked against
the latest version of their table.

Checking a table costs one aggregate pass over it (partial per task, one row
per task shuffled): the per-column counts of values that do not coerce to the
contract type (V5) and of nulls (V6).  The plan of that aggregate is built
from metadata only (the contract rows, bounded by the number of columns).
Checks over many tables at once (V4 across a catalog) are a full outer join
of contract rows and observed schema rows.

The single-table checks take the contract as a frame or as its rows already
collected (streams and loads pin them once instead of once per batch).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.exprs import col, cast_failed, try_cast

CONTRACT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("ordinal", T.IntegerType(), True),
    T.StructField("value", T.StringType(), True),
    T.StructField("nullable", T.BooleanType(), True),
])

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("finding", T.StringType()),
    T.StructField("expected", T.StringType()),
    T.StructField("observed", T.StringType()),
    T.StructField("bad_rows", T.LongType()),
    T.StructField("blocking", T.BooleanType()),
])

VIOLATIONS = "_violations"


class ContractViolation(ValueError):
    def __init__(self, rows):
        self.rows = rows
        lines = "; ".join(f"{r['column_name']}: {r['finding']} ({r['bad_rows']} rows)" for r in rows[:20])
        super().__init__(f"contract violated: {lines}")


def parse_type(spark: SparkSession, text: str) -> T.DataType:
    return T._parse_datatype_string(text)


# --------------------------------------------------------------------------
# V3: capture
# --------------------------------------------------------------------------
def observed_schema(spark: SparkSession, table_name: str, schema: T.StructType) -> DataFrame:
    """Schema of a frame as contract-shaped column rows (metadata only)."""
    rows = [(table_name, 0, "column", f.name, i, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(schema.fields)]
    return spark.createDataFrame(rows, CONTRACT_SCHEMA)


def capture_contract(df: DataFrame, table_name: str, version: int = 1,
                     settings: dict[str, str] | None = None,
                     nullable_from_data: bool = True) -> DataFrame:
    """Contract rows for ``df``.  ``nullable`` is what the first load shows:
    a column is nullable when it holds at least one null (one aggregate);
    with ``nullable_from_data=False`` every column is taken as non-nullable."""
    spark = df.sparkSession
    fields = df.schema.fields
    if nullable_from_data and fields:
        counts = df.agg(*[F.count_if(col(f.name).isNull()).alias(f"n{i}")
                          for i, f in enumerate(fields)])
        cols = counts.select(F.inline(F.array(*[
            F.struct(F.lit(table_name).alias("table_name"), F.lit(version).alias("version"),
                     F.lit("column").alias("kind"), F.lit(f.name).alias("name"),
                     F.lit(i).alias("ordinal"), F.lit(f.dataType.simpleString()).alias("value"),
                     (F.col(f"n{i}") > 0).alias("nullable"))
            for i, f in enumerate(fields)])))
    else:
        cols = spark.createDataFrame(
            [(table_name, version, "column", f.name, i, f.dataType.simpleString(), False)
             for i, f in enumerate(fields)], CONTRACT_SCHEMA)
    cols = cols.select([F.col(f.name).cast(f.dataType) for f in CONTRACT_SCHEMA.fields])
    if settings:
        return cols.unionByName(settings_rows(spark, table_name, settings, version))
    return cols


def settings_rows(spark: SparkSession, table_name: str, settings: dict[str, str], version: int = 1) -> DataFrame:
    """Setting rows: ordinal is the position among the sorted settings; a
    setting always has a value (nullable false)."""
    return spark.createDataFrame(_setting_tuples(table_name, settings, version), CONTRACT_SCHEMA)


def _setting_tuples(table_name: str, settings: dict[str, str] | None, version: int) -> list[tuple]:
    return [(table_name, version, "setting", k, i, v, False)
            for i, (k, v) in enumerate(sorted((settings or {}).items()))]


# --------------------------------------------------------------------------
# K7: store
# --------------------------------------------------------------------------
def load_contracts(spark: SparkSession, location: str) -> DataFrame | None:
    """All stored contract rows, or None when nothing is stored yet."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(location)
    if not hpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hpath):
        return None
    return spark.read.schema(CONTRACT_SCHEMA).parquet(location)


def save_contract(contract: DataFrame, location: str) -> None:
    contract.write.mode("append").parquet(location)


def latest(contract: DataFrame, table_name: str | None = None) -> DataFrame:
    """Rows of the newest version of each table (or of one table)."""
    c = contract if table_name is None else contract.where(F.col("table_name") == table_name)
    w = Window.partitionBy("table_name")
    return c.withColumn("_max", F.max("version").over(w)).where("version = _max").drop("_max")


def ensure_contract(df: DataFrame, location: str, table_name: str,
                    settings: dict[str, str] | None = None) -> tuple[DataFrame, bool]:
    """V3 on the first load of a table, otherwise the stored latest version.
    Returns (contract rows, created)."""
    spark = df.sparkSession
    stored = load_contracts(spark, location)
    if stored is not None:
        mine = latest(stored, table_name)
        if mine.limit(1).count() > 0:
            return mine, False
    save_contract(capture_contract(df, table_name, 1, settings), location)
    return latest(load_contracts(spark, location), table_name), True


def evolve_contract(df: DataFrame, location: str, table_name: str,
                    settings: dict[str, str] | None = None) -> int:
    """Accept the current shape: store it as the next version of the table's
    contract (later loads are checked against it).  Returns the new version."""
    spark = df.sparkSession
    stored = load_contracts(spark, location)
    current = 0
    if stored is not None:
        row = stored.where(F.col("table_name") == table_name).agg(F.max("version").alias("v")).first()
        current = int(row["v"] or 0)
    save_contract(capture_contract(df, table_name, current + 1, settings), location)
    return current + 1


# --------------------------------------------------------------------------
# V4 / V8 over many tables: full outer joins of rows
# --------------------------------------------------------------------------
def catalog_schema_drift(contract: DataFrame, observed: DataFrame) -> DataFrame:
    """Compare the latest contract column rows of many tables with observed
    schema rows: missing / unexpected / type_changed, one row per finding."""
    c = latest(contract).where("kind = 'column'").select(
        "table_name", "name", F.col("value").alias("expected"))
    o = observed.where("kind = 'column'").select("table_name", "name", F.col("value").alias("observed"))
    j = c.join(o, ["table_name", "name"], "full_outer")
    issue = (F.when(F.col("observed").isNull(), "missing_column")
              .when(F.col("expected").isNull(), "unexpected_column")
              .when(F.col("expected") != F.col("observed"), "type_changed"))
    return (j.withColumn("finding", issue).where(F.col("finding").isNotNull())
            .select("table_name", F.col("name").alias("column_name"), "finding", "expected", "observed"))


def settings_drift(contract: DataFrame, current: DataFrame) -> DataFrame:
    """V8: settings that differ from the table's first load (all of them)."""
    c = latest(contract).where("kind = 'setting'").select("table_name", "name", F.col("value").alias("expected"))
    o = current.where("kind = 'setting'").select("table_name", "name", F.col("value").alias("observed"))
    j = c.join(o, ["table_name", "name"], "full_outer")
    return (j.where(~F.col("expected").eqNullSafe(F.col("observed")))
            .select("table_name", F.col("name").alias("column_name"),
                    F.lit("setting_changed").alias("finding"), "expected", "observed"))


# --------------------------------------------------------------------------
# V4-V6 for one table: one aggregate pass
# --------------------------------------------------------------------------
def _contract_rows(contract, table_name: str) -> list:
    """The table's rows of its newest version.  ``contract`` is a contract
    frame (one collect of metadata, all versions, no shuffle) or rows already
    collected."""
    if isinstance(contract, list):
        rows = [r for r in contract if r["table_name"] == table_name]
    else:
        rows = contract.where(F.col("table_name") == table_name).collect()
    if not rows:
        return []
    newest = max(r["version"] for r in rows)
    return [r for r in rows if r["version"] == newest]


def _contract_columns(contract, table_name: str) -> list[tuple[str, str, bool]]:
    rows = _contract_rows(contract, table_name)
    cols = [r for r in rows if r["kind"] == "column"]
    return [(r["name"], r["value"], bool(r["nullable"])) for r in sorted(cols, key=lambda r: r["ordinal"])]


def _contract_settings(contract, table_name: str) -> dict[str, str]:
    rows = _contract_rows(contract, table_name)
    return {r["name"]: r["value"] for r in rows if r["kind"] == "setting"}


def _q(name: str) -> Column:
    return col(name)


def castable(df: DataFrame, name: str, dt: T.DataType) -> bool:
    """Whether Spark can cast the column to ``dt`` at all (analysis only)."""
    try:
        df.select(_q(name).try_cast(dt)).schema
        return True
    except Exception:
        return False


def _fails(df: DataFrame, name: str, dt: T.DataType, src: T.DataType) -> Column:
    """Non-null values that do not coerce; every non-null value when the types
    cannot be cast at all (e.g. an array where a number was)."""
    if castable(df, name, dt):
        return cast_failed(_q(name), dt, src)
    return _q(name).isNotNull()


def _check_plan(df: DataFrame, contract: DataFrame, table_name: str,
                settings: dict[str, str] | None):
    """The aggregates a check needs and the findings they feed.  A finding is
    (column, finding, expected, observed, metric name, rule) where rule is
    'always' (blocking), 'if_bad' (reported, blocking when the metric > 0) or
    'if_bad_only' (reported and blocking only when the metric > 0)."""
    spark = df.sparkSession
    rows = _contract_rows(contract, table_name)
    expected = _contract_columns(rows, table_name)
    have = {f.name: f.dataType for f in df.schema.fields}
    exp_names = {n for n, _, _ in expected}
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    findings = []
    for i, (name, tname, nullable) in enumerate(expected):
        if name not in have:
            findings.append((name, "missing_column", tname, None, "n_rows", "always"))
            continue
        observed = have[name].simpleString()
        if observed != tname:
            aggs.append(F.count_if(_fails(df, name, parse_type(spark, tname), have[name])).alias(f"f{i}"))
            findings.append((name, "type_changed", tname, observed, f"f{i}", "if_bad"))
        if not nullable:
            aggs.append(F.count_if(_q(name).isNull()).alias(f"z{i}"))
            findings.append((name, "null_values", "not null", observed, f"z{i}", "if_bad_only"))
    for name, dt in have.items():
        if name not in exp_names:
            findings.append((name, "unexpected_column", None, dt.simpleString(), "n_rows", "always"))
    if settings is not None:
        stored = _contract_settings(rows, table_name)
        for key in sorted(set(stored) | set(settings)):
            if stored.get(key) != settings.get(key):
                # every row would load under the changed setting
                findings.append((key, "setting_changed", stored.get(key), settings.get(key), "n_rows", "always"))
    return aggs, findings


def _report_rows(table_name: str, findings, metrics: dict) -> list[tuple]:
    rows = []
    for col, kind, exp, obs, metric, rule in findings:
        bad = None if metric is None else int(metrics[metric])
        if rule == "if_bad_only" and not bad:
            continue
        blocking = True if rule == "always" else bool(bad)
        rows.append((table_name, col, kind, exp, obs, bad, blocking))
    return rows


def check_contract(df: DataFrame, contract: DataFrame, table_name: str,
                   settings: dict[str, str] | None = None) -> DataFrame:
    """Findings for one table (REPORT_SCHEMA), from one aggregate over it.
    ``blocking`` marks what breaks the contract: a missing or unexpected
    column, a value that does not coerce to the contract type, a null in a
    non-nullable column, a changed setting.  A changed type whose values all
    coerce is reported, not blocking."""
    spark = df.sparkSession
    aggs, findings = _check_plan(df, contract, table_name, settings)
    if not findings:
        return spark.createDataFrame([], REPORT_SCHEMA)
    counts = df.agg(*aggs)

    def metric(m):
        return F.lit(None).cast("bigint") if m is None else F.col(m).cast("bigint")

    structs = [F.struct(F.lit(table_name).alias("table_name"), F.lit(c).alias("column_name"),
                        F.lit(k).alias("finding"), F.lit(e).cast("string").alias("expected"),
                        F.lit(o).cast("string").alias("observed"), metric(m).alias("bad_rows"),
                        (F.lit(True) if r == "always" else metric(m) > 0).alias("blocking"))
               for c, k, e, o, m, r in findings]
    report = counts.select(F.inline(F.array(*structs)))
    return report.where(~((F.col("finding") == "null_values") & (F.col("bad_rows") == 0)))


def observe_contract(df: DataFrame, contract: DataFrame, table_name: str,
                     settings: dict[str, str] | None = None):
    """The same check as ``check_contract``, computed inside whatever job
    consumes the returned frame (an ``Observation``), so a load that writes
    the frame needs no separate pass.  Returns (frame, finish) where
    ``finish()`` gives the report once that job has run."""
    spark = df.sparkSession
    aggs, findings = _check_plan(df, contract, table_name, settings)
    obs = Observation("contract_check")
    out = df.observe(obs, *aggs)

    def finish() -> DataFrame:
        return spark.createDataFrame(_report_rows(table_name, findings, obs.get), REPORT_SCHEMA)
    return out, finish


def observe_capture(df: DataFrame, table_name: str, version: int = 1,
                    settings: dict[str, str] | None = None):
    """``capture_contract`` computed inside the job that consumes the frame.
    Returns (frame, finish) where ``finish()`` gives the contract rows."""
    spark = df.sparkSession
    fields = df.schema.fields
    obs = Observation("contract_capture")
    out = df.observe(obs, F.count(F.lit(1)).alias("n_rows"),
                     *[F.count_if(_q(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)])

    def finish() -> DataFrame:
        m = obs.get
        rows = [(table_name, version, "column", f.name, i, f.dataType.simpleString(), int(m[f"n{i}"]) > 0)
                for i, f in enumerate(fields)]
        rows += _setting_tuples(table_name, settings, version)
        return spark.createDataFrame(rows, CONTRACT_SCHEMA)
    return out, finish


def row_checks(df: DataFrame, contract: DataFrame, table_name: str) -> tuple[list[str], dict[str, T.DataType], Column]:
    """Row predicate form (V10): (columns of the contract in order, their types,
    a comma list of the checks each row breaks, '' when it keeps all)."""
    spark = df.sparkSession
    expected = _contract_columns(contract, table_name)
    have = set(df.columns)
    parts = []
    types = {}
    for name, tname, nullable in expected:
        dt = parse_type(spark, tname)
        types[name] = dt
        if name not in have:
            if not nullable:
                parts.append(F.lit(f"{name}:missing"))
            continue
        src = df.schema[name].dataType
        if src.simpleString() != tname:
            parts.append(F.when(_fails(df, name, dt, src), F.lit(f"{name}:type")))
        if not nullable:
            parts.append(F.when(_q(name).isNull(), F.lit(f"{name}:null")))
    reason = F.concat_ws(",", *parts) if parts else F.lit("")
    return [n for n, _, _ in expected], types, reason


def split_by_contract(df: DataFrame, contract: DataFrame, table_name: str) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the contract, coerced to its columns and types;
    rows that break it, as they came, with a ``_violations`` list).  One
    predicate decides both sides, so their counts add up to the input.
    Columns the contract does not know are not carried to the good side (the
    report flags them); absent nullable columns come back as nulls."""
    names, types, reason = row_checks(df, contract, table_name)
    flagged = df.withColumn(VIOLATIONS, reason)
    have = set(df.columns)
    src = {f.name: f.dataType for f in df.schema.fields}
    def coerced(n: str) -> Column:
        if n not in have or not castable(df, n, types[n]):
            # absent (nullable) column, or one whose rows all went to the bad side
            return F.lit(None).cast(types[n])
        return try_cast(_q(n), types[n], src[n])

    good = flagged.where(F.col(VIOLATIONS) == "").select(*[coerced(n).alias(n) for n in names])
    bad = flagged.where(F.col(VIOLATIONS) != "")
    return good, bad


def keeps_shape(df: DataFrame, contract: DataFrame, table_name: str) -> bool:
    """Whether the columns of ``df`` are the contract's, in order and type: rows
    that keep the contract then need no coercion."""
    expected = [(name, tname) for name, tname, _ in _contract_columns(contract, table_name)]
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == expected


def enforce(df: DataFrame, contract: DataFrame, table_name: str, on_violation: str = "fail",
            settings: dict[str, str] | None = None):
    """V9.  ``fail``: raise ContractViolation with the blocking findings.
    ``report``: return (df, findings).  ``quarantine``: return (good, bad, findings)."""
    report = check_contract(df, contract, table_name, settings)
    if on_violation == "fail":
        blocking = [r.asDict() for r in report.where("blocking").collect()]
        if blocking:
            raise ContractViolation(blocking)
        return df
    if on_violation == "report":
        return df, report
    if on_violation == "quarantine":
        good, bad = split_by_contract(df, contract, table_name)
        return good, bad, report
    raise ValueError("on_violation must be fail, report or quarantine")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
