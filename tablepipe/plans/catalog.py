"""The registered queries: one Spark callable per operator of the inventory,
each with the DuckDB SQL that must give the same rows.

Every query reads whole test tables (or frames Spark derives from them), so
its work grows with the scale factor.  Computed columns carry the same alias
on both sides; doubles that depend on summation order are rounded on both.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (cast_columns, cast_probe, clean, date_detection_report, detect_date_columns,
                         parse_date_columns, rename_columns, round_floats, safe_cast,
                         widen_date_columns)
from ..operators.contract import (capture_contract, catalog_schema_drift, check_contract,
                                  observed_schema, split_by_contract)
from ..operators.intervals import interval_join
from ..operators.profile import ROWS_MARK, footer_totals, load_plan, row_group_index, size_factors, string_length_stats
from ..operators.sample import head_fraction, keyed_sample, validation_rows
from ..operators.selection import exact_sample
from ..operators.sketches import merged_lengths, profile_new_files, rank_error
from ..session import scratch_path
from ..sinks import TargetExists, create_target, read_target, write_report, write_table
from ..sources import read_csv, row_counts, write_csv
from ..sources.csv_records import read_records, record_counts, record_index
from ..sources.files import CSV_OPTIONS
from ..sources.row_groups import CHUNK, load_chunks
from ..spec import JobSpec
from ..streaming import incremental_ingest, read_ingested, split_into_files
from .load import orchestrate, run_load
from .staged import staged_load
from .query import TEST_TABLES, avg_by_group, register_dir, run_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spark_round_sql(expr: str, digits: int) -> str:
    """DuckDB spelling of T6 rounding (half away from zero on the scaled value)."""
    return f"round({expr}, {digits})"


# --------------------------------------------------------------------------
# Q3 / flagship: clean customer, register it, average balance per segment.
# --------------------------------------------------------------------------
FLAGSHIP_SQL = """
SELECT c_mktsegment, ROUND(AVG(c_acctbal), 2) AS avg_acctbal, COUNT(*) AS n_customers
FROM customer_clean
GROUP BY c_mktsegment
ORDER BY avg_acctbal DESC, c_mktsegment
"""


@register("q3_avg_by_segment", """
SELECT c_mktsegment, ROUND(AVG(c_acctbal), 2) AS avg_acctbal, COUNT(*) AS n_customers
FROM customer GROUP BY c_mktsegment ORDER BY avg_acctbal DESC, c_mktsegment
""")
def q3_avg_by_segment(spark, sf_dir):
    cust = clean(table(spark, sf_dir, "customer"), column_naming="lower",
                 data_type={"C_NATIONKEY": "int32"}, date_format=True)
    cust.createOrReplaceTempView("customer_clean")
    return run_sql(spark, FLAGSHIP_SQL)


@register("q3_avg_by_segment_df", """
SELECT c_mktsegment, ROUND(AVG(c_acctbal), 4) AS avg_acctbal FROM customer GROUP BY c_mktsegment
""")
def q3_avg_by_segment_df(spark, sf_dir):
    out = avg_by_group(table(spark, sf_dir, "customer"), "c_mktsegment", "c_acctbal", "avg_acctbal")
    return out.withColumn("avg_acctbal", F.round("avg_acctbal", 4))


# --------------------------------------------------------------------------
# T1 rename
# --------------------------------------------------------------------------
@register("rename_upper", """
SELECT n_nationkey AS N_NATIONKEY, n_name AS N_NAME, n_regionkey AS N_REGIONKEY FROM nation
""")
def rename_upper(spark, sf_dir):
    return rename_columns(table(spark, sf_dir, "nation"), "upper")


@register("rename_capitalize", """
SELECT o_orderkey AS O_orderkey, o_custkey AS O_custkey, o_orderstatus AS O_orderstatus,
       o_totalprice AS O_totalprice, o_orderdate AS O_orderdate, o_orderpriority AS O_orderpriority
FROM orders
""")
def rename_capitalize(spark, sf_dir):
    return rename_columns(table(spark, sf_dir, "orders"), "capitalize")


@register("rename_lower", """
SELECT c_custkey AS c_custkey, c_name AS "full name", c_nationkey AS c_nationkey,
       c_acctbal AS c_acctbal, c_mktsegment AS c_mktsegment
FROM customer
""")
def rename_lower(spark, sf_dir):
    # Mixed-case names derived from the table, brought back by the rule.
    mixed = table(spark, sf_dir, "customer").toDF(
        "C_CustKey", "FULL Name", "c_NationKey", "C_ACCTBAL", "c_mktSegment")
    return rename_columns(mixed, "lower")


# --------------------------------------------------------------------------
# T2 / T2b casts
# --------------------------------------------------------------------------
LINEITEM_CAST_MAP = {
    "L_QUANTITY": "int8",       # source spelling in another case
    "l_linenumber": "INT8",     # type name in another case
    "l_suppkey": "int32",
    "l_partkey": "int64",
    "l_extendedprice": "float32",
    "l_tax": "float64",
    "l_returnflag": "utf8",
}


@register("cast_strict", """
SELECT l_orderkey, CAST(l_partkey AS BIGINT) AS l_partkey, CAST(l_suppkey AS INTEGER) AS l_suppkey,
       CAST(l_linenumber AS TINYINT) AS l_linenumber, CAST(trunc(l_quantity) AS TINYINT) AS l_quantity,
       CAST(l_extendedprice AS FLOAT) AS l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem
""")
def cast_strict(spark, sf_dir):
    return cast_columns(table(spark, sf_dir, "lineitem"), LINEITEM_CAST_MAP, "lower")


SAFE_CAST_MAP = {"l_partkey": "int8", "l_quantity": "int8"}


@register("cast_safe_good", """
SELECT l_orderkey, CAST(l_partkey AS TINYINT) AS l_partkey, l_suppkey, l_linenumber,
       CAST(trunc(l_quantity) AS TINYINT) AS l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem
WHERE TRY_CAST(l_partkey AS TINYINT) IS NOT NULL AND TRY_CAST(trunc(l_quantity) AS TINYINT) IS NOT NULL
""")
def cast_safe_good(spark, sf_dir):
    good, _ = safe_cast(table(spark, sf_dir, "lineitem"), SAFE_CAST_MAP)
    return good


@register("cast_safe_rejects", """
SELECT *, concat_ws(',', CASE WHEN TRY_CAST(l_partkey AS TINYINT) IS NULL THEN 'l_partkey' END,
                         CASE WHEN TRY_CAST(trunc(l_quantity) AS TINYINT) IS NULL THEN 'l_quantity' END)
          AS _reject_reason
FROM lineitem
WHERE TRY_CAST(l_partkey AS TINYINT) IS NULL OR TRY_CAST(trunc(l_quantity) AS TINYINT) IS NULL
""")
def cast_safe_rejects(spark, sf_dir):
    _, rejects = safe_cast(table(spark, sf_dir, "lineitem"), SAFE_CAST_MAP)
    return rejects


# --------------------------------------------------------------------------
# T3 / T4 dates
# --------------------------------------------------------------------------
def orders_as_text(spark, sf_dir) -> DataFrame:
    """orders with its date as ISO text, a year-only text and two plain texts."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate_txt"),
        F.date_format("o_orderdate", "yyyy").alias("o_year_txt"),
        "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey")


ORDERS_AS_TEXT_SQL = """
(SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate_txt,
        strftime(o_orderdate, '%Y') AS o_year_txt, o_orderstatus, o_orderpriority,
        o_totalprice, o_custkey
 FROM orders)
"""
_DATE_RX = r"^\s*\d{4}[-/]\d{1,2}[-/]\d{1,2}"


def _date_fail_sql(c: str) -> str:
    return (f"count_if({c} IS NOT NULL AND NOT coalesce(regexp_matches({c}, '{_DATE_RX}') "
            f"AND TRY_CAST(trim({c}) AS TIMESTAMP) IS NOT NULL, false))")


@register("date_detect", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null, {_date_fail_sql(c)} AS failures, "
    f"count({c}) > 0 AND {_date_fail_sql(c)} = 0 AS is_date FROM {ORDERS_AS_TEXT_SQL} t"
    for c in ("o_orderdate_txt", "o_year_txt", "o_orderstatus", "o_orderpriority")))
def date_detect(spark, sf_dir):
    return date_detection_report(orders_as_text(spark, sf_dir))


@register("date_parse", f"""
SELECT o_orderkey, CAST(o_orderdate_txt AS TIMESTAMP) AS o_orderdate_txt, o_year_txt,
       o_orderstatus, o_orderpriority, o_totalprice, o_custkey
FROM {ORDERS_AS_TEXT_SQL} t
""")
def date_parse(spark, sf_dir):
    df = orders_as_text(spark, sf_dir)
    return parse_date_columns(df, detect_date_columns(df))


@register("date_widen", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate, o_orderpriority
FROM orders
""")
def date_widen(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return widen_date_columns(o)


# --------------------------------------------------------------------------
# T6 rounding, T5 whole clean
# --------------------------------------------------------------------------
@register("round_floats", f"""
SELECT l_orderkey, l_linenumber, {spark_round_sql('l_quantity', 2)} AS l_quantity,
       {spark_round_sql('l_extendedprice', 2)} AS l_extendedprice,
       {spark_round_sql('l_discount', 2)} AS l_discount, {spark_round_sql('l_tax', 2)} AS l_tax,
       {spark_round_sql('l_extendedprice * l_discount', 2)} AS l_disc_amount,
       {spark_round_sql('l_extendedprice * (1 - l_discount) * (1 + l_tax)', 2)} AS l_charge
FROM lineitem
""")
def round_floats_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * F.col("l_discount")).alias("l_disc_amount"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("l_charge"))
    return round_floats(li, 2)


@register("clean_all", f"""
SELECT o_orderkey, CAST(o_orderdate_txt AS TIMESTAMP) AS o_orderdate_txt, o_year_txt,
       o_orderstatus, o_orderpriority, {spark_round_sql('o_totalprice', 1)} AS o_totalprice,
       CAST(o_custkey AS INTEGER) AS o_custkey
FROM {ORDERS_AS_TEXT_SQL} t
""")
def clean_all(spark, sf_dir):
    raw = orders_as_text(spark, sf_dir)
    shouty = raw.toDF(*[c.upper() for c in raw.columns])
    return clean(shouty, column_naming="lower", data_type={"O_CUSTKEY": "int32"},
                 date_format=True, decimal_precision=1)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_dir(spark, sf_dir, ("customer",))
    return q3_avg_by_segment(spark, sf_dir)


@register("cast_probe", """
SELECT 'l_partkey' AS column_name, 'tinyint' AS target_type,
       count_if(TRY_CAST(l_partkey AS TINYINT) IS NULL) AS failures FROM lineitem
UNION ALL
SELECT 'l_quantity', 'tinyint', count_if(TRY_CAST(trunc(l_quantity) AS TINYINT) IS NULL) FROM lineitem
UNION ALL
SELECT 'l_suppkey', 'int', count_if(TRY_CAST(l_suppkey AS INTEGER) IS NULL) FROM lineitem
""")
def cast_probe_q(spark, sf_dir):
    return cast_probe(table(spark, sf_dir, "lineitem"),
                      {"L_PARTKEY": "int8", "l_quantity": "Int8", "l_suppkey": "int32"})


# --------------------------------------------------------------------------
# V3-V10 contract
# --------------------------------------------------------------------------

EVENT_TYPES = [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"),
               ("event_type", "string"), ("value", "double"), ("props", "string")]
DEFAULT_SETTINGS = JobSpec().settings()


@register("contract_capture", " UNION ALL ".join(
    [f"SELECT 'events' AS table_name, 1 AS version, 'column' AS kind, '{n}' AS name, {i} AS ordinal, "
     f"'{t}' AS value, count_if({n} IS NULL) > 0 AS nullable FROM events"
     for i, (n, t) in enumerate(EVENT_TYPES)]
    + [f"SELECT 'events', 1, 'setting', '{k}', {i}, '{v}', false"
       for i, (k, v) in enumerate(sorted(DEFAULT_SETTINGS.items()))]))
def contract_capture(spark, sf_dir):
    return capture_contract(table(spark, sf_dir, "events"), "events", 1, DEFAULT_SETTINGS)


def orders_drifted(spark, sf_dir) -> DataFrame:
    """orders with a dropped column, an added one, two changed types, reordered."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_totalprice").cast("int").alias("o_totalprice"),
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus", "o_orderdate",
        F.concat(F.lit("note-"), F.col("o_orderkey").cast("string")).alias("o_comment"))


ORDERS_DRIFT_SQL = """
SELECT 'orders' AS table_name, 'o_totalprice' AS column_name, 'type_changed' AS finding,
       'double' AS expected, 'int' AS observed,
       count_if(TRY_CAST(CAST(o_totalprice AS INTEGER) AS DOUBLE) IS NULL) AS bad_rows,
       count_if(TRY_CAST(CAST(o_totalprice AS INTEGER) AS DOUBLE) IS NULL) > 0 AS blocking
FROM orders
UNION ALL
SELECT 'orders', 'o_custkey', 'type_changed', 'bigint', 'string',
       count_if(TRY_CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) IS NULL),
       count_if(TRY_CAST(CAST(o_custkey AS VARCHAR) AS BIGINT) IS NULL) > 0 FROM orders
UNION ALL
SELECT 'orders', 'o_orderpriority', 'missing_column', 'string', NULL, count(*), true FROM orders
UNION ALL
SELECT 'orders', 'o_comment', 'unexpected_column', NULL, 'string', count(*), true FROM orders
"""


@register("contract_schema_drift", ORDERS_DRIFT_SQL)
def contract_schema_drift(spark, sf_dir):
    base = table(spark, sf_dir, "orders")
    contract = capture_contract(base, "orders")
    return check_contract(orders_drifted(spark, sf_dir), contract, "orders")


def orders_planted(spark, sf_dir) -> DataFrame:
    """orders with keys as text (some not numeric) and some missing prices."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 97 == 0, F.concat(F.lit("x"), F.col("o_custkey").cast("string")))
         .otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 101 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority")


ORDERS_PLANTED_SQL = """
(SELECT o_orderkey,
        CASE WHEN o_orderkey % 97 = 0 THEN 'x' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END
          AS o_custkey,
        o_orderstatus,
        CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority
 FROM orders)
"""


@register("contract_value_check", f"""
SELECT 'orders' AS table_name, 'o_custkey' AS column_name, 'type_changed' AS finding,
       'bigint' AS expected, 'string' AS observed,
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL) AS bad_rows,
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL) > 0 AS blocking
FROM {ORDERS_PLANTED_SQL} p
UNION ALL
SELECT 'orders', 'o_totalprice', 'null_values', 'not null', 'double',
       count_if(o_totalprice IS NULL), count_if(o_totalprice IS NULL) > 0
FROM {ORDERS_PLANTED_SQL} p
""")
def contract_value_check(spark, sf_dir):
    contract = capture_contract(table(spark, sf_dir, "orders"), "orders")
    return check_contract(orders_planted(spark, sf_dir), contract, "orders")


_PLANTED_VIOLATIONS_SQL = ("concat_ws(',', CASE WHEN TRY_CAST(o_custkey AS BIGINT) IS NULL THEN 'o_custkey:type' END, "
                           "CASE WHEN o_totalprice IS NULL THEN 'o_totalprice:null' END)")


@register("contract_quarantine", f"""
SELECT *, {_PLANTED_VIOLATIONS_SQL} AS _violations FROM {ORDERS_PLANTED_SQL} p
WHERE TRY_CAST(o_custkey AS BIGINT) IS NULL OR o_totalprice IS NULL
""")
def contract_quarantine(spark, sf_dir):
    contract = capture_contract(table(spark, sf_dir, "orders"), "orders")
    _, bad = split_by_contract(orders_planted(spark, sf_dir), contract, "orders")
    return bad


@register("contract_good_rows", f"""
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority
FROM {ORDERS_PLANTED_SQL} p
WHERE TRY_CAST(o_custkey AS BIGINT) IS NOT NULL AND o_totalprice IS NOT NULL
""")
def contract_good_rows(spark, sf_dir):
    contract = capture_contract(table(spark, sf_dir, "orders"), "orders")
    good, _ = split_by_contract(orders_planted(spark, sf_dir), contract, "orders")
    return good


@register("contract_catalog_drift", """
SELECT 'orders' AS table_name, 'o_totalprice' AS column_name, 'type_changed' AS finding,
       'double' AS expected, 'int' AS observed
UNION ALL SELECT 'orders', 'o_custkey', 'type_changed', 'bigint', 'string'
UNION ALL SELECT 'orders', 'o_orderpriority', 'missing_column', 'string', NULL
UNION ALL SELECT 'orders', 'o_comment', 'unexpected_column', NULL, 'string'
UNION ALL SELECT 'lineitem', 'l_tax', 'missing_column', 'double', NULL
UNION ALL SELECT 'customer', 'c_phone', 'unexpected_column', NULL, 'string'
""")
def contract_catalog_drift(spark, sf_dir):
    contracts = reduce(DataFrame.unionByName,
                       [capture_contract(table(spark, sf_dir, t), t, nullable_from_data=False) for t in TEST_TABLES])
    now = {t: table(spark, sf_dir, t) for t in TEST_TABLES}
    now["orders"] = orders_drifted(spark, sf_dir)
    now["lineitem"] = now["lineitem"].drop("l_tax")
    now["customer"] = now["customer"].withColumn(
        "c_phone", F.concat(F.lit("555-"), F.col("c_custkey").cast("string")))
    observed = reduce(DataFrame.unionByName,
                      [observed_schema(spark, t, df.schema) for t, df in now.items()])
    return catalog_schema_drift(contracts, observed)


# --------------------------------------------------------------------------
# K2-K4 sinks, S1 CSV, S9 counts
# --------------------------------------------------------------------------


@register("sink_modes", """
SELECT 1 AS step, 'replace' AS mode, 'written' AS outcome, count(*) AS rows_after FROM orders
UNION ALL SELECT 2, 'append', 'written', 2 * count(*) FROM orders
UNION ALL SELECT 3, 'fail', 'refused', 2 * count(*) FROM orders
UNION ALL SELECT 4, 'replace', 'written', count(*) FROM orders
""")
def sink_modes(spark, sf_dir):
    src = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "sink-modes")
    steps = []
    for step, mode in enumerate(["replace", "append", "fail", "replace"], start=1):
        try:
            write_table(src, target, mode)
            outcome = "written"
        except TargetExists:
            outcome = "refused"
        steps.append((step, mode, outcome, read_target(spark, target).count()))
    return spark.createDataFrame(steps, "step int, mode string, outcome string, rows_after bigint")


@register("sink_roundtrip", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_roundtrip(spark, sf_dir):
    src = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "sink-roundtrip")
    write_table(src, target, "replace")
    write_table(src, target, "append")
    return read_target(spark, target)


@register("csv_roundtrip", "SELECT * FROM documents")
def csv_roundtrip(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(docs, path)
    # the texts hold quoted newlines: records span lines
    return read_csv(spark, path, schema=docs.schema, multiline=True)


@register("row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in (
        "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations")))
def row_counts_q(spark, sf_dir):
    return row_counts({t: table(spark, sf_dir, t) for t in TEST_TABLES})


# --------------------------------------------------------------------------
# L2 samples
# --------------------------------------------------------------------------

# (l_orderkey, l_linenumber) repeats in the test data, so the order runs over
# every column: ties are then whole-row duplicates and the row set is unique.
LINEITEM_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                  "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                  "l_shipdate"]
_HEAD_SQL = """
SELECT * FROM lineitem ORDER BY {order}
LIMIT (SELECT CAST(floor(count(*) * {f}) AS BIGINT) FROM lineitem)
""".replace("{order}", ", ".join(LINEITEM_ORDER))


@register("sample_head", _HEAD_SQL.format(f=0.01))
def sample_head(spark, sf_dir):
    return head_fraction(table(spark, sf_dir, "lineitem"), 0.01, LINEITEM_ORDER)


@register("sample_head_ranged", _HEAD_SQL.format(f=0.5))
def sample_head_ranged(spark, sf_dir):
    # Half the table: large enough to take the range-partitioned path.
    return head_fraction(table(spark, sf_dir, "lineitem"), 0.5, LINEITEM_ORDER, topk_max_rows=1000)


@register("sample_keyed", f"""
SELECT * FROM lineitem
WHERE ('0x' || substr(md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), 1, 8))::BIGINT
      < {int(0.1 * (1 << 32))}
""")
def sample_keyed(spark, sf_dir):
    return keyed_sample(table(spark, sf_dir, "lineitem"), 0.1, ["l_orderkey", "l_linenumber"])


def _exact_sql(name: str, fraction: float, keys: list[str]) -> str:
    text = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"""
SELECT * EXCLUDE (_place, _rows) FROM (
  SELECT *, row_number() OVER (ORDER BY substr(md5(concat_ws('|', {text})), 1, 12)) AS _place, count(*) OVER () AS _rows FROM {name})
WHERE _place <= CAST(floor(_rows * {fraction}) AS BIGINT)"""


@register("sample_exact", _exact_sql("documents", 0.35, ["doc_id"]))
def sample_exact(spark, sf_dir):
    """Exactly the share of the documents, with their whole texts."""
    return exact_sample(table(spark, sf_dir, "documents"), 0.35, ["doc_id"])


# Rows that repeat all four keys can only matter where the cut falls among them.
EXACT_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@register("sample_exact_lines", _exact_sql("lineitem", 0.1, EXACT_LINE_KEYS))
def sample_exact_lines(spark, sf_dir):
    return validation_rows(table(spark, sf_dir, "lineitem"), 0.1, EXACT_LINE_KEYS, exact=True)


# --------------------------------------------------------------------------
# S5, P1-P14 size profile
# --------------------------------------------------------------------------

ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
# Fixture for the oracles: the text columns of each test table.
STRING_COLUMNS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"],
    "supplier": ["s_name"], "part": ["p_name", "p_brand", "p_type"],
    "orders": ["o_orderstatus", "o_orderpriority"], "lineitem": ["l_returnflag", "l_linestatus"],
    "events": ["event_type", "props"], "documents": ["text", "lang", "source"], "embeddings": [],
    "pages": ["url", "html"], "benchmark": ["text"], "labels": [], "conversations": ["role", "text"],
}
ORACLE_SF_DIR = "/root/testdata/sf0.01"


def _stats_sql(tables) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS n_values, "
        f"median(strlen({c})) AS median_len, avg(strlen({c})) AS avg_len FROM {t}"
        for t in tables for c in STRING_COLUMNS[t])


def _tables(spark, sf_dir, names):
    return {t: table(spark, sf_dir, t) for t in names}


@register("string_length_stats",
          f"SELECT table_name, column_name, n_values, median_len, round(avg_len, 6) AS avg_len "
          f"FROM ({_stats_sql(['customer', 'documents', 'pages', 'conversations'])}) s")
def string_length_stats_q(spark, sf_dir):
    st = string_length_stats(_tables(spark, sf_dir, ["customer", "documents", "pages", "conversations"]))
    return round_floats(st.where(F.col("column_name") != ROWS_MARK), 6, ["avg_len"])


@register("length_sketches", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 2 * count({c}) AS n_values, 2 * CAST(sum(strlen({c})) AS BIGINT) AS total_len, max(strlen({c})) AS max_len, "
    f"round(avg(strlen({c})), 6) AS avg_len, true AS median_within_error, 3 AS files_first, 2 AS files_second, 0 AS files_third FROM documents"
    for c in STRING_COLUMNS["documents"]))
def length_sketches_q(spark, sf_dir):
    """The documents arrive in three files, then once more in two: each profile
    reads new files only, and the merged median is held against the exact ranks."""
    docs, source, store = table(spark, sf_dir, "documents"), scratch_path(spark, "lengths-in"), scratch_path(spark, "lengths-kept")
    read = []
    for when, files in (("first", 3), ("second", 2), (None, 0)):
        parts = split_into_files(docs, f"{source}/{when}", files) if files else 1
        new = profile_new_files(spark, source, store)
        read.append(new if new % parts else new // parts)      # files; a large one comes in equal parts
    merged = merged_lengths(spark, source, store).where(F.col("column_name") != ROWS_MARK).drop("sketch")
    medians = {r["column_name"]: r["median_len"] for r in merged.select("column_name", "median_len").collect()}   # one a column
    lengths = {c: F.octet_length(c) for c in medians}
    ranks = docs.agg(*[f(lengths[c], m) for c, m in medians.items() for f in (
        lambda x, m: F.count_if(x < m) / F.count(x), lambda x, m: F.count_if(x <= m) / F.count(x))]).first()
    within = {c: ranks[2 * i] - rank_error() <= 0.5 <= ranks[2 * i + 1] + rank_error() for i, c in enumerate(medians)}
    checked = F.create_map(*[F.lit(v) for pair in within.items() for v in pair])[F.col("column_name")]
    return round_floats(merged, 6, ["avg_len"]).select(
        "column_name", "n_values", "total_len", "max_len", "avg_len", checked.alias("median_within_error"),
        *[F.lit(n).alias(f"files_{when}") for n, when in zip(read, ("first", "second", "third"))])


def _factors_sql(tables) -> str:
    names = ", ".join(f"'{t}'" for t in tables)
    rows = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in tables)
    return f"""
WITH kinds AS (
  SELECT table_name, column_name,
    CASE data_type WHEN 'TINYINT' THEN 'int8' WHEN 'SMALLINT' THEN 'int16' WHEN 'INTEGER' THEN 'int32'
      WHEN 'BIGINT' THEN 'int64' WHEN 'FLOAT' THEN 'float32' WHEN 'DOUBLE' THEN 'float64'
      WHEN 'BOOLEAN' THEN 'bool' WHEN 'DATE' THEN 'date' WHEN 'TIMESTAMP' THEN 'timestamp'
      WHEN 'VARCHAR' THEN 'string'
      ELSE CASE WHEN data_type LIKE '%[]' THEN 'list' WHEN data_type LIKE 'STRUCT%' THEN 'struct'
                ELSE 'other' END END AS kind
  FROM information_schema.columns WHERE table_name IN ({names})),
w AS (
  SELECT table_name, kind,
    CASE kind WHEN 'int8' THEN 1.4 WHEN 'int16' THEN 1.45 WHEN 'int32' THEN 1.5 WHEN 'int64' THEN 1.55
      WHEN 'float32' THEN 1.6 WHEN 'float64' THEN 1.65 WHEN 'bool' THEN 2.5 WHEN 'date' THEN 1.8
      WHEN 'timestamp' THEN 1.85 WHEN 'list' THEN 2.5 WHEN 'struct' THEN 2.8 ELSE 1.7 END AS text_f,
    CASE kind WHEN 'int8' THEN 1 WHEN 'int16' THEN 2 WHEN 'int32' THEN 4 WHEN 'int64' THEN 8
      WHEN 'float32' THEN 4 WHEN 'float64' THEN 8 WHEN 'timestamp' THEN 8 WHEN 'date' THEN 4
      WHEN 'bool' THEN 1 END AS vbytes,
    CASE kind WHEN 'int8' THEN 1.2 WHEN 'int16' THEN 1.25 WHEN 'int32' THEN 1.3 WHEN 'int64' THEN 1.35
      WHEN 'float32' THEN 1.4 WHEN 'float64' THEN 1.45 WHEN 'bool' THEN 2.0 WHEN 'date' THEN 1.5
      WHEN 'timestamp' THEN 1.55 WHEN 'list' THEN 2.2 WHEN 'struct' THEN 2.5 ELSE 1.7 END AS pq_f,
    CASE WHEN kind IN ('int8', 'int16', 'int32', 'int64') THEN 1.3 WHEN kind IN ('float32', 'float64') THEN 1.4
      WHEN kind = 'bool' THEN 2.0 WHEN kind IN ('date', 'timestamp') THEN 1.5 WHEN kind = 'list' THEN 2.2
      END AS pq9_f
  FROM kinds),
facts AS (
  SELECT table_name, count(*) AS n_cols, count_if(kind = 'string') AS n_str,
    coalesce(sum(text_f) FILTER (WHERE kind <> 'string'), 0) AS text_fixed,
    coalesce(sum(vbytes) FILTER (WHERE kind <> 'string'), 0) AS bytes_fixed,
    count_if(kind <> 'string' AND vbytes IS NULL) AS n_bytes_other,
    coalesce(sum(pq_f) FILTER (WHERE kind <> 'string'), 0) AS pq_fixed,
    coalesce(sum(pq9_f) FILTER (WHERE kind <> 'string'), 0) AS pq9_fixed,
    count_if(kind <> 'string' AND pq9_f IS NULL) AS n_pq9_other
  FROM w GROUP BY table_name),
sstats AS ({_stats_sql(tables) or "SELECT NULL AS table_name, NULL AS median_len, NULL AS avg_len"}),
nrows AS ({rows}),
per AS (SELECT table_name, avg(median_len) AS mm, sum(median_len) AS sm, avg(avg_len) AS ma
        FROM sstats GROUP BY table_name),
g AS (
  SELECT f.*, r.n_rows, p.mm, p.sm, p.ma,
    CASE WHEN p.mm IS NULL THEN 1.0 WHEN p.mm <= 1 THEN 2.0 WHEN p.mm <= 5 THEN 1.8 WHEN p.mm <= 10 THEN 1.6
         WHEN p.mm <= 20 THEN 1.4 WHEN p.mm <= 50 THEN 1.2 ELSE 1.1 END AS p2,
    greatest(coalesce(p.sm, 0), 32) AS p4,
    CASE WHEN p.ma IS NULL THEN 1.0
         WHEN greatest(1, p.ma) < 5 THEN least(1 + 4 / greatest(1, p.ma) + 0.4, 2.2)
         WHEN greatest(1, p.ma) < 10 THEN 1 + 4 / greatest(1, p.ma) + 0.2
         WHEN greatest(1, p.ma) < 20 THEN 1 + 4 / greatest(1, p.ma) + 0.1
         ELSE 1 + 4 / greatest(1, p.ma) + 0.05 END AS p7
  FROM facts f JOIN nrows r USING (table_name) LEFT JOIN per p USING (table_name)),
h AS (
  SELECT *, (text_fixed + n_str * p2) / n_cols AS p3,
         (bytes_fixed + n_str * p4 + n_bytes_other * 16) / n_cols AS p5,
         (pq_fixed + n_str * p7) / n_cols AS p8
  FROM g),
factors AS (
  SELECT table_name, n_rows, n_cols, n_str, mm AS mean_median_len, p2 AS text_string_factor,
         p4 AS string_width, ma AS mean_value_len, p7 AS parquet_string_factor, p3 AS text_type_factor,
         p5 AS mean_value_bytes, bytes_fixed + n_str * p4 + n_bytes_other * p5 AS row_bytes,
         p8 AS parquet_type_factor, (pq9_fixed + n_str * p7 + n_pq9_other * p8) / n_cols AS parquet_coarse_factor
  FROM h)"""


_FACTOR_COLS = ["n_rows", "n_cols", "n_str", "mean_median_len", "text_string_factor", "string_width",
                "mean_value_len", "parquet_string_factor", "text_type_factor", "mean_value_bytes",
                "row_bytes", "parquet_type_factor", "parquet_coarse_factor"]
_INT_COLS = {"n_rows", "n_cols", "n_str"}


def _rounded_sql(cols, digits=6):
    return ", ".join(c if c in _INT_COLS or c in ("table_name", "format", "decision", "load_mode",
                                                   "file_bytes", "uncompressed_bytes", "chunk_rows")
                     else f"round(CAST({c} AS DOUBLE), {digits}) AS {c}" for c in cols)


@register("size_factors", _factors_sql(ALL_TABLES)
          + f" SELECT table_name, {_rounded_sql(_FACTOR_COLS)} FROM factors")
def size_factors_q(spark, sf_dir):
    return round_floats(size_factors(spark, _tables(spark, sf_dir, ALL_TABLES)), 6)


@register("string_bytes_profile", _factors_sql(["customer"])
          + " SELECT table_name, round(mean_median_len, 6) AS mean_median_len,"
            " round(text_string_factor, 6) AS text_string_factor, round(string_width, 6) AS string_width FROM factors")
def string_bytes_profile(spark, sf_dir):
    f = size_factors(spark, _tables(spark, sf_dir, ["customer"]))
    return round_floats(f.select("table_name", "mean_median_len", "text_string_factor", "string_width"), 6)


@register("parquet_string_factor", _factors_sql(["documents"])
          + " SELECT table_name, round(mean_value_len, 6) AS mean_value_len,"
            " round(parquet_string_factor, 6) AS parquet_string_factor FROM factors")
def parquet_string_factor_q(spark, sf_dir):
    f = size_factors(spark, _tables(spark, sf_dir, ["documents"]))
    return round_floats(f.select("table_name", "mean_value_len", "parquet_string_factor"), 6)


_FOOTER_SQL = f"""
footers AS (
  SELECT regexp_extract(file_name, '([^/]+)\\.parquet$', 1) AS table_name,
         count(DISTINCT file_name) AS files,
         CAST(sum(total_uncompressed_size) AS BIGINT) AS uncompressed_bytes,
         count(DISTINCT (file_name, row_group_id)) AS num_row_groups
  FROM parquet_metadata('{ORACLE_SF_DIR}/*.parquet') GROUP BY 1),
rg AS (
  SELECT regexp_extract(file_name, '([^/]+)\\.parquet$', 1) AS table_name, CAST(sum(n) AS BIGINT) AS num_rows
  FROM (SELECT DISTINCT file_name, row_group_id, row_group_num_rows AS n
        FROM parquet_metadata('{ORACLE_SF_DIR}/*.parquet')) GROUP BY 1),
sizes AS (
  SELECT regexp_extract(filename, '([^/]+)\\.parquet$', 1) AS table_name, CAST(sum(size) AS BIGINT) AS file_bytes
  FROM read_blob('{ORACLE_SF_DIR}/*.parquet') GROUP BY 1)"""


@register("footer_bytes", f"""
WITH {_FOOTER_SQL}
SELECT f.table_name, f.files, s.file_bytes, r.num_rows, f.num_row_groups, f.uncompressed_bytes
FROM footers f JOIN rg r USING (table_name) JOIN sizes s USING (table_name)
""")
def footer_bytes(spark, sf_dir):
    return footer_totals(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ALL_TABLES})


@register("row_group_index", f"""
WITH c AS (
  SELECT regexp_extract(file_name, '([^/]+)\\.parquet$', 1) AS table_name, row_group_id, replace(path_in_schema, ', ', '.') AS column_path,
         type, row_group_num_rows, num_values, stats_null_count, total_compressed_size, total_uncompressed_size,
         CASE WHEN stats_max_value IS NOT NULL THEN stats_min_value END AS lo,
         CASE WHEN stats_min_value IS NOT NULL THEN stats_max_value END AS hi
  FROM parquet_metadata('{ORACLE_SF_DIR}/*.parquet'))
SELECT table_name, CAST(row_group_id AS INTEGER) AS row_group, column_path, type AS physical_type,
       CAST(row_group_num_rows AS BIGINT) AS num_rows, CAST(num_values AS BIGINT) AS num_values,
       CAST(stats_null_count AS BIGINT) AS null_count, CAST(total_compressed_size AS BIGINT) AS compressed_bytes,
       CAST(total_uncompressed_size AS BIGINT) AS uncompressed_bytes,
       CASE type WHEN 'BYTE_ARRAY' THEN NULL WHEN 'FLOAT' THEN CAST(TRY_CAST(lo AS FLOAT) AS DOUBLE)
            ELSE coalesce(TRY_CAST(lo AS DOUBLE), CAST(epoch_us(TRY_CAST(lo AS TIMESTAMP)) AS DOUBLE)) END AS min_number,
       CASE type WHEN 'BYTE_ARRAY' THEN NULL WHEN 'FLOAT' THEN CAST(TRY_CAST(hi AS FLOAT) AS DOUBLE)
            ELSE coalesce(TRY_CAST(hi AS DOUBLE), CAST(epoch_us(TRY_CAST(hi AS TIMESTAMP)) AS DOUBLE)) END AS max_number,
       CASE type WHEN 'BYTE_ARRAY' THEN lo END AS min_text, CASE type WHEN 'BYTE_ARRAY' THEN hi END AS max_text
FROM c
""")
def row_group_index_q(spark, sf_dir):
    index = row_group_index(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ALL_TABLES])
    return index.withColumn("table_name", F.regexp_extract("path", r"([^/]+)\.parquet(/[^/]*)?$", 1)).withColumnRenamed("column", "column_path").drop("path")


TASK_ROWS = 250_000


@register("row_group_chunks", """
SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_keys,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
       true AS resumed, 0 AS batches_left
FROM lineitem GROUP BY l_returnflag
""")
def row_group_chunks_q(spark, sf_dir):
    """Files of many row groups (one a task: a small table is one file), loaded chunk by
    chunk; the first run dies between a batch's data and its entry, the second goes on, a
    third has nothing left."""
    lines = table(spark, sf_dir, "lineitem")
    source, target, progress = (scratch_path(spark, f"chunks-{n}") for n in ("source", "target", "progress"))
    lines.write.option("parquet.block.size", 256 * 1024).parquet(source)
    index = row_group_index(spark, source)

    def cut(batch: int) -> None:
        if batch:
            raise InterruptedError(f"cut short in batch {batch}")

    rows = lines.count()
    # A chunk is a task's share and does not grow with the table; there are more of them in a batch.
    arguments = (spark, index, lines.schema, target, progress, max(min(rows // 16, TASK_ROWS), 1), max(rows // 4, 1))
    try:
        load_chunks(*arguments, after_batch=cut)
        resumed = False
    except InterruptedError:
        resumed = load_chunks(*arguments) >= 1
    left = load_chunks(*arguments)
    loaded = spark.read.parquet(target).drop(CHUNK)
    return loaded.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("l_orderkey", "l_linenumber").alias("n_keys"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("sum_qty"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        F.lit(resumed).alias("resumed"), F.lit(left).alias("batches_left"))


# Windows of minutes (every 500th: of days) after the 25th year of an order's date.
_ORDER_WINDOWS = ("SELECT o_orderkey, o_custkey, o_orderdate + INTERVAL 9131 DAYS + {minutes} AS w_start, "
                  "o_orderdate + INTERVAL 9131 DAYS + {minutes} + {length} AS w_end FROM orders")
_WINDOWS_SPARK = _ORDER_WINDOWS.format(
    minutes="make_dt_interval(0, 0, o_orderkey % 1440, 0)",
    length="make_dt_interval(0, 0, CASE WHEN o_orderkey % 500 = 0 THEN 4320 ELSE 1 + o_custkey % 30 END, 0)")
_WINDOWS_DUCK = _ORDER_WINDOWS.format(
    minutes="to_minutes(o_orderkey % 1440)",
    length="to_minutes(CASE WHEN o_orderkey % 500 = 0 THEN 4320 ELSE 1 + o_custkey % 30 END)")


def _order_windows(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("orders")
    return spark.sql(_WINDOWS_SPARK)


@register("interval_join", f"""
SELECT e.event_id, w.o_orderkey, w.w_start, w.w_end
FROM events e JOIN ({_WINDOWS_DUCK}) w ON e.ts >= w.w_start AND e.ts < w.w_end
""")
def interval_join_q(spark, sf_dir):
    pairs = interval_join(table(spark, sf_dir, "events").select("event_id", "ts"), _order_windows(spark, sf_dir), "ts", "w_start", "w_end")
    return pairs.select("p.event_id", "i.o_orderkey", "i.w_start", "i.w_end")


@register("interval_join_keyed", f"""
SELECT e.event_type, count(*) AS n_pairs, count(DISTINCT e.event_id) AS n_events
FROM events e JOIN (SELECT o_custkey, w_start, w_start + INTERVAL 200 DAYS AS w_end FROM ({_WINDOWS_DUCK})) w
  ON e.user_id = w.o_custkey AND e.ts BETWEEN w.w_start AND w.w_end
GROUP BY e.event_type
""")
def interval_join_keyed(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "ts")
    windows = _order_windows(spark, sf_dir).withColumn("w_end", F.expr("w_start + INTERVAL 200 DAYS"))
    pairs = interval_join(events, windows, "ts", "w_start", "w_end", keys=[("user_id", "o_custkey")], closed=True)
    return pairs.groupBy(F.col("p.event_type").alias("event_type")).agg(
        F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("p.event_id").alias("n_events"))


LOAD_BUDGET_BYTES = 2 * 1024 * 1024
_PLAN_COLS = ["table_name", "format", "n_rows", "file_bytes", "uncompressed_bytes", "text_type_factor",
              "row_bytes", "parquet_coarse_factor", "estimated_bytes", "ratio", "decision", "load_mode",
              "chunk_fraction", "chunk_rows"]


@register("load_plan", _factors_sql(ALL_TABLES) + f""",
{_FOOTER_SQL},
est AS (
  SELECT fa.*, 'parquet' AS format, s.file_bytes, f.uncompressed_bytes,
         fa.parquet_coarse_factor * f.uncompressed_bytes AS estimated_bytes,
         fa.parquet_coarse_factor * f.uncompressed_bytes / {float(LOAD_BUDGET_BYTES)} AS ratio
  FROM factors fa JOIN footers f USING (table_name) JOIN sizes s USING (table_name)),
dec AS (
  SELECT *, CASE WHEN ratio <= 0.65 THEN 'eager' WHEN ratio <= 2.0 THEN 'lazy' ELSE 'streaming' END AS decision,
         CASE WHEN ratio > 5 THEN 0.15 WHEN ratio > 2 THEN 0.25 WHEN ratio > 0.5 THEN 0.40 ELSE 0.70 END
           AS chunk_fraction
  FROM est)
SELECT {_rounded_sql(_PLAN_COLS)}
FROM (SELECT *, CASE WHEN decision = 'streaming' THEN 'incremental' ELSE 'batch' END AS load_mode,
             least(greatest(CAST(floor(n_rows * chunk_fraction) AS BIGINT), 10000), n_rows) AS chunk_rows
      FROM dec) x
""")
def load_plan_q(spark, sf_dir):
    inputs = {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ALL_TABLES}
    return round_floats(load_plan(spark, inputs, LOAD_BUDGET_BYTES), 6)


# --------------------------------------------------------------------------
# I1-I5 incremental ingest, M1 run report
# --------------------------------------------------------------------------


@register("incremental_ingest", """
SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, round(value, 1) AS value, props
FROM events
""")
def incremental_ingest_q(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    source = scratch_path(spark, "events-files")
    split_into_files(events, source, 4)
    target = scratch_path(spark, "events-ingested")
    contract = capture_contract(events, "events")
    incremental_ingest(spark, source, target, data_type={"user_id": "int32"}, decimal_precision=1,
                       mode="replace", contract=contract, table_name="events",
                       on_violation="report", max_files_per_trigger=1)
    return read_ingested(spark, target)


@register("run_report", f"""
SELECT 1 AS run, 'orders' AS table_name, count(*) AS rows_in, count(*) AS rows_written,
       CAST(0 AS BIGINT) AS rows_rejected, CAST(0 AS BIGINT) AS findings, CAST(0 AS BIGINT) AS blocking,
       true AS contract_created
FROM orders
UNION ALL
SELECT 2, 'orders', count(*),
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NOT NULL AND o_totalprice IS NOT NULL),
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL OR o_totalprice IS NULL),
       2, 2, false
FROM {ORDERS_PLANTED_SQL} p
""")
def run_report(spark, sf_dir):
    contracts = scratch_path(spark, "contracts")
    target = scratch_path(spark, "orders-target")
    first = run_load(spark, JobSpec(table_name="orders", if_table_exists="replace", date_format=False),
                     contracts, target=target, source=table(spark, sf_dir, "orders"))
    second = run_load(spark, JobSpec(table_name="orders", if_table_exists="append", date_format=False,
                                     on_violation="quarantine"),
                      contracts, target=target, source=orders_planted(spark, sf_dir),
                      quarantine_target=scratch_path(spark, "orders-quarantine"))
    both = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return both.drop("seconds")


# --------------------------------------------------------------------------
# S1 + T2/T3 end to end: a text table cleaned back to types; S7 CSV stream
# --------------------------------------------------------------------------
@register("csv_text_clean", "SELECT * FROM orders")
def csv_text_clean(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "orders-csv")
    write_csv(orders, path)
    text = read_csv(spark, path)            # every column is text
    return clean(text, column_naming="lower",
                 data_type={"o_orderkey": "int64", "o_custkey": "int64", "o_totalprice": "float64"},
                 date_format=True)


@register("incremental_csv", """
SELECT event_id AS EVENT_ID, ts AS TS, user_id AS USER_ID, event_type AS EVENT_TYPE, value AS VALUE,
       props AS PROPS
FROM events
""")
def incremental_csv(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    source = scratch_path(spark, "events-csv")
    write_csv(events.repartition(3), source)
    target = scratch_path(spark, "events-csv-ingested")
    incremental_ingest(spark, source, target, fmt="csv", schema=events.schema, column_naming="upper",
                       mode="fail", max_files_per_trigger=1)
    return read_ingested(spark, target)


# --------------------------------------------------------------------------
# V7 sampled check, V5+V6+V8 together
# --------------------------------------------------------------------------

_MD5_SAMPLE_SQL = ("('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT < "
                   f"{int(0.25 * (1 << 32))}")


@register("contract_sampled_check", f"""
SELECT 'orders' AS table_name, 'o_custkey' AS column_name, 'type_changed' AS finding,
       'bigint' AS expected, 'string' AS observed,
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL) AS bad_rows,
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL) > 0 AS blocking
FROM {ORDERS_PLANTED_SQL} p WHERE {_MD5_SAMPLE_SQL}
UNION ALL
SELECT 'orders', 'o_totalprice', 'null_values', 'not null', 'double',
       count_if(o_totalprice IS NULL), count_if(o_totalprice IS NULL) > 0
FROM {ORDERS_PLANTED_SQL} p WHERE {_MD5_SAMPLE_SQL}
""")
def contract_sampled_check(spark, sf_dir):
    contract = capture_contract(table(spark, sf_dir, "orders"), "orders")
    sample = validation_rows(orders_planted(spark, sf_dir), 0.25, ["o_orderkey"])
    return check_contract(sample, contract, "orders")


@register("contract_full_check", f"""
SELECT 'orders' AS table_name, 'o_custkey' AS column_name, 'type_changed' AS finding,
       'bigint' AS expected, 'string' AS observed,
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL) AS bad_rows,
       count_if(TRY_CAST(o_custkey AS BIGINT) IS NULL) > 0 AS blocking
FROM {ORDERS_PLANTED_SQL} p
UNION ALL
SELECT 'orders', 'o_totalprice', 'null_values', 'not null', 'double',
       count_if(o_totalprice IS NULL), count_if(o_totalprice IS NULL) > 0
FROM {ORDERS_PLANTED_SQL} p
UNION ALL SELECT 'orders', 'column_naming', 'setting_changed', 'lower', 'upper', count(*), true FROM orders
UNION ALL SELECT 'orders', 'decimal_precision', 'setting_changed', '', '2', count(*), true FROM orders
""")
def contract_full_check(spark, sf_dir):
    first = JobSpec()
    contract = capture_contract(table(spark, sf_dir, "orders"), "orders", settings=first.settings())
    now = JobSpec(column_naming="upper", decimal_precision=2)
    return check_contract(orders_planted(spark, sf_dir), contract, "orders", settings=now.settings())


# --------------------------------------------------------------------------
# K2 empty target then append; K1 validation report as Parquet
# --------------------------------------------------------------------------
@register("sink_create_append", "SELECT * FROM orders")
def sink_create_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    target = scratch_path(spark, "created-target")
    create_target(orders, target, "fail")
    write_table(orders, target, "append")
    return read_target(spark, target)


@register("report_parquet", f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE {_MD5_SAMPLE_SQL}
""")
def report_parquet(spark, sf_dir):
    cleaned = clean(table(spark, sf_dir, "orders"), column_naming="lower", date_format=True)
    path = scratch_path(spark, "validation-report")
    write_report(validation_rows(cleaned, 0.25, ["o_orderkey"]), path)
    return spark.read.parquet(path)


# --------------------------------------------------------------------------
# P12 -> I1: size the input, then load it incrementally when it is too big
# --------------------------------------------------------------------------
@register("orchestrated_load", """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 1) AS o_totalprice, o_orderdate,
       o_orderpriority
FROM orders
""")
def orchestrated_load(spark, sf_dir):
    source = scratch_path(spark, "orders-files")
    split_into_files(table(spark, sf_dir, "orders"), source, 6)
    spec = JobSpec(input_path=source, input_format="parquet", table_name="orders", if_table_exists="replace",
                   decimal_precision=1, on_violation="report")
    target = scratch_path(spark, "orders-orchestrated")
    # a budget far below the input size: the plan chooses the incremental path
    out = orchestrate(spark, spec, scratch_path(spark, "orch-contracts"), budget_bytes=1024, target=target)
    if out["path"] != "incremental":
        raise RuntimeError(f"expected the incremental path, got {out['path']}")
    return read_ingested(spark, target)


def _both_paths(spark, sf_dir, name, **settings):
    """The same spec over files of planted orders, once as a batch load and once
    gathered by the stream first; yields (path, what run_load reports, target, quarantine)."""
    clean_files, files = scratch_path(spark, f"{name}-clean"), scratch_path(spark, f"{name}-files")
    table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string")).write.parquet(clean_files)
    split_into_files(orders_planted(spark, sf_dir), files, 5)
    for budget in (1e15, 1024):
        contracts = scratch_path(spark, f"{name}-contracts")
        first = JobSpec(input_path=clean_files, input_format="parquet", table_name="orders", data_type={"o_totalprice": "float64"})
        run_load(spark, first, contracts, target=scratch_path(spark, f"{name}-first"))
        spec = JobSpec(input_path=files, input_format="parquet", table_name="orders", data_type={"o_totalprice": "float64"}, **settings)
        target, rejects = scratch_path(spark, f"{name}-target"), scratch_path(spark, f"{name}-rejects")
        out = orchestrate(spark, spec, contracts, budget, target=target, quarantine_target=rejects)
        yield out["path"], out["report"], target, rejects


@register("orchestrated_quarantine", """
WITH o AS (SELECT count(*) AS n, count_if(o_orderkey % 101 = 0) AS bad FROM orders)
SELECT path, n AS rows_in, n - bad AS rows_written, bad AS rows_rejected, n - bad AS in_target, bad AS in_quarantine
FROM o, (VALUES ('batch'), ('incremental')) AS paths(path)
""")
def orchestrated_quarantine(spark, sf_dir):
    """Kept and rejected rows are the same whichever path the size chooses."""
    parts = []
    for path, report, target, rejects in _both_paths(spark, sf_dir, "orch-quarantine", on_violation="quarantine"):
        both = spark.read.parquet(target).select(F.lit(1).alias("good")).unionByName(spark.read.parquet(rejects).select(F.lit(0).alias("good")))
        figures = [F.lit(report[k]).cast("bigint").alias(k) for k in ("rows_in", "rows_written", "rows_rejected")]
        counts = both.agg(F.count_if(F.col("good") == 1).alias("in_target"), F.count_if(F.col("good") == 0).alias("in_quarantine"))
        parts.append(counts.select(F.lit(path).alias("path"), *figures, "in_target", "in_quarantine"))
    return reduce(DataFrame.unionByName, parts)


@register("ledger_rerun_append", """
SELECT path, o.* FROM orders o, (VALUES ('batch'), ('incremental')) AS paths(path)
""")
def ledger_rerun_append(spark, sf_dir):
    """Two thirds of the files, the same again, then all of them: every file is
    loaded once, whichever path the size chooses."""
    parts = []
    for path, budget in (("batch", 1e15), ("incremental", 1024)):
        source, target, contracts = (scratch_path(spark, f"ledger-{x}") for x in ("files", "target", "contracts"))
        orders = table(spark, sf_dir, "orders")
        spec = JobSpec(input_path=source, input_format="parquet", table_name="orders", if_table_exists="append", date_format=False)
        orders.where("o_orderkey % 3 > 0").repartition(4).write.parquet(source)
        for _ in range(2):
            orchestrate(spark, spec, contracts, budget, target=target)
        orders.where("o_orderkey % 3 = 0").repartition(2).write.mode("append").parquet(source)
        orchestrate(spark, spec, contracts, budget, target=target)
        parts.append(spark.read.parquet(target).withColumn("path", F.lit(path)))
    return reduce(DataFrame.unionByName, parts)


@register("staged_load_resumed", """
WITH o AS (SELECT count(*) AS n, count_if(o_orderkey % 101 = 0) AS bad FROM orders)
SELECT n AS rows_in, n - bad AS rows_written, bad AS rows_rejected, n - bad AS in_target, bad AS in_quarantine,
       (SELECT CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 101 <> 0) AS key_sum, 5 AS batches
FROM o
""")
def staged_load_resumed(spark, sf_dir):
    """A load of five batches cut short after two and started again: the rest is
    staged, everything is committed once."""
    clean_files, files, contracts, target, rejects = (scratch_path(spark, f"resumed-{x}") for x in ("clean", "files", "contracts", "target", "rejects"))
    table(spark, sf_dir, "orders").withColumn("o_custkey", F.col("o_custkey").cast("string")).write.parquet(clean_files)
    parts = split_into_files(orders_planted(spark, sf_dir), files, 5)
    first = JobSpec(input_path=clean_files, input_format="parquet", table_name="orders", date_format=False)
    run_load(spark, first, contracts, target=scratch_path(spark, "resumed-first"))
    spec = JobSpec(input_path=files, input_format="parquet", table_name="orders", date_format=False, on_violation="quarantine")
    seen = []

    class Cut(Exception):
        pass

    def cut(batch: int) -> None:
        seen.append(batch)
        if len(seen) == 2:
            raise Cut

    # A batch is one file, or a fifth of the parts that larger files come in.
    for _ in range(2):
        try:
            report = staged_load(spark, spec, contracts, target, 0.1 if parts == 1 else 0.2, quarantine_target=rejects, on_batch=cut)
        except Cut:
            pass
    good, bad = spark.read.parquet(target), spark.read.parquet(rejects)
    both = good.select("o_orderkey", F.lit(1).alias("good")).unionByName(bad.select("o_orderkey", F.lit(0).alias("good")))
    counts = both.agg(F.count_if(F.col("good") == 1).alias("in_target"), F.count_if(F.col("good") == 0).alias("in_quarantine"), F.sum(F.col("o_orderkey") * F.col("good")).alias("key_sum"))
    figures = [F.lit(report[k]).cast("bigint").alias(k) for k in ("rows_in", "rows_written", "rows_rejected")]
    return counts.select(*figures, "in_target", "in_quarantine", "key_sum", F.lit(len(seen)).alias("batches"))


@register("stream_rerun_append", "SELECT * FROM orders")
def stream_rerun_append(spark, sf_dir):
    """A rerun of the same stream adds nothing: its checkpoint follows from source and target."""
    source, target = scratch_path(spark, "rerun-files"), scratch_path(spark, "rerun-target")
    split_into_files(table(spark, sf_dir, "orders"), source, 3)
    for _ in range(2):
        incremental_ingest(spark, source, target, mode="append", date_format=False, max_files_per_trigger=2)
    return read_ingested(spark, target)


@register("csv_load_documents", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_load_documents(spark, sf_dir):
    """Texts with line breaks, quotes and outer blanks through CSV and a config load."""
    source, target = scratch_path(spark, "documents-csv"), scratch_path(spark, "documents-loaded")
    write_csv(table(spark, sf_dir, "documents"), source)
    spec = JobSpec(input_path=source, input_format="csv", table_name="documents", multiline=True, date_format=False,
                   data_type={"doc_id": "int64", "n_chars": "int64"})
    run_load(spark, spec, scratch_path(spark, "documents-contracts"), target=target)
    return spark.read.parquet(target)


@register("csv_record_ranges", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_record_ranges(spark, sf_dir):
    """The same texts read back in byte ranges of CSV files (one a task: a small table is
    one file), as two row ranges of each."""
    docs, source = table(spark, sf_dir, "documents"), scratch_path(spark, "documents-csv")
    write_csv(docs, source)
    index = record_index(spark, source, 256 << 10)
    half = record_counts(index).agg(F.max("records").alias("most")).first()["most"] // 2
    rows = read_records(spark, source, docs.schema, index, number="_row", **CSV_OPTIONS)
    return rows.where(F.col("_row") < half).unionByName(rows.where(F.col("_row") >= half)).drop("_row")


# Q1 coverage queries register themselves into this catalogue.
from . import sql_coverage  # noqa: E402,F401
