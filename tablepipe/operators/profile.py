"""A distributed size profile of many inputs, to plan loads.

Per table, one pass over its string columns gives a histogram of byte
lengths per column (partial aggregation per task: the shuffle carries at most
one row per (column, distinct length), whatever the row count).  From the
histogram come the exact median length (cumulative counts over the small
histogram, not a percentile buffer holding the column) and the mean length.
Everything else is schema metadata and Parquet footers (read on executors).

The factors are the published heuristics (see ``functions/types.py``); the
ratio divides the estimate by a memory budget the caller passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import types as TY
from ..functions.exprs import col

ROWS_MARK = "\u0000rows"   # pseudo column name carrying the row count

# --------------------------------------------------------------------------
# P1 / P7 inputs: per-column length statistics
# --------------------------------------------------------------------------
def _length_histogram(df: DataFrame, table_name: str) -> DataFrame:
    strings = [f.name for f in df.schema.fields if TY.type_kind(f.dataType) == "string"]
    items = [F.struct(F.lit(ROWS_MARK).alias("column_name"), F.lit(0).cast("int").alias("len"))]
    items += [F.struct(F.lit(c).alias("column_name"), F.octet_length(col(c)).alias("len"))
              for c in strings]
    return (df.select(F.inline(F.array(*items)))
            .where(F.col("len").isNotNull())
            .groupBy("column_name", "len").count()
            .withColumn("table_name", F.lit(table_name)))


def string_length_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, string column) plus a ROWS_MARK row per table:
    n_values (non-null), exact median byte length, mean byte length."""
    hist = reduce(DataFrame.unionByName, [_length_histogram(df, t) for t, df in tables.items()])
    w_all = Window.partitionBy("table_name", "column_name")
    w_run = w_all.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = (hist.withColumn("n", F.sum("count").over(w_all))
             .withColumn("cum", F.sum("count").over(w_run)))
    lo = F.floor((F.col("n") - 1) / 2)
    hi = F.floor(F.col("n") / 2)
    return (h.groupBy("table_name", "column_name").agg(
        F.first("n").alias("n_values"),
        ((F.min(F.when(F.col("cum") > lo, F.col("len"))) + F.min(F.when(F.col("cum") > hi, F.col("len"))))
         / 2.0).alias("median_len"),
        (F.sum(F.col("len") * F.col("count")) / F.sum("count")).alias("avg_len")))


# --------------------------------------------------------------------------
# Parquet footers, read on executors
# --------------------------------------------------------------------------
FOOTER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("file_bytes", T.LongType()),
    T.StructField("num_rows", T.LongType()),
    T.StructField("num_row_groups", T.LongType()),
    T.StructField("uncompressed_bytes", T.LongType()),
    T.StructField("compressed_bytes", T.LongType()),
])


def parquet_footers(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """One row per Parquet file: bytes on disk, rows, row groups and the
    uncompressed / compressed bytes summed over all column chunks.  Only the
    listing and the footers are read (binaryFile content is pruned)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(paths).select("path", "length"))
    names = [f.name for f in FOOTER_SCHEMA.fields]

    # Self-contained (imports inside, only plain values captured): it is
    # shipped by value, so executors need nothing but PyArrow.
    def read_footers(batches):
        from urllib.parse import urlparse as _parse

        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        for pdf in batches:
            out = []
            for path, length in zip(pdf["path"], pdf["length"]):
                u = _parse(path)
                if u.scheme in ("", "file"):
                    fs, inner = pafs.LocalFileSystem(), (u.path if u.scheme else path)
                else:
                    fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as fh:
                    md = pq.ParquetFile(fh).metadata
                    unc = comp = 0
                    for rg in range(md.num_row_groups):
                        g = md.row_group(rg)
                        for c in range(md.num_columns):
                            cc = g.column(c)
                            unc += cc.total_uncompressed_size
                            comp += cc.total_compressed_size
                    out.append((path, int(length), md.num_rows, md.num_row_groups, unc, comp))
            yield pd.DataFrame(out, columns=names)

    return files.mapInPandas(read_footers, FOOTER_SCHEMA)


CHUNK_SCHEMA = ("path string, row_group int, column string, physical_type string, num_rows long, num_values long, "
                "null_count long, compressed_bytes long, uncompressed_bytes long, min_number double, max_number double, "
                "min_text string, max_text string")


def row_group_index(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """A zone map, one row per file, row group and column chunk: rows,
    values, nulls, bytes, and the smallest and largest value (numbers as they are,
    times as microseconds, dates as days, text as text; both null unless the file
    holds both).  Only footers are read, in tasks; a file without row groups has
    no rows."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
             .option("recursiveFileLookup", "true").load(paths).select("path"))
    names = [f.split()[0] for f in CHUNK_SCHEMA.split(", ")]

    def read_chunks(batches):
        import datetime as dt
        from urllib.parse import urlparse as _parse

        import pandas as pd
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        def bound(v):
            """(number, text) of a statistic."""
            if isinstance(v, dt.datetime):
                zero = dt.datetime(1970, 1, 1, tzinfo=v.tzinfo and dt.timezone.utc)
                return float((v - zero) // dt.timedelta(microseconds=1)), None
            if isinstance(v, dt.date):
                return float((v - dt.date(1970, 1, 1)).days), None
            if isinstance(v, bytes):
                return None, v.decode("utf-8", "replace")
            return (None, v) if v is None or isinstance(v, str) else (float(v), None)

        for pdf in batches:
            out = []
            for path in pdf["path"]:
                u = _parse(path)
                if u.scheme in ("", "file"):
                    fs, inner = pafs.LocalFileSystem(), (u.path if u.scheme else path)
                else:
                    fs, inner = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(inner) as fh:
                    md = pq.ParquetFile(fh).metadata
                    for r in range(md.num_row_groups):
                        group = md.row_group(r)
                        for c in range(md.num_columns):
                            chunk = group.column(c)
                            st = chunk.statistics
                            known = st is not None and st.has_min_max
                            low, high = (bound(st.min), bound(st.max)) if known else ((None, None), (None, None))
                            nulls = st.null_count if st is not None and st.has_null_count else None
                            out.append((path, r, chunk.path_in_schema, chunk.physical_type, group.num_rows, chunk.num_values,
                                        nulls, chunk.total_compressed_size, chunk.total_uncompressed_size,
                                        low[0], high[0], low[1], high[1]))
            yield pd.DataFrame(out, columns=names).astype({"null_count": "Int64", "min_number": "float64", "max_number": "float64"})

    return files.mapInPandas(read_chunks, CHUNK_SCHEMA)


def row_groups_holding(index: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """(path, row_group, num_rows) of the row groups that may hold a value of
    ``column`` from ``low`` to ``high`` (numbers, or text); those without
    statistics may, those of nulls alone may not."""
    text = isinstance(low if low is not None else high, str)
    smallest, largest = (F.col(f"{end}_{'text' if text else 'number'}") for end in ("min", "max"))
    may = F.lit(True)
    if low is not None:
        may = may & (largest.isNull() | (largest >= F.lit(low)))
    if high is not None:
        may = may & (smallest.isNull() | (smallest <= F.lit(high)))
    filled = F.col("null_count").isNull() | (F.col("null_count") < F.col("num_values"))
    filled = filled & (F.col("num_values") > 0)
    return index.where((F.col("column") == column) & may & filled).select("path", "row_group", "num_rows")


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark's file listing spells it (scheme and absolute path)."""
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return str(fs.makeQualified(hpath).toString()).rstrip("/")


def _tag_by_prefix(spark: SparkSession, files: DataFrame, inputs: dict[str, str]) -> DataFrame:
    prefixes = spark.createDataFrame([(t, qualified(spark, p)) for t, p in inputs.items()],
                                     "table_name string, prefix string")
    match = (F.col("path") == F.col("prefix")) | F.col("path").startswith(F.concat(F.col("prefix"), F.lit("/")))
    return files.join(F.broadcast(prefixes), match)


def file_totals(spark: SparkSession, inputs: dict[str, str]) -> DataFrame:
    """P14 for any format: (table_name, files, file_bytes) from one listing
    (binaryFile without its content column)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(list(inputs.values())).select("path", "length"))
    return _tag_by_prefix(spark, files, inputs).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("file_bytes"))


def footer_totals(spark: SparkSession, inputs: dict[str, str]) -> DataFrame:
    """P10 / P14 per input: (table_name, files, file_bytes, num_rows, uncompressed_bytes).
    One listing over all inputs; files are matched to inputs by path prefix
    against a broadcast table with one row per input."""
    tagged = _tag_by_prefix(spark, parquet_footers(spark, list(inputs.values())), inputs)
    return tagged.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_bytes").alias("file_bytes"),
        F.sum("num_rows").alias("num_rows"), F.sum("num_row_groups").alias("num_row_groups"),
        F.sum("uncompressed_bytes").alias("uncompressed_bytes"))


# --------------------------------------------------------------------------
# Factors, from schema facts (metadata) and the string statistics
# --------------------------------------------------------------------------
SCHEMA_FACTS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("n_cols", T.IntegerType()),
    T.StructField("n_str", T.IntegerType()),
    T.StructField("text_fixed", T.DoubleType()),      # sum of text factors, non-string columns
    T.StructField("bytes_fixed", T.DoubleType()),     # sum of value bytes, sized kinds
    T.StructField("n_bytes_other", T.IntegerType()),  # columns sized as "other"
    T.StructField("pq_fixed", T.DoubleType()),        # sum of detailed Parquet factors, non-string
    T.StructField("pq9_fixed", T.DoubleType()),       # sum of coarse Parquet factors, known kinds
    T.StructField("n_pq9_other", T.IntegerType()),    # columns that take the detailed mean
])


def schema_facts(table_name: str, schema: T.StructType) -> tuple:
    kinds = [TY.type_kind(f.dataType) for f in schema.fields]
    non_str = [k for k in kinds if k != "string"]
    return (
        table_name, len(kinds), len(kinds) - len(non_str),
        float(sum(TY.TEXT_TYPE_FACTOR.get(k, TY.TEXT_TYPE_FACTOR["other"]) for k in non_str)),
        float(sum(TY.VALUE_BYTES[k] for k in non_str if k in TY.VALUE_BYTES)),
        sum(1 for k in non_str if k not in TY.VALUE_BYTES),
        float(sum(TY.PARQUET_TYPE_FACTOR.get(k, TY.PARQUET_TYPE_FACTOR["other"]) for k in non_str)),
        float(sum(TY.PARQUET_COARSE_FACTOR[k] for k in non_str if k in TY.PARQUET_COARSE_FACTOR)),
        sum(1 for k in non_str if k not in TY.PARQUET_COARSE_FACTOR),
    )


def _ladder_le(x: Column, steps, otherwise: float) -> Column:
    out = None
    for bound, val in steps:
        out = F.when(x <= bound, val) if out is None else out.when(x <= bound, val)
    return out.otherwise(otherwise)


def text_string_factor(mean_median: Column) -> Column:
    """P2 ladder over the mean of median lengths; null (no string data) -> 1.0."""
    return F.when(mean_median.isNull(), TY.NO_STRING_FACTOR).otherwise(
        _ladder_le(mean_median, TY.TEXT_STRING_FACTOR_STEPS, TY.TEXT_STRING_FACTOR_ELSE))


def parquet_string_factor(mean_len: Column) -> Column:
    """P7 over a = max(1, mean length); null (no string data) -> 1.0."""
    a = F.greatest(F.lit(1.0), mean_len)
    base = TY.PARQUET_STRING_BASE + TY.PARQUET_STRING_NUMERATOR / a
    (b1, add1), *rest = TY.PARQUET_STRING_STEPS
    ladder = F.when(a < b1, F.least(base + add1, F.lit(TY.PARQUET_STRING_CAP_FIRST_STEP)))
    for bound, add in rest:
        ladder = ladder.when(a < bound, base + add)
    ladder = ladder.otherwise(base + TY.PARQUET_STRING_ELSE)
    return F.when(mean_len.isNull(), TY.NO_STRING_FACTOR).otherwise(ladder)


def size_factors(spark: SparkSession, tables: dict[str, DataFrame], sample_fraction: float = 1.0,
                 row_counts: DataFrame | None = None, stats: DataFrame | None = None) -> DataFrame:
    """P1-P9 per table: n_rows, string figures and every factor / width.
    ``stats`` (as ``string_length_stats`` or ``sketches.length_profile`` give them)
    stands for a scan of the tables.
    With ``sample_fraction`` < 1 the length statistics come from a seeded
    Bernoulli sample; ``row_counts`` (table_name, n_rows) then supplies exact
    counts (e.g. from Parquet footers), else the sample count is scaled up."""
    if not 0.0 < sample_fraction <= 1.0:
        raise ValueError("sample_fraction must be in (0, 1]")
    sampled = tables if sample_fraction >= 1.0 else {
        t: df.sample(fraction=sample_fraction, seed=29) for t, df in tables.items()}
    if stats is None:
        stats = string_length_stats(sampled)
    # Row counts and string figures from one aggregate: each table is scanned once.
    is_rows = F.col("column_name") == ROWS_MARK
    figures = stats.groupBy("table_name").agg(
        F.round(F.max(F.when(is_rows, F.col("n_values"))) / F.lit(sample_fraction)).cast("bigint").alias("n_rows"),
        F.avg(F.when(~is_rows, F.col("median_len"))).alias("mean_median_len"),          # P1
        F.sum(F.when(~is_rows, F.col("median_len"))).alias("sum_median_len"),
        F.avg(F.when(~is_rows, F.col("avg_len"))).alias("mean_value_len"))              # P7 input
    if row_counts is not None:
        # one row per input on each side: broadcast is bounded by the number of inputs
        figures = (figures.join(F.broadcast(row_counts.select("table_name", F.col("n_rows").alias("_exact"))),
                                "table_name", "left")
                   .withColumn("n_rows", F.coalesce("_exact", "n_rows")).drop("_exact"))
    facts = spark.createDataFrame([schema_facts(t, df.schema) for t, df in tables.items()], SCHEMA_FACTS)
    # one row per table on every side (bounded by the number of inputs)
    j = facts.join(F.broadcast(figures), "table_name", "left")
    n = F.col("n_cols")
    safe_n = F.greatest(n, F.lit(1))
    # Columns without any non-null value have no median and are left out.
    p2 = text_string_factor(F.col("mean_median_len"))
    p4 = F.greatest(F.coalesce(F.col("sum_median_len"), F.lit(0.0)), F.lit(float(TY.STRING_WIDTH_FLOOR)))
    p7 = parquet_string_factor(F.col("mean_value_len"))
    n_str = F.col("n_str")
    p3 = F.when(n == 0, TY.NO_STRING_FACTOR).otherwise((F.col("text_fixed") + n_str * p2) / safe_n)
    p5 = F.when(n == 0, float(TY.STRING_WIDTH_FLOOR)).otherwise(
        (F.col("bytes_fixed") + n_str * p4 + F.col("n_bytes_other") * TY.OTHER_VALUE_BYTES) / safe_n)
    p6 = F.col("bytes_fixed") + n_str * p4 + F.col("n_bytes_other") * p5
    p8 = F.when(n == 0, 1.0).otherwise((F.col("pq_fixed") + n_str * p7) / safe_n)
    p9 = F.when(n == 0, 1.0).otherwise((F.col("pq9_fixed") + n_str * p7 + F.col("n_pq9_other") * p8) / safe_n)
    return j.select(
        "table_name", F.coalesce(F.col("n_rows"), F.lit(0)).alias("n_rows"), "n_cols", "n_str",
        F.col("mean_median_len"), p2.alias("text_string_factor"), p4.alias("string_width"),
        F.col("mean_value_len"), p7.alias("parquet_string_factor"),
        p3.alias("text_type_factor"), p5.alias("mean_value_bytes"), p6.alias("row_bytes"),
        p8.alias("parquet_type_factor"), p9.alias("parquet_coarse_factor"))


# --------------------------------------------------------------------------
# The load plan
# --------------------------------------------------------------------------
def load_plan(spark: SparkSession, inputs: dict[str, str], budget_bytes: float,
              formats: dict[str, str] | None = None, sample_fraction: float = 1.0,
              csv_infer_ratio: float = 1.0, csv_options: dict[str, str] | None = None) -> DataFrame:
    """One row per input path: estimate, ratio to the budget, decision
    (eager / lazy / streaming; the first two are one batch job, the last an
    incremental job), chunk fraction and rows, bytes on disk.  CSV inputs are
    typed by inference over all rows (``csv_infer_ratio`` of them) so numbers
    are not sized as text."""
    from ..sources.files import read_csv, read_table, table_format
    formats = formats or {}
    fmts = {t: table_format(p, formats.get(t)) for t, p in inputs.items()}
    frames = {t: (read_csv(spark, p, inferSchema="true", samplingRatio=str(csv_infer_ratio), **(csv_options or {}))
                  if fmts[t] == "csv" else read_table(spark, p, fmts[t]))
              for t, p in inputs.items()}
    pq_inputs = {t: p for t, p in inputs.items() if fmts[t] == "parquet"}
    footers = footer_totals(spark, pq_inputs) if pq_inputs else None
    exact_rows = footers.select("table_name", F.col("num_rows").alias("n_rows")) if footers is not None else None
    factors = size_factors(spark, frames, sample_fraction, exact_rows)
    sizes = (spark.createDataFrame([(t, f) for t, f in fmts.items()], "table_name string, format string")
             .join(F.broadcast(file_totals(spark, inputs).select("table_name", "file_bytes")), "table_name", "left"))
    if footers is not None:
        sizes = sizes.join(F.broadcast(footers.select("table_name", "uncompressed_bytes")), "table_name", "left")
    else:
        sizes = sizes.withColumn("uncompressed_bytes", F.lit(None).cast("bigint"))
    j = factors.join(F.broadcast(sizes), "table_name")
    est = F.when(F.col("format") == "parquet",
                 F.col("parquet_coarse_factor") * F.col("uncompressed_bytes")) \
           .otherwise(F.col("n_rows") * F.col("text_type_factor") * F.col("row_bytes"))
    return (decide(j.withColumn("estimated_bytes", est), budget_bytes)
            .select("table_name", "format", "n_rows", "file_bytes", "uncompressed_bytes",
                    "text_type_factor", "row_bytes", "parquet_coarse_factor", "estimated_bytes",
                    "ratio", "decision", "load_mode", "chunk_fraction", "chunk_rows"))


def decide(df: DataFrame, budget_bytes: float) -> DataFrame:
    """P12 / P13 on a frame with ``estimated_bytes`` and ``n_rows``: ratio to
    the budget, decision, load mode, chunk fraction and chunk rows."""
    ratio = F.col("estimated_bytes") / F.lit(float(budget_bytes))
    decision = (F.when(F.col("ratio") <= TY.EAGER_MAX_RATIO, "eager")
                .when(F.col("ratio") <= TY.LAZY_MAX_RATIO, "lazy").otherwise("streaming"))
    frac = None
    for bound, val in TY.CHUNK_FRACTION_STEPS:
        frac = F.when(F.col("ratio") > bound, val) if frac is None else frac.when(F.col("ratio") > bound, val)
    frac = frac.otherwise(TY.CHUNK_FRACTION_ELSE)
    rows_c = F.col("n_rows")
    chunk_rows = F.least(F.greatest(F.floor(rows_c * F.col("chunk_fraction")).cast("bigint"),
                                    F.lit(TY.CHUNK_ROWS_FLOOR).cast("bigint")), rows_c)
    return (df.withColumn("ratio", ratio)
              .withColumn("decision", decision)
              .withColumn("load_mode", F.when(F.col("decision") == "streaming", "incremental")
                          .otherwise("batch"))
              .withColumn("chunk_fraction", frac)
              .withColumn("chunk_rows", chunk_rows))
