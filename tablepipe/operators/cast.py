"""Strict and safe casts of named columns.

Cast-map keys are accepted in the source spelling or in the renamed spelling
(the validator and the cast step used to disagree on which one), and type
names in any case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col, cast_failed, strict_cast, try_cast
from ..functions.naming import renamed
from ..functions.types import cast_type

REJECT_REASON = "_reject_reason"


def resolve_cast_map(columns: list[str], cast_map: dict[str, str] | None,
                     rule: str | None = None) -> dict[str, T.DataType]:
    """Map cast-map keys onto present column names; unknown keys raise (V1)."""
    if not cast_map:
        return {}
    present = {c.lower(): c for c in columns}
    out: dict[str, T.DataType] = {}
    missing = []
    for key, type_name in cast_map.items():
        candidates = [key] + ([renamed(key, rule)] if rule else [])
        hit = next((present[c.lower()] for c in candidates if c.lower() in present), None)
        if hit is None:
            missing.append(key)
            continue
        out[hit] = cast_type(type_name)
    if missing:
        raise ValueError(f"cast map names columns that are not in the table: {missing}")
    return out


def cast_columns(df: DataFrame, cast_map: dict[str, str] | None, rule: str | None = None) -> DataFrame:
    """Strict casts; the job fails on the first value that does not convert."""
    types = resolve_cast_map(df.columns, cast_map, rule)
    if not types:
        return df
    src = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: strict_cast(col(c), t, c, src[c]) for c, t in types.items()})


def _reason(types: dict[str, T.DataType], src: dict[str, T.DataType]) -> Column:
    return F.concat_ws(",", *[F.when(cast_failed(col(c), t, src[c]), F.lit(c)) for c, t in types.items()])


def flag_cast_failures(df: DataFrame, cast_map: dict[str, str] | None, rule: str | None = None) -> DataFrame:
    """The frame as it came plus a reject reason (comma list of the columns
    that would not convert, null when the row is good): one frame that a single
    write can split by status, nothing lost."""
    types = resolve_cast_map(df.columns, cast_map, rule)
    if not types:
        return df.withColumn(REJECT_REASON, F.lit(None).cast("string"))
    reason = _reason(types, {f.name: f.dataType for f in df.schema.fields})
    flagged = df.withColumn(REJECT_REASON, F.when(reason != "", reason))
    return flagged


def safe_cast(df: DataFrame, cast_map: dict[str, str] | None,
              rule: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into (good rows with cast types, rejected rows as they came
    with the failing column names).  Both come from one predicate, so the two
    counts add up to the input."""
    types = resolve_cast_map(df.columns, cast_map, rule)
    if not types:
        return df, df.limit(0).withColumn(REJECT_REASON, F.lit(None).cast("string"))
    flagged = flag_cast_failures(df, cast_map, rule)
    src = {f.name: f.dataType for f in df.schema.fields}
    good = (flagged.where(F.col(REJECT_REASON).isNull())
            .withColumns({c: try_cast(col(c), t, src[c]) for c, t in types.items()})
            .drop(REJECT_REASON))
    rejects = flagged.where(F.col(REJECT_REASON).isNotNull())
    return good, rejects


def cast_probe(df: DataFrame, cast_map: dict[str, str] | None, rule: str | None = None) -> DataFrame:
    """V1 + V2: every named column exists and every type name is known (raises
    otherwise, listing all of them), then one aggregate over all rows gives the
    number of values per column that would not convert."""
    types = resolve_cast_map(df.columns, cast_map, rule)
    spark = df.sparkSession
    if not types:
        return spark.createDataFrame([], "column_name string, target_type string, failures bigint")
    src = {f.name: f.dataType for f in df.schema.fields}
    counts = df.agg(*[F.count_if(cast_failed(col(c), t, src[c])).alias(f"f{i}")
                      for i, (c, t) in enumerate(types.items())])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t.simpleString()).alias("target_type"),
                 F.col(f"f{i}").alias("failures"))
        for i, (c, t) in enumerate(types.items())])))
