"""L2 / V7: a sample of exactly n rows by radix selection.

Every row gets a hash of its keys; the sample is the rows of the n smallest
hashes.  Nothing is ordered for it: a histogram of the hash's leading digit (at
most 65,536 counts, whatever the size) shows in which bucket the n-th smallest
lies, the next pass counts the next digit inside that bucket, and three passes
over the key columns fix all 48 bits.  The first pass also gives the row count,
so a share needs no count of its own.  The sample is then one filter on the source.

Rows that tie on the cut hash (repeated keys) are told apart by a hash of the
whole row, selected in the same way; what ties on that too is one row many times,
and as many copies of it are added as are missing.  A key or a row that holds a
third of the table is therefore never gathered.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col

DIGIT = 16                  # bits counted in a pass: at most 65,536 counts reach the driver
KEY_BITS = 48               # of md5: 12 hexadecimal digits
ROW_BITS = 63               # of xxhash64, without its sign
COPIES = 1 << 20            # copies of one row that a task writes


class Cut(NamedTuple):
    """The n smallest values: all below ``limit`` and ``take`` of the ``tied`` that equal it."""
    limit: int
    take: int
    tied: int
    rows: int


def key_hash48(keys: list[str], seed: str = "") -> Column:
    """First 48 bits of md5 over the seed and the keys' text (nulls left out)."""
    text = F.concat_ws("|", *([F.lit(seed)] if seed else []), *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("bigint")


def _hashable(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return all(_hashable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _hashable(dt.elementType)
    return not isinstance(dt, (T.MapType, T.VariantType))


def row_hash(df: DataFrame, seed: str = "") -> Column:
    """63 bits of a hash over all columns (those with maps by their JSON text)."""
    parts = [col(f.name) if _hashable(f.dataType) else F.to_json(F.struct(col(f.name))) for f in df.schema.fields]
    # each column's null is a part of its own, so that a null does not equal its absence
    marks = [col(f.name).isNull() for f in df.schema.fields]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts, *marks), 1)


def radix_cut(df: DataFrame, value: Column, bits: int, wanted, digit: int = DIGIT) -> Cut:
    """Where the ``wanted`` smallest of ``value`` (whole numbers of ``bits`` bits)
    end.  ``wanted`` is a number, or a function of the number of rows.  A pass
    counts one digit of the values that share the digits fixed so far, and stops
    early where a bucket ends exactly at the cut."""
    values = df.select(value.alias("v"))
    shift, prefix, below, rows, n = bits, 0, 0, None, None
    while True:
        inside = values if rows is None else values.where(F.shiftright("v", shift) == F.lit(prefix))
        shift = max(0, shift - digit)
        counts = sorted((r["d"], r["n"]) for r in inside.groupBy(F.shiftright("v", shift).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect())
        if rows is None:
            rows = sum(c for _, c in counts)
            n = min(rows, wanted(rows) if callable(wanted) else wanted)
            if n <= 0:
                return Cut(0, 0, 0, rows)
        for prefix, count in counts:
            if below + count >= n:
                break
            below += count
        if below + count == n:
            return Cut((prefix + 1) << shift, 0, 0, rows)
        if shift == 0:
            return Cut(prefix, n - below, count, rows)


def _copies(row: DataFrame, n: int) -> DataFrame:
    """``n`` copies of a frame of one row, written by as many tasks as that takes."""
    chunks = -(-n // COPIES)
    spread = row.select(F.struct(*[col(c) for c in row.columns]).alias("r"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("c"))
    if chunks > 1:
        spread = spread.repartition("c")
    last = F.when(F.col("c") == chunks - 1, F.lit(n - (chunks - 1) * COPIES)).otherwise(F.lit(COPIES))
    return spread.select("r", F.explode(F.sequence(F.lit(1), last))).select("r.*")


def exact_sample(df: DataFrame, fraction: float | None = None, keys: list[str] | None = None, n: int | None = None, seed: str = "") -> DataFrame:
    """Exactly ``int(rows * fraction)`` rows, or ``n`` (all, if there are fewer),
    by the smallest hashes of ``keys`` (of whole rows, if none are given).

    The same keys and seed give the same rows, whatever the partitioning, and a
    smaller sample lies within a larger one.  Null keys are left out of the hash;
    rows of equal keys are chosen by the hash of the whole row; equal rows count
    as often as they occur (0.0 and -0.0 are one value to the hash).  An empty
    table gives an empty sample.  The source is read again in every pass and must
    give the same rows."""
    if (fraction is None) == (n is None):
        raise ValueError("give either fraction or n")
    if fraction is not None and not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    wanted = n if n is not None else lambda rows: int(rows * fraction)
    whole = row_hash(df, seed)
    chosen, rest = [], df
    steps = ([(key_hash48(keys, seed), KEY_BITS)] if keys else []) + [(whole, ROW_BITS)]
    for value, bits in steps:
        cut = radix_cut(rest, value, bits, wanted)
        chosen.append(rest.where(value < F.lit(cut.limit).cast("bigint")))
        if not cut.take:
            break
        rest, wanted = rest.where(value == F.lit(cut.limit).cast("bigint")), cut.take
    else:
        chosen.append(_copies(rest.limit(1), cut.take))
    out = chosen[0]
    for part in chosen[1:]:
        out = out.unionByName(part)
    return out
