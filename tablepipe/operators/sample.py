"""L1 / L2 / V7: reproducible samples.

"The first n rows" has no meaning in Spark without an order, so head samples
take keys.  Two exact ways, picked by size:

* small n: ``orderBy(keys).limit(n)`` -> TakeOrderedAndProject, each task keeps
  an n-row heap, one task merges at most n rows per input task;
* large n: range-partition the key columns and bring back one row per
  partition (count, smallest and largest key).  Every row below the partition
  that holds the cut is selected by a key predicate on the source; the cut
  partition recurses (it is 1/partitions of the rows, so depth is
  logarithmic).  No checkpoint, no task holding more than its partition, and
  the answer is defined by key predicates, so a recomputed task gives the same
  rows.  Only a cut partition whose keys all tie is taken by a checkpointed
  per-partition prefix.

The keyed sample is a per-row hash test (no shuffle, no limit): the same keys
are always in or out, whatever the partitioning, and the hash is md5 so other
engines can reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col
from ..session import checkpoint_root
from .selection import exact_sample

TOPK_MAX_ROWS = 200_000
_ROW_BITS = (1 << 33) - 1


def key_hash32(keys: list[str]) -> Column:
    """First 32 bits of md5 over the keys' text, as a number in [0, 2^32)."""
    text = F.concat_ws("|", *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def keyed_sample(df: DataFrame, fraction: float, keys: list[str]) -> DataFrame:
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be in (0, 1]")
    if fraction >= 1.0:
        return df
    return df.where(key_hash32(keys) < F.lit(int(fraction * (1 << 32))))


def head_rows(df: DataFrame, n: int, keys: list[str], topk_max_rows: int = TOPK_MAX_ROWS,
              partitions: int | None = None) -> DataFrame:
    """First ``n`` rows in key order (rows that tie on every key are
    interchangeable, so keys should be unique for a unique answer)."""
    if n <= 0:
        return df.limit(0)
    if n <= topk_max_rows:
        return df.orderBy(*keys).limit(n)
    spark = df.sparkSession
    parts = partitions or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = F.struct(*[col(k) for k in keys])
    # Only the key columns are shuffled; one row per range partition returns.
    stats = (df.select(*keys).repartitionByRange(parts, *keys)
             .groupBy(F.spark_partition_id().alias("pid"))
             .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
             .collect())
    stats.sort(key=lambda r: tuple((v is not None, v) for v in r["lo"]))
    total = sum(r["n"] for r in stats)
    before = 0
    for r in stats:
        if before + r["n"] >= n:
            lo, hi, take, in_cut = r["lo"], r["hi"], n - before, r["n"]
            break
        before += r["n"]
    else:
        return df                                   # n covers the whole table
    fields = {f.name: f.dataType for f in df.schema.fields}

    def lit_value(v, dt):
        if v is not None and isinstance(dt, T.TimestampNTZType):
            return F.lit(v.isoformat(sep=" ")).cast(dt)     # zone-free, unlike lit(datetime)
        return F.lit(v).cast(dt)

    def lit_key(row) -> Column:
        return F.struct(*[lit_value(row[i], fields[k]).alias(k) for i, k in enumerate(keys)])

    # Plain bounds on the leading key are implied by the struct bounds; unlike
    # them they reach the Parquet scan, whose statistics skip row groups.
    lead, k0 = col(keys[0]), keys[0]
    lead_le_lo = lead <= lit_value(lo[0], fields[k0]) if lo[0] is not None else F.lit(True)
    lead_in = ((lead >= lit_value(lo[0], fields[k0])) if lo[0] is not None else F.lit(True)) & \
              ((lead <= lit_value(hi[0], fields[k0])) if hi[0] is not None else lead.isNull())
    below = df.where(lead_le_lo | lead.isNull()).where(key < lit_key(lo))     # partitions before the cut
    inside = df.where(lead_in | lead.isNull()).where((key >= lit_key(lo)) & (key <= lit_key(hi)))
    if tuple(lo) == tuple(hi):
        # all rows of the cut partition tie on the keys: any ``take`` of them
        return below.unionByName(_prefix_by_partition(inside, take))
    if in_cut == total:
        # No progress (one key so frequent that every sampled bound equals it):
        # peel off the largest key's ties; what is left is strictly smaller.
        under = inside.where(key < lit_key(hi))
        n_under = under.count()
        if n_under >= take:
            return below.unionByName(head_rows(under, take, keys, topk_max_rows, parts))
        ties = inside.where(key == lit_key(hi))
        return below.unionByName(under).unionByName(_prefix_by_partition(ties, take - n_under))
    return below.unionByName(head_rows(inside, take, keys, topk_max_rows, parts))


def _prefix_by_partition(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows of ``df``, exactly, without gathering them in one task:
    checkpoint (stable rows), count per partition, keep per-partition prefixes."""
    spark = df.sparkSession
    checkpoint_root(spark)
    fixed = df.checkpoint(eager=True)
    tagged = fixed.withColumn("_pid", F.spark_partition_id()) \
                  .withColumn("_rn", F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)))
    sizes = sorted((r["_pid"], r["count"]) for r in tagged.groupBy("_pid").count().collect())
    keep, before = [], 0
    for pid, cnt in sizes:
        if before >= n:
            break
        keep.append((pid, min(cnt, n - before)))
        before += cnt
    cut = spark.createDataFrame(keep, "_pid int, _take bigint")
    return (tagged.join(F.broadcast(cut), "_pid")
            .where(F.col("_rn") < F.col("_take"))
            .drop("_pid", "_rn", "_take"))


def head_fraction(df: DataFrame, fraction: float, keys: list[str], **kw) -> DataFrame:
    """L2: the first ``int(rows * fraction)`` rows in key order."""
    if not 0.0 < fraction <= 1.0:
        raise ValueError("fraction must be in (0, 1]")
    n = int(df.count() * fraction)
    return head_rows(df, n, keys, **kw)


def validation_rows(df: DataFrame, sample_size: float = 1.0, keys: list[str] | None = None, exact: bool = False) -> DataFrame:
    """V7: the rows a contract check looks at: all of them by default, else a
    keyed sample (or a seeded Bernoulli sample when no keys are given); with
    ``exact``, one of exactly ``int(rows * sample_size)`` rows."""
    if sample_size >= 1.0:
        return df
    if exact:
        return exact_sample(df, sample_size, keys)
    if keys:
        return keyed_sample(df, sample_size, keys)
    return df.sample(fraction=sample_size, seed=17)
