"""Q1 theta / range join: rows with a point that lies in rows' intervals, without a
nested loop.

Intervals get a level by their length: level 0 holds lengths up to a base width
(the median length unless given), each further level doubles it.  An interval is
filed under the bins of its own level that it touches, two at most; a point looks
into its one bin at each level that occurs.  So both sides meet in an equi-join
on (keys, level, bin), a pair meets once, and the interval itself is checked there.

A bin that holds more than ``crowd`` rows of a side is cut into cells: that side's
rows are dealt to one of its cuts, and each row goes to all cuts of the other side.
A pair still meets in just one cell.  A row's cut follows from its content, so a
recomputed task deals it alike; only copies of one row share a cut.

Intervals hold their start and not their end (``closed=True``: both).  Rows with a
null, NaN or infinite point or bound, or a null key, match nothing, neither do intervals that end
before they start.  Equal rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CROWD = 100_000
_EPOCH = "1970-01-01"


def _place(df: DataFrame, name: str) -> Column:
    """The column on one axis of doubles, in its order (times as microseconds)."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.datediff(col, F.lit(_EPOCH)).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '{_EPOCH}', `{name}`)").cast("double")
    if isinstance(kind, T.NumericType):
        return col.cast("double")
    raise TypeError(f"{name}: no order of points for {kind.simpleString()}")


def _usable(places: list[Column], df: DataFrame, keys: list[str]) -> Column:
    out = F.lit(True)
    for p in places:
        out = out & p.isNotNull() & (F.abs(p) < F.lit(float("inf")))
    for k in keys:
        out = out & F.col(f"`{k}`").isNotNull()
    return out


def _base_width(intervals: DataFrame) -> float:
    got = intervals.where("_e > _s").agg(F.percentile_approx(F.col("_e") - F.col("_s"), 0.5, 1000)).first()[0]
    return float(got) if got else 1.0


def interval_join(points: DataFrame, intervals: DataFrame, point: str, start: str, end: str,
                  keys: list[tuple[str, str]] | None = None, closed: bool = False, width: float | None = None,
                  crowd: int = CROWD) -> DataFrame:
    """Pairs of a row of ``points`` and a row of ``intervals`` as the structs ``p``
    and ``i``, where ``point`` lies between ``start`` and ``end`` and the ``keys``
    (pairs of column names) are equal."""
    keys = keys or []
    p_place, s, e = _place(points, point), _place(intervals, start), _place(intervals, end)
    kn = [f"_k{n}" for n in range(len(keys))]
    left = points.where(_usable([p_place], points, [a for a, _ in keys])).select(
        F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("p"), p_place.alias("_x"),
        *[F.col(f"`{a}`").alias(n) for (a, _), n in zip(keys, kn)])
    right = intervals.where(_usable([s, e], intervals, [b for _, b in keys]) & (s <= e)).select(
        F.struct(*[F.col(f"`{c}`") for c in intervals.columns]).alias("i"), s.alias("_s"), e.alias("_e"),
        *[F.col(f"`{b}`").alias(n) for (_, b), n in zip(keys, kn)])

    w = float(width) if width else _base_width(right)
    size = lambda level: F.lit(w) * F.pow(F.lit(2.0), level)
    right = right.withColumn("_level", F.greatest(F.lit(0), F.ceil(F.log2((F.col("_e") - F.col("_s")) / w))).cast("int"))
    # As many levels as doublings between the base width and the longest interval.
    levels = sorted(right.agg(F.collect_set("_level")).first()[0]) or [0]
    bins = F.sequence(F.floor(F.col("_s") / size(F.col("_level"))), F.floor(F.col("_e") / size(F.col("_level"))))
    right = right.withColumn("_bin", F.explode(bins))
    left = left.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels])))
    left = left.withColumn("_bin", F.floor(F.col("_x") / size(F.col("_level"))))

    by = [*kn, "_level", "_bin"]
    cuts = (left.groupBy(*by).agg(F.count(F.lit(1)).alias("_np"), F.lit(0).cast("long").alias("_ni"))
            .unionByName(right.groupBy(*by).agg(F.lit(0).cast("long").alias("_np"), F.count(F.lit(1)).alias("_ni")))
            .groupBy(*by).agg(F.ceil(F.sum("_np") / crowd).alias("_pc"), F.ceil(F.sum("_ni") / crowd).alias("_ic"))
            .where("_pc > 0 and _ic > 0 and _pc + _ic > 2"))  # crowded and met from both sides

    def dealt(df: DataFrame, own: str, other: str, own_cell: str, other_cell: str, row: str) -> DataFrame:
        df = df.join(cuts, by, "left").fillna(1, ["_pc", "_ic"])
        df = df.withColumn(own_cell, F.pmod(F.xxhash64(row), F.col(own)))
        return df.withColumn(other_cell, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop("_pc", "_ic")

    left = dealt(left, "_pc", "_ic", "_a", "_b", "p")
    right = dealt(right, "_ic", "_pc", "_b", "_a", "i")
    upper = F.col(f"p.`{point}`") <= F.col(f"i.`{end}`") if closed else F.col(f"p.`{point}`") < F.col(f"i.`{end}`")
    return left.join(right, [*by, "_a", "_b"]).where((F.col(f"p.`{point}`") >= F.col(f"i.`{start}`")) & upper).select("p", "i")
