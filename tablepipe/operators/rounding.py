"""Round float columns to a number of decimals.

Rounding is half away from zero on the scaled binary value,
``round(x * 10^p) / 10^p``.  Rounding at 0 decimals of a double never depends
on how the JVM prints it (a printed double parses back to the same value, so
it sits on the same side of .5), which makes the result engine-independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import col

_INF = float("inf")


def round_value(c: Column, precision: int, dt: T.DataType = T.DoubleType()) -> Column:
    scale = float(10 ** int(precision))
    x = c.cast("double")
    scaled = x * F.lit(scale)
    out = F.when(scaled.isin(_INF, -_INF), x).otherwise(F.round(scaled, 0) / F.lit(scale))
    return out.cast(dt)


def round_floats(df: DataFrame, precision: int = 2, columns: list[str] | None = None) -> DataFrame:
    floats = {f.name: f.dataType for f in df.schema.fields
              if isinstance(f.dataType, (T.FloatType, T.DoubleType))
              and (columns is None or f.name in columns)}
    if not floats:
        return df
    return df.withColumns({c: round_value(col(c), precision, dt) for c, dt in floats.items()})
