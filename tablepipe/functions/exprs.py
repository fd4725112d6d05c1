"""Reusable Column expressions.  All JVM-side built-ins: they stay inside
whole-stage codegen and never call back into Python."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: a value counts as date text only when it starts with a
# year-month-day triple, so a bare year such as '2024' is never taken for a date.
DATE_TEXT_PATTERN = r"^\s*\d{4}[-/]\d{1,2}[-/]\d{1,2}"

_INF = float("inf")


def col(name: str) -> Column:
    """A column by its exact name (dots, spaces and backticks taken literally)."""
    return F.col("`" + name.replace("`", "``") + "`")


# What Spark's try_cast accepts as integer text (ASCII control
# characters and spaces around an optionally signed run of ASCII digits), and
# a superset test for float text (a digit, or inf / nan in any case).
INT_TEXT_PATTERN = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
FLOAT_TEXT_HINT = r"(?i)[0-9]|inf|nan"

_INTEGRAL_RANGE = {
    T.ByteType: (-(1 << 7), (1 << 7) - 1),
    T.ShortType: (-(1 << 15), (1 << 15) - 1),
    T.IntegerType: (-(1 << 31), (1 << 31) - 1),
    T.LongType: (-(1 << 63), (1 << 63) - 1),
}
_WIDTH = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8}


def _integral(dt: T.DataType):
    return next((k for k in _INTEGRAL_RANGE if isinstance(dt, k)), None)


def _fast_try_cast(c: Column, dt: T.DataType, src: T.DataType | None) -> Column | None:
    """Exception-free forms of ``try_cast`` with the same result.  A failing
    ``try_cast`` costs an exception per row (about 10x slower), which matters
    when most rows of a column do not fit."""
    if src is None:
        return None
    target = _integral(dt)
    if target is not None:
        lo, hi = _INTEGRAL_RANGE[target]
        source = _integral(src)
        if source is not None:
            if _WIDTH[source] <= _WIDTH[target]:
                return c.cast(dt)
            return F.when(c.between(lo, hi), c.cast(dt))
        if isinstance(src, (T.FloatType, T.DoubleType, T.DecimalType)):
            # casting truncates toward zero: (lo - 1, hi + 1) exclusive fits
            if isinstance(src, T.DecimalType):
                ok = (c > F.lit(Decimal(lo - 1))) & (c < F.lit(Decimal(hi + 1)))
            elif target is T.LongType:
                # doubles next to -2^63 are 2048 apart: [-2^63, 2^63) is the range
                ok = (c >= F.lit(float(lo))) & (c < F.lit(float(hi + 1))) & ~F.isnan(c)
            else:
                ok = (c > F.lit(lo - 1)) & (c < F.lit(hi + 1)) & ~F.isnan(c)
            return F.when(ok, c.cast(dt))
        if isinstance(src, T.StringType):
            as_long = F.when(c.rlike(INT_TEXT_PATTERN), c.try_cast(T.LongType()))
            if target is T.LongType:
                return as_long
            return F.when(as_long.between(lo, hi), as_long.cast(dt))
        return None
    if isinstance(dt, (T.DoubleType, T.FloatType)) and isinstance(src, T.StringType):
        return F.when(c.rlike(FLOAT_TEXT_HINT), c.try_cast(dt))
    return None


def try_cast(c: Column, dt: T.DataType, src: T.DataType | None = None) -> Column:
    """``try_cast`` that also treats an overflow to +-Infinity as a failure
    (Spark narrows 1e300 to a float32 Infinity silently).  With the source
    type known, failing values are found without exceptions."""
    out = _fast_try_cast(c, dt, src)
    if out is None:
        out = c.try_cast(dt)
    if isinstance(dt, T.FloatType) and not isinstance(src, (T.FloatType, T.ByteType, T.ShortType,
                                                             T.IntegerType, T.LongType)):
        as_double = _fast_try_cast(c, T.DoubleType(), src) if src is not None else None
        as_double = c.try_cast(T.DoubleType()) if as_double is None else as_double
        overflow = out.isin(_INF, -_INF) & ~as_double.isin(_INF, -_INF)
        out = F.when(overflow, F.lit(None).cast(dt)).otherwise(out)
    return out


def cast_failed(c: Column, dt: T.DataType, src: T.DataType | None = None) -> Column:
    """True where a non-null value does not convert to ``dt``."""
    return c.isNotNull() & try_cast(c, dt, src).isNull()


def strict_cast(c: Column, dt: T.DataType, name: str, src: T.DataType | None = None) -> Column:
    """Cast that fails the job on the first value that does not convert,
    whatever the session's ANSI setting is."""
    msg = F.concat(
        F.lit(f"cannot cast column {name!r} to {dt.simpleString()}: value "),
        F.coalesce(c.cast("string"), F.lit("?")),
    )
    converted = try_cast(c, dt, src)
    return F.when(c.isNotNull() & converted.isNull(), F.raise_error(msg).cast(dt)).otherwise(converted)


def date_text(c: Column) -> Column:
    """Bring 'yyyy/mm/dd...' to ISO 'yyyy-mm-dd...' so the zone-free cast reads it."""
    return F.regexp_replace(F.trim(c), r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")


def parse_date_text(c: Column) -> Column:
    """Date text -> timestamp_ntz, null where it is not date text."""
    return F.when(c.rlike(DATE_TEXT_PATTERN), date_text(c).try_cast(T.TimestampNTZType()))


def not_date_text(c: Column) -> Column:
    """True where a non-null value is not date text."""
    return c.isNotNull() & parse_date_text(c).isNull()
