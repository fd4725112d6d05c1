"""Type names users may write, and the fixed sizing values of the profile.

Everything here is metadata about a schema (driver side, a few entries per
column); no table rows pass through this module.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The castable type names (case-insensitive) and what they mean.
#   utf8 -> string, int64 -> bigint, int32 -> int, int8 -> tinyint,
#   float64 -> double, float32 -> float
# plus the documented but previously unaccepted name "datetime" -> timestamp_ntz.
# ---------------------------------------------------------------------------
CAST_TYPES: dict[str, T.DataType] = {
    "utf8": T.StringType(),
    "int64": T.LongType(),
    "int32": T.IntegerType(),
    "int8": T.ByteType(),
    "float64": T.DoubleType(),
    "float32": T.FloatType(),
    "datetime": T.TimestampNTZType(),
}


def cast_type(name: str) -> T.DataType:
    """Resolve a user type name (any case) to a Spark type, or raise."""
    key = name.strip().lower()
    if key not in CAST_TYPES:
        raise ValueError(f"unknown type name {name!r}; allowed: {sorted(CAST_TYPES)}")
    return CAST_TYPES[key]


def type_kind(dt: T.DataType) -> str:
    """Coarse kind of a Spark type used by the sizing tables below."""
    if isinstance(dt, T.ByteType):
        return "int8"
    if isinstance(dt, T.ShortType):
        return "int16"
    if isinstance(dt, T.IntegerType):
        return "int32"
    if isinstance(dt, T.LongType):
        return "int64"
    if isinstance(dt, T.FloatType):
        return "float32"
    if isinstance(dt, T.DoubleType):
        return "float64"
    if isinstance(dt, T.BooleanType):
        return "bool"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(dt, (T.StringType, T.VarcharType, T.CharType)):
        return "string"
    if isinstance(dt, T.ArrayType):
        return "list"
    if isinstance(dt, T.StructType):
        return "struct"
    return "other"


# ---------------------------------------------------------------------------
# Fixed values of the size profile (must equal the published heuristics).
#
# Text (CSV) in-memory overhead factor per column kind; strings get the
# string factor computed from the data:
#   int8 1.4, int16 1.45, int32 1.5, int64 1.55, float32 1.6, float64 1.65,
#   bool 2.5, date 1.8, timestamp 1.85, list 2.5, struct 2.8, other 1.7
TEXT_TYPE_FACTOR = {
    "int8": 1.4, "int16": 1.45, "int32": 1.5, "int64": 1.55,
    "float32": 1.6, "float64": 1.65, "bool": 2.5, "date": 1.8,
    "timestamp": 1.85, "list": 2.5, "struct": 2.8, "other": 1.7,
}
# Text string factor by mean (over string columns) of median byte length:
#   <=1 -> 2.0, <=5 -> 1.8, <=10 -> 1.6, <=20 -> 1.4, <=50 -> 1.2, else 1.1;
#   no string column -> 1.0
TEXT_STRING_FACTOR_STEPS = [(1, 2.0), (5, 1.8), (10, 1.6), (20, 1.4), (50, 1.2)]
TEXT_STRING_FACTOR_ELSE = 1.1
# Bytes per value by kind; strings are charged the string width (sum of the
# string columns' median byte lengths, at least 32); "other" is 16 in the mean
# width and the mean width itself in the row width:
#   int8 1, int16 2, int32 4, int64 8, float32 4, float64 8, timestamp 8,
#   date 4, bool 1, other 16
VALUE_BYTES = {
    "int8": 1, "int16": 2, "int32": 4, "int64": 8, "float32": 4, "float64": 8,
    "timestamp": 8, "date": 4, "bool": 1,
}
OTHER_VALUE_BYTES = 16
STRING_WIDTH_FLOOR = 32
# Parquet detailed factor per kind (strings get the Parquet string factor):
#   int8 1.2, int16 1.25, int32 1.3, int64 1.35, float32 1.4, float64 1.45,
#   bool 2.0, date 1.5, timestamp 1.55, list 2.2, struct 2.5, other 1.7
PARQUET_TYPE_FACTOR = {
    "int8": 1.2, "int16": 1.25, "int32": 1.3, "int64": 1.35,
    "float32": 1.4, "float64": 1.45, "bool": 2.0, "date": 1.5,
    "timestamp": 1.55, "list": 2.2, "struct": 2.5, "other": 1.7,
}
# Parquet coarse factor: integer 1.3, floating 1.4, bool 2.0, date/timestamp
# 1.5, list 2.2, string = Parquet string factor, anything else = the mean of
# the detailed factors.
PARQUET_COARSE_FACTOR = {
    "int8": 1.3, "int16": 1.3, "int32": 1.3, "int64": 1.3,
    "float32": 1.4, "float64": 1.4, "bool": 2.0, "date": 1.5,
    "timestamp": 1.5, "list": 2.2,
}
# Parquet string factor from a = max(1, mean value byte length):
#   base = 1 + 4 / a; a < 5 -> min(base + 0.4, 2.2); a < 10 -> base + 0.2;
#   a < 20 -> base + 0.1; else base + 0.05; no string column -> 1.0
PARQUET_STRING_BASE = 1.0
PARQUET_STRING_NUMERATOR = 4.0
PARQUET_STRING_STEPS = [(5, 0.4), (10, 0.2), (20, 0.1)]
PARQUET_STRING_ELSE = 0.05
PARQUET_STRING_CAP_FIRST_STEP = 2.2
NO_STRING_FACTOR = 1.0
# Load decision by ratio = estimate / budget: <= 0.65 eager, <= 2.0 lazy,
# else streaming.  Chunk fraction by ratio: > 5 -> 0.15, > 2 -> 0.25,
# > 0.5 -> 0.40, else 0.70; chunk rows = min(max(rows * fraction, 10000), rows).
EAGER_MAX_RATIO = 0.65
LAZY_MAX_RATIO = 2.0
CHUNK_FRACTION_STEPS = [(5.0, 0.15), (2.0, 0.25), (0.5, 0.40)]
CHUNK_FRACTION_ELSE = 0.70
CHUNK_ROWS_FLOOR = 10000
