"""CSV records with quoted line breaks, read in parallel within a file.

Spark's ``multiLine`` reads a file in one task, since only a scan from its first
byte tells a line break inside quotes from one that ends a record.  Here a file
is cut into byte ranges and that state is computed first:

1. Every range counts its quotes (a task a range).  Doubled quotes count twice,
   so an odd number means that the range ends in the other state than it began
   in.  It also counts the line breaks that end a record with another behind
   them, for either state.
2. The exclusive-or of the parities before a range (a prefix over the small
   table of ranges) is its state at the start; the sum of the counts before it,
   the number of its first record.
3. Every range reads the records that follow a break in it, going on past its
   end for the last one.  Spark parses each record on its own.

The result is that of ``multiLine``, but for the order of rows, and for line
breaks inside quotes, which stay as the file has them (``multiLine`` turns \\r\\n
into \\n in files whose lines end so).  Files must quote
as RFC 4180 has it (a quote inside a field only in quoted fields, doubled) and
end lines with \\n or \\r\\n; empty lines are skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

RANGE_BYTES = 64 << 20
INDEX_SCHEMA = "path string, length bigint, start bigint, stop bigint, odd boolean, next_closed bigint, next_open bigint"
RANGES_A_TASK = 16


def byte_ranges(spark: SparkSession, source: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, length, start, stop: the files below ``source`` in ranges of ``range_bytes``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", "length").where("length > 0")
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    ranges = files.select("path", "length", F.explode(starts).alias("start"))
    return ranges.withColumn("stop", F.least(F.col("start") + F.lit(range_bytes), F.col("length")))


def _spread(ranges: DataFrame) -> DataFrame:
    """A task a range, or a few of them where there are many more than cores
    (names and numbers are all that moves)."""
    n = ranges.count()
    n = max(1, min(n, max(4 * ranges.sparkSession.sparkContext.defaultParallelism, n // RANGES_A_TASK)))
    return ranges.repartition(n, "path", "start") if n > 1 else ranges.coalesce(1)


def _opener():
    """Opens a file by its URI.  Made inside tasks (shipped by value)."""
    from urllib.parse import unquote, urlparse

    import pyarrow.fs as pafs

    def opened(path: str):
        u = urlparse(path)
        if u.scheme in ("", "file"):
            return pafs.LocalFileSystem().open_input_file(unquote(u.path) if u.scheme else path)
        fs, inner = pafs.FileSystem.from_uri(path)
        return fs.open_input_file(inner)

    return opened


def _scanner():
    """(opened, found): ``found(raw, own, first, last)`` gives where the records
    begin that follow a break in the first ``own`` of the bytes ``raw`` (two more
    are looked at), for bytes that begin outside and inside quotes, and whether
    their number of quotes is odd.  Shipped by value."""
    import numpy as np
    opened = _opener()

    def found(raw: bytes, own: int, first: bool, last: bool):
        data = np.frombuffer(raw, np.uint8)
        quotes, breaks = np.flatnonzero(data[:own] == 34), np.flatnonzero(data[:own] == 10)
        inside = np.searchsorted(quotes, breaks) & 1
        begins = breaks + 1

        def at(places):                                       # behind the last byte of a file as if lines went on
            return np.where(places < len(data), data[np.minimum(places, len(data) - 1)], 10 if last else 0)

        # Empty lines are no records: "\\n", "\\r\\n" or the end of the file follows.
        follow = at(begins)
        real = ~((follow == 10) | ((follow == 13) & (at(begins + 1) == 10)))
        states = [begins[real & (inside == state)] for state in (0, 1)]
        if first and not (raw[:1] == b"\n" or raw[:2] == b"\r\n" or raw == b"\r"):
            states[0] = np.concatenate([[0], states[0]])
        return states, bool(len(quotes) & 1)

    return opened, found


def record_index(spark: SparkSession, source: str | list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row a byte range: path, length, start, stop, open (whether it begins
    inside quotes), first_record (0-based in its file, the header counted) and
    records (that follow a break in it).  Written once under the shared scratch folder."""
    opened, found = _scanner()

    def scan(batches):
        import pyarrow as pa
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                start, stop, length = row["start"], row["stop"], row["length"]
                with opened(row["path"]) as fh:
                    fh.seek(start)
                    raw = fh.read(min(stop + 2, length) - start)
                (closed, inside), odd = found(raw, stop - start, start == 0, stop + 2 >= length)
                out.append(row | {"odd": odd, "next_closed": len(closed), "next_open": len(inside)})
            if out:
                yield pa.RecordBatch.from_pylist(out)

    counted = _spread(byte_ranges(spark, source, range_bytes)).mapInArrow(scan, INDEX_SCHEMA)
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = counted.withColumn("open", F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0)) % 2 == 1)
    state = state.withColumn("records", F.when(F.col("open"), F.col("next_open")).otherwise(F.col("next_closed")))
    state = state.withColumn("first_record", F.coalesce(F.sum("records").over(before), F.lit(0)).cast("bigint"))
    state = state.select("path", "length", "start", "stop", "open", "first_record", "records")
    place = scratch_path(spark, "csv-index")
    state.write.parquet(place)
    return spark.read.schema(state.schema).parquet(place)


def records(index: DataFrame) -> DataFrame:
    """path, record (0-based in its file, the header counted), text of every
    record, by the ranges of ``record_index``."""
    opened, found = _scanner()

    def read(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for row in batch.to_pylist():
                start, stop, length = row["start"], row["stop"], row["length"]
                with opened(row["path"]) as fh:
                    fh.seek(start)
                    raw = fh.read(min(stop + 2, length) - start)
                    own = stop - start
                    states, odd = found(raw, own, start == 0, stop + 2 >= length)
                    begins, inside = states[row["open"]], row["open"] ^ odd
                    if not len(begins):
                        continue
                    # The last record may go on behind the range: up to the next break outside quotes.
                    fh.seek(stop)
                    more, at, ended = [raw[:own]], stop, begins[-1] < own and stop == length
                    while not ended and at < length:
                        block = fh.read(min(1 << 20, length - at))
                        here = np.frombuffer(block, np.uint8)
                        quotes, breaks = np.flatnonzero(here == 34), np.flatnonzero(here == 10)
                        breaks = breaks[((np.searchsorted(quotes, breaks) + inside) & 1) == 0]
                        ended = len(breaks) > 0
                        more.append(block[: breaks[0]] if ended else block)
                        inside ^= bool(len(quotes) & 1)
                        at += len(block)
                    raw = b"".join(more)
                lasts = np.append(begins[1:], len(raw)).tolist()
                for k in range(0, len(begins), 10_000):
                    texts = []
                    for a, b in zip(begins[k : k + 10_000].tolist(), lasts[k : k + 10_000]):
                        text = raw[a:b].rstrip(b"\r\n")          # its own break and empty lines behind it
                        texts.append(text)
                    number = row["first_record"] + k + np.arange(len(texts))
                    yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(texts)), pa.array(number), pa.array(texts, pa.binary())], names=["path", "record", "raw"])

    mine = index.select("path", "length", "start", "stop", "open", "first_record").where(F.col("records") > 0)
    lines = _spread(mine).mapInArrow(read, "path string, record bigint, raw binary")
    return lines.select("path", "record", F.col("raw").cast("string").alias("text"))


def read_records(spark: SparkSession, source: str | list[str], schema: T.StructType, index: DataFrame | None = None,
                 range_bytes: int = RANGE_BYTES, number: str | None = None, **options: str) -> DataFrame:
    """The rows of CSV files with a header, typed by ``schema``; with ``number`` a
    column of that name holds each row's 0-based place in its file (a row range is
    a filter on it)."""
    found = records(index if index is not None else record_index(spark, source, range_bytes)).where("record > 0")
    opts = {k: v for k, v in options.items() if k.lower() not in ("header", "inferschema", "basepath")} | {"multiLine": "true"}
    row = F.from_csv("text", _ddl(schema), opts)
    out = found.select("record", row.alias("_row"))
    cols = [F.col("_row").getField(f.name).alias(f.name) for f in schema.fields]
    return out.select(*cols, *([(F.col("record") - 1).alias(number)] if number else []))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def record_counts(index: DataFrame) -> DataFrame:
    """path, records: of every file, its header left out."""
    return index.groupBy("path").agg(F.greatest(F.sum("records") - 1, F.lit(0)).alias("records"))
