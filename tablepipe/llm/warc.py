"""Dictionary-compressed WARC archives (operator 8).

Writing: records of equal payload meet by digest (a partial aggregate finds the
first page of each); every page becomes a ``response`` record or a ``revisit``
of the first.  A Zstandard dictionary is built from a bounded sample of records.
Each partition is one archive: a leading skippable frame with the dictionary,
then one frame per record, so records can be read one by one.

The files are written by Spark's own committed text writer (any Hadoop file
system, lost tasks rerun): a row is one frame and the line separator is an empty
skippable frame, which every Zstandard reader passes over.

Defined results: null html is the empty payload; repeated rows are records of
their own and, at equal page ids, the one of smaller url is the response (of wholly
equal rows, one); an empty table gives an empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepipe.llm.common import written

# The two values the format fixes: the skippable frame of the dictionary, and of the separator.
DICT_MAGIC = 0x184D2A5D
EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
MIN_PAYLOAD = 0
# The dictionary is fitted on at most this many records' first bytes.
SAMPLE_ROWS = 2000
SAMPLE_BYTES = 16_384
DICT_BYTES = 65_536
DATE = "2020-01-01T00:00:00Z"
COPIES = 1024               # records of one repeated row that stay together


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has headers only and names the response."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {(url or '').translate(_BREAKS)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http + (b"" if revisit else payload)
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_BREAKS = {10: " ", 13: " "}


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields and the payload of a record."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """(magic, start, end) of each frame, found from frame and block headers without decompressing."""
    import zstandard

    at = 0
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0]
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + struct.unpack_from("<I", data, at + 4)[0]
        else:
            view = data[at : at + 18]
            end, last = at + zstandard.frame_header_size(view), False
            while not last:
                block = int.from_bytes(data[end : end + 3], "little")
                last = block & 1
                end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
            end += 4 * zstandard.get_frame_parameters(view).has_checksum
        yield magic, at, end
        at = end


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of at most DICT_BYTES; raw sample bytes where there is too little to train on."""
    import zstandard

    size = min(DICT_BYTES, sum(map(len, samples)) // 10)
    if len(samples) >= 16 and size >= 1024:
        try:
            return zstandard.train_dictionary(size, samples, threads=0).as_bytes()
        except zstandard.ZstdError:  # too alike or too few to train on: use the records themselves
            pass
    return b"".join(samples)[-DICT_BYTES:]


def classified(pages: DataFrame, id_col: str, url_col: str, html_col: str, min_payload: int) -> DataFrame:
    """page_id, url, payload, refers_to, revisit.

    Of equal payloads the row of the smallest page id (null last), then url, is the
    response.  Rows are told apart by their values alone, never by their place, so
    a task that runs again decides as before.  Rows that repeat one page (id, url
    and payload) are counted and written again as one response and its revisits."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    # Partial aggregates before either shuffle; neither carries a payload.
    alike = rows.where(F.length("payload") >= min_payload).groupBy(F.col("key").alias("f_key"), "page_id", F.coalesce("url", F.lit("")).alias("url")).count()
    first = F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url", "count"))
    firsts = written(alike.groupBy("f_key").agg(first.alias("first")), "first-pages")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.coalesce("url", F.lit("")) == F.col("first.url"))
    out = rows.join(firsts, F.col("key") == F.col("f_key"), "left")
    revisit = F.col("f_key").isNotNull() & ~is_first        # no key: too small to be met again
    answer = ["page_id", "url", "payload", F.when(F.col("revisit"), F.col("first.page_id")).alias("refers_to"), "revisit"]
    repeated = firsts.where("first.count > 1")
    if not repeated.limit(1).count():
        return out.withColumn("revisit", revisit).select(*answer)
    single = out.where(F.col("f_key").isNull() | ~is_first | (F.col("first.count") == 1)).withColumn("revisit", revisit)
    pages_of = rows.join(repeated, (F.col("key") == F.col("f_key")) & is_first)
    one = pages_of.groupBy("key").agg(F.first("page_id").alias("page_id"), F.max("url").alias("url"), F.first("payload").alias("payload"), F.first("first").alias("first"))
    chunks = F.floor((F.col("first.count") - 1) / COPIES).cast("int")
    spread = one.withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks))).repartition("key", "chunk")
    copies = spread.withColumn("copy", F.explode(F.sequence(F.col("chunk") * COPIES, F.least((F.col("chunk") + 1) * COPIES, F.col("first.count")) - 1)))
    return single.select(*answer).unionByName(copies.withColumn("revisit", F.col("copy") > 0).select(*answer))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_payload: int = MIN_PAYLOAD) -> str:
    """Write every page under ``path``, an archive a partition; returns ``path``.

    Partitions are those of the join, so an archive is about as large as the
    session's advisory partition size; one is read back as one value."""
    # An evenly spread sample: a hash range that holds about SAMPLE_ROWS rows, half of it for the bound.
    share = SAMPLE_ROWS / 2 / max(pages.count(), SAMPLE_ROWS / 2)
    prefix = F.substring(F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")), 1, SAMPLE_BYTES)
    some = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), prefix.alias("payload"), F.pmod(F.xxhash64(id_col, url_col), F.lit(1_000_003)).alias("h"))
    some = some.where(F.col("h") < share * 1_000_003).limit(SAMPLE_ROWS).collect()
    dictionary = train_dictionary([record(r.page_id, r.url, bytes(r.payload), sha1_base32(bytes(r.payload)), None, False) for r in some])

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True)
        yield pa.RecordBatch.from_arrays([pa.array([struct.pack("<II", DICT_MAGIC, len(dictionary)) + dictionary], pa.binary())], names=["frame"])
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                out = []
                for r in batch.slice(k, 256).to_pylist():
                    out.append(packer.compress(record(r["page_id"], r["url"], r["payload"], sha1_base32(r["payload"]), r["refers_to"], r["revisit"])))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    rows = classified(pages, id_col, url_col, html_col, min_payload)
    packed = rows.mapInArrow(compress, "frame binary")
    packed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME.decode("latin-1")).option("compression", "none").text(path)
    return path


def read_archives(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and the
    payload (null for revisits) of every record under ``path``; payloads are
    checked against their digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        schema = pa.schema([("page_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("payload", pa.binary())])
        for batch in batches:
            for value in batch.column(0):
                data, reader, out = value.as_py(), None, []
                for magic, start, end in frames(data):
                    if magic == DICT_MAGIC:
                        reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[start + 8 : end]))
                    elif magic & 0xFFFFFFF0 != 0x184D2A50:
                        fields, payload = parse(reader.decompress(data[start:end]))
                        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and sha1_base32(payload) != digest:
                            raise ValueError(f"record {fields['WARC-Record-ID']} does not match its digest")
                        name = lambda k: fields.get(k, "<urn:page:>")[len("<urn:page:") : -1] or None  # noqa: E731, B023
                        out.append((name("WARC-Record-ID"), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, kind, name("WARC-Refers-To"), payload if kind == "response" else None))
                    if len(out) == 256:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)

    rows = files.mapInArrow(unpack, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary")
    return rows.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


def archive_round_trip(pages: DataFrame, root: str, id_col: str = "page_id", **options) -> DataFrame:
    """Write the archives in a fresh folder under ``root`` and read them back."""
    path = write_archives(pages, f"{root.rstrip('/')}/warc-{uuid.uuid4().hex}", id_col, **options)
    return read_archives(pages.sparkSession, path, pages.schema[id_col].dataType.simpleString())
