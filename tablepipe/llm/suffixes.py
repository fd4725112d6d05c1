"""Removing repeated passages with suffix order and longest previous factors (operator 7).

A byte goes when a string of LENGTH bytes that covers it also starts elsewhere,
in the same document or another.  ``keep="none"`` takes every copy,
``keep="first"`` leaves the one that comes first by id and place.

1. Every window of LENGTH bytes picks an anchor (anchors.py); equal windows pick
   the same place, so copies meet by the anchor's gram.  Grams that occur once
   are dropped by a partial aggregate.
2. Anchors whose whole surroundings (all windows that hold the gram) are equal
   form a class.  All windows of a class of two or more repeat.
3. Where classes of one gram differ, the surroundings of one member each are
   read.  In a task, their suffixes are put in order by prefix doubling up to
   LENGTH.  The longest previous factor of a suffix is its longest common prefix
   with the nearest smaller positions before and after it in that order; cut at
   LENGTH, it is reached just when a suffix of equal first LENGTH bytes comes
   earlier in the text, its predecessor among its equals.  The same from the
   other end tells whether one follows.
4. A gram with more than GROUP classes is never gathered: its surroundings are
   cut into bands of windows, whose common core and whole extent are compared by
   hashed aggregates, then what is still open by narrower bands and at last
   window by window.  The result is the same.

Identity of classes, bands and single windows is by pairs of 64-bit hashes.

Small sides are broadcast only below BROADCAST_BYTES, measured; else shuffled.

Defined results: null or empty text, or text shorter than LENGTH, loses nothing;
rows of the same id and text match each other (all their bytes go with "none";
with "first" they are treated alike); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm import anchors
from tablepipe.llm.common import discard, written
from tablepipe.llm.texts import slim

LENGTH = 200
GRAM = 48
GROUP = 512
# Windows in a band, level by level.
BANDS = (17, 4, 1)
BROADCAST_BYTES = 64 << 20
# Symbols a task orders at a time.
CHUNK = 500_000
# Parts into which the places of one extent are dealt before they meet.
SALTS = 64
PAD = 0


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, key (of id and text) and the text as bytes."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("key"), text.cast("binary").alias("text"))


def _small(df: DataFrame, column: str) -> DataFrame:
    """``df`` marked for broadcast if its ``column`` and keys take up little."""
    size = df.agg(F.sum(F.length(column) + 16)).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def find_anchors(rows: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some, row, found = batch.slice(k, 256), [], []
                for j, text in enumerate(some.column(2)):
                    p, g, e = anchors.find(text.as_py(), length, gram)
                    row.append(np.full(len(p), j))
                    found.append((p, g.view(np.int64), e.view(np.int64)))
                at = pa.array(np.concatenate(row).astype(np.int64))
                p, g, e = (pa.array(np.concatenate([f[j] for f in found])) for j in range(3))
                yield pa.RecordBatch.from_arrays([some.column(0).take(at), some.column(1).take(at), p, g, e], names=["id", "key", "pos", "g", "e"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(slim(run), f"id {kind}, key long, pos long, g long, e long")


def ordered_equal(symbols: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """For the suffix at each (row, column) of ``symbols`` its rank in suffix order,
    compared within the row's group and to the first ``length`` symbols; suffixes
    equal so far share a rank.  Prefix doubling that sorts only what is not yet
    settled."""
    m, w = symbols.shape
    first = np.zeros((m, w + 3), np.int64)
    first[:, :w] = symbols
    key = group[:, None].astype(np.int64) << 36
    for j in range(4):
        key = key | first[:, j : j + w] << (9 * (3 - j))
    _, inverse, counts = np.unique(key.ravel(), return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse]
    live = np.flatnonzero(counts[inverse] > 1)
    depth = 4
    while depth < length and len(live):
        step = min(depth, length - depth)
        column = live % w
        after = np.where(column + step < w, rank[np.minimum(live + step, m * w - 1)], -1)
        order = np.lexsort((after, rank[live]))
        live, after = live[order], after[order]
        head = rank[live]
        new_head = np.concatenate([[True], head[1:] != head[:-1]])
        new = new_head | np.concatenate([[True], after[1:] != after[:-1]])
        index = np.arange(len(live))
        starts = np.maximum.accumulate(np.where(new_head, index, 0))
        here = np.maximum.accumulate(np.where(new, index, 0))
        rank[live] = head + here - starts
        sizes = np.diff(np.append(np.flatnonzero(new), len(live)))
        live = live[np.repeat(sizes, sizes) > 1]
        depth += step
    return rank.reshape(m, w)


def _matrix(parts: list[bytes], before: list[int], length: int, gram: int) -> np.ndarray:
    """Surroundings in rows, the anchor in one column; symbols are bytes + 1, PAD outside the text."""
    out = np.full((len(parts), 2 * length - gram), PAD, np.uint64)
    for j, (part, b) in enumerate(zip(parts, before, strict=True)):
        at = length - gram - b
        out[j, at : at + len(part)] = np.frombuffer(part, np.uint8) + np.uint64(1)
    return out


def _whole(symbols: np.ndarray, length: int) -> np.ndarray:
    """Which windows lie within the text."""
    pads = np.cumsum(np.pad(symbols == PAD, ((0, 0), (1, 0))), axis=1)
    return pads[:, length:] == pads[:, :-length]


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, last) of the runs of set flags in each row."""
    padded = np.pad(flags, ((0, 0), (1, 1))).astype(np.int8)
    turn = np.diff(padded, axis=1)
    row, first = np.nonzero(turn == 1)
    return row, first, np.nonzero(turn == -1)[1] - 1


def repeated_windows(symbols: np.ndarray, group: np.ndarray, length: int, keep: str) -> np.ndarray:
    """Which windows repeat one of another row of the group; with "first" only
    those that an earlier row holds.  Rows are in text order."""
    rank = ordered_equal(symbols, group, length)[:, : symbols.shape[1] - length + 1]
    whole = _whole(symbols, length)
    row, column = np.nonzero(whole)
    tie = rank[row, column]
    # Suffix order, equals by text position. Equal windows have the anchor in the same place; a
    # window seen from two anchors of its own document has not, and so never meets itself.
    order = np.lexsort((row, column, tie))
    tie, place = tie[order], column[order]
    same = (tie[1:] == tie[:-1]) & (place[1:] == place[:-1])
    previous = np.concatenate([[False], same])  # reaches LENGTH with the nearest smaller position
    following = np.concatenate([same, [False]])
    out = np.zeros(whole.shape, bool)
    out[row[order], column[order]] = previous if keep == "first" else previous | following
    return out


def _span_batch(keys: pa.Array, pos: np.ndarray, flags: np.ndarray, length: int, gram: int) -> pa.RecordBatch:
    row, first, last = _runs(flags)
    base = pos[row] - (length - gram)
    return pa.RecordBatch.from_arrays([keys.take(pa.array(row)), pa.array(base + first), pa.array(base + last + length)], names=["key", "s", "t"])


def _small_groups(parts: DataFrame, length: int, gram: int, keep: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def solve(table: pa.Table) -> pa.RecordBatch:
            g, key, pos = (table.column(c).to_numpy() for c in ("g", "key", "pos"))
            new = np.ones(len(g), bool)  # a document that occurs in several rows counts once
            new[1:] = (g[1:] != g[:-1]) | (key[1:] != key[:-1]) | (pos[1:] != pos[:-1])
            table = table.filter(pa.array(new))
            g, pos = g[new], pos[new]
            group = np.cumsum(np.concatenate([[0], (g[1:] != g[:-1]).astype(np.int64)]))
            symbols = _matrix(table.column("part").to_pylist(), table.column("before").to_pylist(), length, gram)
            return _span_batch(table.column("key").combine_chunks(), pos, repeated_windows(symbols, group, length, keep), length, gram)

        for batch in batches:
            for k in range(0, batch.num_rows, CHUNK // (2 * length)):
                some = pa.Table.from_batches([batch.slice(k, CHUNK // (2 * length))])
                held = pa.concat_tables([held, some]) if held is not None else some
                g = held.column("g").to_numpy()
                cut = int(np.flatnonzero(g != g[-1])[-1] + 1) if g[0] != g[-1] else 0  # the last group may go on
                if cut and len(g) * 2 * length >= CHUNK:
                    yield solve(held.slice(0, cut).combine_chunks())
                    held = held.slice(cut).combine_chunks()
        if held is not None and len(held):
            yield solve(held.combine_chunks())

    rows = parts.repartition("g").sortWithinPartitions("g", "id", "pos", "key").select("g", "key", "pos", "before", "part")
    return rows.mapInArrow(slim(run), "key long, s long, t long")


def _window_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of symbols[:, start:end] for each pair of starts and ends."""
    up, down = anchors._powers(symbols.shape[1] + 1)
    sums = np.zeros((len(symbols), symbols.shape[1] + 1), np.uint64)
    np.cumsum(mixed_symbols(symbols) * up[: symbols.shape[1]], axis=1, out=sums[:, 1:])
    return anchors.mix((sums[:, ends] - sums[:, starts]) * down[starts])


def mixed_symbols(symbols: np.ndarray) -> np.ndarray:
    return anchors.mix(symbols + np.uint64(0x1234567))


def _levels(width: int) -> list[list[tuple[int, int, int]]]:
    """(first, last, parent's first) of the bands of windows, level by level."""
    out, above = [], [(0, width - 1, 0)]
    for size in BANDS:
        above = [(a, min(a + size - 1, last), first) for first, last, _ in above for a in range(first, last + 1, size)]
        out.append(above)
    return out


def _large_groups(parts: DataFrame, length: int, gram: int, keep: str) -> DataFrame:
    """Spans of grams with many classes, by hashed aggregates only.

    A band of windows is settled as a whole where its extents are equal, or no
    other has its core; what is open goes on to the narrower bands within, the
    last of one window each, so rows stand for the ends of matches only."""

    def banded(level: list[tuple[int, int, int]]):
        lows, highs, above = (np.array([band[k] for band in level]) for k in range(3))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(0, batch.num_rows, 1024):
                    some = batch.slice(k, 1024)
                    symbols = _matrix(some.column("part").to_pylist(), some.column("before").to_pylist(), length, gram)
                    whole = np.cumsum(np.pad(_whole(symbols, length), ((0, 0), (1, 0))), axis=1)
                    live = whole[:, highs + 1] > whole[:, lows]
                    live &= np.array([np.isin(above, which) for which in some.column("open").to_pylist()])
                    core = _window_hashes(symbols, highs, lows + length).view(np.int64)
                    extent = _window_hashes(symbols, lows, highs + length).view(np.int64)
                    row, band = np.nonzero(live)
                    at = pa.array(row)
                    bands = [pa.array(x) for x in (lows[band], highs[band], core[row, band], extent[row, band])]
                    yield pa.RecordBatch.from_arrays([*[some.column(c).take(at) for c in ("g", "id", "key", "pos")], *bands], names=["g", "id", "key", "pos", "low", "high", "core", "extent"])

        return run

    kind = parts.schema["id"].dataType.simpleString()
    by, spans = ["g", "low", "core", "extent"], None
    asking = parts.withColumn("open", F.array(F.lit(0).cast("long")))
    levels = _levels(length - gram + 1)
    for turn, level in enumerate(levels):
        found = asking.select("g", "id", "key", "pos", "before", "part", "open").mapInArrow(slim(banded(level)), f"g long, id {kind}, key long, pos long, low long, high long, core long, extent long")
        # The first place of each extent, found in two steps so that a very common one is dealt to many tasks:
        # within salted parts, then among the first places of the parts.
        # (Equal extents have equal cores.)
        found = found.select("g", F.col("low").cast("short").alias("low"), "core", "extent", F.struct("id", "pos", "key").alias("place"))
        found = found.withColumn("salt", F.pmod(F.xxhash64("place.key", "place.pos"), F.lit(SALTS)).cast("byte"))
        part, whole = Window.partitionBy("g", "low", "extent", "salt"), Window.partitionBy("g", "low", "extent")
        found = found.withColumn("lead", F.col("place") == F.min("place").over(part)).withColumn("many", F.count(F.lit(1)).over(part) > 1)
        found = written(found.select(*by, "place", "lead", "many"), "bands")
        leads = found.where("lead").drop("lead").withColumn("first", F.min("place").over(whole)).withColumn("shared", F.max("many").over(whole) | (F.count(F.lit(1)).over(whole) > 1))
        leads = written(leads.drop("many"), "extents")
        tied = leads.where(F.col("place") == F.col("first")).select(*[F.col(c).alias(f"t_{c}") for c in by], "first")
        # Bands whose equals lie elsewhere (with "first": not the first of them).
        start = F.col("place.pos") - (length - gram) + F.col("low")
        high = F.element_at(F.create_map(*[F.lit(x) for first, last, _ in level for x in (first, last)]), F.col("low").cast("int"))
        cols = [F.col("place.key").alias("key"), start.alias("s"), (F.col("place.pos") - (length - gram) + high + length).alias("t")]
        more = found.where(~F.col("lead")).select(*cols).unionByName(leads.where(F.col("place") != F.col("first") if keep == "first" else F.col("shared")).select(*cols))
        more = written(more, "band-spans")
        spans = more if spans is None else spans.unionByName(more)
        discard(found)
        if turn + 1 == len(levels):  # a window is its own core
            discard(leads)
            return spans
        # Left open: extents that differ though their core is shared; one place of each extent takes part.
        cores = tied.groupBy(F.col("t_g").alias("c_g"), F.col("t_low").alias("c_low"), F.col("t_core").alias("c_core")).agg((F.min("t_extent") != F.max("t_extent")).alias("differ"))
        unsettled = tied.join(cores.where("differ"), (F.col("t_g") == F.col("c_g")) & (F.col("t_low") == F.col("c_low")) & (F.col("t_core") == F.col("c_core")))
        asked = unsettled.groupBy(F.col("t_g").alias("a_g"), F.col("first.key").alias("a_key"), F.col("first.pos").alias("a_pos")).agg(F.collect_set(F.col("t_low").cast("long")).alias("open"))
        asked = written(asked, "asked")
        discard(leads)
        asking = parts.join(asked, (F.col("g") == F.col("a_g")) & (F.col("key") == F.col("a_key")) & (F.col("pos") == F.col("a_pos")))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, keep: str = "none", group: int = GROUP) -> DataFrame:
    """key and spans (merged, as pairs of 32-bit-safe longs in bytes) of the documents that lose bytes."""
    rows = _keyed(docs, id_col, text_col)
    found = written(find_anchors(rows, length, gram), "anchors")
    grams = written(found.groupBy(F.col("g").alias("l_g")).count().where(F.col("count") > 1).select("l_g"), "grams")
    many = grams.count() * 8 > BROADCAST_BYTES // 4
    live = written(found.join(grams if many else F.broadcast(grams), F.col("g") == F.col("l_g")).drop("l_g"), "live")
    discard(found, grams)
    classes = written(live.groupBy(F.col("g").alias("c_g"), F.col("e").alias("c_e")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "pos", "key")).alias("first")), "classes")
    sizes = classes.groupBy(F.col("c_g").alias("m_g")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")

    # Members of classes of two or more: all their windows repeat.
    rest = (F.struct("id", "pos", "key") != F.col("first")) if keep == "first" else F.lit(True)
    copies = live.join(classes.where("n > 1"), (F.col("g") == F.col("c_g")) & (F.col("e") == F.col("c_e"))).where(rest)
    spans = written(copies.select("key", F.greatest(F.col("pos") - (length - gram), F.lit(0)).alias("s"), (F.col("pos") + length).alias("t")), "copies")
    discard(live)

    # One member of each class where a gram's classes differ, with its surroundings.
    members = classes.join(sizes, F.col("c_g") == F.col("m_g")).select(F.col("first.key").alias("r_key"), F.struct(F.col("first.pos").alias("pos"), F.col("c_g").alias("g"), "m").alias("at"))
    members = written(members.groupBy("r_key").agg(F.collect_list("at").alias("ats")), "members")
    held = members.agg(F.sum(24 * F.size("ats") + 32)).first()[0] or 0
    discard(classes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                some, row, out = batch.slice(k, 128), [], []
                for j, (text, ats) in enumerate(zip(some.column(2), some.column(3).to_pylist(), strict=True)):
                    data = text.as_py()
                    for at in ats:
                        low = max(at["pos"] + gram - length, 0)
                        row.append(j)
                        out.append((at["g"], at["m"], at["pos"], at["pos"] - low, data[low : at["pos"] + length]))
                take = pa.array(row, pa.int64())
                cols = [pa.array([o[j] for o in out], pa.binary() if j == 4 else pa.int64()) for j in range(5)]
                yield pa.RecordBatch.from_arrays([some.column(0).take(take), some.column(1).take(take), *cols], names=["id", "key", "g", "m", "pos", "before", "part"])

    kind = rows.schema["id"].dataType.simpleString()
    sides = (F.broadcast(members) if held <= BROADCAST_BYTES else members)
    parts = written(rows.join(sides, F.col("key") == F.col("r_key")).select("id", "key", "text", "ats").mapInArrow(slim(cut), f"id {kind}, key long, g long, m long, pos long, before long, part binary"), "parts")
    discard(members)
    spans = spans.unionByName(_small_groups(parts.where(F.col("m") <= group), length, gram, keep))
    if parts.where(F.col("m") > group).limit(1).count():
        large = parts.where(F.col("m") > group).dropDuplicates(["g", "key", "pos"])
        spans = spans.unionByName(_large_groups(large, length, gram, keep))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.column(1):
                flat = row.values
                s, t = flat.field("s").to_numpy(), flat.field("t").to_numpy()
                order = np.argsort(s, kind="stable")
                s, t = s[order], np.maximum.accumulate(t[order])
                new = np.concatenate([[True], s[1:] > t[:-1]])
                first = np.flatnonzero(new)
                out.append(np.stack([s[first], t[np.append(first[1:] - 1, len(s) - 1)]], axis=1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["key", "spans"])

    merged = written(spans.groupBy("key").agg(F.collect_set(F.struct("s", "t")).alias("all")).mapInArrow(slim(merge), "key long, spans binary"), "spans")
    discard(spans.select("s"), parts)
    return merged


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, keep: str = "none", group: int = GROUP) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc``, with kept (the bytes that stay),
    n_bytes, n_removed and n_spans."""
    spans = repeated_spans(docs, id_col, text_col, length, gram, keep, group)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.xxhash64(F.col(id_col), text).alias("key"), text.cast("binary").alias("data"))
    rows = rows.join(_small(spans.withColumnRenamed("key", "s_key"), "spans"), F.col("key") == F.col("s_key"), "left").select("doc", "data", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                some = batch.slice(k, 256)
                kept, n, gone, pieces = [], [], [], []
                for data, raw in zip(some.column(1), some.column(2), strict=True):
                    data, raw = data.as_py(), raw.as_py()
                    n.append(len(data))
                    out, at, number = [], 0, 0
                    for s, t in np.frombuffer(raw, "<i8").reshape(-1, 2).tolist() if raw else ():
                        out.append(data[at : max(s, at)])
                        at, number = min(t, len(data)), number + 1
                    out.append(data[at:])
                    kept.append(b"".join(out))
                    gone.append(len(data) - len(kept[-1]))
                    pieces.append(number)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(kept, pa.binary()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(pieces, pa.int64())], names=["doc", "kept", "n_bytes", "n_removed", "n_spans"])

    schema = rows.select("doc").schema.add("kept", "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    return rows.mapInArrow(slim(run), schema)


def kept_text(found: DataFrame, columns: list[str], text_col: str = "text", count_col: str | None = "n_chars") -> DataFrame:
    """The documents of ``removed`` with what stays as their text (a character cut
    in two is dropped); documents of which nothing stays go, if they lost bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py().decode("utf-8", "ignore") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), batch.column(2)], names=["doc", "kept", "n_removed"])

    rows = found.select("doc", "kept", "n_removed")
    out = rows.mapInArrow(slim(run), rows.select("doc").schema.add("kept", "string").add("n_removed", "long"))
    out = out.where("n_removed = 0 or trim(kept) != ''").withColumn("kept", F.when(F.col("n_removed") == 0, F.col(f"doc.{text_col}")).otherwise(F.col("kept")))
    cols = [F.col("kept").alias(c) if c == text_col else F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col(f"doc.{c}")).cast(found.schema["doc"].dataType[c].dataType).alias(c) if c == count_col else F.col(f"doc.`{c}`").alias(c) for c in columns]
    return out.select(*cols)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept_sha256."""
    return found.select(F.col(f"doc.{id_col}").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
