"""MinHash near-duplicates with sequential Bayesian verification (operator 10).

1. Every document's set of 5-word shingles becomes 64-bit hashes, a digest of
   the set and 252 MinHash values.  Documents of equal sets are one class, its
   smallest id standing for it (a partial aggregate, so thousands of copies meet
   as one row a task).
2. The representatives' values are cut into 36 bands of 7; members of a band
   bucket are candidates.  At similarity 0.85 a pair shares a band but for a
   chance of 1e-6, so none is lost in practice.
3. A bucket never emits all its pairs.  In rounds, the largest component of a
   bucket (a single document at first) is held against its other components,
   then leaves it.  Components meet in packed chunks of documents, so a large one
   costs rows by its chunks.  Once a round links few of those that it compares,
   what is left in a bucket is packed into chunks, and its chunks meet: a row for
   a document and chunk, not for a pair.  A bucket is done when its members are
   all in one component or all its chunks have met.
4. Two signatures are compared in steps of 36 values.  After each step the
   posterior chance that the similarity reaches the threshold (uniform prior) is
   bounded; below the chosen miss probability the pair is dropped.
5. Survivors are confirmed on the full shingle sets, until a document is linked.
6. Components come from repeated smallest-label steps with pointer jumping.

Defined results: null, empty or blank text has an empty set, is its own
component and kept; with fewer than five words the whole sequence is the only
shingle; rows that share an id share its links, each row is labelled through
its own set; a null id is a node of no links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm.common import written
from tablepipe.llm.texts import slim

WORDS = 5
BANDS, ROWS = 36, 7
STEP = 36
THRESHOLD = (85, 100)
MISS = 1e-6
# Documents in a chunk: of a component, of a bucket.
CHUNK, BUCKET_CHUNK = 64, 128
# Rounds go on while they link one in so many of the documents that ask.
WORTH = 5
# Ids (24 bytes each) sent to all executors at most; more are shuffled.
BROADCAST_ROWS = 1_000_000
_CACHE_WORDS = 500_000
_MASK = (1 << 64) - 1


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_607)
    return rng.integers(1, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shifts and odd multipliers), so all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= _CACHE_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(text: str | None, words: int = WORDS, hashes: WordHashes | None = None) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the text's shingles of ``words`` words.
    ``hashes``: those of words seen before, which a task keeps while it runs."""
    hashes = WordHashes() if hashes is None else hashes
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    span = min(words, len(parts))
    out = np.full(len(h) - span + 1, span, np.uint64)
    for k in range(span):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(out)])
    return np.unique(out)


def signature(found: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values of 32 bits."""
    a, b = _constants(n)
    least = np.full(n, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(found), 256):
        some = found[k : k + 256, None] * a + b
        np.minimum(least, (some >> np.uint64(32)).astype(np.uint32).min(axis=0), out=least)
    return least


def least_matches(step: int, n: int, threshold: float, miss: float) -> list[int]:
    """For each prefix of a multiple of ``step`` values: the fewest equal values at
    which P(similarity >= threshold | matches) is not below ``miss``.  Under the
    uniform prior that chance is P(Binomial(prefix + 1, threshold) <= matches)."""
    out = []
    for k in range(step, n + 1, step):
        below = 0.0
        for m in range(k + 1):
            below += math.comb(k + 1, m) * threshold**m * (1 - threshold) ** (k + 1 - m)
            if below >= miss:
                out.append(m)
                break
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, n: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, signature; written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hashes = WordHashes()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some, size, digest, sig = batch.slice(k, 512), [], [], []
                for text in some.column(1).to_pylist():
                    found = shingles(text, words, hashes)
                    size.append(len(found))
                    digest.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                    sig.append(signature(found, n).astype("<u4").tobytes() if len(found) else None)
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["doc_id", "n_shingles", "digest", "sig"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(slim(run), f"doc_id {kind}, n_shingles long, digest binary, sig binary"), "sketches")


def with_data(dealt: DataFrame, data: DataFrame, rows: int) -> DataFrame:
    """The signature and shingles of each id of the ``rows`` rows of ``dealt``."""
    needed = dealt.withColumnRenamed("id", "d_id")
    return data.join(needed if rows > BROADCAST_ROWS else F.broadcast(needed), F.col("id") == F.col("d_id")).drop("d_id")


class Likeness:
    """Pruning by signatures and confirmation on full sets."""

    def __init__(self, n: int, step: int, threshold: tuple[int, int], miss: float):
        self.n, self.step, self.threshold = n, step, threshold
        self.least = least_matches(step, n, threshold[0] / threshold[1], miss)

    def unpacked(self, docs: pa.StructArray) -> tuple[pa.Array, np.ndarray, list[np.ndarray]]:
        sigs = np.frombuffer(b"".join(docs.field("sig").to_pylist()), "<u4").reshape(-1, self.n)
        return docs.field("id"), sigs, [np.frombuffer(x, "<u8") for x in docs.field("shingles").to_pylist()]

    def candidates(self, x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
        """The pairs (i, j) that stay, the most alike first; only pairs still in the
        running see the next values."""
        equal = np.zeros(len(i), np.int64)
        for turn, need in enumerate(self.least):
            part = slice(turn * self.step, (turn + 1) * self.step)
            equal = equal + (x[i, part] == y[j, part]).sum(axis=1)
            stays = equal >= need
            i, j, equal = i[stays], j[stays], equal[stays]
        best = np.argsort(-equal, kind="stable")
        return list(zip(i[best].tolist(), j[best].tolist(), strict=True))

    def confirmed(self, u: np.ndarray, v: np.ndarray) -> bool:
        low, high = self.threshold
        if min(len(u), len(v)) * high < max(len(u), len(v)) * low:
            return False
        both = len(np.intersect1d(u, v, assume_unique=True))
        return high * both >= low * (len(u) + len(v) - both)


def block_links(asks: DataFrame, labels: DataFrame, data: DataFrame, n: int, step: int, threshold: tuple[int, int], miss: float, chunk: int) -> DataFrame:
    """(a, b): a link for every document of an asking component that has one to the
    target component, or several; none where there is none.

    ``asks``: label, target (labels of two components).  The documents of both
    sides, with signature and shingles, are packed into chunks of bounded size
    that meet by target; a chunk pair compares signatures step by step, then
    confirms on the full sets, the most alike first, until a document is linked."""
    kind = labels.schema["id"].dataType.simpleString()

    def packed(rows: DataFrame, name: str) -> DataFrame:
        """target and chunks of (id, sig, shingles) of the (target, id) rows."""
        rows = written(rows, name)
        sizes = rows.groupBy(F.col("target").alias("s_target")).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
        dealt = rows.join(sizes, F.col("target") == F.col("s_target")).select("target", "id", F.pmod(F.xxhash64("id", F.lit(9)), F.col("chunks")).alias("chunk"))
        full = with_data(dealt, data, rows.count()).select("target", "chunk", F.struct("id", "sig", "shingles").alias("doc"))
        return full.groupBy("target", "chunk").agg(F.collect_list("doc").alias(name))

    own = labels.select("id", F.col("label").alias("own_label"))
    askers = packed(asks.join(own, F.col("label") == F.col("own_label")).select("target", "id"), "askers")
    wanted = packed(asks.select("target").distinct().join(own, F.col("target") == F.col("own_label")).select("target", "id"), "wanted")
    met = askers.select("target", "askers").join(wanted.select(F.col("target").alias("w_target"), "wanted"), F.col("target") == F.col("w_target")).select("askers", "wanted")
    alike = Likeness(n, step, threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (x_ids, x, x_sets), (y_ids, y, y_sets) = (alike.unpacked(batch.column(c).slice(k, 1).flatten()) for c in (0, 1))
                i, j = (g.ravel() for g in np.indices((len(x), len(y))))
                linked: dict[int, int] = {}
                for p, q in alike.candidates(x, y, i, j):
                    if p not in linked and alike.confirmed(x_sets[p], y_sets[q]):
                        linked[p] = q
                yield pa.RecordBatch.from_arrays([x_ids.take(pa.array(list(linked), pa.int64())), y_ids.take(pa.array(list(linked.values()), pa.int64()))], names=["a", "b"])

    return met.mapInArrow(slim(run), f"a {kind}, b {kind}")


def bucket_links(named: DataFrame, data: DataFrame, n: int, step: int, threshold: tuple[int, int], miss: float, chunk: int) -> DataFrame:
    """(a, b): links that join all linked components of a bucket.

    ``named``: bucket, id, label.  A bucket's documents are dealt to chunks; every
    two chunks meet once as a row, where pairs of different labels are compared
    unless links found there already join them."""
    kind = named.schema["id"].dataType.simpleString()
    sizes = named.groupBy(F.col("bucket").alias("s_bucket")).agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"))
    dealt = named.join(sizes, F.col("bucket") == F.col("s_bucket")).withColumn("own", F.pmod(F.xxhash64("id", F.lit(9)), F.col("chunks")))
    full = with_data(dealt.select("bucket", "id", "label", "own", "chunks"), data, named.count())
    doc = F.struct("own", "label", "id", "sig", "shingles").alias("doc")
    full = full.select("bucket", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"), doc)
    met = full.groupBy("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(F.collect_list("doc").alias("docs")).select("low", "docs")
    alike = Likeness(n, step, threshold, miss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                docs = batch.column(1).slice(k, 1).flatten()
                ids, sigs, sets = alike.unpacked(docs)
                label = docs.field("label").dictionary_encode().indices.to_numpy()
                low = docs.field("own").to_numpy() == batch.column(0)[k].as_py()
                i, j = np.nonzero(np.triu(label[:, None] != label[None, :], 1) & ((low[:, None] != low[None, :]) | low.all()))
                root = list(range(len(label)))

                def find(x: int, root: list[int] = root) -> int:
                    while root[x] != x:
                        root[x] = x = root[root[x]]
                    return x

                links = []
                for p, q in alike.candidates(sigs, sigs, i, j):
                    u, v = find(int(label[p])), find(int(label[q]))
                    if u != v and alike.confirmed(sets[p], sets[q]):
                        root[u] = v
                        links.append((p, q))
                a, b = (ids.take(pa.array([x[c] for x in links], pa.int64())) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])

    return met.mapInArrow(slim(run), f"a {kind}, b {kind}")


def components(edges: DataFrame, name: str = "labels") -> DataFrame:
    """id, label (smallest id reachable) for every end of ``edges`` (a, b).

    Each round hooks every node to the smallest label next to it, then jumps to
    the label's own label; chains shorten by powers of two.  Neighbours are
    aggregated before the shuffle, so a hub costs one row a task."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")), f"{name}-edges")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near")).select("id", F.least("id", "near").alias("label")), name)
    while True:
        near = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        # A node's own label is hooked as well, so that a whole component moves with its root.
        own = labels.join(near, F.col("id") == F.col("a")).select("id", "label", F.least("label", "near").alias("least"))
        roots = own.groupBy(F.col("label").alias("root")).agg(F.min("least").alias("to"))
        moved = own.join(roots, F.col("label") == F.col("root")).select("id", F.col("label").alias("was"), F.least("least", "to").alias("hook"))
        jump = moved.select(F.col("id").alias("j_id"), F.col("hook").alias("j_hook"))
        moved = moved.join(jump, F.col("hook") == F.col("j_id")).select("id", "was", F.least("hook", "j_hook").alias("label"))
        moved = written(moved, name)
        if not moved.where("label != was").limit(1).count():
            return moved.select("id", "label")
        labels = moved.select("id", "label")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: tuple[int, int] = THRESHOLD, bands: int = BANDS, rows: int = ROWS, step: int = STEP, miss: float = MISS, chunk: int = CHUNK, bucket_chunk: int = BUCKET_CHUNK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per row of ``docs``."""
    n = bands * rows
    sketched = sketches(docs, id_col, text_col, words, n)
    named = sketched.where("doc_id is not null and digest is not null")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("id"))

    # Band buckets of class representatives that hold two of them at least.
    per_class = sketched.select("doc_id", "digest", "sig").join(classes.withColumnRenamed("digest", "c_digest"), (F.col("doc_id") == F.col("id")) & (F.col("digest") == F.col("c_digest"))).select("id", "sig").dropDuplicates(["id", "sig"])
    keys = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 4 * rows * k + 1, 4 * rows)) for k in range(bands)])
    banded = per_class.select("id", F.explode(keys).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select(F.col("bucket").alias("s_bucket"))
    members = written(banded.join(shared, F.col("bucket") == F.col("s_bucket")).select("bucket", "id").distinct(), "members")
    ids = written(members.select("id").distinct(), "ids")
    sigs = written(per_class.join(ids, "id", "left_semi"), "sigs")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                found = [shingles(t, words, hashes).astype("<u8").tobytes() for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(found, pa.binary())], names=["id", "shingles"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(ids, "id", "left_semi")
    kind = docs.schema[id_col].dataType.simpleString()
    sets = texts.mapInArrow(slim(hashed), f"id {kind}, shingles binary").where(F.length("shingles") > 0)
    data = written(sets.join(sigs, "id").dropDuplicates(["id", "sig", "shingles"]), "data")

    # How much company an id has: a group's common origin shares most buckets and comes first.
    filled = members.groupBy(F.col("bucket").alias("f_bucket")).agg(F.count(F.lit(1)).alias("filled"))
    company = written(members.join(filled, F.col("bucket") == F.col("f_bucket")).groupBy(F.col("id").alias("c_id")).agg(F.sum("filled").alias("company")), "company")
    labels = written(ids.join(company, F.col("id") == F.col("c_id")).select("id", F.col("id").alias("label"), "company"), "classes")
    edges, rounds = None, True
    while True:
        sizes = labels.groupBy(F.col("label").alias("z_label")).agg(F.count(F.lit(1)).alias("size"), F.max("company").alias("company"))
        named = members.join(labels.select(F.col("id").alias("n_id"), "label"), F.col("id") == F.col("n_id")).select("bucket", "id", "label")
        open_ = named.groupBy(F.col("bucket").alias("o_bucket")).agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("o_bucket")
        named = written(named.join(open_, F.col("bucket") == F.col("o_bucket")).select("bucket", "id", "label"), "open")
        if not named.limit(1).count():
            break
        if rounds:
            parts = named.select("bucket", "label").distinct().join(sizes, F.col("label") == F.col("z_label"))
            # The largest component of a bucket: most others fall to it.
            first = Window.partitionBy("bucket").orderBy(F.desc("size"), F.desc("company"), "label")
            chosen = parts.withColumn("rank", F.row_number().over(first)).where("rank = 1")
            chosen = written(chosen.select(F.col("bucket").alias("p_bucket"), F.col("label").alias("target"), F.col("size").alias("p_size")), "pivots")
            met = parts.join(chosen, (F.col("bucket") == F.col("p_bucket")) & (F.col("label") != F.col("target")))
            # Of two components the smaller asks.
            swap = (F.col("p_size") < F.col("size")) | ((F.col("p_size") == F.col("size")) & (F.col("target") > F.col("label")))
            asks = written(met.select(F.when(swap, F.col("target")).otherwise(F.col("label")).alias("label"), F.when(swap, F.col("label")).otherwise(F.col("target")).alias("target")).distinct(), "asks")
            links = written(block_links(asks, labels, data, n, step, threshold, miss, chunk), "links")
            members = written(named.join(chosen, (F.col("bucket") == F.col("p_bucket")) & (F.col("label") == F.col("target")), "left_anti").select("bucket", "id"), "members")
            worth = links.count() * WORTH >= asks.count()
        else:
            links = written(bucket_links(named, data, n, step, threshold, miss, bucket_chunk), "links")
        if links.limit(1).count():
            edges = links if edges is None else edges.unionByName(links)
            found = components(edges).select(F.col("id").alias("f_id"), F.col("label").alias("f_label"))
            labels = written(labels.join(found, F.col("id") == F.col("f_id"), "left").select("id", F.coalesce("f_label", "id").alias("label"), "company"), "classes")
        if not rounds:
            break  # all chunks of all buckets have met
        rounds = worth

    # Every row is labelled through the class of its own set.
    of_class = classes.join(labels, "id", "left").select(F.col("digest").alias("l_digest"), F.coalesce("label", "id").alias("label"))
    out = sketched.select("doc_id", "n_shingles", "digest").join(of_class, F.col("digest") == F.col("l_digest"), "left")
    out = out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
