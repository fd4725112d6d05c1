"""Exact top-k search by columnar branch and bound (operator 11).

* Components become integers, floor(scale * x), so every score is exact.
* Candidate rows are packed into blocks of bounded size in vertical layout (all
  rows' first component, then all rows' second, ...), queries into chunks.  A
  chunk meets stripes of blocks: one shuffle by (length, chunk, stripe), and a
  task holds one chunk and one block at a time.
* A query takes its dimensions by falling weight, a few at a time.  After each
  few, a candidate can at most add the product of what is left of the query's
  mass and of its own (Cauchy-Schwarz); those that cannot reach the query's
  k-th best so far go, and the next dimensions are read for the survivors only.
* The k-th best so far starts at that of one block, which every query meets
  first, and rises from block to block of a stripe.

Only one row a vector length is broadcast, once their number is known to be
under LENGTHS; nothing is collected.

Defined results: vectors that are null or hold a null or non-finite component
take no part, nor do rows without an id; vectors meet those of their own length
only (empty ones score 0); every row is a candidate of its own, but those with
the query's id; rows of one query id are one query (the least of its vectors
where they differ); ties go to the smaller id, rows of one id and score count
each; a score outside a long is cut to its range; an empty table gives no rows;
columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm.common import written

K = 20
SCALE = 64
BLOCK_ROWS = 4096
CHUNK_QUERIES = 256
STRIPE_BLOCKS = 8
# Dimensions read between two bounds.
STEP = 12
# Lengths of vectors up to which one row a length is broadcast.
LENGTHS = 100_000
# The bound's own rounding.
SLACK = 1 + 1e-5
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def _packed(values: np.ndarray) -> tuple[str, bytes]:
    """Integral doubles (rows, dims) in vertical layout, in the smallest type that holds them."""
    most = np.abs(values).max(initial=0)
    kind = next((k for k, n in (("i1", 7), ("i2", 15), ("i4", 31)) if most < 1 << n), "f8")
    return kind, np.ascontiguousarray(values.T).astype(f"<{kind}").tobytes()


def _unpacked(kind: str, data: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(data, f"<{kind}").reshape(dim, rows)


class Block:
    """Candidates of one block: columns[d] holds component d of every row."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, largest_query: float):
        self.ids = ids
        wide = columns.astype(np.float64)
        mass = (wide * wide).sum(axis=0)
        reach = np.sqrt(mass.max(initial=0)) * max(largest_query, np.sqrt(mass.max(initial=0)))
        # Integers below the type's mantissa add up without rounding, in any order.
        kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else object
        self.exact = kind is object
        self.columns = np.array([[int(x) for x in c] for c in wide], object).reshape(wide.shape) if self.exact else wide.astype(kind)
        if not self.exact:
            self.squares, self.mass = self.columns * self.columns, mass.astype(kind)

    def survivors(self, query: np.ndarray, floor: float | None) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of every row that reaches ``floor``, maybe with others below it."""
        if self.exact:  # beyond doubles: whole numbers of any size, no bounds
            scores = sum((int(q) * c for q, c in zip(query, self.columns)), np.zeros(len(self.ids), object))
            return np.arange(len(self.ids)), np.array([min(max(s, LEAST), MOST) for s in scores], object)
        q = query.astype(self.columns.dtype)
        order = np.argsort(-np.abs(q), kind="stable")
        left = np.append(np.cumsum((q * q)[order][::-1])[::-1], 0)
        rows, score, mass = None, 0, self.mass
        for at in range(0, len(order), STEP):
            dims = order[at : at + STEP]
            here = dims if rows is None else np.ix_(dims, rows)
            score = score + q[dims] @ self.columns[here]
            if floor is None or at + STEP >= len(order):
                continue
            mass = mass - self.squares[here].sum(axis=0)
            alive = np.flatnonzero(score + np.sqrt(left[at + STEP] * mass) * SLACK >= floor)
            if len(alive) < 0.9 * len(score):
                rows = alive if rows is None else rows[alive]
                score, mass = score[alive], mass[alive]
        rows = np.arange(len(self.ids)) if rows is None else rows
        return rows, np.broadcast_to(np.asarray(score), len(rows))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best, ties to the smaller id."""
    if len(scores) > k and scores.dtype != object:
        near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        ids, scores = ids[near], scores[near]
    order = np.lexsort((ids, -scores))[:k] if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k], int)
    return ids[order], scores[order]


def _usable(v: Column) -> Column:
    return v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def _few(df: DataFrame, name: str) -> DataFrame:
    """``df`` (one row a length) written, and marked for broadcast if it is small."""
    df = written(df, name)
    return F.broadcast(df) if df.count() <= LENGTHS else df


def top_k(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: float = SCALE, block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES, stripe_blocks: int = STRIPE_BLOCKS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest integer inner products of each
    row for which ``queries`` (a condition on the id column) holds, over all rows of other ids."""
    kind = vectors.schema[id_col].dataType.simpleString()
    whole = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.when(F.abs(x * scale) < F.lit(float("inf")), x * scale).otherwise(F.signum(x) * F.lit(1.7e308)))
    rows = vectors.where(_usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("vec_id"), whole.alias("v"), F.coalesce(queries.cast("boolean"), F.lit(False)).alias("asks"))
    rows = rows.withColumn("dim", F.size("v"))
    # Copies of a row go to different blocks: the salt counts rows, not values.
    rows = written(rows.withColumn("salt", F.monotonically_increasing_id()), "vectors")
    sizes = _few(rows.groupBy(F.col("dim").alias("s_dim")).agg(F.count(F.lit(1)).alias("n")), "lengths")
    asked = rows.where("asks").groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
    # An id with vectors of several lengths is one query, that of the least vector.
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("v", "dim")).alias("least")).select("vec_id", "least.dim", "least.v")
    asked = written(asked, "queries")
    asked_sizes = _few(asked.groupBy(F.col("dim").alias("a_dim")).agg(F.count(F.lit(1)).alias("m")), "query-lengths")

    def packed(df: DataFrame, number: str, most: int) -> DataFrame:
        """(dim, number) -> rows in vertical layout; ``most`` rows each, hashed, in groups of bounded size."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    dim, inside = b.column(0)[i].as_py(), b.column(2).slice(i, 1).flatten()
                    ids = inside.field("vec_id")
                    values = np.floor(inside.field("v").flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), dim)
                    small, data = _packed(values)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), b.column(1).slice(i, 1), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([small]), pa.array([data], pa.binary())],
                        names=["dim", number, "ids", "kind", "data"],
                    )

        grouped = df.groupBy("dim", number).agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
        return grouped.mapInArrow(run, f"dim int, {number} long, ids array<{kind}>, kind string, data binary")

    blocks = rows.join(sizes, F.col("dim") == F.col("s_dim")).withColumn("block", F.pmod(F.xxhash64("salt", F.lit(7)), F.ceil(F.col("n") / block_rows)))
    blocks = written(packed(blocks, "block", block_rows), "blocks")
    chunks = asked.join(asked_sizes, F.col("dim") == F.col("a_dim")).withColumn("chunk", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.ceil(F.col("m") / chunk_queries)))
    chunks = written(packed(chunks, "chunk", chunk_queries), "chunks")

    def visited(turn: int, floors: DataFrame | None) -> DataFrame:
        """The best of every (query, stripe): turn 0 sees the first block alone, turn 1 all others."""
        mine = blocks.where("block = 0" if turn == 0 else "block > 0").withColumn("stripe", F.floor(F.col("block") / stripe_blocks))
        chunk_count = _few(chunks.groupBy(F.col("dim").alias("c_dim")).agg((F.max("chunk") + 1).alias("chunks")), "chunk-counts")
        stripes = _few(mine.groupBy(F.col("dim").alias("t_dim")).agg(F.collect_set("stripe").alias("stripes")), "stripes")
        met = mine.join(chunk_count, F.col("dim") == F.col("c_dim")).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        met = met.select("dim", "chunk", "stripe", "block", "ids", "kind", "data", F.lit(None).cast("array<double>").alias("floors"))
        asks = chunks if floors is None else floors
        asks = asks.join(stripes, F.col("dim") == F.col("t_dim")).withColumn("stripe", F.explode("stripes"))
        asks = asks.select("dim", "chunk", "stripe", F.lit(-1).cast("long").alias("block"), "ids", "kind", "data", F.lit(None).cast("array<double>").alias("floors") if floors is None else F.col("floors"))
        tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # given, so that small cells are not put together
        dealt = met.unionByName(asks).repartition(tasks, "dim", "chunk", "stripe").sortWithinPartitions("dim", "chunk", "stripe", "block")
        return dealt.mapInArrow(_search(k), f"dim int, chunk long, stripe long, ids array<{kind}>, kind string, data binary, floors array<double>, found array<struct<query_id:{kind},vec_id:{kind},score:long>>")

    first = written(visited(0, None), "first")
    found = first.select(F.explode("found").alias("f"))
    rest = visited(1, first.select("dim", "chunk", "ids", "kind", "data", "floors"))
    found = found.unionByName(rest.select(F.explode("found").alias("f"))).select("f.*")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(k: int):
    """Rows sorted by (dim, chunk, stripe, block): a chunk's queries (block -1), then its blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def done(state: dict) -> pa.RecordBatch:
            names, row = state["names"], state["row"]
            of = np.repeat(np.arange(len(names)), [len(s) for _, s in state["best"]])
            ids = pa.array([x for i, _ in state["best"] for x in i.tolist()], names.type)
            scores = pa.array([int(x) for _, s in state["best"] for x in s.tolist()], pa.int64())
            floors = pa.array([float(s[k - 1]) if len(s) >= k else -np.inf for _, s in state["best"]], pa.float64())
            inside = pa.StructArray.from_arrays([names.take(pa.array(of)), ids, scores], names=["query_id", "vec_id", "score"])
            ends = lambda x: pa.array([0, len(x)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [*[row.column(c) for c in ("dim", "chunk", "stripe", "ids", "kind", "data")], pa.ListArray.from_arrays(ends(floors), floors), pa.ListArray.from_arrays(ends(inside), inside)],
                names=["dim", "chunk", "stripe", "ids", "kind", "data", "floors", "found"],
            )

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1)
                dim, number = row.column("dim")[0].as_py(), row.column("block")[0].as_py()
                ids = row.column("ids").flatten()
                columns = _unpacked(row.column("kind")[0].as_py(), row.column("data")[0].as_py(), dim, len(ids))
                if number < 0:
                    if held:
                        yield done(held)
                    floors = row.column("floors")[0].as_py() or [-np.inf] * len(ids)
                    asks = columns.astype(np.float64).T
                    none = (ids.to_numpy(zero_copy_only=False)[:0], np.zeros(0))
                    held = {"row": row, "names": ids, "own": ids.to_pylist(), "asks": asks, "floors": floors, "best": [none] * len(ids), "largest": float(np.sqrt((asks * asks).sum(axis=1)).max(initial=0))}
                    continue
                block = Block(ids.to_numpy(zero_copy_only=False), columns, held["largest"])
                for j, q in enumerate(held["asks"]):
                    mine, scores = held["best"][j]
                    floor = max(float(scores[k - 1]) if len(scores) >= k else -np.inf, held["floors"][j])
                    at, new = block.survivors(q, floor if floor > -np.inf else None)
                    found = block.ids[at]
                    keep = found != held["own"][j]
                    if not block.exact:
                        keep &= new >= floor
                        new = new.astype(np.float64)
                    if keep.any():
                        held["best"][j] = _best(np.concatenate([mine, found[keep]]), np.concatenate([scores, new[keep]]), k)
        if held:
            yield done(held)

    return run
