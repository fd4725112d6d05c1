"""Nearest neighbours with a hierarchical k-means tree (operator 5).

* The tree is fitted on a bounded sample (SAMPLE vectors, a documented
  parameter); every vector is then dealt to a leaf by descending the tree.
* A query pops the best node of a priority queue (largest inner product with the
  node's centre); inner nodes push their children, leaves are visited.  How many
  leaves is widened until the recall over a bounded set of calibration queries,
  against an exact scan of all vectors, reaches TARGET.
* Leaf members are packed into blocks of bounded size and so are the queries of
  a leaf; blocks and query chunks meet by leaf.  Only the best scores of a chunk
  leave a task; a rank over each query's rows gives its nearest.

Nothing but the tree (bounded by SAMPLE) is broadcast.

Defined results: vectors that are null, zero, or hold a null or non-finite
component take no part, nor do those of another length than most; every row is a
candidate of its own (but those with the query's id); rows of one query id are
one query (the least of its vectors where they differ); an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablepipe.llm.common import written

K = 20
SAMPLE = 16_384
BRANCH = 8
LEAF = 512
CALIBRATION = 64
TARGET = 0.97
BLOCK_ROWS = 256
CHUNK_QUERIES = 256
# Queries whose best scores a task remembers before it starts afresh.
REMEMBERED = 50_000
# The rounding error of an inner product, relative to the dimension and both norms, with room to spare.
ROUNDING = 4 * np.finfo(np.float64).eps


class Tree(NamedTuple):
    """Nodes in breadth-first order; children[k] is empty for a leaf, leaf[k] its number."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    leaves: int


def fit_tree(points: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 11) -> Tree:
    """Hierarchical k-means by a few Lloyd rounds at each node."""
    rng = np.random.default_rng(seed)
    centres, children, numbers, leaves = [points.mean(axis=0)], [[]], [-1], 0
    todo = [(0, np.arange(len(points)))]
    for node, rows in todo:
        here, groups = points[rows], []
        if len(rows) > leaf:
            c = here[rng.choice(len(rows), min(branch, len(rows)), replace=False)]
            for _ in range(8):
                near = (2 * here @ c.T - (c * c).sum(axis=1)).argmax(axis=1)
                c = np.stack([here[near == j].mean(axis=0) if (near == j).any() else c[j] for j in range(len(c))])
            near = (2 * here @ c.T - (c * c).sum(axis=1)).argmax(axis=1)
            groups = [(c[j], rows[near == j]) for j in range(len(c)) if (near == j).any()]
        if len(groups) < 2:
            numbers[node] = leaves
            leaves += 1
            continue
        for centre, members in groups:
            children[node].append(len(centres))
            centres.append(centre)
            children.append([])
            numbers.append(-1)
            todo.append((len(centres) - 1, members))
    return Tree(np.stack(centres), children, numbers, leaves)


def assign(tree: Tree, x: np.ndarray) -> np.ndarray:
    """The leaf of each row: at every node on to the nearest child."""
    out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
    for node, rows in todo:
        kids = tree.children[node]
        if not kids:
            out[rows] = tree.leaf[node]
            continue
        c = tree.centres[kids]
        near = (2 * x[rows] @ c.T - (c * c).sum(axis=1)).argmax(axis=1)
        todo += [(kids[j], rows[near == j]) for j in np.unique(near)]
    return out


def best_first(tree: Tree, q: np.ndarray, counts: list[int], visits: int, least: int) -> list[int]:
    """Leaves in the order of the priority queue: ``visits`` of them, more until they hold ``least`` rows."""
    heap, out, held = [(0.0, 0)], [], 0
    near = tree.centres @ q
    while heap and (len(out) < visits or held < least):
        _, node = heapq.heappop(heap)
        if tree.children[node]:
            for kid in tree.children[node]:
                heapq.heappush(heap, (-near[kid], kid))
        else:
            out.append(tree.leaf[node])
            held += counts[tree.leaf[node]]
    return out


def _usable(v: Column) -> Column:
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & fine & F.exists(v, lambda x: x != 0)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores with all ties at the last place."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])


def nearest(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, sample: int = SAMPLE, target: float = TARGET, calibration: int = CALIBRATION, seed: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row for which
    ``queries`` (a condition on the id column) holds."""
    spark = vectors.sparkSession
    kind = vectors.schema[id_col].dataType.simpleString()
    result = f"query_id {kind}, rank int, vec_id {kind}, score double"
    rows = vectors.where(_usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(queries.cast("boolean"), F.lit(False)).alias("asks"))
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], result)
    dim, total = dims[0]["d"], dims[0]["count"]
    rows = rows.where(F.size("v") == dim)
    pick = F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1_000_003))
    # Copies of a row count once, so that a hot id does not fill the sample.
    fit = rows.where(pick < 1_000_003 * min(1.0, 0.9 * sample / total)).select("vec_id", "v").distinct().limit(sample).collect()
    fit = fit or rows.select("vec_id", "v").limit(1).collect()
    points, point_ids = np.asarray([r["v"] for r in fit]), pa.array([r["vec_id"] for r in fit]).to_numpy(zero_copy_only=False)
    largest = np.linalg.norm(points, axis=1).max()
    tree = fit_tree(points)
    point_leaf = assign(tree, points)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for b in batches:
            salt = pa.array(range(at, at + b.num_rows), pa.int64())  # tells the rows of one id apart
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(assign(tree, _matrix(b.column(1), dim))), salt], names=["vec_id", "v", "asks", "leaf", "salt"])

    dealt = written(rows.mapInArrow(deal, f"vec_id {kind}, v array<double>, asks boolean, leaf long, salt long"), "leaves")
    counted = {r[0]: r[1] for r in dealt.groupBy("leaf").count().collect()}  # one row a leaf, bounded by the sample
    counts = [counted.get(j, 0) for j in range(tree.leaves)]
    asked = dealt.where("asks").groupBy("vec_id").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("own"))
    visits = _calibrated(dealt, asked, tree, counts, dim, k, target, calibration, seed)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 256):
                some = b.slice(s, 256)
                row, leaf, asks = [], [], _matrix(some.column(1), dim)
                # Sample vectors are candidates too: the last of the query's k best among those in its leaves (those of
                # its own id apart) bounds its k-th nearest found from below, and no lower score need leave a task.
                known, floor, seen = asks @ points.T, np.full(some.num_rows, -np.inf), np.zeros(tree.leaves, bool)
                slack = ROUNDING * dim * largest * np.linalg.norm(asks, axis=1)
                names, own = some.column(0).to_pylist(), some.column(2).to_pylist()
                for i, q in enumerate(asks):
                    go = [j for j in best_first(tree, q, counts, visits, k + own[i]) if counts[j]]
                    row += [i] * len(go)
                    leaf += go
                    seen[:] = False
                    seen[go] = True
                    mine = known[i][seen[point_leaf] & (point_ids != names[i])]
                    if len(mine) >= k:
                        floor[i] = np.partition(mine, len(mine) - k)[len(mine) - k] - slack[i]
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0).take(at), pa.array(leaf, pa.int64()), pa.array(floor).take(at)], names=["vec_id", "leaf", "floor"])

    # Chunks of a leaf's queries and blocks of its members, both of bounded size, meet by leaf.
    met = asked.mapInArrow(visit, f"vec_id {kind}, leaf long, floor double")
    met = written(met, "visits")
    per_leaf = met.groupBy(F.col("leaf").alias("m_leaf")).agg(F.count(F.lit(1)).alias("n"))
    spread = lambda by, n, size: F.pmod(F.xxhash64(*by, F.lit(3)), F.ceil(F.col(n) / size))
    met = met.join(F.broadcast(per_leaf), F.col("leaf") == F.col("m_leaf")).withColumn("chunk", spread(["vec_id"], "n", CHUNK_QUERIES))  # one row a leaf
    chunks = met.join(asked.drop("own"), "vec_id").groupBy("leaf", "chunk").agg(F.collect_list(F.struct("vec_id", "v", "floor")).alias("q"))
    sizes = spark.createDataFrame(pa.table({"s_leaf": pa.array(range(tree.leaves), pa.int64()), "n": pa.array(counts, pa.int64())}))
    blocks = dealt.join(F.broadcast(sizes), F.col("leaf") == F.col("s_leaf")).withColumn("block", spread(["vec_id", "salt"], "n", BLOCK_ROWS))
    blocks = blocks.groupBy(F.col("leaf").alias("b_leaf"), "block").agg(F.collect_list(F.struct("vec_id", "v")).alias("x"))
    pairs = chunks.join(blocks, F.col("leaf") == F.col("b_leaf")).select("q", "x")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}  # query -> its k best scores here; a row below the last of them cannot be among the nearest
        for b in batches:
            for i in range(b.num_rows):
                q, x = (b.column(c).slice(i, 1).flatten() for c in (0, 1))
                q_ids, x_ids = q.field("vec_id"), x.field("vec_id")
                least = q.field("floor").to_numpy()
                names, own = q_ids.to_pylist(), x_ids.to_numpy(zero_copy_only=False)
                x_rows = _matrix(x.field("v"), dim)
                q_rows = _matrix(q.field("v"), dim)
                scores = q_rows @ x_rows.T
                least = least - ROUNDING * dim * np.linalg.norm(x_rows, axis=1).max() * np.linalg.norm(q_rows, axis=1)
                out_q, out_x, out_s = [], [], []
                for j, name in enumerate(names):
                    floor = best.get(name)
                    at = np.flatnonzero((own != name) & (scores[j] >= (max(floor[0], least[j]) if floor is not None and len(floor) >= k else least[j])))
                    at = at[_top(scores[j][at], own[at], k)] if len(at) else at
                    if len(at):
                        mine = scores[j][at]
                        best[name] = np.sort(mine if floor is None else np.concatenate([floor, mine]))[-k:]
                        out_q += [j] * len(at)
                        out_x.append(at)
                        out_s.append(mine)
                if len(best) > REMEMBERED:
                    best.clear()
                if out_q:
                    yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(out_q, pa.int64())), x_ids.take(pa.array(np.concatenate(out_x))), pa.array(np.concatenate(out_s))], names=["query_id", "vec_id", "score"])

    found = pairs.mapInArrow(score, f"query_id {kind}, vec_id {kind}, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrated(dealt: DataFrame, asked: DataFrame, tree: Tree, counts: list[int], dim: int, k: int, target: float, calibration: int, seed: int) -> int:
    """Leaf visits at which the calibration queries find the target share of their true nearest."""
    some = asked.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(calibration).collect()
    if not some:
        return 1
    ids, q = [r["vec_id"] for r in some], np.asarray([r["v"] for r in some])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0), np.zeros(0, np.int64))] * len(ids)
        for b in batches:
            own, leaf = b.column(0).to_numpy(zero_copy_only=False), b.column(3).to_numpy()
            scores = q @ _matrix(b.column(1), dim).T
            for j, name in enumerate(ids):
                at = np.flatnonzero(own != name)
                s, where = np.concatenate([best[j][0], scores[j][at]]), np.concatenate([best[j][1], leaf[at]])
                top = np.argsort(-s, kind="stable")[:k]
                best[j] = s[top], where[top]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(ids)), [len(s) for s, _ in best])), pa.array(np.concatenate([s for s, _ in best])), pa.array(np.concatenate([w for _, w in best]))], names=["j", "score", "leaf"])

    exact = dealt.mapInArrow(scan, "j long, score double, leaf long")
    rank = F.row_number().over(Window.partitionBy("j").orderBy(F.desc("score"), "leaf"))
    true = exact.withColumn("rank", rank).where(F.col("rank") <= k).collect()  # k rows a calibration query
    hits = np.zeros(tree.leaves + 1)
    for j in range(len(ids)):
        place = {leaf: i for i, leaf in enumerate(best_first(tree, q[j], counts, tree.leaves, 0))}
        for r in true:
            if r["j"] == j:
                hits[place[r["leaf"]] + 1] += 1
    share = np.cumsum(hits) / max(hits.sum(), 1)
    return int(np.argmax(share >= target)) or 1
