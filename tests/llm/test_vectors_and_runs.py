"""Exact top-k, periodic runs and whitening against brute force, and on awkward rows."""

import collections
import hashlib
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tablepipe.llm import columnar, periodic, whitening

SF = "/root/testdata/sf0.01"
ODD = [(5000, None), (5020, [float("nan")] * 8), (5040, [float("inf"), *[1.0] * 7]), (5060, [None, *[1.0] * 7]), (None, [1.0] * 8)]
VECTORS = "vec_id long, embedding array<float>, score string, rank string, block string, v string, n string, component string"


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(*r, *"abcdef") for r in rows], VECTORS).repartition(parts)


def brute_top(rows, k=20):
    """Rows of one id are one query, the least of its vectors; vectors meet those of their length."""
    usable = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    least = {}
    for i, v in usable:
        if i % 20 == 0:
            least[i] = min(least.get(i, v), v)
    whole = lambda v: [int(np.floor(64 * float(np.float32(x)))) for x in v]
    out = {}
    for q, v in least.items():
        found = sorted((-min(sum(a * b for a, b in zip(whole(v), whole(w))), (1 << 63) - 1), i) for i, w in usable if i != q and len(w) == len(v))
        out[q] = [(i, -s) for s, i in found[:k]]
    return out


def test_top_k(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(5, 8))
    x = (centre[rng.integers(0, 5, 700)] + 0.3 * rng.normal(size=(700, 8))).round(1)  # many equal scores
    x[100:140] = x[100]
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + ODD
    rows += [(20, x[20].tolist())] * 3 + [(21, x[20].tolist())] * 2 + [(40, [9.0] * 8), (5100, [1.0, 2.0]), (5101, [2.0, 1.0]), (5120, [0.0] * 8), (5140, [])]
    for settings in ({}, dict(block_rows=64, chunk_queries=8, stripe_blocks=3)):
        got = collections.defaultdict(list)
        for r in columnar.top_k(vectors(spark, rows), F.col("vec_id") % 20 == 0, **settings).orderBy("query_id", "rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
            assert r["rank"] == len(got[r.query_id])
        want = brute_top(rows)
        assert {k: v for k, v in want.items() if v} == got
    assert columnar.top_k(vectors(spark, rows).limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert columnar.top_k(vectors(spark, ODD), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_beyond_doubles(spark):
    big = [(0, [1e9, 3.0, 1e9]), (1, [1e9, 1.0, 1e9]), (2, [1e9, 2.0, 1e9]), (3, [-1e9, 2.0, 1e9]), (4, [1.0, 1.0, 1.0])]
    got = [(r.vec_id, r.score) for r in columnar.top_k(vectors(spark, big), F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == brute_top(big)[0]
    assert columnar.top_k(vectors(spark, [(0, [3e38]), (1, [3e38]), (2, [-3e38])]), F.col("vec_id") == 0).orderBy("rank").first().score == (1 << 63) - 1


def test_bounds_drop_only_what_cannot_win():
    rng = np.random.default_rng(4)
    columns = np.floor(64 * rng.normal(size=(48, 900)) / 7)
    block = columnar.Block(np.arange(900), columns, 200.0)
    q = np.floor(64 * rng.normal(size=48) / 7)
    true = q @ columns
    floor = float(np.sort(true)[-20])
    at, scores = block.survivors(q, floor)
    assert len(at) < 900 and set(np.flatnonzero(true >= floor)) <= set(at) and (scores == true[at]).all()


def test_top_k_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    want = con.sql(E.oracle_sql()["op11_topk"]).fetchall()
    got = E.queries()["op11_topk"](spark, SF).collect()
    assert sorted(want) == sorted(tuple(r) for r in got) and len(want) > 0


def brute_runs(w, least=6, power=4):
    found = []
    for q in range(1, len(w) // power + 1):
        j = 0
        while j + q < len(w):
            k = j
            while k + q < len(w) and w[k] == w[k + q]:
                k += 1
            n = k - j + q
            if k > j and n >= max(least, power * q) and not any(w[j : j + n - r] == w[j + r : j + n] for r in range(1, q)):
                found.append((j, n, q))
            j = max(k, j + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def split(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    return [x for x in text.split(" ") if x]


def test_runs_of_short_sequences():
    rng = np.random.default_rng(6)
    for _ in range(300):
        texts = []
        for _ in range(rng.integers(1, 5)):
            w = rng.integers(0, rng.integers(1, 4), rng.integers(0, 70)).tolist()
            p, s = int(rng.integers(1, 9)), int(rng.integers(0, 60))
            for i in range(s + p, len(w)):
                w[i] = w[i - p]
            texts.append(w)
        counts = np.array([len(t) for t in texts])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(counts)), counts)
        got = periodic.runs(text << 32 | np.array(sum(texts, []), np.int64), bounds[text], bounds[text + 1])
        assert list(zip(got.start.tolist(), got.length.tolist(), got.period.tolist())) == [(int(bounds[j]) + s, n, q) for j, t in enumerate(texts) for s, n, q in brute_runs(t)]


def test_wavelet_tree():
    rng = np.random.default_rng(8)
    values = rng.permutation(500)
    tree = periodic.WaveletTree(values)
    low = rng.integers(0, 490, 200)
    high = low + rng.integers(1, 10, 200)
    value = rng.integers(0, 500, 200)
    assert tree.below(low, high, value).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, value)]
    place = (high - low) // 2
    assert tree.smallest(low, high, place).tolist() == [sorted(values[a:b])[p] for a, b, p in zip(low, high, place)]


def check_runs(docs, got):
    assert len(got) == docs.count()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    for r in got:
        matched = False
        for t in texts[r.doc_id]:
            w = split(t)
            h = zlib.crc32(str(r.doc_id).encode()) if r.doc_id is not None else 1
            n, g = len(w), h // 10
            if h % 10 == 0 and n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                w = w[:a] + [w[a + i % p] for i in range(n - a)]
            runs = brute_runs(w) if n < 3000 else None
            if runs is None:
                matched = True
                continue
            drop = {i for s, m, q in runs for i in range(s + q, s + m)}
            best = max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
            want = (len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4))
            want += (hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())
            matched |= want == (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)
        assert matched, r.doc_id


def test_runs_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = E.queries()["op12_runs"](spark, "/root/testdata/sf0.001").collect()
    assert any(r.n_runs for r in got)
    check_runs(docs, got)


def test_runs_awkward(spark):
    texts = [None, "", " \t\n ", "one", "a " * 5, "a " * 6, "x y " * 4, "x y " * 3 + "x", "é\x0bü " * 9, "b " * 4000, "tail " + "p q r " * 500, "same same same same same same", "same same same same same same", "a b " * 8]
    rows = [(k, t, *"abcdef") for k, t in enumerate(texts)] + [(None, "n " * 7, *"abcdef"), (5, None, *"abcdef"), (11, texts[11], *"abcdef")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, words string, h string, start string, length string, collapsed string").repartition(3)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    check_runs(docs, periodic.digest(periodic.collapse_runs(docs, hashes=h)).collect())
    plain = {(r.doc_id, r.words): r for r in periodic.collapse_runs(docs).collect()}
    assert bytes(plain[9, 4000].collapsed) == b"b" and [tuple(x) for x in plain[9, 4000].runs] == [(0, 4000, 1)]
    assert bytes(plain[10, 1501].collapsed) == b"tail p q r"
    assert periodic.collapse_runs(docs.limit(0)).count() == 0


def test_runs_of_a_long_text_among_others(spark):
    rng = np.random.default_rng(10)
    long = " ".join(f"w{k}" for k in rng.integers(0, 50_000, 200_000)) + " c d e" * 30_000
    docs = spark.createDataFrame([(1, long), (2, "z " * 8)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r for r in periodic.collapse_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(200_000, 90_000, 3)] and [tuple(x) for x in got[2].runs] == [(0, 8, 1)]


def brute_white(c, k=8):
    x = np.floor(1024 * c.astype(np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    z = (n * x - s) / n
    e, u = np.linalg.eigh(z.T @ z / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return ((n * x - s) ** 2).sum(axis=1), z @ u / np.sqrt(e), e / np.trace(z.T @ z / n)


def compare_white(got, ids, c, k):
    deviation, w, explained = brute_white(c, k)
    by = collections.defaultdict(dict)
    for r in got:
        by[r.vec_id][r.component] = r
        assert r.n == len(c) and 0 <= r.identity_error <= 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
    assert sorted(by) == sorted(ids)
    sign = np.sign([by[ids[np.abs(w[:, j]).argmax()]][j + 1].whitened * w[np.abs(w[:, j]).argmax(), j] for j in range(k)])
    for i, vec_id in enumerate(ids):
        assert sorted(by[vec_id]) == list(range(1, k + 1))
        assert {r.deviation for r in by[vec_id].values()} == {int(deviation[i])}
        assert np.allclose([by[vec_id][j + 1].whitened for j in range(k)], sign * w[i], atol=1e-8)


def test_whitening(spark):
    rng = np.random.default_rng(12)
    x = (rng.normal(size=(400, 8)) @ rng.normal(size=(8, 8))).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = whitening.whiten(vectors(spark, rows + ODD[:-1] + [(6000, [1.0, 2.0]), (6001, [])])).collect()
    compare_white(got, list(range(400)), x, 8)
    again = whitening.whiten(vectors(spark, rows, 5)).collect()
    assert {(r.vec_id, r.component, r.whitened) for r in again} == {(r.vec_id, r.component, r.whitened) for r in got}


def test_whitening_query(spark):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/embeddings.parquet")
    got = E.queries()["op13_whitening"](spark, SF).collect()
    compare_white(got, t["vec_id"].to_pylist(), np.array(t["embedding"].to_pylist(), np.float32), 8)


def test_whitening_awkward(spark):
    assert whitening.whiten(vectors(spark, ODD).limit(0)).count() == 0
    assert whitening.whiten(vectors(spark, ODD[:-1])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).count() == 0  # no variance
    flat = [(k, [float(k), 2.0 * k, 5.0]) for k in range(4)]  # rank one
    got = whitening.whiten(vectors(spark, flat + flat[:1] + [(None, [9.0, 18.0, 5.0])])).collect()
    assert len(got) == 6 and {r.component for r in got} == {1} and all(abs(r.explained - 1) < 1e-12 for r in got)
    assert sum(r.vec_id is None for r in got) == 1 and sum(r.vec_id == 0 for r in got) == 2
    far = whitening.whiten(vectors(spark, [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 2.0])])).collect()
    assert {r.vec_id for r in far if r.deviation is None} == {1, 2, 3} or all(r.deviation is None or r.deviation >= 0 for r in far)


@pytest.mark.parametrize("n", [1, 2, 5, 24, 33])
def test_cholesky_and_jacobi(n):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(n, max(n - 2, 1)))
    v = a @ a.T
    factor = whitening.pivoted_cholesky(v)
    assert factor.shape[1] == np.linalg.matrix_rank(v) and np.allclose(factor @ factor.T, v)
    e, u = whitening.jacobi(factor)
    want = np.linalg.eigvalsh(v)[::-1][: len(e)]
    assert np.allclose(e, want) and np.allclose(u.T @ u, np.eye(len(e))) and np.allclose(v @ u, u * e)
