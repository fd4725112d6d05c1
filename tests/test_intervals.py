"""Interval join against brute force, and the row-group index against the files."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tablepipe.operators.intervals import interval_join
from tablepipe.operators.profile import row_group_index, row_groups_holding

POINTS = "k int, x double, p int"
SPANS = "k int, s double, e double, i int"


def fixture(seed):
    rnd = random.Random(seed)
    points = [(rnd.randrange(3), float(rnd.randrange(-200, 200)), n) for n in range(300)]
    points += [(1, 7.0, 300 + n) for n in range(80)]                      # a crowded place
    points += [(None, 7.0, 400), (1, None, 401), (1, float("nan"), 402), (1, float("inf"), 403)]
    spans = [(rnd.randrange(3), s := float(rnd.randrange(-200, 200)), s + rnd.choice([0, 1, 3, 40, 350]), n) for n in range(150)]
    spans += [(1, 6.0, 9.0, 150 + n) for n in range(60)]
    spans += [(1, 9.0, 2.0, 300), (None, 0.0, 9.0, 301), (1, None, 9.0, 302), (1, 0.0, None, 303), (1, 0.0, float("inf"), 304)]
    return points, spans


def finite(v):
    return v is not None and v == v and abs(v) != float("inf")


@pytest.mark.parametrize("keyed,closed,crowd,width", [(True, False, 100_000, None), (False, True, 16, None), (True, True, 5, 3.0)])
def test_interval_join_against_brute_force(spark, keyed, closed, crowd, width):
    points, spans = fixture(crowd)
    got = interval_join(spark.createDataFrame(points, POINTS), spark.createDataFrame(spans, SPANS), "x", "s", "e",
                        keys=[("k", "k")] if keyed else None, closed=closed, crowd=crowd, width=width)
    got = sorted((r.p.p, r.i.i) for r in got.collect())
    want = sorted((p, i) for kp, x, p in points for ki, s, e, i in spans
                  if finite(x) and finite(s) and finite(e) and (not keyed or (kp is not None and kp == ki))
                  and s <= x and (x <= e if closed else x < e))
    assert got == want


def test_interval_join_on_times_and_empty_sides(spark):
    day = dt.datetime(2024, 1, 1)
    points = spark.createDataFrame([(day + dt.timedelta(hours=h), h) for h in range(48)], "t timestamp_ntz, p int")
    spans = spark.createDataFrame([(day + dt.timedelta(hours=a), day + dt.timedelta(hours=b), a) for a, b in ((0, 1), (5, 40), (47, 90))],
                                  "s timestamp_ntz, e timestamp_ntz, i int")
    got = sorted((r.i.i, r.p.p) for r in interval_join(points, spans, "t", "s", "e").collect())
    assert got == [(0, 0), *[(5, h) for h in range(5, 40)], (47, 47)]
    assert interval_join(points.limit(0), spans, "t", "s", "e").count() == 0
    assert interval_join(points, spans.limit(0), "t", "s", "e").count() == 0
    with pytest.raises(TypeError):
        interval_join(points.selectExpr("'a' AS t"), spans, "t", "s", "e")


def test_row_group_index(spark, tmp_dir):
    n = list(range(100))
    t = pa.table({"n": pa.array(n, pa.int64()), "f": pa.array([None if i >= 60 else i / 2 for i in n], pa.float64()),
                  "s": pa.array([f"v{i:03d}" for i in n]), "d": pa.array([dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in n]),
                  "v": pa.array([[i, i + 1] for i in n], pa.list_(pa.int32()))})
    pq.write_table(t, f"{tmp_dir}/a.parquet", row_group_size=30)
    pq.write_table(t.slice(0, 0), f"{tmp_dir}/none.parquet")
    index = row_group_index(spark, tmp_dir).cache()
    rows = {(r.row_group, r.column): r for r in index.collect() if r.path.endswith("a.parquet")}
    assert len(rows) == 4 * 5
    md = pq.ParquetFile(f"{tmp_dir}/a.parquet").metadata
    for g in range(4):
        part = t.slice(30 * g, 30)
        for c in range(5):
            chunk = md.row_group(g).column(c)
            r = rows[(g, chunk.path_in_schema)]
            assert (r.num_rows, r.compressed_bytes, r.uncompressed_bytes) == (len(part), chunk.total_compressed_size, chunk.total_uncompressed_size)
        assert (rows[(g, "n")].min_number, rows[(g, "n")].max_number) == (30 * g, 30 * g + len(part) - 1)
        assert (rows[(g, "s")].min_text, rows[(g, "s")].max_text) == (part["s"][0].as_py(), part["s"][-1].as_py())
        assert rows[(g, "d")].min_number == (part["d"][0].as_py() - dt.date(1970, 1, 1)).days
        assert rows[(g, "f")].null_count == part["f"].null_count
    groups = lambda *a: sorted(r.row_group for r in row_groups_holding(index, *a).collect())
    assert groups("n", 30, 59) == [1]
    assert groups("n", 59) == [1, 2, 3]
    assert groups("s", None, "v029") == [0]
    assert groups("f") == [0, 1]                                          # the others hold nulls alone
    assert groups("n", 500) == []
