"""Radix selection against sorting, with repeated keys, repeated rows, nulls and empty tables."""

from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablepipe.operators import selection
from tablepipe.operators.sample import validation_rows
from tablepipe.operators.selection import exact_sample, key_hash48, radix_cut


def rows_of(df):
    return Counter(tuple(map(str, r)) for r in df.collect())


@settings(max_examples=12, deadline=None)
@given(values=st.lists(st.integers(0, 4095), max_size=60), n=st.integers(0, 70), digit=st.sampled_from([3, 4, 12, 16]))
def test_cut_equals_sorting(spark, values, n, digit):
    cut = radix_cut(spark.createDataFrame([(v,) for v in values], "v bigint"), F.col("v"), 12, n, digit)
    n = min(n, len(values))
    below = [v for v in values if v < cut.limit]
    assert cut.rows == len(values) and len(below) + cut.take == n
    assert sorted(values)[:n] == sorted(below) + [cut.limit] * cut.take
    assert not cut.take or cut.tied == values.count(cut.limit) > cut.take


def test_exact_share_by_smallest_hashes(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    ranked = [r.k for r in df.orderBy(key_hash48(["k"])).collect()]
    for share in (0.0, 0.0001, 0.1, 0.37, 1.0):
        got = exact_sample(df.repartition(7), share, ["k"])
        assert sorted(r.k for r in got.collect()) == sorted(ranked[:int(5000 * share)])
    other = {r.k for r in exact_sample(df, 0.1, ["k"], seed="b").collect()}
    assert len(other) == 500 and other != set(ranked[:500])
    assert exact_sample(df, n=9000, keys=["k"]).count() == 5000
    assert validation_rows(df, 0.25, ["k"], exact=True).count() == 1250


def test_hot_key_and_hot_row(spark, monkeypatch):
    monkeypatch.setattr(selection, "COPIES", 100)              # several tasks of copies
    data = [(1, "same")] * 700 + [(1, f"v{i}") for i in range(300)] + [(i, "x") for i in range(2, 502)]
    df = spark.createDataFrame(data, "k int, t string").repartition(5)
    have = rows_of(df)
    for n in (1, 250, 499, 500, 501, 900, 1300, 1499):
        got = exact_sample(df, n=n, keys=["k"])
        taken = rows_of(got)
        assert sum(taken.values()) == n and not taken - have
        assert rows_of(exact_sample(df.repartition(3), n=n, keys=["k"])) == taken
    assert rows_of(exact_sample(df, n=400)) - have == Counter() and exact_sample(df, n=400).count() == 400


def test_nulls_maps_and_empty_tables(spark):
    df = spark.createDataFrame([(None, {"a": 1}, "r"), (None, {"a": 2}, "r"), (None, None, None), (3, {}, "c")], "k int, m map<string,int>, c string")
    for n in range(5):
        got = exact_sample(df, n=n, keys=["k"])
        assert got.columns == df.columns and sum(rows_of(got).values()) == n and not rows_of(got) - rows_of(df)
    assert exact_sample(df.limit(0), 0.5, ["k"]).count() == 0
    assert exact_sample(df.limit(0), n=3).count() == 0
    odd = spark.createDataFrame([(i, i) for i in range(20)], "`a.b` int, r int")
    assert exact_sample(odd, 0.5, ["a.b"]).count() == 10
    for bad in ({}, {"fraction": 0.5, "n": 1}, {"fraction": 1.5}):
        with pytest.raises(ValueError):
            exact_sample(df, **bad)


def test_three_passes_over_the_keys(spark, monkeypatch):
    df = spark.range(20000).withColumnRenamed("id", "k")
    seen = []
    real = selection.F.shiftright
    monkeypatch.setattr(selection.F, "shiftright", lambda *a: seen.append(a) or real(*a))
    exact_sample(df, 0.3, ["k"])
    assert len(seen) <= 5                                       # a digit a pass, a prefix test in all but the first
