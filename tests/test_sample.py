"""L2 / V7: exact head samples on both paths, keyed samples."""

from tablepipe.operators.sample import head_fraction, head_rows, keyed_sample, validation_rows

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
         "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def test_head_paths_agree(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for n in (1, 777, 3000, 6000, 10 ** 6):
        small = head_rows(li, n, ORDER)
        ranged = head_rows(li, n, ORDER, topk_max_rows=100, partitions=5)
        assert ranged.count() == min(n, li.count())
        assert small.exceptAll(ranged).count() == 0 and ranged.exceptAll(small).count() == 0


def test_head_fraction_takes_the_first_rows(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in head_fraction(df, 0.25, ["k"], topk_max_rows=10).collect())
    assert got == list(range(250))


def test_keyed_sample_is_stable(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    a = keyed_sample(df, 0.1, ["k"])
    b = keyed_sample(df.repartition(7), 0.1, ["k"])
    assert a.exceptAll(b).count() == 0
    assert 1700 < a.count() < 2300
    assert validation_rows(df, 1.0) is df


def test_head_with_tied_keys(spark):
    df = spark.range(5000).selectExpr("id DIV 1000 AS k", "id")
    got = head_rows(df, 2500, ["k"], topk_max_rows=10, partitions=4)
    rows = got.collect()
    assert len(rows) == 2500
    assert sorted({r.k for r in rows}) == [0, 1, 2]
    assert sum(1 for r in rows if r.k == 2) == 500


def test_head_with_null_keys(spark):
    df = spark.createDataFrame([(None if i % 9 == 0 else i, i) for i in range(400)], "k int, v int")
    want = sorted(df.collect(), key=lambda r: (r.k is not None, r.k if r.k is not None else 0, r.v))[:150]
    got = head_rows(df, 150, ["k", "v"], topk_max_rows=5, partitions=3).collect()
    assert sorted(r.v for r in got) == sorted(r.v for r in want)


def test_head_when_one_key_dominates(spark):
    rows = [(0, -1)] + [(1, i) for i in range(5000)] + [(2, i) for i in range(3)]
    df = spark.createDataFrame(rows, "k int, v int").repartition(4)
    got = head_rows(df, 3000, ["k"], topk_max_rows=10, partitions=4).collect()
    assert len(got) == 3000
    assert sum(1 for r in got if r.k == 0) == 1 and sum(1 for r in got if r.k == 2) == 0
    got2 = head_rows(df, 5003, ["k"], topk_max_rows=10, partitions=4).collect()
    assert sorted(r.k for r in got2)[-2:] == [2, 2] and len(got2) == 5003
