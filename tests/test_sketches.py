"""Length sketches by file: exact counts, medians within the stated rank error, only new files read."""

import random

import pytest

from tablepipe.operators.profile import ROWS_MARK, size_factors, string_length_stats
from tablepipe.operators.sketches import length_profile, merged_lengths, profile_new_files, rank_error


def rank_off(lengths, value):
    below, upto = sum(x < value for x in lengths), sum(x <= value for x in lengths)
    n = len(lengths)
    return max(0.0, below / n - 0.5, 0.5 - upto / n)


def by_column(spark, source, store):
    return {r["column_name"]: r for r in merged_lengths(spark, source, store).collect()}


@pytest.mark.parametrize("k", [64, 2048])
def test_merged_medians_and_new_files(spark, tmp_dir, k):
    rnd = random.Random(k)
    source, store, every = f"{tmp_dir}/in", f"{tmp_dir}/kept", []
    for day, shape in enumerate((lambda: rnd.randrange(1, 2000), lambda: int(rnd.paretovariate(1.1)) % 5000, lambda: 7)):
        lengths = [shape() for _ in range(3000)]
        every += lengths
        spark.createDataFrame([("x" * n, None if i % 3 else "é", i) for i, n in enumerate(lengths)], "t string, s string, i int") \
             .repartition(2).write.parquet(f"{source}/day={day}")
        assert profile_new_files(spark, source, store, k=k) == 2
        assert profile_new_files(spark, source, store, k=k) == 0
        got = by_column(spark, source, store)
        assert set(got) == {"t", "s", ROWS_MARK} and got[ROWS_MARK].n_values == len(every)
        assert (got["t"].n_values, got["t"].total_len, got["t"].max_len) == (len(every), sum(every), max(every))
        assert rank_off(every, got["t"].median_len) <= rank_error(k)
        assert got["s"].n_values == 1000 * (day + 1) and got["s"].median_len == 2.0 and got["s"].avg_len == 2.0


def test_rewritten_and_deleted_files_no_longer_count(spark, tmp_dir):
    source, store = f"{tmp_dir}/in", f"{tmp_dir}/kept"
    spark.createDataFrame([("abc",)] * 10, "t string").coalesce(1).write.parquet(f"{source}/a")
    spark.createDataFrame([("a", None)] * 4, "t string, later string").coalesce(1).write.parquet(f"{source}/b")
    assert profile_new_files(spark, source, store) == 2
    got = by_column(spark, source, store)
    assert got["t"].n_values == 14 and got["later"].n_values == 0 and got["later"].median_len is None
    spark.createDataFrame([("abcdef",)] * 3, "t string").coalesce(1).write.mode("overwrite").parquet(f"{source}/a")
    assert profile_new_files(spark, source, store) == 1
    got = by_column(spark, source, store)
    assert (got["t"].n_values, got["t"].total_len, got["t"].files) == (7, 22, 2)


def test_empty_files_csv_and_no_strings(spark, tmp_dir):
    source, store = f"{tmp_dir}/in", f"{tmp_dir}/kept"
    spark.createDataFrame([("abc", 1)], "t string, n int").coalesce(1).where("n > 5").write.parquet(f"{source}/none")
    assert profile_new_files(spark, source, store) == 1 and profile_new_files(spark, source, store) == 0
    assert by_column(spark, source, store)[ROWS_MARK].n_values == 0
    spark.range(5).write.parquet(f"{tmp_dir}/numbers")
    assert profile_new_files(spark, f"{tmp_dir}/numbers", f"{tmp_dir}/kept2") > 0
    assert set(by_column(spark, f"{tmp_dir}/numbers", f"{tmp_dir}/kept2")) == {ROWS_MARK}
    spark.createDataFrame([("abcd", "x")] * 6, "a string, b string").coalesce(1).write.option("header", True).csv(f"{tmp_dir}/text")
    assert profile_new_files(spark, f"{tmp_dir}/text", f"{tmp_dir}/kept3", "csv") == 1
    assert by_column(spark, f"{tmp_dir}/text", f"{tmp_dir}/kept3")["a"].median_len == 4.0
    with pytest.raises(ValueError):
        profile_new_files(spark, source, store, "csv", multiline=True)


def test_factors_from_sketches(spark, tmp_dir):
    spark.createDataFrame([("x" * (i % 11), i) for i in range(999)], "t string, i int").repartition(3).write.parquet(f"{tmp_dir}/one")
    tables = {"one": spark.read.parquet(f"{tmp_dir}/one")}
    stats = length_profile(spark, {"one": f"{tmp_dir}/one"}, f"{tmp_dir}/kept")
    exact = {r.column_name: r for r in string_length_stats(tables).collect()}
    for r in stats.collect():
        if r.column_name != ROWS_MARK:
            assert (r.n_values, r.median_len) == (exact[r.column_name].n_values, exact[r.column_name].median_len)
    assert size_factors(spark, tables, stats=stats).collect() == size_factors(spark, tables).collect()


def test_large_files_come_in_parts(spark, tmp_dir, monkeypatch):
    from tablepipe.plans import catalog
    from tablepipe.streaming import incremental

    docs = spark.range(600).selectExpr("id as doc_id", "repeat(string(hash(id)), int(id % 40)) as text", "'en' as lang", "if(id % 3 = 0, null, 'site') as source", "id as n_chars")
    docs.coalesce(1).write.parquet(f"{tmp_dir}/a b/documents.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/a b/documents.parquet")
    assert incremental.split_into_files(docs, f"{tmp_dir}/whole", 3) == 1 and len(spark.read.parquet(f"{tmp_dir}/whole").inputFiles()) == 3
    monkeypatch.setattr(incremental, "PART_BYTES", 2000)
    parts = incremental.split_into_files(docs, f"{tmp_dir}/parts", 3)
    written = spark.read.parquet(f"{tmp_dir}/parts")
    assert parts > 1 and len(written.inputFiles()) == 3 * parts and written.exceptAll(docs).count() == 0 and written.count() == 600
    got = {r.column_name: r for r in catalog.length_sketches_q(spark, f"{tmp_dir}/a b").collect()}
    assert {(r.files_first, r.files_second, r.files_third) for r in got.values()} == {(3, 2, 0)}
    assert got["source"].n_values == 800 and got["text"].n_values == 1200 and all(r.median_within_error for r in got.values())
