"""Parallel reading of CSV with quoted line breaks against Spark's multiLine."""

import csv
import io
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablepipe.sources.csv_records import byte_ranges, read_records, record_counts, record_index, records
from tablepipe.sources.files import CSV_OPTIONS, read_csv, write_csv

ROWS = [["a", "b", "c"], ["1", "plain", "x"], ["2", "two\nlines", ""], ["3", 'say "hi"\n\n"there"', "y"], ["4", "", "\n"], ["5", "é\r\nü", "z,z"], ["6", "   ", "w" * 50], ["7", "\n\n\n", '""']]


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


def spark_rows(spark, path, schema):
    return sorted(map(str, spark.read.options(**CSV_OPTIONS, multiLine=True).schema(schema).csv(path).collect()))


SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("tail", ["", "last", "blank"])
def test_every_range_size_equals_multiline(spark, tmp_dir, end, tail):
    text = text_of(ROWS, end)
    text = text + "8,no end,q" if tail == "last" else text + end + end if tail == "blank" else text
    text = text.replace(f"2,", f"{end}2,", 1) if tail == "blank" else text   # empty lines between records
    path = f"{tmp_dir}/t.csv"
    with open(path, "w", newline="") as f:
        f.write(text)
    want = spark_rows(spark, path, SCHEMA)
    n = len(ROWS) - 1 + (tail == "last")
    assert len(want) == n
    for size in (2, 5, 16, 10_000):
        index = record_index(spark, path, size)
        assert index.count() == -(-len(text.encode()) // size)
        got = read_records(spark, path, SCHEMA, index, number="at", **CSV_OPTIONS).collect()
        # inside quotes multiLine turns the file's line end into \n
        shown = lambda v: v.replace(end, "\n") if v is not None else v
        assert sorted(str(T.Row(**{c: shown(r[c]) for c in "abc"})) for r in got) == want, size
        assert sorted(r["at"] for r in got) == list(range(n)) and record_counts(index).first().records == n
        assert [r.a for r in sorted(got, key=lambda r: r["at"])] == [str(k + 1) for k in range(n)]


def test_documents_in_several_files(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    write_csv(docs.repartition(3), f"{tmp_dir}/docs")
    index = record_index(spark, f"{tmp_dir}/docs", 5_000)
    assert index.where("open").count() > 0 and record_counts(index).agg(F.sum("records")).first()[0] == docs.count()
    back = read_records(spark, f"{tmp_dir}/docs", docs.schema, index, **CSV_OPTIONS)
    assert back.rdd.getNumPartitions() > 3
    assert back.exceptAll(docs).count() == 0 == docs.exceptAll(back).count()
    names = read_csv(spark, f"{tmp_dir}/docs", multiline=True)
    assert names.columns == docs.columns and names.count() == docs.count()


def test_row_ranges(spark, tmp_dir):
    rows = [["k", "t"]] + [[str(k), f"line\n{k}"] for k in range(500)]
    with open(f"{tmp_dir}/r.csv", "w", newline="") as f:
        f.write(text_of(rows))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("t", T.StringType())])
    got = read_records(spark, f"{tmp_dir}/r.csv", schema, range_bytes=400, number="at", **CSV_OPTIONS).where("at between 120 and 179")
    assert sorted(r.k for r in got.collect()) == list(range(120, 180))


def test_odd_files(spark, tmp_dir):
    for name, text in (("header.csv", "a,b,c\n"), ("bare.csv", "a,b,c"), ("empty.csv", "")):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
        assert read_records(spark, f"{tmp_dir}/{name}", SCHEMA, **CSV_OPTIONS).count() == 0
    assert byte_ranges(spark, f"{tmp_dir}/empty.csv").count() == 0
    os.mkdir(f"{tmp_dir}/many")
    for k in range(3):
        with open(f"{tmp_dir}/many/{k} é.csv", "w", newline="") as f:
            f.write(text_of(ROWS))
    assert records(record_index(spark, f"{tmp_dir}/many", 20)).count() == 3 * len(ROWS)


def test_bad_rows_and_types(spark, tmp_dir):
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write('a,b\n1,"x\ny"\nno,2\n3\n')
    typed = "a int, b string"
    got = read_csv(spark, f"{tmp_dir}/b.csv", typed, keep_corrupt=True, multiline=True).collect()
    want = spark.read.options(**CSV_OPTIONS, multiLine=True, columnNameOfCorruptRecord="_corrupt_record").schema(typed + ", _corrupt_record string").csv(f"{tmp_dir}/b.csv").collect()
    assert sorted((r.a is None, r.a, r.b) for r in got) == sorted((r.a is None, r.a, r.b) for r in want)
    assert sorted(r._corrupt_record is None for r in got) == sorted(r._corrupt_record is None for r in want)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv(spark, f"{tmp_dir}/b.csv", typed, multiline=True, mode="FAILFAST").collect()


def test_compressed_files_go_to_spark(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "a\nb"), (2, "c")], "k int, t string")
    docs.coalesce(1).write.option("header", True).option("escape", '"').option("compression", "gzip").csv(f"{tmp_dir}/gz")
    assert sorted(r.t for r in read_csv(spark, f"{tmp_dir}/gz", "k int, t string", multiline=True).collect()) == ["a\nb", "c"]


def test_csv_query_over_several_files(spark, tmp_dir, monkeypatch):
    from tablepipe.plans import catalog

    docs = spark.range(300).selectExpr("id as doc_id", "if(id % 7 = 0, null, concat('a\"', id, '\n\n', repeat('x, ', int(id)))) as text", "'en' as lang", "'s' as source", "id as n_chars")
    docs.repartition(4).write.parquet(f"{tmp_dir}/documents.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda *_: f"{tmp_dir}/written")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        got = catalog.csv_record_ranges(spark, tmp_dir).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(str, got)) == sorted(map(str, spark.read.parquet(f"{tmp_dir}/documents.parquet").collect()))
    assert len(spark.read.text(f"{tmp_dir}/written").inputFiles()) > 1
