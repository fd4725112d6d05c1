"""K1-K5: write the cleaned table.

Modes follow the published config: ``fail`` (default), ``append``,
``replace``.  ``fail`` is checked before any work is done.  A catalog table
(``saveAsTable``) or a path is the default sink and commits as one Spark job;
JDBC writes are parallel per partition, so they are atomic per partition
only (see ``write_jdbc``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SPARK_MODE = {"fail": "errorifexists", "append": "append", "replace": "overwrite"}


class TargetExists(RuntimeError):
    pass


def is_path(target: str) -> bool:
    return "/" in target or target.startswith(("file:", "hdfs:", "s3", "gs:", "abfs"))


def target_exists(spark: SparkSession, target: str) -> bool:
    if is_path(target):
        jvm = spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(target)
        fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
        return bool(fs.exists(hpath))
    return bool(spark.catalog.tableExists(target))


def check_target(spark: SparkSession, target: str, mode: str) -> None:
    """Refuse early: with ``fail`` an existing target stops the load before
    anything is read or transformed."""
    if mode not in SPARK_MODE:
        raise ValueError(f"mode must be one of {sorted(SPARK_MODE)}")
    if mode == "fail" and target_exists(spark, target):
        raise TargetExists(f"target {target!r} exists and if_table_exists is 'fail'")


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def write_table(df: DataFrame, target: str, mode: str = "fail", fmt: str = "parquet",
                partition_by: list[str] | None = None, **options: str) -> None:
    """K3/K4/K5: one parallel write; catalog name or path.

    ``replace`` of a path writes a sibling staging folder first and swaps it
    in with two renames, so a failed job leaves the old table as it was
    (the commit of new files is Spark's job commit).  ``append`` and ``fail``
    only add files at job commit.  Catalog ``replace`` is Spark's overwrite."""
    spark = df.sparkSession
    check_target(spark, target, mode)
    w = df.write.format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if not is_path(target):
        w.mode(SPARK_MODE[mode]).saveAsTable(target)
        return
    if mode != "replace" or not target_exists(spark, target):
        w.mode(SPARK_MODE[mode] if mode != "replace" else "overwrite").save(target)
        return
    commit_staged(spark, stage(df, target, fmt, partition_by, **options), target, "replace")


def stage(df: DataFrame, target: str, fmt: str = "parquet", partition_by: list[str] | None = None,
          **options: str) -> str:
    """Write ``df`` to a fresh staging folder next to ``target`` (path targets);
    return its path.  Nothing is visible at the target until ``commit_staged``."""
    staging = f"{target.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
    w = df.write.format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    try:
        w.mode("errorifexists").save(staging)
    except Exception:
        discard_staged(df.sparkSession, staging)
        raise
    return staging


def discard_staged(spark: SparkSession, staging: str) -> None:
    fs, spath = _fs(spark, staging)
    fs.delete(spath, True)


def commit_staged(spark: SparkSession, staging: str, target: str, mode: str) -> None:
    """Make a staged write visible with renames only (no data is rewritten):
    ``fail`` / ``replace`` swap the folder in, ``append`` moves the data files
    (relative paths kept, so partition folders too) into the target."""
    check_target(spark, target, mode)
    fs, tpath = _fs(spark, target)
    _, spath = _fs(spark, staging)
    if mode == "append" and fs.exists(tpath):
        files = fs.listFiles(spath, True)
        base = str(spath.toUri().getPath()).rstrip("/")
        jvm = spark._jvm
        while files.hasNext():
            src = files.next().getPath()
            rel = str(src.toUri().getPath())[len(base) + 1:]
            if rel == "_SUCCESS" or rel.split("/")[-1].startswith("."):
                continue                                  # job marker, checksums; partitions may begin with "_"
            dst = jvm.org.apache.hadoop.fs.Path(tpath, rel)
            fs.mkdirs(dst.getParent())
            if not fs.rename(src, dst):
                raise RuntimeError(f"could not move {src} into {target}")
        fs.delete(spath, True)
        return
    if fs.exists(tpath):                                  # replace: swap, keep the old one until done
        _, retired = _fs(spark, f"{target.rstrip('/')}.__retired-{uuid.uuid4().hex[:12]}")
        if not fs.rename(tpath, retired):
            raise RuntimeError(f"could not move {target} aside")
        if not fs.rename(spath, tpath):
            fs.rename(retired, tpath)
            raise RuntimeError(f"could not move {staging} into place")
        fs.delete(retired, True)
        return
    fs.mkdirs(tpath.getParent())
    if not fs.rename(spath, tpath):
        raise RuntimeError(f"could not move {staging} into place")


def create_target(df: DataFrame, target: str, mode: str = "fail", fmt: str = "parquet") -> None:
    """K2: empty target with the frame's schema (for loads that append later)."""
    write_table(df.limit(0), target, mode, fmt)


def read_target(spark: SparkSession, target: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(target) if is_path(target) else spark.table(target)


def write_report(df: DataFrame, path: str) -> None:
    """K1: the cleaned table (or its validation sample) as a Parquet report."""
    df.write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "fail", *,
               properties: dict[str, str] | None = None, batchsize: int = 10000,
               num_partitions: int | None = None) -> None:
    """K3/K5 over JDBC.  Each partition writes in its own transaction; for an
    all-or-nothing load write a stage table with ``replace`` and let the
    database move the rows in one transaction."""
    if mode not in SPARK_MODE:
        raise ValueError(f"mode must be one of {sorted(SPARK_MODE)}")
    w = (df.write.format("jdbc").mode(SPARK_MODE[mode])
         .option("url", url).option("dbtable", table).option("batchsize", str(batchsize)))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
