"""Care of tables: emptying, leftovers, statistics, health, and layouts that let scans skip data."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "path string, bytes bigint, modified_ms bigint"


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if fs.exists(p):
        walk = fs.listFiles(p, True)
        while walk.hasNext():
            f = walk.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return found


def truncate(spark: SparkSession, path: str, fmt: str = "parquet") -> None:
    """Keeps the schema and takes all rows."""
    empty = spark.createDataFrame([], spark.read.format(fmt).load(path).schema)
    empty.coalesce(1).write.format(fmt).mode("overwrite").save(path)


def vacuum(spark: SparkSession, path: str, hours: float = 168.0, now_ms: int | None = None) -> list[str]:
    """Deletes what unfinished writes left (temporary folders, swapped tables, hidden files) if it is older; returns the files."""
    jvm = spark._jvm
    limit = (int(time.time() * 1000) if now_ms is None else now_ms) - hours * 3_600_000
    left = [f for p in (path, path + ".new", path + ".old") for f in _files(spark, p)]
    gone = [f for f, _, at in left if at <= limit and ("/_temporary/" in f or "/.spark-staging" in f or ".new/" in f or ".old/" in f or f.rsplit("/", 1)[-1].startswith("."))]
    for f in gone:
        q = jvm.org.apache.hadoop.fs.Path(f)
        q.getFileSystem(spark._jsc.hadoopConfiguration()).delete(q, False)
    return sorted(gone)


def analyze(spark: SparkSession, table: str) -> None:
    """Statistics of a catalog table and its columns, for the cost-based optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def table_health(spark: SparkSession, path: str, small_bytes: int = 16 << 20) -> DataFrame:
    """One row: data files, bytes, small files, the largest, and whether compaction would pay (more than half of many files are small)."""
    data = [f for f in _files(spark, path) if not f[0].rsplit("/", 1)[-1].startswith(("_", "."))]
    f = spark.createDataFrame(data, FILES)
    out = f.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("bytes") < small_bytes).alias("small_files"), F.coalesce(F.max("bytes"), F.lit(0)).alias("largest"))
    return out.withColumn("compact", (F.col("files") > 8) & (F.col("small_files") * 2 > F.col("files")))


def write_skippable(df: DataFrame, path: str, by: list[str], filters: list[str] = (), files: int | None = None) -> None:
    """Rows ranged and sorted by columns, so that file and row-group bounds rule files out, with Parquet Bloom filters for point lookups.

    It stands for indexes: b-tree ones are the order, those on single values the filters.
    """
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    w = ranged.sortWithinPartitions(*by).write.mode("overwrite")
    for c in filters:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def lineage(df: DataFrame) -> dict[str, list[str]]:
    """What a frame is made of, from its plan: input files and their tables, and the columns each leaf gives."""
    files = sorted(df.inputFiles())
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    columns = [", ".join(a.name() for a in _items(leaves.apply(i).output())) for i in range(leaves.size())]
    tables = set()
    for f in files:
        folder = f.split("/")[:-1]
        while folder and "=" in folder[-1]:
            folder.pop()
        tables.add("/".join(folder))
    return {"files": files, "tables": sorted(tables), "columns": sorted(columns)}


def _items(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]
