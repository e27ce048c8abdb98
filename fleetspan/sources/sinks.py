"""Writing layers and tables: partitioned appends, overwrites, merges, quarantine, retention.

The format is a parameter (parquet by default; ``delta`` where its jars are there). A table that is rewritten from its own rows
is written beside itself first and swapped in by renaming, so no read sees a half-written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.operators.clean import with_time_parts
from fleetspan.operators.dedup import merged_latest

PARTS = {"bronze": ("year", "month", "day", "hour"), "silver": ("year", "month", "day"), "gold": ("year", "month")}
KEYS = {"hourly": ["line_id", "hour_timestamp"], "daily": ["date"], "line": ["line_id", "analysis_period", "period_start"]}


def write_layer(df: DataFrame, path: str, layer: str, ts: str, mode: str = "append", fmt: str = "parquet", files_per_part: int | None = None) -> None:
    """Event-time partitions by the layer's parts. Rows are clustered by partition first, so a task writes few files; ``files_per_part`` salts busy partitions."""
    parts = PARTS[layer]
    out = with_time_parts(df, ts, parts)
    salt = [F.pmod(F.xxhash64(ts), F.lit(files_per_part))] if files_per_part else []
    writer = out.repartition(*parts, *salt).write.format(fmt).mode(mode).partitionBy(*parts).option("compression", "snappy")
    (writer.option("mergeSchema", "true") if fmt == "delta" else writer).save(path)


def read_table(spark: SparkSession, path: str, like: Callable[[], DataFrame], fmt: str = "parquet") -> DataFrame:
    """The table at ``path``. A partitioned table that was written without rows has no file to tell its columns: it is empty, with those of ``like``."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
    return spark.createDataFrame([], like().schema)


def read_layer(spark: SparkSession, path: str, layer: str, ts: str, rows: Callable[[], DataFrame], fmt: str = "parquet") -> DataFrame:
    """What ``write_layer`` wrote of ``rows``."""
    return read_table(spark, path, lambda: with_time_parts(rows(), ts, PARTS[layer]), fmt)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    df.write.format(fmt).mode(mode).save(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrites a table that ``df`` may itself read: written beside it, then swapped."""
    spark = df.sparkSession
    jvm = spark._jvm
    new, old, here = (jvm.org.apache.hadoop.fs.Path(path + x) for x in (".new", ".old", ""))
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(new, True)
    df.write.format(fmt).mode("overwrite").save(path + ".new")
    fs.delete(old, True)
    if fs.exists(here):
        fs.rename(here, old)
    fs.rename(new, here)
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


BUCKET = "key_bucket"


def upsert(df: DataFrame, path: str, keys: list[str], version: str, fmt: str = "parquet", buckets: int = 64) -> None:
    """Insert or update by key; the higher version stays. The first write creates the table.

    The table is partitioned by a hash of the key (``key_bucket``), so a write reads and replaces only the buckets that it touches; the number of
    buckets is that of the first write. Formats with a log replace them at once; with plain files a reader can find a bucket missing between two renames.
    """
    spark = df.sparkSession
    new = df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    if not exists(spark, path):
        first = merged_latest(new.limit(0), new, [*keys, BUCKET], version)
        return first.write.format(fmt).partitionBy(BUCKET).save(path)
    touched = new.select(BUCKET).distinct()  # at most ``buckets`` rows
    old = read_table(spark, path, lambda: new, fmt).join(F.broadcast(touched), BUCKET, "left_semi").select(*new.columns)
    merged = merged_latest(old, new, [*keys, BUCKET], version).repartition(BUCKET)
    merged.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).save(path)
    spark.catalog.refreshByPath(path)


def merge_job(df: DataFrame, path: str, job: str, version: str, fmt: str = "parquet") -> None:
    """Upsert of a gold frame by the keys of its job (``hourly``, ``daily`` or ``line``); a job without keys is appended."""
    if job in KEYS:
        return upsert(df, path, KEYS[job], version, fmt, 16)
    return write_table(df, path, "append", fmt)


def write_quarantine(flagged: DataFrame, path: str) -> None:
    """Appends the rows that are not valid; their flags tell why."""
    flagged.where(~F.col("is_valid")).write.mode("append").parquet(path)


def write_figures(figures: dict[str, DataFrame], path: str) -> dict[str, str]:
    """One directory for each frame; returns where they are."""
    for name, df in figures.items():
        write_table(df, f"{path}/{name}")
    return {n: f"{path}/{n}" for n in figures}


def load_serving(spark: SparkSession, path: str, names: list[str], prefix: str = "kpi_") -> dict[str, str]:
    """Temporary views over written figures; what is missing is reported, not raised."""
    state = {}
    for n in names:
        if exists(spark, f"{path}/{n}"):
            spark.read.parquet(f"{path}/{n}").createOrReplaceTempView(prefix + n)
            state[n] = "loaded"
        else:
            state[n] = "missing"
    return state


def retain(df: DataFrame, ts: str, now, days: int = 90) -> DataFrame:
    """Rows that are at most ``days`` old; null times go."""
    return df.where(F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp")) <= days * 86_400_000_000)


def drop_months(spark: SparkSession, path: str, before: tuple[int, int]) -> list[str]:
    """Deletes the year=/month= partitions before (year, month); returns them."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/year=*/month=*")) or []:
        p = s.getPath()
        year, month = int(p.getParent().getName().split("=")[1]), int(p.getName().split("=")[1])
        if (year, month) < before:
            fs.delete(p, True)
            gone.append(f"{year}-{month:02d}")
    return sorted(gone)
