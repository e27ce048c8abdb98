"""Positions as a stream: parsing, cleaning, windows, sinks, and state across batches.

Every query has a fixed checkpoint path, so a restart resumes where it ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetspan.functions.columns import in_box, is_moving
from fleetspan.operators.kpi import windowed
from fleetspan.operators.telemetry import against_snapshot
from fleetspan.schemas import schema
from fleetspan.settings import BOXES, Box
from fleetspan.sources.sinks import BUCKET, exists, read_table, upsert


def file_stream(spark: SparkSession, path: str, ddl: str | None = None, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(ddl or schema("stream", "positions")).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def parsed(messages: DataFrame, ddl: str | None = None) -> DataFrame:
    """Rows of JSON messages (``value``), with the time of processing; what is no position of the schema goes."""
    rows = messages.select(F.from_json(F.col("value").cast("string"), ddl or schema("stream", "positions")).alias("m")).select("m.*")
    return rows.where("vehicle_id is not null and timestamp is not null and latitude is not null and longitude is not null").withColumn("processing_time", F.current_timestamp())


def transformed(rows: DataFrame, box: Box = BOXES["stream"]) -> DataFrame:
    """Rows inside the box with date parts and ``is_moving``."""
    kept = rows.where(in_box(F.col("latitude"), F.col("longitude"), box))
    return kept.withColumns({"date": F.to_date("timestamp"), "hour": F.hour("timestamp"), "minute": F.minute("timestamp"), "is_moving": is_moving(F.col("speed"))})


def once_each(rows: DataFrame, late: str = "1 hour") -> DataFrame:
    """One row for each vehicle and time within the watermark; state is bounded by it."""
    return rows.withWatermark("timestamp", late).dropDuplicatesWithinWatermark(["vehicle_id", "timestamp"])


def window_figures(rows: DataFrame, late: str = "10 minutes", key: str = "route_code") -> DataFrame:
    """Five-minute windows every minute, with an exact count of vehicles; windows come out once they are closed."""
    return windowed(rows.withWatermark("timestamp", late), key)


def to_files(rows: DataFrame, path: str, checkpoint: str, every: str | None = "2 minutes", parts: tuple[str, ...] = ("date", "hour")) -> StreamingQuery:
    """Parquet by date and hour; ``every=None`` processes what is there and ends."""
    w = rows.writeStream.format("parquet").outputMode("append").partitionBy(*parts).option("checkpointLocation", checkpoint).option("path", path)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def to_console(rows: DataFrame, checkpoint: str, every: str = "10 seconds") -> StreamingQuery:
    return rows.writeStream.format("console").outputMode("append").option("truncate", False).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def keep_latest(rows: DataFrame, table: str, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """For each batch: speeds against the stored last positions are appended to ``out``, then the last positions are merged.

    A batch that is run again writes the same rows to its own folder and merges to the same state.
    """

    def one(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now = batch.withColumnRenamed("timestamp", "ts")
        last = now.groupBy("vehicle_id").agg(F.max_by(F.struct("latitude", "longitude", "ts"), "ts").alias("r")).select("vehicle_id", "r.*")
        before = read_table(spark, table, lambda: last).drop(BUCKET) if exists(spark, table) else last.limit(0)
        against_snapshot(now, before).write.mode("overwrite").parquet(f"{out}/batch={number}")
        upsert(last, table, ["vehicle_id"], "ts")

    w = rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()
