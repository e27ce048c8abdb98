"""The layers as plans: delivered positions, silver rows, telemetry and gold frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.functions.vehicle import bare_vehicle
from fleetspan.operators import clean, dedup, kpi, quality, telemetry
from fleetspan.session import table
from fleetspan.settings import BOXES, Box

COLUMNS = ("line_id", "latitude", "longitude", "speed", "route_id", "received_at", "batch_id")


def positions(spark: SparkSession, d: str) -> DataFrame:
    """Delivered positions with the bare vehicle number and ``ts``."""
    return table(spark, d, "vehicle_positions").select("row_id", bare_vehicle("vehicle_id").alias("vehicle_id"), F.col("timestamp").cast("timestamp").alias("ts"), *COLUMNS)


def with_clock(df: DataFrame, of: str = "received_at") -> DataFrame:
    """Adds ``now``, the latest arrival, so that results do not depend on the day of the run (one row is broadcast)."""
    return df.join(F.broadcast(df.agg(F.max(F.col(of).cast("timestamp")).alias("now"))))


def silver(df: DataFrame, box: Box = BOXES["strict"]) -> DataFrame:
    """Rows with vehicle, line, place and time inside the box; later copies flagged; scored. The route stands for the line's name, the speed for its destination. ``__day`` goes along."""
    rows = clean.inside_box(clean.mandatory(df, ["vehicle_id", "line_id", "latitude", "longitude", "ts"]), box=box)
    rows = rows.withColumn("__day", F.to_date("ts")).repartition("vehicle_id", "__day")  # the clustering that ``telemetry.with_previous`` asks for
    flagged = dedup.flag_later(rows, ["vehicle_id", "__day", "ts"], [F.col("received_at"), F.col("row_id")])
    return flagged.withColumn("data_quality_score", quality.row_score(F.col("is_duplicate"), F.col("route_id"), F.col("speed")))


def with_telemetry(rows: DataFrame) -> DataFrame:
    """Silver rows that are no duplicates, with step telemetry; ``line_name`` and ``accessible`` stand in where the source has none."""
    kept = rows.where(~F.col("is_duplicate"))
    return telemetry.steps(kept, acceleration=False).withColumns({"line_name": F.col("route_id"), "accessible": F.pmod("row_id", F.lit(3)) == 0})


def gold_hourly(spark: SparkSession, d: str) -> DataFrame:
    return kpi.gold_hourly(with_telemetry(silver(positions(spark, d))))
