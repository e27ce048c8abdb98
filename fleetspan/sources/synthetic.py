"""Seeded synthetic positions and timetables, made in the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def positions(spark: SparkSession, rows: int, lines: int = 12, vehicles: int = 60, seed: int = 42, start: str = "2018-01-01 05:00:00") -> DataFrame:
    """``rows`` positions; speeds follow a triangular law over 0 to 60 with its mode at 25. The same seed gives the same rows."""
    u, low, mode, high = F.rand(seed), 0.0, 25.0, 60.0
    turn = (mode - low) / (high - low)
    speed = F.when(u < turn, low + F.sqrt(u * (high - low) * (mode - low))).otherwise(high - F.sqrt((1 - u) * (high - low) * (high - mode)))
    mixed = F.abs(F.xxhash64("id", F.lit(seed)))
    return spark.range(0, rows, 1, 8).withColumn("u", u).select(
        F.format_string("V%04d", F.col("id") % vehicles).alias("vehicle_id"), F.format_string("L%02d", F.col("id") % vehicles % lines).alias("line_id"),
        (F.lit(-23.9) + mixed % 600000 / 1e6).alias("latitude"), (F.lit(-46.9) + F.shiftright(mixed, 20) % 600000 / 1e6).alias("longitude"),
        F.timestamp_micros(F.unix_micros(F.lit(start).cast("timestamp")) + F.col("id") * 1_000_000).alias("timestamp"), speed.alias("speed"), F.format_string("R%02d", F.col("id") % lines).alias("route_id"),
    )


def timetable(spark: SparkSession, routes: int = 10, stops: int = 40, trips_per_route: int = 4) -> dict[str, DataFrame]:
    """Routes, stops, trips and stop times that fit each other; times run past midnight as 24:.. and later."""
    r = spark.range(routes).select(F.format_string("R%03d", "id").alias("route_id"), F.format_string("%d-10", F.col("id") + 8000).alias("route_short_name"), F.format_string("Line %d", "id").alias("route_long_name"), F.lit(3).alias("route_type"))
    s = spark.range(stops).select(F.format_string("S%03d", "id").alias("stop_id"), F.format_string("Stop %d", "id").alias("stop_name"), (F.lit(-23.6) + F.col("id") * 0.001).alias("stop_lat"), (F.lit(-46.6) + F.col("id") * 0.001).alias("stop_lon"))
    t = spark.range(routes * trips_per_route).select(F.format_string("T%04d", "id").alias("trip_id"), F.format_string("R%03d", F.floor(F.col("id") / trips_per_route)).alias("route_id"), (F.col("id") % 2).cast("int").alias("direction_id"))
    at = spark.range(routes * trips_per_route * 5).withColumn("minute", F.col("id") % 5 * 7 + F.floor(F.col("id") / 5) * 11)
    st = at.select(F.format_string("T%04d", F.floor(F.col("id") / 5)).alias("trip_id"), F.format_string("S%03d", F.col("id") % stops).alias("stop_id"), (F.col("id") % 5 + 1).cast("int").alias("stop_sequence"), F.format_string("%02d:%02d:00", F.floor(F.col("minute") / 60) + 20, F.col("minute") % 60).alias("arrival_time"))
    return {"routes": r, "stops": s, "trips": t, "stop_times": st}
