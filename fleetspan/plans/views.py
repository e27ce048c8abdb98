"""Serving views and lookups as SQL text with parameters, over frames handed in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def congested_lines(spark: SparkSession, by_line: DataFrame, below: float = 15.0, hours: int = 2) -> DataFrame:
    """Lines slower than a speed in the last hours of the table."""
    sql = """SELECT line_id, round(avg_speed, 6) AS avg_speed, date_format(timestamp, 'yyyy-MM-dd HH:mm:ss') AS at FROM {lines}
             WHERE avg_speed < :below AND timestamp > (SELECT max(timestamp) FROM {lines}) - make_interval(0, 0, 0, 0, :hours)"""
    return spark.sql(sql, args={"below": below, "hours": hours}, lines=by_line)


def active_lines(spark: SparkSession, positions: DataFrame, minutes: int = 30) -> DataFrame:
    """Lines with vehicles in the last minutes of the table (``line_id``, ``vehicle_id``, ``ts``, ``speed``)."""
    sql = """SELECT line_id, count(DISTINCT vehicle_id) AS vehicles_active, avg(speed) AS avg_speed, max(ts) AS last_update FROM {p}
             WHERE ts > (SELECT max(ts) FROM {p}) - make_interval(0, 0, 0, 0, 0, :minutes) GROUP BY line_id"""
    return spark.sql(sql, args={"minutes": minutes}, p=positions)


def dashboard_summary(spark: SparkSession, realtime: DataFrame, by_line: DataFrame) -> DataFrame:
    """The latest network figures with the number of lines in the latest snapshot."""
    sql = """SELECT r.total_vehicles, r.total_lines, r.coverage_percentage, r.data_source, q.lines
             FROM (SELECT max_by(struct(total_vehicles, total_lines, coverage_percentage, data_source), struct(timestamp, id)) AS r FROM {realtime})
             LEFT JOIN (SELECT count(*) AS lines FROM {lines} WHERE timestamp = (SELECT max(timestamp) FROM {lines})) q ON true"""
    return spark.sql(sql, realtime=realtime, lines=by_line)


def fleet_document(daily: DataFrame) -> DataFrame:
    """One JSON document for each day of a gold daily frame."""
    fields = ["date", "total_vehicles", "total_lines", "avg_speed_kmh", "total_distance_km", "peak_hour_vehicles", "peak_hour", "data_quality_score"]
    return daily.select("date", F.to_json(F.struct(*fields)).alias("document"))


def register(frames: dict[str, DataFrame], prefix: str = "serving_") -> list[str]:
    """Frames as temporary views; returns their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
    return [prefix + n for n in frames]
