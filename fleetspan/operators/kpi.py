"""Key figures of fleet, lines, trips and stops. Frames in, frames out; nothing is collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.functions.columns import congestion_index, headway_quality, is_moving
from fleetspan.operators.telemetry import with_previous


def hour_of(ts: str) -> Column:
    return F.date_trunc("hour", F.col(ts).cast("timestamp"))


def fleet_coverage(df: DataFrame, fleet_size: int, ts: str = "ts") -> DataFrame:
    """Per hour: distinct vehicles, rows and the share of the fleet in percent."""
    out = df.groupBy(hour_of(ts).alias("hour")).agg(F.count_distinct("vehicle_id").alias("active_vehicles"), F.count("*").alias("total_records"))
    return out.withColumn("coverage_percent", F.try_divide(F.col("active_vehicles") * 100.0, F.lit(fleet_size)))


def speed_stats(df: DataFrame, by: list[Column | str], speed: str = "speed") -> DataFrame:
    """Average, sample deviation, least, greatest and number of the known speeds."""
    known = df.where(F.col(speed).isNotNull())
    return known.groupBy(*by).agg(
        F.avg(speed).alias("avg_speed"), F.stddev_samp(speed).alias("stddev_speed"), F.min(speed).alias("min_speed"), F.max(speed).alias("max_speed"), F.count("*").alias("sample_count")
    )


def headways(df: DataFrame, stop: str = "stop_id", line: str | None = "line_id", ts: str = "ts", tie: str = "row_id") -> DataFrame:
    """Minutes since the vehicle before, at each stop and line (or stop alone); the first passage has none and goes. Busy stops are spread over their days."""
    keys = [stop] + ([line] if line else [])
    out = with_previous(df, keys, ts, tie, {"__was": F.unix_timestamp(ts)})
    return out.withColumn("headway_minutes", (F.unix_timestamp(ts) - F.col("__was")) / 60.0).drop("__was").where("headway_minutes is not null")


def headway_summary(df: DataFrame, stop: str = "stop_id", line: str = "line_id", **kw) -> DataFrame:
    """Average, deviation, least, greatest, number and quality of the headways of a stop and line."""
    m = F.col("headway_minutes")
    out = headways(df, stop, line, **kw).groupBy(stop, line).agg(
        F.avg(m).alias("avg_headway_minutes"), F.stddev_samp(m).alias("stddev_headway"), F.min(m).alias("min_headway"), F.max(m).alias("max_headway"), F.count("*").alias("sample_size"), F.var_samp(m).alias("var_headway")
    )
    regularity = (1 - F.try_divide(F.col("var_headway"), F.col("avg_headway_minutes"))) * 100
    return out.withColumns({"headway_quality": headway_quality(F.col("avg_headway_minutes")), "regularity": regularity}).drop("var_headway")


def punctuality(df: DataFrame, line: str, delay_minutes: Column, tolerance: float = 5.0) -> DataFrame:
    """Per line: average and deviation of the delay, share on time (at most the tolerance off, both ways), early and late rows."""
    d = df.withColumn("delay", delay_minutes).where("delay is not null")
    on_time = F.abs(F.col("delay")) <= tolerance
    return d.groupBy(line).agg(
        F.avg("delay").alias("avg_delay_minutes"), F.stddev_samp("delay").alias("stddev_delay"), F.count("*").alias("total_arrivals"),
        (F.count_if(on_time) * 100.0 / F.count("*")).alias("on_time_percent"), F.count_if(F.col("delay") < -tolerance).alias("early"), F.count_if(F.col("delay") > tolerance).alias("late"),
    )


def trip_stats(df: DataFrame, trip: str = "trip_id", ts: str = "ts", speed: str = "speed") -> DataFrame:
    """Per line: trips, average duration, average of the trips' average speeds, distinct vehicles."""
    each = df.groupBy(trip, "line_id", "vehicle_id").agg(F.min(ts).alias("start"), F.max(ts).alias("end"), F.count("*").alias("points"), F.avg(speed).alias("avg_speed"))
    minutes = (F.unix_timestamp("end") - F.unix_timestamp("start")) / 60.0
    return each.withColumn("minutes", minutes).groupBy("line_id").agg(
        F.count("*").alias("total_trips"), F.avg("minutes").alias("avg_duration_minutes"), F.avg("avg_speed").alias("avg_speed"), F.count_distinct("vehicle_id").alias("unique_vehicles")
    )


def daily_figures(df: DataFrame, ts: str = "ts", speed: str = "speed", trip: str = "trip_id") -> DataFrame:
    """Per date: distinct vehicles, lines and trips (0 without a column of trips), rows, speeds, first and last time and the hours between."""
    df = df if trip in df.columns else df.withColumn(trip, F.lit(None).cast("string"))
    out = df.groupBy(F.to_date(ts).alias("date")).agg(
        F.count_distinct("vehicle_id").alias("total_vehicles"), F.count_distinct("line_id").alias("total_lines"), F.count_distinct(trip).alias("total_trips"), F.count("*").alias("total_records"),
        F.avg(speed).alias("avg_speed"), F.max(speed).alias("max_speed"), F.min(ts).alias("first_record"), F.max(ts).alias("last_record"),
    )
    return out.withColumn("operational_hours", (F.unix_timestamp("last_record") - F.unix_timestamp("first_record")) / 3600.0)


def all_figures(df: DataFrame, fleet_size: int, arrivals: DataFrame | None = None, ts: str = "ts") -> dict[str, DataFrame]:
    """The library's figures by name; headway where there is a ``stop_id``, punctuality where arrivals with ``delay_min`` are given."""
    out = {"coverage": fleet_coverage(df, fleet_size, ts), "speed": speed_stats(df, ["line_id", hour_of(ts).alias("hour")]), "daily": daily_figures(df, ts)}
    if "trip_id" in df.columns:
        out["trips"] = trip_stats(df, ts=ts)
    if "stop_id" in df.columns:
        out["headway"] = headway_summary(df, ts=ts)
    if arrivals is not None:
        out["punctuality"] = punctuality(arrivals, "line_id", F.col("delay_min"))
    return out


def gold_hourly(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Per line, name and hour, from silver rows with telemetry: vehicles, speeds, distance, quality."""
    out = df.groupBy("line_id", "line_name", hour_of(ts).alias("hour_timestamp")).agg(
        F.count_distinct("vehicle_id").alias("vehicles_active"), F.count_if("accessible").alias("vehicles_accessible"),
        F.avg("speed_kmh").alias("avg_speed_kmh"), F.min("speed_kmh").alias("min_speed_kmh"), F.max("speed_kmh").alias("max_speed_kmh"), F.stddev_samp("speed_kmh").alias("std_speed_kmh"),
        F.sum("distance_km").alias("total_distance_km"), F.avg("data_quality_score").alias("data_quality_score"), F.count("*").alias("total_records"), F.count_if(F.col("data_quality_score") >= 0.9).alias("valid_records"),
    )
    return out.withColumn("avg_distance_per_vehicle_km", F.try_divide("total_distance_km", "vehicles_active"))


def gold_daily(df: DataFrame, ts: str = "ts", uptime: float = 0.98) -> DataFrame:
    """Per date: vehicles, lines, rows as trips, speed, distance, quality, peak hour, a constant uptime.

    One pass: rows are summed per date, hour, vehicle and line first; that small frame is read as three sets (vehicles of an hour, vehicles
    and lines of the day), counted together. The peak is the hour with most distinct vehicles (the earliest of several); the others' average is ``off_peak_avg_vehicles``.
    """
    sums = {"n": F.count("*"), "s": F.sum("speed_kmh"), "c": F.count("speed_kmh"), "km": F.sum("distance_km"), "q": F.sum("data_quality_score"), "qn": F.count("data_quality_score")}
    part = df.groupBy(F.to_date(ts).alias("date"), F.hour(ts).alias("hour"), "vehicle_id", "line_id").agg(*[c.alias(n) for n, c in sums.items()])
    kinds = {"n": "bigint", "s": "double", "c": "bigint", "km": "double", "q": "double", "qn": "bigint"}

    def one_set(kind: str, hour: Column, key: str, with_sums: bool) -> Column:
        own = [(F.col(n) if with_sums else F.lit(0)).cast(k).alias(n) for n, k in kinds.items()]
        return F.struct(F.lit(kind).alias("kind"), hour.alias("h"), F.col(key).cast("string").alias("key"), *own)

    sets = F.array(one_set("hour", F.col("hour"), "vehicle_id", False), one_set("line", F.lit(-1), "line_id", False), one_set("day", F.lit(-1), "vehicle_id", True))
    keyed = part.select("date", F.inline(sets)).groupBy("date", "kind", "h", "key").agg(*[F.sum(n).alias(n) for n in sums])
    counted = keyed.groupBy("date", "kind", "h").agg(F.count("key").alias("k"), *[F.sum(n).alias(n) for n in sums])
    of = lambda kind, c: F.when(F.col("kind") == kind, c)
    day = counted.groupBy("date").agg(
        F.max(of("day", F.col("k"))).alias("total_vehicles"), F.max(of("line", F.col("k"))).alias("total_lines"), F.sum("n").alias("total_trips"), F.try_divide(F.sum("s"), F.sum("c")).alias("avg_speed_kmh"),
        F.sum(of("day", F.col("km"))).alias("total_distance_km"), F.try_divide(F.sum("q"), F.sum("qn")).alias("data_quality_score"),
        F.max(of("hour", F.struct("k", (-F.col("h")).alias("early")))).alias("top"), F.sum(of("hour", F.col("k"))).alias("all_k"), F.count(of("hour", F.lit(1))).alias("hours"),
    )
    peak = F.col("top.k")
    return day.select(
        "date", "total_vehicles", "total_lines", "total_trips", "avg_speed_kmh", "total_distance_km", "data_quality_score", (-F.col("top.early")).alias("peak_hour"), peak.alias("peak_hour_vehicles"),
        F.when(F.col("hours") > 1, (F.col("all_k") - peak) / (F.col("hours") - 1)).alias("off_peak_avg_vehicles"), F.lit(uptime).alias("uptime_percentage"),
    )


def peak_hours(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Per date the peak hour, its vehicles and the average of the other hours (see ``gold_daily``)."""
    unknown = {c: F.lit(None).cast("double") for c in ("speed_kmh", "distance_km", "data_quality_score") if c not in df.columns}
    return gold_daily(df.withColumns(unknown) if unknown else df, ts).select("date", "peak_hour", "peak_hour_vehicles", "off_peak_avg_vehicles")


def gold_lines(df: DataFrame, ts: str = "ts", period: str = "daily") -> DataFrame:
    """Per line: speed, average vehicles per hour, quality, period of all rows, congestion and reliability. One pass; the period is taken over a row for each line."""
    each = df.groupBy("line_id", "line_name", hour_of(ts).alias("hour"), "vehicle_id").agg(F.sum("speed_kmh").alias("s"), F.count("speed_kmh").alias("c"), F.sum("data_quality_score").alias("q"), F.count("data_quality_score").alias("qn"), F.min(ts).alias("a"), F.max(ts).alias("b"))
    hours = each.groupBy("line_id", "line_name", "hour").agg(F.count("vehicle_id").alias("vehicles"), *[F.sum(c).alias(c) for c in ("s", "c", "q", "qn")], F.min("a").alias("a"), F.max("b").alias("b"))
    lines = hours.groupBy("line_id", "line_name").agg(F.try_divide(F.sum("s"), F.sum("c")).alias("avg_speed_kmh"), F.avg("vehicles").alias("avg_vehicles_operating"), F.try_divide(F.sum("q"), F.sum("qn")).alias("data_quality_score"), F.min("a").alias("a"), F.max("b").alias("b"))
    all_lines = Window.partitionBy()
    return lines.withColumns({
        "period_start": F.min("a").over(all_lines), "period_end": F.max("b").over(all_lines),
        "analysis_period": F.lit(period), "congestion_index": congestion_index(F.col("avg_speed_kmh")), "reliability_score": F.col("data_quality_score") * 100,
        "avg_headway_minutes": F.lit(None).cast("double"), "utilization_rate": F.lit(None).cast("double"),
    }).drop("a", "b")


def realtime_row(df: DataFrame, now: Column, known_lines: int = 400, stale_minutes: int = 4, ts: str = "ts") -> DataFrame:
    """One row: vehicles, lines, stale rows, stale and coverage percent to two digits. Stale counts rows, so it may exceed 100 %."""
    old = F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp")) > stale_minutes * 60_000_000
    out = df.agg(F.count_distinct("vehicle_id").alias("total_vehicles"), F.count_distinct("line_id").alias("total_lines"), F.count_if(old).alias("stale_vehicles"))
    return out.withColumns({
        "stale_percentage": F.round(F.coalesce(F.try_divide(F.col("stale_vehicles") * 100.0, F.col("total_vehicles")), F.lit(0.0)), 2),
        "coverage_percentage": F.round(F.col("total_lines") * 100.0 / known_lines, 2),
    })


def by_line(df: DataFrame, speed: str = "speed") -> DataFrame:
    """Per line: rows (as vehicles), distinct vehicles, speeds and four speed bands."""
    s = F.col(speed)
    return df.groupBy("line_id").agg(
        F.count("*").alias("total_vehicles"), F.count_distinct("vehicle_id").alias("distinct_vehicles"), F.avg(s).alias("avg_speed"), F.max(s).alias("max_speed"), F.min(s).alias("min_speed"),
        F.count_if(s < 20).alias("vehicles_0_20kmh"), F.count_if((s >= 20) & (s < 40)).alias("vehicles_20_40kmh"), F.count_if((s >= 40) & (s < 60)).alias("vehicles_40_60kmh"), F.count_if(s >= 60).alias("vehicles_60plus_kmh"),
    )


def quality_row(raw: DataFrame, valid: DataFrame, now: Column, seconds: float, stale_minutes: int = 4, ts: str = "ts") -> DataFrame:
    """One row over both frames: ingested, valid, invalid, validation percent, stale, duration and status."""
    old = F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp")) > stale_minutes * 60_000_000
    a = raw.agg(F.count("*").alias("records_ingested"))
    b = valid.agg(F.count("*").alias("records_valid"), F.count_if(old).alias("stale_records"))
    return a.join(F.broadcast(b)).withColumns({
        "records_invalid": F.col("records_ingested") - F.col("records_valid"),
        "validation_rate": F.round(F.coalesce(F.try_divide(F.col("records_valid") * 100.0, F.col("records_ingested")), F.lit(0.0)), 2),
        "duration_seconds": F.lit(float(seconds)), "pipeline_status": F.lit("success"),
    })


def metric_series(df: DataFrame, top: int = 10, speed: str = "speed") -> DataFrame:
    """Long form: two figures of all rows and the rows of the busiest lines (ties by line)."""
    whole = df.agg(F.count_distinct("vehicle_id").cast("double").alias("v"), F.avg(speed).alias("s"))
    long = whole.select(F.expr("stack(2, 'total_vehicles', v, 'avg_speed', s) as (metric_name, metric_value)")).withColumn("line_id", F.lit(None).cast("string"))
    lines = df.where("line_id is not null").groupBy("line_id").agg(F.count("*").cast("double").alias("metric_value")).orderBy(F.desc("metric_value"), "line_id").limit(top)
    return long.unionByName(lines.withColumn("metric_name", F.lit("vehicles_per_line")))


def windowed(df: DataFrame, key: str, ts: str = "timestamp", length: str = "5 minutes", slide: str | None = "1 minute", speed: str = "speed", moving_above: float = 5.0) -> DataFrame:
    """Sliding (or tumbling) windows per key: distinct vehicles, rows, average and greatest speed, moving rows.

    Two chained aggregates (window and vehicle, then window) make the distinct count exact, in a batch and on a stream.
    """
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    s = F.col(speed)
    first = df.groupBy(w.alias("w"), key, "vehicle_id").agg(F.count("*").alias("n"), F.sum(s).alias("s"), F.count(s).alias("c"), F.max(s).alias("m"), F.sum(is_moving(s, moving_above).cast("int")).alias("mv"))
    second = first.groupBy("w", key).agg(F.count("vehicle_id").alias("vehicle_count"), F.sum("n").alias("position_count"), F.sum("s").alias("s"), F.sum("c").alias("c"), F.max("m").alias("max_speed"), F.sum("mv").alias("moving_count"))
    return second.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "vehicle_count", "position_count", F.try_divide("s", "c").alias("avg_speed"), "max_speed", "moving_count")


def percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Exact percentiles (interpolated) of each group. Equal values are counted first, in parallel; a group's task gets a row
    for each distinct value, not for each row, so values should be rounded to what is meant (seconds, tenths).
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("__n"))
    return counts.groupBy(*by).agg(*[F.percentile(value, p, F.col("__n")).alias(n) for n, p in shares.items()])


def utilization(df: DataFrame, by: str, active: Column, load: Column, capacity: Column) -> DataFrame:
    """Per key: percent of active rows, and the average load in percent of the capacity (rows without either are left out)."""
    g = df.groupBy(by).agg((F.count_if(active) * 100.0 / F.count("*")).alias("utilization_percent"), F.avg(F.try_divide(load, capacity) * 100).alias("occupancy_percent"))
    return g


def call_statistics(df: DataFrame, by: str, seconds: Column, ok: Column) -> DataFrame:
    """Per key: calls, mean, least, greatest and deviation of the latency, percent of calls that succeeded."""
    return df.groupBy(by).agg(
        F.count("*").alias("calls"), F.avg(seconds).alias("mean_s"), F.min(seconds).alias("min_s"), F.max(seconds).alias("max_s"), F.stddev_samp(seconds).alias("std_s"), (F.count_if(ok) * 100.0 / F.count("*")).alias("success_percent")
    )


def fleet_metrics(df: DataFrame, speed: str = "speed") -> DataFrame:
    """The business metrics of a frame in long form: fleet size, lines, average speed, rows."""
    one = df.agg(F.count_distinct("vehicle_id").cast("double").alias("a"), F.count_distinct("line_id").cast("double").alias("b"), F.avg(speed).alias("c"), F.count("*").cast("double").alias("d"))
    return one.select(F.expr("stack(4, 'fleet_size', a, 'lines', b, 'avg_speed', c, 'rows', d) as (metric, value)"))
