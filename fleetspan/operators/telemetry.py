"""What follows from a vehicle's consecutive positions: distance, time, speed, heading, trips, sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.functions.geo import haversine_km, heading_deg


def with_previous(df: DataFrame, keys: list[str], ts: str, tie: str, values: dict[str, Column]) -> DataFrame:
    """Adds ``values`` of the row before (by ``ts``, ``tie``) within the keys; null for the first row.

    Rows are clustered by keys and day, so a key that holds a third of all rows is spread over its days. For the first row of a day the
    first and last rows of the key's days, two a day, are ordered among themselves. Both branches read the same exchange, or none where
    ``df`` is clustered by the keys and a column ``__day`` already. A null time is a day of its own, before all others.
    """
    given = "__day" in df.columns
    laid = (df if given else df.withColumn("__day", F.to_date(ts))).withColumn("__at", F.struct(*[c.alias(n) for n, c in values.items()]))
    by = Window.partitionBy(*keys, "__day").orderBy(ts, tie)
    rows = laid.withColumns({"__prev": F.lag("__at").over(by), "__first": F.row_number().over(by) == 1, "__last": F.lead(F.lit(1)).over(by).isNull()})
    inner = rows.where(~F.col("__first"))
    edges = rows.where(F.col("__first") | F.col("__last")).withColumn("__prev", F.lag("__at").over(Window.partitionBy(*keys).orderBy("__day", ts, tie))).where("__first")
    both = inner.unionByName(edges).withColumns({n: F.col("__prev")[n] for n in values}).drop("__at", "__prev", "__first", "__last")
    return both if given else both.drop("__day")


def steps(df: DataFrame, vehicle: str = "vehicle_id", ts: str = "ts", tie: str = "row_id", limit: float | None = 120.0, acceleration: bool = True) -> DataFrame:
    """Adds ``distance_km``, ``elapsed_s`` (whole seconds), ``speed_kmh``, ``heading`` and, if asked for, ``acceleration`` against the row before.

    A speed needs a positive time and, with a limit, a value from 0 to it; otherwise it is null. The first row of a vehicle has
    nulls. Ties in time follow ``tie``.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    before = with_previous(df, [vehicle], ts, tie, {"__lat": lat, "__lon": lon, "__ts": F.unix_timestamp(ts)})
    moved = before.withColumns({"distance_km": haversine_km(F.col("__lat"), F.col("__lon"), lat, lon), "elapsed_s": F.unix_timestamp(ts) - F.col("__ts"), "heading": heading_deg(F.col("__lat"), F.col("__lon"), lat, lon)})
    kmh = F.when(F.col("elapsed_s") > 0, F.col("distance_km") / (F.col("elapsed_s") / 3600.0))
    fast = moved.withColumn("speed_kmh", kmh if limit is None else F.when(kmh.between(0, limit), kmh)).drop("__lat", "__lon", "__ts")
    if not acceleration:
        return fast
    gain = (F.col("speed_kmh") - F.col("__kmh")) / 3.6
    return with_previous(fast, [vehicle], ts, tie, {"__kmh": F.col("speed_kmh")}).withColumn("acceleration", F.when(F.col("elapsed_s") > 0, gain / F.col("elapsed_s"))).drop("__kmh")


def against_snapshot(now: DataFrame, before: DataFrame, max_gap_s: int = 600, limit: float = 100.0, missing: float | None = 0.0) -> DataFrame:
    """Speed of each row against the vehicle's row of an earlier snapshot (one row per vehicle).

    No earlier row, no positive gap or one above ``max_gap_s`` gives ``missing``; so does a speed outside 0 to ``limit``.
    """
    prev = before.select("vehicle_id", F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon"), F.col("ts").alias("__ts"))
    gap = F.unix_timestamp("ts") - F.unix_timestamp("__ts")
    km = haversine_km(F.col("__lat"), F.col("__lon"), F.col("latitude"), F.col("longitude"))
    kmh = F.when((gap > 0) & (gap <= max_gap_s), km / (gap / 3600.0))
    out = now.join(prev, "vehicle_id", "left").withColumn("computed_speed", F.coalesce(F.when(kmh.between(0, limit), kmh), F.lit(missing)))
    return out.drop("__lat", "__lon", "__ts")


def trip_marks(df: DataFrame, trip: str, ts: str = "ts", tie: str = "row_id") -> DataFrame:
    """Place of each row in its trip, whether it starts or ends it, and minutes since the start.

    Rows are numbered within a day of their trip; a row for each trip and day, counted on the map side, gives what lies before. A long trip
    is spread over its days. Rows with a null trip belong to one trip; null times come first.
    """
    laid = df.withColumn("__day", F.to_date(ts))
    all_days = Window.partitionBy("__t")
    earlier = all_days.orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)
    days = laid.groupBy(F.col(trip).alias("__t"), F.col("__day").alias("__d")).agg(F.count("*").alias("__n"), F.min(F.unix_timestamp(ts)).alias("__a"), F.count_if(F.col(ts).isNull()).alias("__unknown"))
    days = days.select("__t", "__d", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"), F.sum("__n").over(all_days).alias("__all"), F.when(F.sum("__unknown").over(all_days) == 0, F.min("__a").over(all_days)).alias("__first"))
    rows = laid.join(days, F.col(trip).eqNullSafe(F.col("__t")) & F.col("__day").eqNullSafe(F.col("__d")))
    point = F.col("__before") + F.row_number().over(Window.partitionBy("__t", "__d").orderBy(ts, tie))
    out = rows.withColumn("point", point).withColumns({"is_trip_start": F.col("point") == 1, "is_trip_end": F.col("point") == F.col("__all"), "elapsed_minutes": (F.unix_timestamp(ts) - F.col("__first")) / 60.0})
    return out.drop("__t", "__d", "__day", "__before", "__all", "__first")


def sessions(df: DataFrame, vehicle: str = "vehicle_id", ts: str = "ts", tie: str = "row_id", speed: str = "speed", above: float = 5.0, pause_s: int = 300) -> DataFrame:
    """Moving sessions: rows above a speed, cut where two of them are more than ``pause_s`` apart."""
    by = Window.partitionBy(vehicle).orderBy(ts, tie)
    moving = df.where(F.col(speed) > above)
    cut = F.coalesce((F.unix_timestamp(ts) - F.lag(F.unix_timestamp(ts)).over(by) > pause_s).cast("int"), F.lit(1))
    numbered = moving.withColumn("__cut", cut).withColumn("session", F.sum("__cut").over(by))
    return numbered.groupBy(vehicle, "session").agg(F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"), F.count("*").alias("points"), F.avg(speed).alias("avg_speed"))


def z_scores(df: DataFrame, value: str, keys: list[str], beyond: float = 3.0) -> DataFrame:
    """Standard score of each value within its keys, and whether it is beyond the bound; keys are aggregated first, so no group is gathered."""
    stats = df.groupBy(*keys).agg(F.avg(value).alias("__m"), F.stddev_samp(value).alias("__s"))
    z = (F.col(value) - F.col("__m")) / F.nullif(F.col("__s"), F.lit(0.0))
    return df.join(stats, keys).withColumns({"z": z, "is_anomaly": F.coalesce(F.abs(z) > beyond, F.lit(False))}).drop("__m", "__s")
