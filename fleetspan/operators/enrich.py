"""Joins with timetable dimensions and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.columns import calendar
from fleetspan.functions.geo import haversine_m


def with_routes(df: DataFrame, routes: DataFrame, key: str = "route_id") -> DataFrame:
    """Left join with the routes; their columns that clash with those of ``df`` get the prefix ``route_``.

    Whether the routes are broadcast is left to the optimizer, which knows their size.
    """
    taken = set(df.columns) - {key}
    renamed = routes.select(*[F.col(c).alias(f"route_{c}" if c in taken else c) for c in routes.columns])
    return df.join(renamed, key, "left")


def match_rate(df: DataFrame, name: str = "route_long_name") -> DataFrame:
    """One row: rows, matched rows and their share."""
    return df.agg(F.count("*").alias("rows"), F.count(name).alias("matched"), F.try_divide(F.count(name), F.count("*")).alias("match_rate"))


def nearest_stop(df: DataFrame, stops: DataFrame, row_key: str, within_m: float = 50.0, how: str = "inner") -> DataFrame:
    """The closest stop (``stop_id``) within the radius of each row, with ``stop_distance_m``.

    The plane is laid out in latitude bands as high as the radius, each cut into cells that are as wide as the radius at the band's
    highest latitude. Stops are copied to the cells around, in their own band and the two beside it; a row meets the stops of its own cell
    only. A tie goes to the smaller id. ``how="left"`` keeps rows without a stop. ``row_key`` is unique. Beyond 89 degrees and across
    180 degrees nothing is found.
    """
    if within_m <= 0:
        raise ValueError("the radius has to be positive")
    deg = within_m / 111_000.0

    def cell(band: Column, lon: Column) -> Column:
        highest = F.greatest(F.abs(band * deg), F.abs((band + 1) * deg))
        return F.floor(lon * F.cos(F.radians(F.least(highest, F.lit(89.0)))) / deg)

    around = F.array(F.lit(-1), F.lit(0), F.lit(1))
    s = stops.select("stop_id", "stop_lat", "stop_lon").where("stop_id is not null and stop_lat is not null and stop_lon is not null")
    s = s.withColumn("__band", F.explode(F.transform(around, lambda k: F.floor(F.col("stop_lat") / deg) + k)))
    s = s.withColumn("__cell", F.explode(F.transform(around, lambda k: cell(F.col("__band"), F.col("stop_lon")) + k)))
    band = F.floor(F.col("latitude") / deg)
    near = df.withColumns({"__band": band, "__cell": cell(band, F.col("longitude"))}).join(s, ["__band", "__cell"])
    near = near.withColumn("stop_distance_m", haversine_m(F.col("latitude"), F.col("longitude"), F.col("stop_lat"), F.col("stop_lon"))).where(F.col("stop_distance_m") <= within_m)
    found = F.struct("stop_id", "stop_distance_m")
    if how == "inner":  # the row rides along; nothing is joined back
        best = near.groupBy(row_key).agg(F.min_by(F.struct(*df.columns, found.alias("__stop")), F.struct("stop_distance_m", "stop_id")).alias("__row"))
        return best.select("__row.*").select(*df.columns, "__stop.*")
    best = near.groupBy(row_key).agg(F.min_by(found, F.struct("stop_distance_m", "stop_id")).alias("__stop")).select(row_key, "__stop.*")
    return df.join(best, row_key, how)


def with_calendar(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns(calendar(F.col(ts)))


def geocoded(df: DataFrame, lookup: DataFrame, digits: int = 3) -> DataFrame:
    """Address columns by coordinates rounded to ``digits``; one join with a lookup table (``lat_key``, ``lon_key``, ...)."""
    keyed = df.withColumns({"lat_key": F.round("latitude", digits), "lon_key": F.round("longitude", digits)})
    return keyed.join(lookup, ["lat_key", "lon_key"], "left").drop("lat_key", "lon_key")


def places_to_look_up(df: DataFrame, digits: int = 3) -> DataFrame:
    """Distinct rounded coordinates, for a resolver that fills the lookup table."""
    return df.where("latitude is not null and longitude is not null").select(F.round("latitude", digits).alias("lat_key"), F.round("longitude", digits).alias("lon_key")).distinct()
