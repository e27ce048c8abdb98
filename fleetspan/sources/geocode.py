"""Addresses of places: a resolver behind a bounded cache, and its results as a lookup table that rows are joined with."""

from __future__ import annotations

import time
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.operators.enrich import geocoded, places_to_look_up
from fleetspan.sources.sinks import write_table

Resolver = Callable[[float, float], dict[str, str] | None]
PARTS = ("address", "road", "suburb")


class Geocoder:
    """A resolver with a cache of the last used places (rounded to ``digits``). Null places, and those the resolver fails on, have no address."""

    def __init__(self, resolver: Resolver, capacity: int = 10_000, digits: int = 3, delay_s: float = 0.0, sleep: Callable[[float], None] = time.sleep):
        self.resolver, self.capacity, self.digits, self.delay_s, self.sleep = resolver, capacity, digits, delay_s, sleep
        self.kept: OrderedDict[tuple[float, float], dict[str, str] | None] = OrderedDict()
        self.hits = self.asked = self.failed = 0

    def address(self, lat: float | None, lon: float | None) -> dict[str, str] | None:
        if lat is None or lon is None or lat != lat or lon != lon:
            return None
        key = (round(lat, self.digits), round(lon, self.digits))
        if key in self.kept:
            self.hits += 1
            self.kept.move_to_end(key)
            return self.kept[key]
        self.asked += 1
        if self.asked > 1 and self.delay_s:
            self.sleep(self.delay_s)
        try:
            found = self.resolver(*key)
        except Exception:  # a failed call is a place without an address, and is asked again next time
            self.failed += 1
            return None
        self.kept[key] = found
        if len(self.kept) > self.capacity:
            self.kept.popitem(last=False)
        return found

    def batch(self, places: list[tuple[float | None, float | None]]) -> list[dict[str, str] | None]:
        return [self.address(*p) for p in places]

    def stats(self) -> dict[str, float]:
        n = self.hits + self.asked
        return {"kept": len(self.kept), "hits": self.hits, "asked": self.asked, "failed": self.failed, "hit_rate": self.hits / n if n else 0.0}


def resolved(places: DataFrame, resolver: Resolver, digits: int = 3, delay_s: float = 0.0) -> DataFrame:
    """Places (``lat_key``, ``lon_key``) with address, road and suburb; each task asks for its own distinct places."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coder = Geocoder(resolver, digits=digits, delay_s=delay_s)
        for f in frames:
            found = coder.batch(list(zip(f["lat_key"], f["lon_key"], strict=True)))
            yield f.assign(**{p: [None if x is None else x.get(p) for x in found] for p in PARTS})

    return places.mapInPandas(ask, "lat_key double, lon_key double, " + ", ".join(f"{p} string" for p in PARTS))


def write_lookup(df: DataFrame, path: str, resolver: Resolver, digits: int = 3, delay_s: float = 0.0) -> DataFrame:
    """The lookup table of all distinct places of ``df``, overwritten and read back."""
    write_table(resolved(places_to_look_up(df, digits), resolver, digits, delay_s), path)
    return df.sparkSession.read.parquet(path)


def with_addresses(df: DataFrame, lookup: DataFrame, digits: int = 3) -> DataFrame:
    """``df`` with address, road and suburb; null where the place is unknown."""
    return geocoded(df, lookup.select("lat_key", "lon_key", *PARTS), digits)


def success_rate(df: DataFrame) -> DataFrame:
    """One row: rows with a place, of those with an address, and their share."""
    placed = F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return df.agg(placed.alias("placed"), F.count("address").alias("found"), F.try_divide(F.count("address"), placed).alias("success_rate"))
