"""Edges to other systems: JDBC, Kafka, a key-value cache. Thin, and only as good as the driver on the class path."""

from __future__ import annotations

import fnmatch
import json
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, user: str, password: str, driver: str = "org.postgresql.Driver") -> dict[str, str]:
    return {"url": url, "user": user, "password": password, "driver": driver}


def read_jdbc(spark: SparkSession, table: str, options: dict[str, str], key: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 8) -> DataFrame:
    """A table; with a numeric key and bounds it is read in parallel."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if key and bounds:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def write_jdbc(df: DataFrame, table: str, options: dict[str, str], mode: str = "append", parts: int = 10, batch: int = 10_000) -> None:
    """Bulk load over at most ``parts`` connections."""
    df.repartition(parts).write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch).mode(mode).save()


def kafka_stream(spark: SparkSession, servers: str, topic: str, most_per_trigger: int = 50_000, start: str = "latest") -> DataFrame:
    """A topic as a stream; offsets live in the query's checkpoint."""
    o = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start, "failOnDataLoss": "false", "maxOffsetsPerTrigger": str(most_per_trigger)}
    return spark.readStream.format("kafka").options(**o).load()


class Cache:
    """Key-value cache with times to live; the dictionary stands in for a server, ``clock`` is injectable."""

    def __init__(self, clock: Callable[[], float] = time.time):
        self.clock, self.data, self.hits, self.misses = clock, {}, 0, 0

    def put(self, key: str, value, ttl: float | None = None) -> None:
        self.data[key] = (json.dumps(value), None if ttl is None else self.clock() + ttl)

    def get(self, key: str):
        text, until = self.data.get(key, (None, None))
        if text is None or (until is not None and self.clock() >= until):
            self.data.pop(key, None)
            self.misses += 1
            return None
        self.hits += 1
        return json.loads(text)

    def put_many(self, values: dict, ttl: float | None = None) -> None:
        for k, v in values.items():
            self.put(k, v, ttl)

    def get_many(self, keys: list[str]) -> dict:
        return {k: v for k in keys if (v := self.get(k)) is not None}

    def drop(self, pattern: str) -> int:
        gone = [k for k in self.data if fnmatch.fnmatch(k, pattern)]
        for k in gone:
            del self.data[k]
        return len(gone)

    def stats(self) -> dict[str, float]:
        asked = self.hits + self.misses
        return {"keys": len(self.data), "hits": self.hits, "misses": self.misses, "hit_rate": self.hits / asked if asked else 0.0}

    def put_position(self, vehicle: str, position: dict) -> None:
        self.put(f"vehicle:position:{vehicle}", position, 180)

    def put_figures(self, name: str, figures: dict) -> None:
        self.put(f"kpi:{name}", figures, 3600)
