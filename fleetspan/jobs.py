"""The pipeline's jobs: positions to bronze, bronze to silver, silver to gold, gold to serving; each logged and counted."""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.errors import JobError
from fleetspan.operators import clean, control, kpi
from fleetspan.plans import layers
from fleetspan.sources import sinks


def _bronze_rows(spark: SparkSession, source: str) -> DataFrame:
    return layers.positions(spark, source).withColumn("event_time", F.coalesce("ts", F.col("received_at").cast("timestamp")))


def _bronze(spark: SparkSession, source: str, lake: str) -> DataFrame:
    return sinks.read_layer(spark, f"{lake}/bronze", "bronze", "event_time", lambda: _bronze_rows(spark, source))


def _silver_rows(spark: SparkSession, source: str, lake: str) -> DataFrame:
    return clean.with_processing(layers.silver(_bronze(spark, source, lake).drop("event_time", "year", "month", "day", "hour")).drop("__day"), "silver", "to_silver")


def _silver(spark: SparkSession, source: str, lake: str) -> DataFrame:
    return sinks.read_layer(spark, f"{lake}/silver", "silver", "ts", lambda: _silver_rows(spark, source, lake))


def _gold_rows(spark: SparkSession, source: str, lake: str, name: str) -> DataFrame:
    return GOLD[name][0](layers.with_telemetry(_silver(spark, source, lake).drop("year", "month", "day")))


def _gold(spark: SparkSession, source: str, lake: str, name: str) -> DataFrame:
    return sinks.read_layer(spark, f"{lake}/gold/{name}", "gold", GOLD[name][1], lambda: _gold_rows(spark, source, lake, name))


# The gold frames, and the times that they are partitioned and merged by.
GOLD: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {"hourly": (kpi.gold_hourly, "hour_timestamp"), "daily": (kpi.gold_daily, "date")}


def to_bronze(spark: SparkSession, source: str, lake: str) -> DataFrame:
    """Positions as delivered, by event hour; those without a time go by their arrival."""
    sinks.write_layer(_bronze_rows(spark, source), f"{lake}/bronze", "bronze", "event_time", "overwrite")
    return _bronze(spark, source, lake)


def to_silver(spark: SparkSession, source: str, lake: str) -> DataFrame:
    sinks.write_layer(_silver_rows(spark, source, lake), f"{lake}/silver", "silver", "ts", "overwrite")
    return _silver(spark, source, lake)


def to_gold(spark: SparkSession, source: str, lake: str) -> DataFrame:
    for name, (_, ts) in GOLD.items():
        sinks.write_layer(_gold_rows(spark, source, lake, name), f"{lake}/gold/{name}", "gold", ts, "overwrite")
    return _gold(spark, source, lake, "hourly")


def to_serving(spark: SparkSession, source: str, lake: str) -> DataFrame:
    """The gold frames merged into the serving tables by their keys."""
    for name, (_, ts) in GOLD.items():
        sinks.merge_job(_gold(spark, source, lake, name), f"{lake}/serving/{name}", name, ts)
    return sinks.read_table(spark, f"{lake}/serving/hourly", lambda: _gold(spark, source, lake, "hourly"))


JOBS: dict[str, Callable[[SparkSession, str, str], DataFrame]] = {"bronze": to_bronze, "silver": to_silver, "gold": to_gold, "serving": to_serving}


def run(spark: SparkSession, name: str, source: str, lake: str, counters: control.Counters | None = None) -> DataFrame:
    """One job, in the run log of the lake; what it wrote is returned."""
    if name not in JOBS:
        raise JobError(f"unknown job {name}; known: {list(JOBS)}", details={"job": name})
    f = counters.stage(name)(JOBS[name]) if counters else JOBS[name]
    with control.job_run(spark, name, f"{lake}/control/runs") as record:
        out = f(spark, source, lake)
        record["records_out"] = out.count()
    return out


def run_all(spark: SparkSession, source: str, lake: str, counters: control.Counters | None = None) -> DataFrame:
    """All jobs in turn; the first that fails ends it."""
    out = None
    for name in JOBS:
        out = run(spark, name, source, lake, counters)
    return out


def components(spark: SparkSession) -> dict[str, bool]:
    """Which optional parts are there: text operators, and the connectors on the class path."""
    def on_path(name: str) -> bool:
        try:
            spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().loadClass(name)
        except Exception:
            return False
        return True

    drivers = {"delta": "io.delta.sql.DeltaSparkSessionExtension", "kafka": "org.apache.spark.sql.kafka010.KafkaSourceProvider", "postgresql": "org.postgresql.Driver"}
    return {"text": find_spec("fleetspan.llm") is not None} | {n: on_path(c) for n, c in drivers.items()}


def summary() -> dict[str, object]:
    """The pipeline in short, for a catalogue."""
    reads = {"bronze": "positions", "silver": "bronze", "gold": "silver", "serving": "gold"}
    return {"jobs": [{"name": n, "reads": reads[n], "writes": n, "partitions": list(sinks.PARTS.get(n, (sinks.BUCKET,))), "about": (f.__doc__ or "").split("\n")[0]} for n, f in JOBS.items()], "keys": sinks.KEYS, "control": list(control.TABLES)}
