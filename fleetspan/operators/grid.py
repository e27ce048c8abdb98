"""Irregular readings onto a regular grid.

A reading holds from its time until the next one: a step function kept as validity intervals, intersected with the grid
cells. It is done in two levels, so that no group is larger than a cell or than the cells of one day: first each
cell is reduced to a partial (readings, first, last, inner integral), then the partials of a day are joined end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.functions.clock import MICROS, floor_to, micros
from fleetspan.functions.vehicle import bare_vehicle

DAY = 86_400


def cell_partials(df: DataFrame, value: str = "speed", source: str = "vehicle_id", time: str = "timestamp", order: str = "row_id", seconds: int = 120) -> DataFrame:
    """One row for each (source, cell) with a reading: count, first and last reading, integral between first and last.

    Of several rows of one source and time the first by ``order`` counts, be its value null or not; then nulls drop out.
    The shuffle is by (source, cell): a source that holds a third of all rows is spread over its cells.
    """
    rows = df.select(bare_vehicle(source).alias("source_key"), micros(time).alias("us"), F.col(order).alias("arrival"), F.col(value).cast("double").alias("v"))
    rows = rows.where("source_key is not null and us is not null").withColumn("cell", floor_to(F.col("us"), seconds))
    by_time = Window.partitionBy("source_key", "cell").orderBy("us", "arrival")
    kept = rows.withColumn("before", F.lag("us").over(by_time)).where("(before is null or before < us) and v is not null and not isnan(v)")
    steps = kept.withColumn("until", F.lead("us").over(Window.partitionBy("source_key", "cell").orderBy("us", "arrival")))
    return steps.groupBy("source_key", "cell").agg(
        F.count("*").alias("n"),
        F.min("us").alias("first_us"),
        F.max("us").alias("last_us"),
        F.max_by("v", "us").alias("last_v"),
        F.coalesce(F.sum(F.col("v") * (F.col("until") - F.col("us"))), F.lit(0.0)).alias("inner_sum"),
        F.sum("v").alias("sum_v"),
    )


def regular_series(df: DataFrame, value: str = "speed", source: str = "vehicle_id", time: str = "timestamp", order: str = "row_id", seconds: int = 120, hold_seconds: int = 600) -> DataFrame:
    """A row for every cell between the first and the last cell with a reading, for each source and calendar day.

    ``mean_value`` is the time-weighted average over the covered part of the cell, ``coverage`` the covered fraction and
    ``filled`` marks cells without a reading of their own (their value is carried from the last reading while that is
    at most ``hold_seconds`` old; beyond that ``mean_value`` is null and coverage 0).

    Nulls: rows without source, time or value count for nothing, except that a first-arrived row with null value hides its
    later copies. Ties: see ``cell_partials``. A single reading gives one cell with its own value and what it covers. An empty input gives no rows.
    """
    step, hold = seconds * MICROS, hold_seconds * MICROS
    parts = cell_partials(df, value, source, time, order, seconds).withColumn("day", floor_to(F.col("cell"), DAY))
    day = Window.partitionBy("source_key", "day").orderBy("cell")
    linked = parts.withColumns({"next_us": F.lead("first_us").over(day), "next_cell": F.lead("cell").over(day)})
    # The last interval of a cell reaches into the cells up to the next reading, or to the end of its own cell at the day's end.
    end = F.least(F.coalesce("next_us", F.col("cell") + step), F.col("last_us") + hold)
    reach = F.sequence(F.col("cell"), F.coalesce("next_cell", "cell"), F.lit(step))
    cut = linked.withColumn("until", end).withColumn("grid", F.explode(reach))
    own = F.col("grid") == F.col("cell")
    over = F.greatest(F.lit(0), F.least("until", F.col("grid") + step) - F.greatest("last_us", "grid"))
    pieces = cut.select(
        "source_key",
        "day",
        "grid",
        F.when(own, F.col("n")).otherwise(0).alias("n"),
        over.alias("tail_us"),
        (F.col("last_v") * over).alias("tail_sum"),
        F.when(own, F.col("last_us") - F.col("first_us")).otherwise(0).alias("inner_us"),
        F.when(own, F.col("inner_sum")).otherwise(0.0).alias("inner_sum"),
        F.when(own, F.col("sum_v")).alias("sum_v"),
    )
    cells = pieces.groupBy("source_key", "day", "grid").agg(
        F.sum("n").alias("readings"),
        F.sum(F.col("tail_us") + F.col("inner_us")).alias("covered_us"),
        F.sum(F.col("tail_sum") + F.col("inner_sum")).alias("total"),
        F.sum("sum_v").alias("sum_v"),
    )
    mean = F.when(F.col("covered_us") > 0, F.col("total") / F.col("covered_us")).when(F.col("readings") > 0, F.col("sum_v") / F.col("readings"))
    return cells.select(
        "source_key",
        F.col("grid").alias("slot_us"),
        "readings",
        mean.alias("mean_value"),
        (F.col("covered_us") / F.lit(step)).alias("coverage"),
        (F.col("readings") == 0).alias("filled"),
    )


def empty_slots(df: DataFrame, **kw) -> DataFrame:
    """The cells of ``regular_series`` without a reading of their own."""
    return regular_series(df, **kw).where("filled")
