"""Per-period figures by event time, corrected as late records arrive, up to a cut-off.

What is stored are mergeable partials. ``partials`` has, for each series, period and arrival batch, the newest version of each member
(a vehicle seen, a polled minute); a figure at any moment is combined on read from the batches that had arrived by then. A batch is a
whole minute, rounded up, so every whole-minute moment (publication, cut-off) lies between batches.

``PeriodStore`` keeps them on shared storage and merges each delivery into them: a member's batches are compacted to what
publication and cut-off need, periods past their cut-off are set aside for good, and only the open ones are read and written again.
"""

from __future__ import annotations

from dataclasses import dataclass

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.functions.clock import MICROS, floor_to
from fleetspan.sources.sinks import exists

MINUTE = 60


@dataclass(frozen=True)
class Lateness:
    """Period length, and publication and cut-off after the end of the period, all in seconds (whole minutes)."""

    period: int
    publish_after: int
    cut_off_after: int

    def end(self, start: Column) -> Column:
        return start + self.period * MICROS

    def published(self, start: Column) -> Column:
        return self.end(start) + self.publish_after * MICROS

    def closed(self, start: Column) -> Column:
        return self.end(start) + self.cut_off_after * MICROS


def accepted(events: DataFrame, rule: Lateness) -> DataFrame:
    """Events that are complete and came before the cut-off of their period, with ``period_us``."""
    rows = events.where("series_key is not null and event_us is not null and arrival_us is not null and member is not null").withColumn("period_us", floor_to(F.col("event_us"), rule.period))
    return rows.where(F.col("arrival_us") <= rule.closed(F.col("period_us")))


def partials(events: DataFrame, rule: Lateness) -> DataFrame:
    """Partials of ``events`` (``series_key``, ``event_us``, ``arrival_us``, ``version``, ``member``, ``figure``).

    One row for each series, period, arrival batch and member: the figure of the batch's last version (``arrival_us``, then
    ``version``; null versions come first). The aggregate is combined on the map side, so a series that holds a third of all rows
    shuffles as its members per minute. Events without series, time, arrival or member, and those that arrive after the
    cut-off of their period (closed periods), are refused.
    """
    rows = accepted(events, rule).withColumn("batch_us", -floor_to(-F.col("arrival_us"), MINUTE))  # rounded up
    last = F.max(F.struct("arrival_us", "version", F.struct("figure").alias("state")))
    return rows.groupBy("series_key", "period_us", "batch_us", "member").agg(last.alias("last"))


def merge_partials(store: DataFrame, more: DataFrame) -> DataFrame:
    """Two stores made one; merging is associative and commutative, and merging a batch twice changes nothing."""
    both = store.unionByName(more)
    return both.groupBy("series_key", "period_us", "batch_us", "member").agg(F.max("last").alias("last"))


def figures(store: DataFrame, rule: Lateness) -> DataFrame:
    """For each series, period and member: its figure at publication and at the cut-off, and whether it was there at all."""
    early = F.col("batch_us") <= rule.published(F.col("period_us"))
    by_member = store.groupBy("series_key", "period_us", "member").agg(F.max(F.when(early, F.col("last"))).alias("first"), F.max("last").alias("final"))
    return by_member.select(
        "series_key",
        "period_us",
        "member",
        F.col("first").isNotNull().alias("was_published"),
        F.col("first.state.figure").alias("published"),
        F.col("final.state.figure").alias("corrected"),
    )


def corrected_periods(store: DataFrame, rule: Lateness) -> DataFrame:
    """Per series and period: members with a figure and their mean, as published and as corrected, and ``changed``.

    A period is changed if any member's figure differs between publication and cut-off; a member with a null figure counts as not there.
    """
    return _by_period(figures(store, rule))


def _by_period(members: DataFrame, *more: Column) -> DataFrame:
    return members.groupBy("series_key", "period_us").agg(
        F.count("published").alias("n_published"),
        F.count("corrected").alias("n_corrected"),
        F.avg("published").alias("mean_published"),
        F.avg("corrected").alias("mean_corrected"),
        F.max(~F.col("published").eqNullSafe(F.col("corrected"))).alias("changed"),
        *more,
    )


def current(store: DataFrame, now_us: int, rule: Lateness) -> DataFrame:
    """The figures as of a moment, from the batches that had arrived; ``open`` tells which periods may still change."""
    seen = store.where(F.col("batch_us") <= now_us).groupBy("series_key", "period_us", "member").agg(F.max("last").alias("l"))
    out = seen.groupBy("series_key", "period_us").agg(F.count("l.state.figure").alias("n"), F.avg("l.state.figure").alias("mean"))
    return out.withColumn("open", rule.closed(F.col("period_us")) > now_us)


class PeriodStore:
    """Members of each period on shared storage, merged delivery by delivery. ``gen=<n>/open=<0 or 1>`` has the periods as of delivery n.

    A delivery is merged with the periods that were open after the one before; those that its end closes are written as closed and never
    read again by a merge, so what a merge costs depends on the open periods, not on the history. Deliveries are told apart by
    arrival: each has what came after the end of the one before and up to its own end (``until_us``). Events of closed periods are refused.
    A delivery that is ingested again under its number gives the same files.

    With ``presence`` a member counts by being there, and its first arrival is all that is kept; else the newest version (``arrival_us``,
    then ``version``) of each member is kept as of publication and as of the last arrival.
    """

    KEYS = ("series_key", "period_us", "member")

    def __init__(self, path: str, rule: Lateness, presence: bool = False):
        self.path, self.rule, self.presence = path, rule, presence

    def _compact(self, events: DataFrame, since_us: int | None) -> DataFrame:
        rows = accepted(events, self.rule)
        if since_us is not None:
            rows = rows.where(self.rule.closed(F.col("period_us")) > since_us)
        if self.presence:
            return rows.groupBy(*self.KEYS).agg(F.min("arrival_us").alias("came"))
        version = F.struct("arrival_us", "version", F.struct("figure").alias("state"))
        early = F.col("arrival_us") <= self.rule.published(F.col("period_us"))
        return rows.groupBy(*self.KEYS).agg(F.max(F.when(early, version)).alias("first"), F.max(version).alias("last"))

    def _merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        both = a.unionByName(b).groupBy(*self.KEYS)
        return both.agg(F.min("came").alias("came")) if self.presence else both.agg(F.max("first").alias("first"), F.max("last").alias("last"))

    def _read(self, spark: SparkSession, number: int, still_open: bool) -> DataFrame | None:
        path = f"{self.path}/gen={number}/open={int(still_open)}"
        return spark.read.parquet(path) if exists(spark, path) else None

    def ingest(self, events: DataFrame, number: int, until_us: int, since_us: int | None = None) -> None:
        """Merges delivery ``number`` (from 0), whose arrivals are after ``since_us`` and up to ``until_us``."""
        spark = events.sparkSession
        state = self._compact(events, since_us)
        if number and (before := self._read(spark, number - 1, True)) is not None:
            state = self._merged(state, before)
        still_open = (self.rule.closed(F.col("period_us")) > until_us).cast("int")
        state.withColumn("open", still_open).write.mode("overwrite").partitionBy("open").parquet(f"{self.path}/gen={number}")

    def periods(self, spark: SparkSession, number: int) -> DataFrame | None:
        """Of every period as of delivery ``number``: what ``corrected_periods`` gives, and ``open``. None if nothing is stored."""
        parts = [p.withColumn("open", F.lit(o)) for n in range(number + 1) for o in (False, True) if (o is False or n == number) and (p := self._read(spark, n, o)) is not None]
        if not parts:
            return None
        rows = reduce(DataFrame.unionByName, parts)
        if self.presence:
            one = F.lit(1.0)
            published, corrected = F.when(F.col("came") <= self.rule.published(F.col("period_us")), one), one
        else:
            published, corrected = F.col("first.state.figure"), F.col("last.state.figure")
        return _by_period(rows.withColumns({"published": published, "corrected": corrected}), F.max("open").alias("open"))
