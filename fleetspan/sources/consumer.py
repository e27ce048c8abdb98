"""A stream as a consumer that polls: a callback for each batch or message, a limit, figures of what was taken.

Offsets live in the query's checkpoint, so there is nothing to commit: a batch whose callback failed is delivered again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetspan.sources.adapters import kafka_stream


@dataclass(frozen=True)
class PollRules:
    """Defaults of the consumer: messages in a poll, seconds between polls, where a new consumer begins."""

    most_per_poll: int = 500
    every_seconds: int = 5
    start: str = "latest"


def topic(spark: SparkSession, servers: str, name: str, rules: PollRules = PollRules()) -> DataFrame:
    """A topic with the consumer's limits; values are JSON text."""
    return kafka_stream(spark, servers, name, rules.most_per_poll, rules.start).selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value", "topic", "partition", "offset", "timestamp")


class PollConsumer:
    """``with PollConsumer(stream, checkpoint) as c: c.drain(callback)``. A callback gets the batch as a frame and its number."""

    def __init__(self, stream: DataFrame, checkpoint: str, rules: PollRules = PollRules()):
        self.stream, self.checkpoint, self.rules = stream, checkpoint, rules
        self.query: StreamingQuery | None = None
        self.taken = self.batches = self.failed = 0
        self.begun = time.monotonic()

    def __enter__(self) -> PollConsumer:
        return self

    def __exit__(self, *_: object) -> None:
        self.stop()

    def _one(self, callback: Callable[[DataFrame, int], None], most: int | None) -> Callable[[DataFrame, int], None]:
        def one(batch: DataFrame, number: int) -> None:
            if most is not None and self.taken >= most:
                raise _Enough
            try:
                callback(batch, number)
            except Exception:
                self.failed += 1
                raise
            self.taken += batch.count()
            self.batches += 1

        return one

    def drain(self, callback: Callable[[DataFrame, int], None], most: int | None = None) -> dict[str, float]:
        """Takes what is there, batch by batch, and ends; with ``most`` it ends after the batch that reaches it, and what is left is taken next time."""
        q = self.query = self.stream.writeStream.foreachBatch(self._one(callback, most)).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        except Exception:
            if most is None or self.taken < most:
                raise
        return self.stats()

    def run(self, callback: Callable[[DataFrame, int], None]) -> StreamingQuery:
        """Polls until ``stop``."""
        self.query = self.stream.writeStream.foreachBatch(self._one(callback, None)).option("checkpointLocation", self.checkpoint).trigger(processingTime=f"{self.rules.every_seconds} seconds").start()
        return self.query

    def stop(self) -> None:
        if self.query is not None and self.query.isActive:
            self.query.stop()

    def stats(self) -> dict[str, float]:
        seconds = max(time.monotonic() - self.begun, 1e-9)
        return {"messages": self.taken, "batches": self.batches, "failed": self.failed, "seconds": seconds, "messages_per_second": self.taken / seconds}


class _Enough(Exception):
    """The limit of messages is reached."""


def each_message(f: Callable[[Row], None]) -> Callable[[DataFrame, int], None]:
    """A callback for single messages; it runs in the executors, a partition at a time."""

    def run(rows) -> None:
        for r in rows:
            f(r)

    return lambda batch, _: batch.foreachPartition(run)
