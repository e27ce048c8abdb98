"""Sources in time order, handed to array code in blocks of whole sources.

``ordered`` shuffles once by source (and by part for the few sources that are too large for one task) and sorts inside
the partitions; ``blocks`` cuts the sorted stream into arrays that hold whole (source, part) runs, so memory is bounded by
a block or by the largest part, not by the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetspan.functions.clock import MICROS
from fleetspan.operators.delivery import local_first

BLOCK_ROWS = 60_000
HOT_ROWS = 1_000_000
SILENCE = 1200


def with_parts(rows: DataFrame, hot_rows: int = HOT_ROWS, silence: int = SILENCE, counted: DataFrame | None = None, held: tuple[str, ...] = (), copies: bool = False) -> DataFrame:
    """Adds ``part``: 0, but for sources with more than ``hot_rows`` rows a number that grows at silences.

    Rows are counted by source; only for sources above the bound (at most all rows / ``hot_rows`` of them) rows per slot of
    ``silence`` seconds are counted too. Between two occupied slots with an empty one in between nothing was sent for
    at least ``silence`` seconds, so a cut there separates no stop or trip. Parts are filled up to ``hot_rows`` rows.
    ``counted`` may hold the same sources with more rows but a cheaper plan; the counts come from it.
    A run of one value of a column of ``held`` (zero and null apart) is never cut; with ``copies`` the first row to arrive of a time counts for that.
    """
    hot = [r[0] for r in (rows if counted is None else counted).groupBy("source_key").count().where(F.col("count") > hot_rows).select("source_key").collect()]
    if not hot:
        return rows.withColumn("part", F.lit(0))
    is_hot = F.col("source_key").isin(hot)
    slot = F.floor(F.col("event_us") / (silence * MICROS))
    by = Window.partitionBy("source_key").orderBy("slot")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    values = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in held]
    thin = rows.where(is_hot).select("source_key", "event_us", "arrival", *values)
    slots = thin.groupBy("source_key", slot.alias("slot")).count()
    clean = F.lit(True)
    if held:
        if copies:
            thin = thin.groupBy("source_key", "event_us").agg(F.min_by(F.struct(*held), "arrival").alias("kept"), F.min("arrival").alias("arrival")).select("source_key", "event_us", "arrival", "kept.*")
        at = {c: F.when(F.col(c).isNotNull(), F.struct("event_us", "arrival")) for c in held}
        ends = thin.groupBy("source_key", slot.alias("slot")).agg(*(f(c, at[c]).alias(f"{end}_{c}") for c in held for f, end in ((F.min_by, "first"), (F.max_by, "last"))))
        slots = slots.join(ends, ["source_key", "slot"])
        for c in held:
            was, now = F.last(f"last_{c}", True).over(before), F.first(f"first_{c}", True).over(by.rowsBetween(0, Window.unboundedFollowing))
            clean &= F.coalesce((was != now) | (now == 0), F.lit(True))
    slots = slots.withColumns({"fresh": F.coalesce((F.col("slot") - F.lag("slot").over(by) > 1) & clean, F.lit(True)), "total": F.sum("count").over(by) - F.col("count")})
    slots = slots.select("source_key", "slot", F.floor(F.last(F.when(F.col("fresh"), F.col("total")), True).over(by) / hot_rows).cast("int").alias("part"))
    cut = rows.where(is_hot).withColumn("slot", slot).join(slots, ["source_key", "slot"]).drop("slot")
    return rows.where(~is_hot).withColumn("part", F.lit(0)).unionByName(cut)


def ordered(ids: DataFrame, hot_rows: int = HOT_ROWS, first_only: bool = True, *, held: tuple[str, ...]) -> DataFrame:
    """Rows of ``identified`` by source in time order; copies that arrive together are dropped before the shuffle."""
    rows = local_first(ids, "id_hash", "arrival", ["source_key", "event_us"]) if first_only else ids
    return by_part(with_parts(rows, hot_rows, counted=ids, held=held, copies=True).drop("id_hash"))


def by_part(rows: DataFrame) -> DataFrame:
    return rows.repartition("source_key", "part").sortWithinPartitions("source_key", "part", "event_us", "arrival")


def of_cut_sources(laid: DataFrame) -> DataFrame | None:
    """The rows of the sources that are cut into parts; None if there are none (known without a pass if no source is hot)."""
    names = [r[0] for r in laid.where("part > 0").select("source_key").distinct().collect()]
    return laid.where(F.col("source_key").isin(names)) if names else None


def blocks(batches: Iterator[pa.RecordBatch], rows: int = BLOCK_ROWS) -> Iterator[pa.Table]:
    """Tables of whole (source, part) runs from a stream sorted by them, with at least ``rows`` rows each but the last."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(held)
        source, part = whole.column("source_key").combine_chunks(), whole.column("part").to_numpy()
        last, last_part = source[len(source) - 1], part[-1]
        same = pc.equal(source, last).to_numpy(zero_copy_only=False) & (part == last_part)
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield whole.slice(0, cut)
        held = whole.slice(cut).to_batches()
        count = len(same) - cut
    if held:
        yield pa.Table.from_batches(held)


def runs(table: pa.Table) -> np.ndarray:
    """Number of the (source, part) run of each row, from 0."""
    source = table.column("source_key").combine_chunks().dictionary_encode().indices.to_numpy()
    part = table.column("part").to_numpy()
    new = np.concatenate([[True], (source[1:] != source[:-1]) | (part[1:] != part[:-1])])
    return np.cumsum(new) - 1


def names(table: pa.Table, run: np.ndarray) -> list[str]:
    """Source of each run."""
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else run
    return table.column("source_key").combine_chunks().take(pa.array(first)).to_pylist()


def floats(table: pa.Table, name: str) -> np.ndarray:
    """A column as doubles, NaN for null."""
    return table.column(name).cast(pa.float64()).to_numpy()
