"""At-least-once deliveries: exactly one row of each identifier.

An identifier is the pair (source, event time). What has been seen is kept on shared storage in buckets of event time: the identifiers,
and for each bucket, hash segment and generation of deliveries a Bloom filter of them. A generation is shuffled once by bucket
and segment, together with the stored filters of its own slots; what no filter of its bucket knows is certainly new. Only the possible
repeats are verified exactly, by a join with the stored identifiers of the slots and buckets they fall in.

Copies of one identifier that arrive together are told apart before the shuffle, so that a group of copies holding a third of all rows
reaches the exact stage as at most one row for each Arrow batch. Hash segments spread a busy hour.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.functions.clock import MICROS, micros
from fleetspan.functions.vehicle import bare_vehicle
from fleetspan.sources.lineage import new_store
from fleetspan.sources.sinks import exists

BUCKET_SECONDS = 3600
SLOT_BUCKETS = 6
SLOTS = 16
SEGMENTS = 4
ROUNDS = 2
BITS_PER_ID = 12
PROBES = 4


def filter_bits(ids: np.ndarray) -> np.ndarray:
    """Size in bits of a filter for so many identifiers; whole words."""
    return np.maximum(-(-ids.astype(np.int64) * BITS_PER_ID // 64) * 64, 64)


class BucketBlooms:
    """Bloom filters laid end to end in one bit array, a filter for each group."""

    def __init__(self, size: np.ndarray, bits: np.ndarray | None = None):
        self.size = size
        self.start = np.concatenate([[0], np.cumsum(size)])
        self.bits = np.zeros(int(self.start[-1]) // 8, dtype=np.uint8) if bits is None else bits

    def places(self, group: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Bit positions, a row for each probe (double hashing of the 64-bit key)."""
        k = key.view(np.uint64)
        low, high = k & np.uint64(0xFFFFFFFF), (k >> np.uint64(32)) | np.uint64(1)
        steps = np.arange(PROBES, dtype=np.uint64)[:, None]
        return self.start[group] + ((low + steps * high) % self.size[group].astype(np.uint64)).astype(np.int64)

    def seen(self, group: np.ndarray, key: np.ndarray) -> np.ndarray:
        places = self.places(group, key)
        return ((self.bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)

    def add(self, group: np.ndarray, key: np.ndarray) -> None:
        flat = np.unique(self.places(group, key).ravel())
        at = np.zeros(len(self.bits) * 8, dtype=bool)
        at[flat] = True
        self.bits |= np.packbits(at, bitorder="little")

    def of(self, group: int) -> bytes:
        return self.bits[self.start[group] // 8 : self.start[group + 1] // 8].tobytes()


def _first_of_batch(batch: pa.RecordBatch | pa.Table, key: str, order: str, also: list[str]) -> np.ndarray:
    """Mask of the rows that are the first by ``order`` of their identifier in the batch (hash first, identifier exactly)."""
    h, o = np.asarray(batch.column(key)), np.asarray(batch.column(order))
    by = np.lexsort((o, h))
    hs = h[by]
    same = np.concatenate([[False], hs[1:] == hs[:-1]])
    if same.any():
        left, right = by[np.flatnonzero(same) - 1], by[same]
        equal = np.ones(len(left), dtype=bool)
        for name in also:
            col = batch.column(name)
            a, b = col.take(pa.array(left)), col.take(pa.array(right))
            equal &= pc.equal(a, b).to_numpy(zero_copy_only=False)
        same[same] = equal
    first = np.ones(len(h), dtype=bool)
    first[by[same]] = False
    return first


def local_first(df: DataFrame, key: str, order: str, identity: list[str]) -> DataFrame:
    """Drop, inside each Arrow batch, all rows of an identifier but the first by ``order``: what is dropped is surplus for sure."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_first_of_batch(batch, key, order, identity)))

    return df.mapInArrow(keep, df.schema)


def identified(df: DataFrame, source: str = "vehicle_id", time: str = "timestamp", order: str = "row_id", *, payload: tuple[str, ...] = ()) -> DataFrame:
    """Rows with both parts of the identifier, narrowed to ``source_key``, ``event_us``, ``arrival``, ``id_hash`` and the payload."""
    at = micros(time)
    return (
        df.select(bare_vehicle(source).alias("source_key"), at.alias("event_us"), F.col(order).alias("arrival"), *payload)
        .where("source_key is not null and event_us is not null and arrival is not null")
        .withColumn("id_hash", F.xxhash64("source_key", "event_us"))
    )


KEYS = "slot int, bucket bigint, segment int, source_key string, event_us bigint, arrival bigint"
LAID = f"{KEYS}, id_hash bigint, surplus boolean, size bigint, bits binary"
STORED = f"kind string, {KEYS}, size bigint, bits binary"
NEW, MAYBE, SURPLUS, FILTER = "new", "maybe", "surplus", "filter"


def pair(t: pa.Table) -> np.ndarray:
    """Bucket and segment as one number."""
    return np.asarray(t.column("bucket")) * 65_536 + np.asarray(t.column("segment"))


def screened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole (slot, segment) groups, with the stored filters among them, to rows of the store.

    The first of each identifier is ``new`` if no stored filter of its bucket and segment knows it, else ``maybe`` a repeat; later ones
    are ``surplus``. Each bucket and segment gets a filter of its first ones.
    """
    names = [c.split()[0] for c in STORED.split(", ")]

    def rows(kind: str, t: pa.Table, size: np.ndarray | None = None, bits: list[bytes] | None = None) -> Iterator[pa.RecordBatch]:
        if len(t):
            n = len(t)
            t = t.append_column("kind", pa.array([kind] * n).dictionary_encode().cast(pa.string()))
            t = t.append_column("size", pa.nulls(n, pa.int64()) if size is None else pa.array(size)).append_column("bits", pa.nulls(n, pa.binary()) if bits is None else pa.array(bits, pa.binary()))
            yield from t.select(names).combine_chunks().to_batches()

    ids, stored = [], []
    keys = names[1:-2]
    for batch in batches:
        is_filter = batch.column("bits").is_valid()
        if pc.any(is_filter).as_py():
            stored.append(batch.filter(is_filter))
            batch = batch.filter(pc.invert(is_filter))
        if batch.num_rows:
            ids.append(batch.drop_columns(["size", "bits"]))
    if not ids:
        return
    t = pa.Table.from_batches(ids)
    known = t.column("surplus").to_numpy(zero_copy_only=False)
    yield from rows(SURPLUS, t.filter(pa.array(known)).select(keys))
    t = t.filter(pa.array(~known)).combine_chunks()
    if not len(t):
        return
    first = _first_of_batch(t, "id_hash", "arrival", ["source_key", "event_us"])
    yield from rows(SURPLUS, t.filter(pa.array(~first)).select(keys))
    t = t.filter(pa.array(first)).combine_chunks()
    key = np.asarray(t.column("id_hash"))
    groups, at, group = np.unique(pair(t), return_index=True, return_inverse=True)
    maybe = np.zeros(len(t), dtype=bool)
    if stored:
        old = pa.Table.from_batches(stored)
        of = pair(old)
        own = np.searchsorted(groups, of)
        ok = (own < len(groups)) & (groups[np.minimum(own, len(groups) - 1)] == of)
        own, old = own[ok], old.filter(pa.array(ok))
        nth = np.zeros(len(own), dtype=np.int64)  # a filter for each generation that touched the group
        by = np.argsort(own, kind="stable")
        new = np.concatenate([[True], own[by][1:] != own[by][:-1]]) if len(own) else np.zeros(0, dtype=bool)
        nth[by] = np.arange(len(own)) - np.maximum.accumulate(np.where(new, np.arange(len(own)), 0)) if len(own) else nth
        size, bits = np.asarray(old.column("size")), old.column("bits").to_pylist()
        for k in range(int(nth.max()) + 1 if len(nth) else 0):
            some = np.flatnonzero(nth == k)
            blooms = BucketBlooms(size[some], np.frombuffer(b"".join(bits[i] for i in some), dtype=np.uint8))
            place = np.full(len(groups), -1)
            place[own[some]] = np.arange(len(some))
            here = np.flatnonzero(place[group] >= 0)
            maybe[here] |= blooms.seen(place[group[here]], key[here])
    yield from rows(NEW, t.filter(pa.array(~maybe)).select(keys))
    yield from rows(MAYBE, t.filter(pa.array(maybe)).select(keys))
    blooms = BucketBlooms(filter_bits(np.bincount(group)))
    blooms.add(group, key)
    heads = t.select(["slot", "bucket", "segment"]).take(pa.array(at))
    for name, kind in (("source_key", pa.string()), ("event_us", pa.int64()), ("arrival", pa.int64())):
        heads = heads.append_column(name, pa.nulls(len(heads), kind))
    yield from rows(FILTER, heads, blooms.size, [blooms.of(g) for g in range(len(groups))])


class DeliveryLog:
    """Identifiers seen so far, on shared storage, for deliveries that come generation by generation.

    ``gen=<n>/slot=<s>`` holds the identifiers and the filters of one generation; six buckets in a row share a slot, and the slots recur.
    A generation reads the filters of its own slots only, and its possible repeats are verified against the identifiers of their own slots
    and buckets. A generation that is ingested again under its number overwrites its files. There are at most ``slots`` times
    ``segments`` tasks (at most 65,536 segments); both should grow with the size of a generation.
    """

    def __init__(self, path: str, bucket_seconds: int = BUCKET_SECONDS, slots: int = SLOTS, segments: int = SEGMENTS):
        self.path, self.bucket_seconds, self.slots, self.segments = path, bucket_seconds, slots, segments

    def bucket(self) -> Column:
        return F.floor(F.col("event_us") / (self.bucket_seconds * MICROS))

    def stored(self, spark: SparkSession, before: int) -> DataFrame | None:
        """Rows of the generations before one; None if there are none."""
        if not exists(spark, self.path):
            return None
        rows = spark.read.schema(f"{STORED}, gen int").option("basePath", self.path).parquet(self.path)
        return rows.where(F.col("gen") < before)

    def ingest(self, batch: DataFrame, number: int, source: str = "vehicle_id", time: str = "timestamp", order: str = "row_id") -> DataFrame:
        """Stores the generation and gives its ``kind``, ``source_key``, ``event_us`` and ``arrival``: ``new`` or ``surplus``.

        ``number`` and ``order`` have to grow from generation to generation. Rows without source, time or order are left out.
        """
        spark = batch.sparkSession

        def screen_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    first = _first_of_batch(b, "id_hash", "arrival", ["source_key", "event_us"])
                    yield b.append_column("surplus", pa.array(~first))

        flagged = identified(batch, source, time, order).mapInArrow(screen_batch, "source_key string, event_us bigint, arrival bigint, id_hash bigint, surplus boolean")
        slot = F.pmod(F.floor(F.col("bucket") / SLOT_BUCKETS), F.lit(self.slots)).cast("int")
        flagged = flagged.withColumn("bucket", self.bucket())
        spread = F.when(F.col("surplus"), F.col("arrival")).otherwise(F.shiftrightunsigned("id_hash", 7))  # a surplus row goes anywhere
        ids = flagged.select(
            F.when(F.col("surplus"), F.pmod(F.shiftright("arrival", 3), F.lit(self.slots)).cast("int")).otherwise(slot).alias("slot"), "bucket", F.pmod(spread, F.lit(self.segments)).cast("int").alias("segment"),
            "source_key", "event_us", "arrival", "id_hash", "surplus", F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("binary").alias("bits"),
        )
        older = self.stored(spark, number)
        if older is not None:
            touched = identified(batch, source, time, order).withColumn("bucket", self.bucket()).select(slot.alias("slot")).distinct()  # at most ``slots`` rows
            filters = older.where(F.col("kind") == FILTER).join(F.broadcast(touched), "slot", "left_semi")
            ids = ids.unionByName(filters.select("slot", "bucket", "segment", "size", "bits"), allowMissingColumns=True)
        out = f"{self.path}/gen={number}"
        ids.repartition("slot", "segment").mapInArrow(screened, STORED).write.mode("overwrite").partitionBy("slot").parquet(out)
        return self.kinds(spark, number)

    def kinds(self, spark: SparkSession, number: int) -> DataFrame:
        """What ``ingest`` gives, from the store: possible repeats are joined with the identifiers of the slots and buckets they fall in."""
        rows = spark.read.schema(STORED).parquet(f"{self.path}/gen={number}").where(F.col("kind") != FILTER)
        cols = ("source_key", "event_us", "arrival")
        sure = rows.where(F.col("kind") != MAYBE).select("kind", *cols)
        older = self.stored(spark, number)
        maybe = rows.where(F.col("kind") == MAYBE)
        keys = ["slot", "bucket", "source_key", "event_us"]
        seen = older.where(F.col("kind").isin(NEW, MAYBE)).select(*keys)
        known, fresh = maybe.join(seen, keys, "left_semi"), maybe.join(seen, keys, "left_anti")
        return sure.unionByName(known.select(F.lit(SURPLUS).alias("kind"), *cols)).unionByName(fresh.select(F.lit(NEW).alias("kind"), *cols))


def surplus_rows(df: DataFrame, source: str = "vehicle_id", time: str = "timestamp", order: str = "row_id", rounds: int = ROUNDS, path: str | None = None, bucket_seconds: int = BUCKET_SECONDS, slots: int = SLOTS, segments: int = SEGMENTS) -> DataFrame:
    """``arrival`` of every surplus row: all rows of one (source, time) but the first by ``order``.

    The rows go through a ``DeliveryLog`` in ``rounds`` generations of arrival, so this writes a store (``path``, or one in the shared folder).
    Nulls: rows without source, time or order are never surplus. Ties: ``order`` is unique; of rows with equal ``order``
    one is kept. Repeated rows with another payload count as copies. Empty input gives no rows. Other columns are ignored.
    """
    spark = df.sparkSession
    lo, hi = df.agg(F.min(order), F.max(order)).first()  # one row
    log, out = DeliveryLog(path or new_store(spark, "deliveries"), bucket_seconds, slots, segments), []
    lo, hi = (0, 0) if lo is None else (lo, hi)
    rounds = max(1, min(rounds, hi - lo + 1))
    edges = [lo + (hi - lo + 1) * k // rounds for k in range(rounds + 1)]
    for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        out.append(log.ingest(df.where((F.col(order) >= a) & (F.col(order) < b)), n, source, time, order).where(F.col("kind") == SURPLUS).select("arrival"))
    return reduce(DataFrame.unionByName, out)
