"""Filling windows of fixed capacity with texts, controlled by the mixture of sources.

Every source has a queue. In each window every queue is given its share of the window's tokens as credit (deficit
round-robin) and yields texts while they fit the credit; what is left, or overdrawn by nothing, is carried to the next
window. The texts of a window are placed largest first where they leave the least space, also into the gaps of earlier
windows. The corpus is spread over shelves that are packed in parallel; the deficit that a shelf would have inherited from the shelves before it is
computed from their token sums, so the proportions hold across partitions.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CAPACITY = 2048
SHELF_ITEMS = 20_000
WINDOW_CONTAINERS = 64
NO_SOURCE = ""


class Shelf:
    """Containers of one shelf."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.space: list[int] = []
        self.open: list[tuple[int, int]] = []  # (space left, container), ascending

    def new(self, size: int) -> int:
        self.space.append(self.capacity - size)
        at = len(self.space) - 1
        if size < self.capacity:
            insort(self.open, (self.capacity - size, at))
        return at

    def place(self, size: int) -> int:
        """Into the container where the least space is left; an empty item goes to any container."""
        if size == 0 and self.space:
            return self.open[0][1] if self.open else len(self.space) - 1
        k = bisect_left(self.open, (size, -1))
        if k == len(self.open):
            return self.new(size)
        left, at = self.open.pop(k)
        self.space[at] = left - size
        if left > size:
            insort(self.open, (left - size, at))
        return at


def rounds(queues: dict[str, deque], share: dict[str, float], credit: dict[str, float], window: int) -> Iterable[list[tuple]]:
    """Windows of (item, tokens): one deficit round each, until all queues are empty. ``credit`` is carried and updated."""
    while any(queues.values()):
        live = [s for s in queues if queues[s]]
        total = sum(share[s] for s in live)
        part = {s: share[s] / total if total > 0 else 1 / len(live) for s in live}
        taken = []
        for s in live:
            credit[s] += window * part[s]
            q = queues[s]
            while q and q[0][1] <= credit[s]:
                item = q.popleft()
                credit[s] -= item[1]
                taken.append(item)
            if not q:
                credit[s] = min(credit[s], 0.0)
        if taken:
            yield taken
            continue
        # every head is larger than its credit: as many windows' credit at once as the first of them needs
        need = min((queues[s][0][1] - credit[s]) / part[s] for s in live if part[s] > 0)
        for s in live:
            credit[s] += need * part[s]


def pack_shelf(items: list[tuple], share: dict[str, float], credit: dict[str, float], capacity: int = CAPACITY, window_containers: int = WINDOW_CONTAINERS) -> list[tuple]:
    """(item number, piece, first token, tokens, container, window) of items (source, tokens) in order.

    Only an item above the capacity is split: into full containers and one remainder, which is packed like any other.
    """
    queues: dict[str, deque] = {s: deque() for s in sorted(share)}
    for n, (source, tokens) in enumerate(items):
        queues[source].append((n, tokens))
    shelf, out = Shelf(capacity), []
    for w, taken in enumerate(rounds(queues, share, credit, capacity * window_containers)):
        pieces = []
        for n, tokens in taken:
            full = tokens // capacity if tokens > capacity else 0
            for k in range(full):
                out.append((n, k, k * capacity, capacity, shelf.new(capacity), w))
            if tokens > full * capacity or tokens == 0:
                pieces.append((tokens - full * capacity, n, full))
        for size, n, k in sorted(pieces, key=lambda p: (-p[0], p[1])):
            out.append((n, k, k * capacity, size, shelf.place(size), w))
    return out


def packed(sizes: DataFrame, key: str = "doc_id", size: str = "tokens", source: str = "source", capacity: int = CAPACITY, shelf_items: int = SHELF_ITEMS, target: dict[str, float] | None = None) -> DataFrame:
    """Containers for all rows of ``sizes``, which has to be materialised (its row order must not change between reads).

    Gives ``key``, ``source``, ``piece``, ``first_token``, ``tokens``, ``container_id`` and ``window_id``; a container holds at most ``capacity``
    tokens. Items with size 0 or null take no space but come out in a container; null sources are a source of their own
    (''). Null and repeated keys are items of their own. ``target`` are the shares of the sources (default: those of all
    tokens); a source without a share gets what the others leave. Empty input: no rows.
    """
    rows = sizes.select(
        F.col(key).alias("item_key"), F.coalesce(F.col(source).cast("string"), F.lit(NO_SOURCE)).alias("item_source"), F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)).alias("item_size"),
        F.monotonically_increasing_id().alias("row_no"),
    )
    shelves = max(1, -(-rows.count() // shelf_items))
    laid = rows.withColumn("shelf", F.pmod(F.xxhash64("row_no"), F.lit(shelves)).cast("int"))
    sums = laid.groupBy("shelf", "item_source").agg(F.sum("item_size").cast("double").alias("own"))
    per_source = sums.groupBy("item_source").agg(F.sum("own").alias("share"))
    if target:
        wanted = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])
        per_source = per_source.withColumn("share", F.coalesce(wanted[F.col("item_source")], F.lit(1e-6)))
    per_source = per_source.join(per_source.agg(F.sum("share").alias("total"))).select("item_source", F.coalesce(F.try_divide("share", "total"), F.lit(0.0)).alias("share"))
    # what a source lacks before a shelf: its share of all tokens of the shelves before, less its own
    by = Window.orderBy("shelf").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shelf
    whole = sums.groupBy("shelf").agg(F.sum("own").alias("all_own")).select("shelf", F.coalesce(F.sum("all_own").over(by), F.lit(0.0)).alias("passed"))
    mine = Window.partitionBy("item_source").orderBy("shelf").rowsBetween(Window.unboundedPreceding, -1)
    owed = sums.withColumn("had", F.coalesce(F.sum("own").over(mine), F.lit(0.0))).join(whole, "shelf").join(per_source, "item_source")
    owed = owed.select(F.col("shelf").alias("owed_shelf"), F.col("item_source").alias("owed_source"), "share", (F.col("share") * F.col("passed") - F.col("had")).alias("credit"))
    key_type = dict(rows.dtypes)["item_key"]
    schema = f"`{key}` {key_type}, `{source}` string, piece int, first_token bigint, tokens bigint, container_id bigint, window_id bigint"

    def pack(items: pd.DataFrame, owing: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values("row_no", kind="stable")
        credit = dict(zip(owing["owed_source"], owing["credit"], strict=True))
        share = dict(zip(owing["owed_source"], owing["share"], strict=True))
        got = pack_shelf(list(zip(items["item_source"], items["item_size"].astype(int).tolist(), strict=True)), share, credit, capacity)
        out = pd.DataFrame(got, columns=["n", "piece", "first_token", "tokens", "container_id", "window_id"])
        base = (int(items["shelf"].iloc[0]) if len(items) else 0) << 32
        keys, names = items["item_key"].to_numpy(), items["item_source"].to_numpy()
        return pd.DataFrame({
            key: keys[out["n"]], source: names[out["n"]], "piece": out["piece"].astype("int32"), "first_token": out["first_token"], "tokens": out["tokens"],
            "container_id": out["container_id"] + base, "window_id": out["window_id"] + base,
        })

    return laid.groupBy("shelf").cogroup(owed.groupBy("owed_shelf")).applyInPandas(pack, schema)


def mixture(containers: DataFrame, source: str = "source") -> DataFrame:
    """What came out: ``window_id``, source, its tokens and its share of the window's tokens (null for a window without tokens).

    A source runs out when its texts are used up before those of the others; the last windows then have the shares of the rest. With the
    corpus's own shares as the target that is a matter of the last window of each shelf; with other targets this is where it shows.
    """
    each = containers.groupBy("window_id", source).agg(F.sum("tokens").alias("tokens"))
    all_of = each.groupBy("window_id").agg(F.sum("tokens").alias("window_tokens"))
    return each.join(all_of, "window_id").select("window_id", source, "tokens", F.try_divide("tokens", "window_tokens").alias("share"))
