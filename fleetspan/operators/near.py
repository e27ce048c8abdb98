"""Points near other points, and points in regions, by overlapping strips and a sweep.

The plane is range-partitioned into latitude strips, each cut into longitude tiles so that one busy latitude is spread.
A point belongs to one tile and is copied to the tiles below, to the left and diagonally where it lies within the distance
of the shared border. Inside a tile the points are sorted by longitude and a sweep keeps the set of points whose longitude
is within reach; distances of the active set are verified exactly. The tile with the smaller strip and the smaller column
of the two homes owns a pair: both points are there, and no other tile reports it.

A tile with more than ``tile_rows`` points (a crowded place) is cut into row blocks; each pair of blocks is a task of its
own, so the work of a place is spread over tasks while each point is copied only as often as there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.geo import EARTH_M, inside, metres, rings

STRIP_REACHES = 4
TILE_DEG = 0.02
TILE_ROWS = 20_000
PAIR_BLOCK = 2_000_000


def _usable(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    p = df.select(F.col(key).cast("string").alias("k"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    return p.where("k is not null and lat between -90 and 90 and lon between -180 and 180 and not isnan(lat) and not isnan(lon)")


def _reach(metres_: float) -> tuple[float, float]:
    """Reach in degrees of latitude and, at the equator, of longitude, with a margin for rounding."""
    deg = float(np.degrees(metres_ / EARTH_M)) * (1 + 1e-9) + 1e-12
    return deg, deg


def _lon_reach(lat, deg: float):
    """Degrees of longitude that the distance spans at most near a latitude, the far side of the reach included."""
    worst = F.least(F.abs(lat) + deg, F.lit(89.999))
    return F.lit(deg) / F.cos(F.radians(worst)) * 1.0001


def near_pairs(df: DataFrame, key: str, lat: str, lon: str, within_m: float, strip_deg: float | None = None, tile_deg: float = TILE_DEG, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``key_a``, ``key_b`` (``key_a`` < ``key_b``) and ``metres`` of each pair of different keys at most ``within_m`` apart, once.

    Rows with a null key or coordinate, NaN or coordinates off the globe have no neighbours. A repeated key is taken once
    for each place it has; a pair found at several places comes out once, with its least distance. Empty input: no rows. Longitudes do not wrap at 180 degrees, and the
    poles (beyond 89.99 degrees) are not covered. A strip is four times as high as the distance unless ``strip_deg`` says otherwise.
    """
    deg, _ = _reach(within_m)
    strip_deg = STRIP_REACHES * deg if strip_deg is None else max(strip_deg, 2 * deg)
    points = _usable(df, key, lat, lon).withColumns({"reach": _lon_reach(F.col("lat"), deg)})
    home = points.withColumns({"strip": F.floor(F.col("lat") / strip_deg), "tile": F.floor(F.col("lon") / tile_deg)})
    # copies: the strip below and all tiles to the left that the reach touches (one, unless the distance is wide)
    low = F.floor((F.col("lat") - deg) / strip_deg)
    left = F.floor((F.col("lon") - F.col("reach")) / tile_deg)
    copies = home.withColumn("in_strip", F.explode(F.sequence(low, F.col("strip")))).withColumn("in_tile", F.explode(F.sequence(left, F.col("tile"))))
    crowded = home.groupBy("strip", "tile").count().where(F.col("count") > tile_rows)
    crowded = crowded.select(F.col("strip").alias("in_strip"), F.col("tile").alias("in_tile"), F.ceil(F.col("count") / tile_rows).cast("int").alias("blocks"))
    placed = copies.join(crowded, ["in_strip", "in_tile"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
    # block b meets blocks 0..b as the right side and b..n-1 as the left side
    tasks = placed.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = tasks.select(
        "k", "lat", "lon", "reach", "strip", "tile", "in_strip", "in_tile", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own"
    ).repartition("in_strip", "in_tile", "lo", "hi")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        t = pa.Table.from_batches(parts)
        cols = {c: t.column(c).to_numpy() for c in ("lat", "lon", "reach", "strip", "tile", "in_strip", "in_tile", "lo", "hi", "own")}
        by = np.lexsort([cols[c] for c in ("lon", "hi", "lo", "in_tile", "in_strip")])
        la, lo, reach, strip, tile, in_strip, in_tile, blk_lo, blk_hi, own = (cols[c][by] for c in cols)
        key = t.column("k").combine_chunks().take(pa.array(by))
        rank = pc.rank(key, tiebreaker="dense").to_numpy()
        new = np.concatenate([[True], (in_strip[1:] != in_strip[:-1]) | (in_tile[1:] != in_tile[:-1]) | (blk_lo[1:] != blk_lo[:-1]) | (blk_hi[1:] != blk_hi[:-1])])
        axis = (np.cumsum(new) - 1) * 1024.0 + (lo + 180)
        # right end of the active set of each point; 1e-9 covers the rounding of the shifted axis
        last = np.searchsorted(axis, axis + reach + 1e-9, side="right")
        count = last - np.arange(len(la)) - 1
        ends = np.cumsum(count)
        at = 0
        while at < len(la):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIR_BLOCK, side="right")))
            n = count[at:to]
            i = np.repeat(np.arange(at, to), n)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
            ok = np.abs(la[i] - la[j]) <= deg
            i, j = i[ok], j[ok]
            ok = (np.minimum(strip[i], strip[j]) == in_strip[i]) & (np.minimum(tile[i], tile[j]) == in_tile[i]) & (rank[i] != rank[j])
            ok &= (np.minimum(own[i], own[j]) == blk_lo[i]) & (np.maximum(own[i], own[j]) == blk_hi[i])
            i, j = i[ok], j[ok]
            m = metres(la[i], lo[i], la[j], lo[j])
            ok = m <= within_m
            i, j = i[ok], j[ok]
            swap = rank[i] > rank[j]
            yield pa.RecordBatch.from_arrays([key.take(pa.array(np.where(swap, j, i))), key.take(pa.array(np.where(swap, i, j))), pa.array(m[ok])], ["key_a", "key_b", "metres"])
            at = to

    return tasks.mapInArrow(sweep, "key_a string, key_b string, metres double").groupBy("key_a", "key_b").agg(F.min("metres").alias("metres"))


def containing_regions(points: DataFrame, key: str, lat: str, lon: str, regions: DataFrame, region_key: str, wkt: str, strip_deg: float = 0.02, tile_deg: float = 0.1) -> DataFrame:
    """``key_a`` (point) and ``key_b`` (region) of each region that contains the point, holes left out, edges counted in.

    Points go to their tile, regions to every tile that their bounding box touches; each tile sweeps its regions over its
    longitude-sorted points. A (point, region) pair is met only in the point's tile. Nulls as in ``near_pairs``; a text
    that is no polygon contains nothing; regions may overlap; repeated rows come out once. No side is broadcast.
    """
    p = _usable(points, key, lat, lon)
    p = p.select("k", "lat", "lon", F.lit(None).cast("string").alias("wkt"), F.floor(F.col("lat") / strip_deg).alias("s"), F.floor(F.col("lon") / tile_deg).alias("t"))

    def lay(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k, text in zip(f["k"], f["wkt"], strict=True):
                shape = rings(text)
                if not shape:
                    continue
                xy = np.vstack(shape)
                s = np.arange(np.floor(xy[:, 1].min() / strip_deg), np.floor(xy[:, 1].max() / strip_deg) + 1)
                t = np.arange(np.floor(xy[:, 0].min() / tile_deg), np.floor(xy[:, 0].max() / tile_deg) + 1)
                ss, tt = np.repeat(s, len(t)), np.tile(t, len(s))
                yield pd.DataFrame({"k": k, "lat": 0.0, "lon": 0.0, "wkt": text, "s": ss.astype("int64"), "t": tt.astype("int64")})

    r = regions.select(F.col(region_key).cast("string").alias("k"), F.col(wkt).alias("wkt")).where("k is not null").distinct()
    r = r.mapInPandas(lay, "k string, lat double, lon double, wkt string, s bigint, t bigint")
    # a busy tile is salted: its points are spread, its regions (bounded by the regions of one tile) go to each salt
    salts = 16
    salted = p.withColumn("salt", F.pmod(F.xxhash64("k"), F.lit(salts)).cast("int")).unionByName(r.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        f = pa.Table.from_batches(parts)
        is_area = f.column("wkt").is_valid()
        pts, areas = f.filter(pc.invert(is_area)), f.filter(is_area)
        if not len(pts) or not len(areas):
            return
        of = lambda t: np.stack([t.column(c).to_numpy() for c in ("s", "t", "salt")], axis=1)
        cells, cell = np.unique(of(pts), axis=0, return_inverse=True)
        cell = cell.ravel()
        by = np.lexsort((pts.column("lon").to_numpy(), cell))
        cell, x, y = cell[by], pts.column("lon").to_numpy()[by], pts.column("lat").to_numpy()[by]
        key = pts.column("k").combine_chunks().take(pa.array(by))
        axis = cell * 1024.0 + (x + 180)
        number = {tuple(c): n for n, c in enumerate(cells.tolist())}
        tiles: dict[tuple[str, str], list[int]] = {}
        for zone, text, c in zip(areas.column("k").to_pylist(), areas.column("wkt").to_pylist(), of(areas).tolist(), strict=True):
            if (n := number.get(tuple(c))) is not None:
                tiles.setdefault((zone, text), []).append(n)
        for (zone, text), mine in tiles.items():
            shape = rings(text)
            xs, ys = np.concatenate(shape).T
            base = np.array(mine) * 1024.0 + 180
            a, b = np.searchsorted(axis, base + xs.min() - 1e-9, "left"), np.searchsorted(axis, base + xs.max() + 1e-9, "right")
            n = np.maximum(b - a, 0)
            at = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = at[(y[at] >= ys.min()) & (y[at] <= ys.max())]
            if len(at) and (hit := at[inside(x[at], y[at], shape)]).size:
                yield pa.RecordBatch.from_arrays([key.take(pa.array(hit)), pa.array([zone] * len(hit), pa.string())], ["key_a", "key_b"])

    out = salted.repartition("s", "t", "salt").mapInArrow(sweep, "key_a string, key_b string")
    return out.distinct()
