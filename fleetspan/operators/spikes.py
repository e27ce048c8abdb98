"""Readings that are false for their own source: spikes, stuck values, impossible values and impossible places.

Spikes are the outliers of a robust seasonal-trend decomposition of each source by the generalised extreme studentised deviate test
(``deviates``). An exact check follows: the lowest gap between two readings that follow each other by size and differ by ``ratio`` or more
parts the sound ones from the spikes, if most of what is above it are outliers. Constant runs and ranges are checked on their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan.functions.clock import micros
from fleetspan.functions.geo import metres
from fleetspan.operators.delivery import identified
from fleetspan.operators.deviates import group_median, outliers, residuals
from fleetspan.operators.series import HOT_ROWS, blocks, by_part, floats, names, of_cut_sources, ordered, runs, with_parts


@dataclass(frozen=True)
class Limits:
    """What a reading may be. A bar and a deviation below ``least_scale`` count as that.

    ``level``: chance of a sound reading to be beyond the deviate limit. ``most``: greatest share of spikes of a source, rounded up. More than
    the share ``common`` above a gap are spikes only if they are scattered, ``stretch`` or fewer in a row on average: else the source
    drives so at times. ``odd``: least share of outliers among the readings above a gap.
    """

    low: float = 0.0
    high: float = 250.0
    ratio: float = 1.8
    held: int = 8
    lat: tuple[float, float] = (-24.0, -23.0)
    kmh: float = 120.0
    moved_m: float = 100.0
    drift_m: float = 20.0
    walk_kmh: float = 3.0
    level: float = 0.05
    most: float = 0.35
    common: float = 0.1
    stretch: float = 4.0
    odd: float = 0.5
    least_scale: float = 1.0


def held_runs(run: np.ndarray, x: np.ndarray, least: int) -> np.ndarray:
    """Number of the run of equal values that each reading belongs to, -1 for runs shorter than ``least``."""
    if not len(x):
        return np.zeros(0, dtype=np.int64)
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (x[1:] != x[:-1])])
    number = np.cumsum(new) - 1
    n = np.bincount(number)
    return np.where(n[number] >= least, number, -1)


def spike_bars(group: np.ndarray, low: np.ndarray, high: np.ndarray, n: np.ndarray, odd: np.ndarray, begins: np.ndarray, size: int, lim: Limits) -> np.ndarray:
    """The least spike of each group 0..size-1, infinite where there is none.

    Each entry, in order of group and size, stands for ``n`` readings from ``low`` to ``high`` without a gap between them, ``odd`` of
    them outliers: a reading, or a bucket of them. The sum of ``begins`` up to an entry is the number of stretches of readings, in order of
    time, from that size on. At least three readings must be left below the gap.
    """
    bars = np.full(size, np.inf)
    if not len(group):
        return bars

    def within(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total = np.bincount(group, x, size)
        return total[group], np.cumsum(x) - (np.cumsum(total) - total)[group]

    begun = within(begins)[1]
    (total, so_far), (odd_total, odd_so_far) = within(n), within(odd)
    some = n > 0
    g, least, most, total, so_far, begun = group[some], low[some], high[some], total[some], so_far[some], begun[some]
    above, odd_above = (total - so_far)[:-1], (odd_total[some] - odd_so_far[some])[:-1]
    gap = (g[1:] == g[:-1]) & (least[1:] >= lim.ratio * np.maximum(most[:-1], lim.least_scale)) & (so_far[:-1] >= 3)
    gap &= (above <= np.ceil(lim.most * total[:-1])) & (odd_above >= lim.odd * above)
    gap &= (above <= np.ceil(lim.common * total[:-1])) | (above <= lim.stretch * begun[1:])
    np.minimum.at(bars, g[1:][gap], least[1:][gap])
    return bars


def stretches(run: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, size, change) such that the sum of the changes of a run up to a size is the number of its stretches of readings from that size on.

    ``size`` is a whole number from 0, in order of run and time. A reading larger than the one before begins a stretch for all sizes between the two.
    """
    before = np.concatenate([[-1], size[:-1]])
    before[np.concatenate([[True], run[1:] != run[:-1]])] = -1
    up = np.flatnonzero(size > before)
    return np.concatenate([run[up], run[up]]), np.concatenate([before[up] + 1, size[up] + 1]), np.concatenate([np.ones(len(up)), -np.ones(len(up))])


def odd_ones(run: np.ndarray, us: np.ndarray, x: np.ndarray, lim: Limits) -> np.ndarray:
    """The outliers of each run, of readings in order of run and time."""
    _, run = np.unique(run, return_inverse=True)
    return outliers(run, residuals(run, us, x), lim.level, min(0.5, lim.most / lim.odd), lim.least_scale)


def spikes(run: np.ndarray, us: np.ndarray, x: np.ndarray, out: np.ndarray, lim: Limits, known: dict[int, float] | None = None) -> np.ndarray:
    """Spikes among the readings that are not ``out`` already. ``known``: bars of runs that are parts of a source, from the whole of it."""
    at = np.flatnonzero(~out)
    if not len(at):
        return np.zeros(len(x), dtype=bool)
    r, v = run[at], x[at]
    by = np.lexsort((v, r))
    total = np.bincount(r, minlength=run.max() + 1)
    begin = np.cumsum(total) - total
    place = np.empty(len(at), dtype=np.int64)
    place[by] = np.arange(len(at))
    of, size, change = stretches(r, place - begin[r])
    inner = size < total[of]
    begins = np.bincount(begin[of[inner]] + size[inner], change[inner], len(at))
    bars = spike_bars(r[by], v[by], v[by], np.ones(len(at)), odd_ones(r, us[at], v, lim)[by].astype(float), begins, len(total), lim)
    for one, bar in (known or {}).items():
        if one < len(bars):
            bars[one] = bar
    return ~out & (x >= bars[run])


def _extent_m(number: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Diagonal of the box of the known places of each run of equal values (0 where none is known)."""
    size = number.max() + 1
    ok = ~np.isnan(lat) & ~np.isnan(lon)
    a, b, c, d = np.full(size, np.inf), np.full(size, -np.inf), np.full(size, np.inf), np.full(size, -np.inf)
    for low, high, v in ((a, b, lat), (c, d, lon)):
        np.minimum.at(low, number[ok], v[ok])
        np.maximum.at(high, number[ok], v[ok])
    return np.where(np.isfinite(a), metres(np.where(np.isfinite(a), a, 0), np.where(np.isfinite(c), c, 0), np.where(np.isfinite(b), b, 0), np.where(np.isfinite(d), d, 0)), 0.0)


def _kmh(lat: np.ndarray, lon: np.ndarray, us: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return metres(lat[i], lon[i], lat[j], lon[j]) * 3.6e6 / np.maximum(us[j] - us[i], 1)


def false_places(run: np.ndarray, us: np.ndarray, lat: np.ndarray, lon: np.ndarray, lim: Limits) -> np.ndarray:
    """Places that need more than ``kmh`` both from the sound place before and to the one after.

    A lone place between two that fit each other is decided at once; where impossible steps crowd, the sound places are the longest
    chain of possible steps around them. What is left of impossible steps is judged by ``_excursions``.
    """
    n = len(us)
    bad = np.zeros(n, dtype=bool)
    if n < 3:
        return bad
    i = np.arange(n - 1)
    same = run[1:] == run[:-1]
    step = same & (_kmh(lat, lon, us, i, i + 1) > lim.kmh)  # step[i]: from i to i + 1
    if not step.any():
        return bad
    edges = np.flatnonzero(step)
    cluster = np.cumsum(np.concatenate([[True], (np.diff(edges) > 4) | (run[edges[1:]] != run[edges[:-1]])])) - 1
    for group in np.split(edges, np.flatnonzero(np.diff(cluster)) + 1):
        if len(group) == 2 and group[1] == group[0] + 1 and _kmh(lat, lon, us, group[:1], group[1:] + 1)[0] <= lim.kmh:
            bad[group[1]] = True
            continue
        if len(group) == 1:  # one impossible step between two sound stretches: neither side fails both ways
            continue
        lo, hi = group[0], group[-1] + 1
        own = run[lo]
        while lo > 0 and run[lo - 1] == own and group[0] - lo < 4:
            lo -= 1
        while hi < n - 1 and run[hi + 1] == own and hi - group[-1] < 5:
            hi += 1
        idx = np.arange(lo, hi + 1)
        length, back, longest = np.ones(len(idx), dtype=int), np.full(len(idx), -1), np.ones(len(idx), dtype=int)
        for k in range(1, len(idx)):
            far = k
            while far > 0 and longest[far - 1] >= length[k]:  # else nothing before makes the chain longer
                far, end = max(0, far - 64), far
                ok = _kmh(lat, lon, us, idx[far:end], np.full(end - far, idx[k])) <= lim.kmh
                best = far + int(np.argmax(np.where(ok, length[far:end], 0)))
                if ok.any() and length[best] >= length[k]:
                    length[k], back[k] = length[best] + 1, best
            longest[k] = max(longest[k - 1], length[k])
        k = int(np.argmax(length))
        sound = np.zeros(len(idx), dtype=bool)
        while k >= 0:
            sound[k] = True
            k = back[k]
        good = idx[sound]
        for x in idx[~sound]:
            at = np.searchsorted(good, x)
            if 0 < at < len(good) and _kmh(lat, lon, us, good[at - 1 : at], np.array([x]))[0] > lim.kmh and _kmh(lat, lon, us, np.array([x]), good[at : at + 1])[0] > lim.kmh:
                bad[x] = True
    return bad | _excursions(run, us, lat, lon, edges, bad, lim)


def _lone(good: np.ndarray, first: int, last: int, a: int, b: int, us: np.ndarray, lat: np.ndarray, lon: np.ndarray, lim: Limits) -> np.ndarray | None:
    """Which of the places first..last are impossible from a and to b both; None if a and b don't fit or one of them lies well between."""
    if _kmh(lat, lon, us, good[a : a + 1], good[b : b + 1])[0] > lim.kmh:
        return None
    x = good[first : last + 1]
    there, back = _kmh(lat, lon, us, np.full(len(x), good[a]), x) > lim.kmh, _kmh(lat, lon, us, x, np.full(len(x), good[b])) > lim.kmh
    return there & back if (there | back).all() else None


def _excursions(run: np.ndarray, us: np.ndarray, lat: np.ndarray, lon: np.ndarray, edges: np.ndarray, bad: np.ndarray, lim: Limits) -> np.ndarray:
    """Places of whole stretches, of any length, between two impossible steps whose outer sides fit each other.

    The stretches between the impossible steps that are left are taken as sound or not such that the fewest impossible steps stay, then
    the fewest places are left out. A stretch of which a place can be reached from one side and left for the other is no excursion.
    """
    out = np.zeros(len(us), dtype=bool)
    good = np.flatnonzero(~bad)
    left, right = np.searchsorted(good, edges, side="right") - 1, np.searchsorted(good, edges + 1)  # beside each step, as places in good
    ok = (left >= 0) & (right < len(good))
    left, right = left[ok], right[ok]
    ok = (run[good[left]] == run[good[right]]) & (_kmh(lat, lon, us, good[left], good[right]) > lim.kmh)
    left, right = np.unique(left[ok]), np.unique(right[ok])
    for group in np.split(np.arange(len(left)), np.flatnonzero(np.diff(run[good[left]])) + 1):
        if len(group) < 2:
            continue
        own = run[good[left[group[0]]]]
        all_of = good[np.searchsorted(run[good], own) : np.searchsorted(run[good], own, side="right")]
        wide = 111_200 * (np.ptp(lat[all_of]) + min(np.ptp(lon[all_of]), 180.0))  # no two places are further apart
        reach = int(wide * 3.6e6 / lim.kmh)  # after so long any place can be reached
        ends, starts, t = left[group], right[group], us[good]
        m = len(group)
        cost: list[tuple[int, int]] = [(0, 0)]
        came = [0] * (m + 1)
        for j in range(1, m + 1):  # stretch j follows step j - 1
            best, came_from, b = (cost[j - 1][0] + 1, cost[j - 1][1]), j - 1, starts[j - 1]
            for i in range(j - 2, -1, -1):  # stretches i + 1 to j - 1 are left out
                a, first, last = ends[i], starts[i], ends[j - 1]
                k = first + np.searchsorted(t[first : last + 1], t[a] + reach)
                if k <= last and t[k] <= t[b] - reach:
                    break
                this = (cost[i][0], cost[i][1] + int(last - first + 1))
                if this < best and _lone(good, first, last, a, b, us, lat, lon, lim) is not None:
                    best, came_from = this, i
            cost.append(best)
            came[j] = came_from
        j = m
        while j > 0:
            if came[j] < j - 1:
                i = came[j]
                out[good[starts[i] : ends[j - 1] + 1]] = _lone(good, starts[i], ends[j - 1], ends[i], starts[j - 1], us, lat, lon, lim)
            j = came[j]
    return out


def sound_but_for_steps(run: np.ndarray, lat: np.ndarray, lon: np.ndarray, speed: np.ndarray, lim: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the latitudes out of range or held under way, and of the places left for ``false_places``.

    A vehicle whose latitude is held is under way if its longitude drifts or its median speed is above walking pace.
    """
    known = ~np.isnan(lat)
    hit = known & ~((lat >= lim.lat[0]) & (lat <= lim.lat[1]))
    at = np.flatnonzero(known)
    if len(at):
        number = held_runs(run[at], lat[at], lim.held)
        if (number >= 0).any():
            held = number >= 0
            far = _extent_m(np.maximum(number, 0), np.where(held, lat[at], np.nan), lon[at])
            paced = held & ~np.isnan(speed[at])
            pace = group_median(number[paced], speed[at][paced], len(far))
            under_way = (far > lim.drift_m) | (pace > lim.walk_kmh)
            hit[at[held & under_way[np.maximum(number, 0)]]] = True
    return hit, known & ~hit & (np.abs(lon) <= 180)


def false_latitudes(run: np.ndarray, us: np.ndarray, lat: np.ndarray, lon: np.ndarray, speed: np.ndarray, lim: Limits, known: dict[int, np.ndarray] | None = None) -> np.ndarray:
    """Cases of latitude among pings in time order. ``known``: times of the impossible places of runs that are parts of a source."""
    hit, left = sound_but_for_steps(run, lat, lon, speed, lim)
    part = np.isin(run, list(known or ()))
    at = np.flatnonzero(left & ~part)
    hit[at[false_places(run[at], us[at], lat[at], lon[at], lim)]] = True
    for r, times in (known or {}).items():
        hit |= left & (run == r) & np.isin(us, times)
    return hit


def false_speeds(run: np.ndarray, us: np.ndarray, speed: np.ndarray, lim: Limits, lat: np.ndarray | None = None, lon: np.ndarray | None = None, floor: np.ndarray | None = None, bars: dict[int, float] | None = None) -> np.ndarray:
    """Cases of speed; with places, values held while standing are none. ``floor``: what a reading may not be below. ``bars``: see ``spikes``."""
    hit = out_or_held(run, speed, lim, lat, lon, floor)
    at = np.flatnonzero(~np.isnan(speed))
    hit[at] |= spikes(run[at], us[at], speed[at], hit[at], lim, bars)
    return hit


def out_or_held(run: np.ndarray, speed: np.ndarray, lim: Limits, lat: np.ndarray | None, lon: np.ndarray | None, floor: np.ndarray | None) -> np.ndarray:
    """Cases of speed but for the spikes."""
    hit = np.zeros(len(speed), dtype=bool)
    at = np.flatnonzero(~np.isnan(speed))
    if not len(at):
        return hit
    x, g = speed[at], run[at]
    out = (x < lim.low) | (x > lim.high)
    if floor is not None:
        out |= x < floor[at]
    number = held_runs(g, x, lim.held)
    held = (number >= 0) & (x != 0)
    if lat is not None and held.any():
        far = _extent_m(np.maximum(number, 0), np.where(number >= 0, lat[at], np.nan), lon[at])
        held &= far[np.maximum(number, 0)] > lim.moved_m
    hit[at] = out | held
    return hit


def kept_pings(df: DataFrame, payload: tuple[str, ...]) -> DataFrame:
    """One row for each vehicle and time, the first to arrive, by vehicle in time order (see ``series.ordered``).

    Copies that did not arrive together still follow each other here; ``first_of_time`` drops them.
    """
    return ordered(identified(df, payload=payload), held=("latitude", "speed"))


def first_of_time(table: pa.Table, run: np.ndarray, us: np.ndarray) -> tuple[pa.Table, np.ndarray, np.ndarray]:
    """Without later copies of the same run and time."""
    first = np.concatenate([[True], (run[1:] != run[:-1]) | (us[1:] != us[:-1])])
    return (table.filter(pa.array(first)), run[first], us[first]) if not first.all() else (table, run, us)


def of_runs(known: dict, table: pa.Table, run: np.ndarray) -> dict:
    """By run, what is known by source."""
    return {r: known[name] for r, name in zip(np.unique(run).tolist(), names(table, run), strict=True) if name in known} if known else {}


def impossible_times(laid: DataFrame, lim: Limits) -> dict[str, np.ndarray]:
    """Times of the impossible places of each source that is cut into parts, from the whole of it.

    A place is judged by the sound ones around it, however far; so the sound places of a source (24 bytes each) meet in one task.
    """
    cut = of_cut_sources(laid)
    if cut is None:
        return {}

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            table, run, us = first_of_time(table, runs(table), table.column("event_us").to_numpy())
            lat, lon = floats(table, "latitude"), floats(table, "longitude")
            at = np.flatnonzero(sound_but_for_steps(run, lat, lon, floats(table, "speed"), lim)[1])
            yield pa.RecordBatch.from_arrays([table.column("source_key").combine_chunks().take(pa.array(at)), pa.array(us[at]), pa.array(lat[at]), pa.array(lon[at])], ["source_key", "event_us", "lat", "lon"])

    def judge(table: pa.Table) -> pa.Table:
        table = table.sort_by("event_us")
        us = table.column("event_us").to_numpy()
        bad = false_places(np.zeros(len(us), dtype=np.int64), us, floats(table, "lat"), floats(table, "lon"), lim)
        return table.select(["source_key", "event_us"]).filter(pa.array(bad))

    sources = [r[0] for r in cut.select("source_key").distinct().collect()]
    found = cut.mapInArrow(thin, "source_key string, event_us bigint, lat double, lon double").groupBy("source_key").applyInArrow(judge, "source_key string, event_us bigint").toArrow()
    source, us = np.array(found.column("source_key").to_pylist(), dtype=object), found.column("event_us").to_numpy()
    return {name: us[source == name] for name in sources}


BUCKETS = "source_key string, bucket bigint, low double, high double, n bigint, odd bigint, begins bigint"


def buckets(table: pa.Table, run: np.ndarray, us: np.ndarray, x: np.ndarray, out: np.ndarray, lim: Limits) -> Iterator[pa.RecordBatch]:
    """Readings that are not ``out`` by source and size; a bucket is narrower than ``ratio``, so it holds no gap."""
    at = np.flatnonzero(~out & ~np.isnan(x))
    if not len(at):
        return
    r, v = run[at], x[at]
    number = np.floor(np.log(np.maximum(v, lim.least_scale) / lim.least_scale) / (0.5 * np.log(lim.ratio))).astype(np.int64)
    of, size, change = stretches(r, number)
    names_of = np.array(names(table, run), dtype=object)
    _, order = np.unique(run, return_inverse=True)
    label = dict(zip(run.tolist(), order.tolist(), strict=True))
    rows = pa.table({
        "source_key": pa.array(names_of[[label[k] for k in np.concatenate([r, of]).tolist()]], pa.string()), "bucket": np.concatenate([number, size]),
        "low": np.concatenate([v, np.full(len(of), np.inf)]), "high": np.concatenate([v, np.full(len(of), -np.inf)]), "n": np.concatenate([np.ones(len(at), np.int64), np.zeros(len(of), np.int64)]),
        "odd": np.concatenate([odd_ones(r, us[at], v, lim).astype(np.int64), np.zeros(len(of), np.int64)]), "begins": np.concatenate([np.zeros(len(at), np.int64), change.astype(np.int64)]),
    })
    sums = rows.group_by(["source_key", "bucket"]).aggregate([("low", "min"), ("high", "max"), ("n", "sum"), ("odd", "sum"), ("begins", "sum")])
    yield from sums.select(["source_key", "bucket", "low_min", "high_max", "n_sum", "odd_sum", "begins_sum"]).combine_chunks().to_batches()


def whole_bars(laid: DataFrame, sound: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], lim: Limits) -> dict[str, float]:
    """``spike_bars`` of each source that is cut into parts, from the ``buckets`` of all of them (some 20 rows a source)."""
    cut = of_cut_sources(laid)
    if cut is None:
        return {}
    sums = cut.mapInArrow(sound, BUCKETS).groupBy("source_key", "bucket").agg(F.min("low"), F.max("high"), F.sum("n"), F.sum("odd"), F.sum("begins")).toArrow()
    source, group = np.unique(np.array(sums.column(0).to_pylist(), dtype=str), return_inverse=True)
    by = np.lexsort((sums.column(1).to_numpy(), group))
    return dict(zip(source.tolist(), spike_bars(group[by], *(c.to_numpy()[by].astype(float) for c in sums.columns[2:]), len(source), lim).tolist(), strict=True))


def false_positions(df: DataFrame, lim: Limits = Limits()) -> DataFrame:
    """``row_key``, ``false_speed``, ``false_latitude`` of the kept rows of vehicle positions that are a case of either.

    Nulls: rows without vehicle or time are no kept rows; null speeds and places are no readings and interrupt nothing. Ties
    in time are copies, of which the first to arrive counts. An empty input gives no rows; other columns are ignored.
    """

    laid = kept_pings(df, ("latitude", "longitude", "speed"))
    times = impossible_times(laid, lim)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        for table in blocks(batches):
            table, run, us = first_of_time(table, runs(table), table.column("event_us").to_numpy())
            lat, lon, speed = floats(table, "latitude"), floats(table, "longitude"), floats(table, "speed")
            place = false_latitudes(run, us, lat, lon, speed, lim, of_runs(times, table, run))
            yield table, run, speed, place, np.where(place, np.nan, lat), lon

    def sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, run, speed, _, lat, lon in judged(batches):
            yield from buckets(table, run, table.column("event_us").to_numpy(), speed, out_or_held(run, speed, lim, lat, lon, None), lim)

    bars = whole_bars(laid, sound, lim)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, run, speed, place, lat, lon in judged(batches):
            pace = false_speeds(run, table.column("event_us").to_numpy(), speed, lim, lat, lon, bars=of_runs(bars, table, run))
            at = np.flatnonzero(place | pace)
            yield pa.RecordBatch.from_arrays([table.column("arrival").combine_chunks().take(pa.array(at)), pa.array(pace[at]), pa.array(place[at])], ["row_key", "false_speed", "false_latitude"])

    return laid.mapInArrow(flag, "row_key bigint, false_speed boolean, false_latitude boolean")


def false_line_speeds(df: DataFrame, source: str = "line_id", time: str = "timestamp", order: str = "id", value: str = "max_speed", floor: str = "avg_speed", lim: Limits = Limits(), hot_rows: int = HOT_ROWS) -> DataFrame:
    """``row_key`` of the rows whose ``value`` is a case for its line.

    Rows of one line and time all count, in the order of ``order``. A row without line or time is judged alone (range and floor).
    """
    rows = df.where(F.col(order).isNotNull()).select(
        F.coalesce(F.when(F.col(time).isNotNull(), F.col(source).cast("string")), F.concat(F.lit("~"), F.col(order).cast("string"))).alias("source_key"),
        F.coalesce(micros(time), F.lit(0)).alias("event_us"), F.col(order).cast("bigint").alias("arrival"), F.col(value).cast("double").alias("v"), F.col(floor).cast("double").alias("f"),
    )
    laid = by_part(with_parts(rows, hot_rows, held=("v",)))

    def sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            bar, v, run = floats(table, "f"), floats(table, "v"), runs(table)
            yield from buckets(table, run, table.column("event_us").to_numpy(), v, out_or_held(run, v, lim, None, None, np.where(np.isnan(bar), -np.inf, bar)), lim)

    bars = whole_bars(laid, sound, lim)

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            bar, run = floats(table, "f"), runs(table)
            hit = false_speeds(run, table.column("event_us").to_numpy(), floats(table, "v"), lim, floor=np.where(np.isnan(bar), -np.inf, bar), bars=of_runs(bars, table, run))
            yield pa.RecordBatch.from_arrays([table.column("arrival").combine_chunks().filter(pa.array(hit))], ["row_key"])

    return laid.mapInArrow(flag, "row_key bigint")
