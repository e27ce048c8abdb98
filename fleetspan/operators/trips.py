"""Stops and trips from location pings.

Pings are split at silences; each stretch is smoothed with a Kalman filter and smoother (constant velocity, position and speed of
both axes), decoded into moving and stationary by a two-state hidden Markov model over the smoothed speeds (Viterbi), and the
stationary segments become stops after an exact check: all pings within ``radius_m`` of the place (the median
position of the segment), extended to the longest such series, at least ``stop_seconds`` long. All steps run over many
stretches at once: step t of every stretch is one array operation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetspan.functions.clock import MICROS
from fleetspan.functions.geo import EARTH_M, metres
from fleetspan.operators.series import blocks, floats, runs
from fleetspan.operators.spikes import Limits, false_latitudes, first_of_time, impossible_times, kept_pings, of_runs


@dataclass(frozen=True)
class TripRules:
    """Silence that ends what is under way, stop radius and least duration, least trip; noise of positions and of the motion; the two states."""

    silence_s: int = 1200
    radius_m: float = 50.0
    stop_seconds: int = 300
    trip_m: float = 500.0
    noise_m: float = 8.0
    drive: float = 0.5
    still_ms: float = 0.6
    moving_ms: float = 5.0
    switch: float = 0.1


class Stretches:
    """Stretches of pings, longest first, so that step t concerns a prefix of them."""

    def __init__(self, start: np.ndarray, length: np.ndarray):
        by = np.argsort(-length, kind="stable")
        self.start, self.length = start[by], length[by]

    def steps(self) -> Iterator[np.ndarray]:
        """Row numbers at step 0, 1, ... of the stretches that are that long."""
        active = np.searchsorted(-self.length, -np.arange(self.length[0]), side="left")
        for t, k in enumerate(active):
            yield self.start[:k] + t


def smoothed_speed(st: Stretches, sec: np.ndarray, x: np.ndarray, y: np.ndarray, rules: TripRules) -> np.ndarray:
    """Metres per second of the smoothed motion; a lone ping has speed 0."""
    n, r, q = len(sec), rules.noise_m**2, rules.drive
    pos = np.stack([x, y])
    m, v = np.zeros((2, n)), np.zeros((2, n))  # filtered position and velocity
    mp, vp = np.zeros((2, n)), np.zeros((2, n))  # predicted
    a, b, c = np.full(n, r), np.zeros(n), np.full(n, 100.0)  # filtered covariance
    ap, bp, cp = np.zeros(n), np.zeros(n), np.zeros(n)
    order = list(st.steps())
    first = order[0]
    m[:, first] = pos[:, first]
    for idx in order[1:]:
        back = idx - 1
        dt = sec[idx] - sec[back]
        pv = v[:, back]
        pm = m[:, back] + pv * dt
        c0, b0 = c[back], b[back]
        pa_ = a[back] + dt * (2 * b0 + dt * c0) + q * dt**3 / 3
        pb = b0 + dt * c0 + q * dt**2 / 2
        pc = c0 + q * dt
        s = pa_ + r
        k1, k2 = pa_ / s, pb / s
        e = pos[:, idx] - pm
        mp[:, idx], vp[:, idx], ap[idx], bp[idx], cp[idx] = pm, pv, pa_, pb, pc
        m[:, idx], v[:, idx] = pm + k1 * e, pv + k2 * e
        a[idx], b[idx], c[idx] = (1 - k1) * pa_, (1 - k1) * pb, pc - k2 * pb
    for idx in reversed(order[1:]):  # m and v become the smoothed ones
        back = idx - 1
        dt = sec[idx] - sec[back]
        det = ap[idx] * cp[idx] - bp[idx] ** 2
        f11, f12 = a[back] + dt * b[back], b[back]
        f21, f22 = b[back] + dt * c[back], c[back]
        g11, g12 = (f11 * cp[idx] - f12 * bp[idx]) / det, (f12 * ap[idx] - f11 * bp[idx]) / det
        g21, g22 = (f21 * cp[idx] - f22 * bp[idx]) / det, (f22 * ap[idx] - f21 * bp[idx]) / det
        dm, dv = m[:, idx] - mp[:, idx], v[:, idx] - vp[:, idx]
        m[:, back] += g11 * dm + g12 * dv
        v[:, back] += g21 * dm + g22 * dv
    return np.hypot(v[0], v[1])


def stationary(st: Stretches, speed: np.ndarray, step_ms: np.ndarray, step_s: np.ndarray, rules: TripRules) -> np.ndarray:
    """Most likely state of each ping, True for stationary.

    What is observed is the smoothed speed or, if less, the raw speed of the slower adjacent step: half-normal when stationary,
    exponential when moving. A step of several minutes counts as that many observations (1 to 8).
    """
    n = len(speed)
    seen, weight = np.minimum(speed, step_ms), np.clip(step_s / 60, 1, 8)
    cost = np.empty((2, n))
    cost[0] = weight * (seen**2 / (2 * rules.still_ms**2) + np.log(rules.still_ms * np.sqrt(np.pi / 2)))
    cost[1] = weight * (seen / rules.moving_ms + np.log(rules.moving_ms))
    stay, move = -np.log(1 - rules.switch), -np.log(rules.switch)
    total, came = cost.copy(), np.zeros((2, n), dtype=bool)
    order = list(st.steps())
    for idx in order[1:]:
        back = idx - 1
        for s in (0, 1):
            same, other = total[s, back] + stay, total[1 - s, back] + move
            came[s, idx] = other < same
            total[s, idx] = cost[s, idx] + np.minimum(same, other)
    state = np.zeros(n, dtype=np.int8)
    end = st.start + st.length - 1
    state[end] = total[1, end] < total[0, end]
    for idx in reversed(order[1:]):
        state[idx - 1] = np.where(came[state[idx], idx], 1 - state[idx], state[idx])
    return state == 0


def _seeds(i: int, j: int, lo: int, hi: int, lat: np.ndarray, lon: np.ndarray, us: np.ndarray, rules: TripRules) -> list[tuple[int, int]]:
    """Places within a stationary segment: the segment itself if one place holds it all, else the series in it that stay at one place long enough.

    A segment can hold more than one place, or slow driving besides one.
    """
    near = metres(np.median(lat[i : j + 1]), np.median(lon[i : j + 1]), lat[i : j + 1], lon[i : j + 1]) <= rules.radius_m
    if near.all():
        return [(i, j)]
    out, k, last = [], max(lo, i - 2), min(hi, j + 2)
    while k < last:
        y, x, n, m = float(lat[k]), float(lon[k]), 1, k
        while m < last and metres(y / n, x / n, lat[m + 1], lon[m + 1]) <= rules.radius_m:
            m, n = m + 1, n + 1
            y, x = y + float(lat[m]), x + float(lon[m])
        if us[m] - us[k] >= rules.stop_seconds * MICROS:
            out.append((k, m))
            k = m
        k += 1
    return out


def _stops_of(lo: int, hi: int, still: np.ndarray, lat: np.ndarray, lon: np.ndarray, us: np.ndarray, rules: TripRules) -> list[tuple[int, int]]:
    """Stops (first and last row) of the stretch lo..hi, in order, apart from each other."""
    out: list[tuple[int, int]] = []
    flag = still[lo : hi + 1].astype(np.int8)
    edge = np.diff(np.concatenate([[0], flag, [0]]))
    floor = lo
    segments = zip((lo + np.flatnonzero(edge == 1)).tolist(), (lo + np.flatnonzero(edge == -1) - 1).tolist(), strict=True)
    for i, j in (seed for a, b in segments for seed in _seeds(a, b, lo, hi, lat, lon, us, rules)):
        i = max(i, floor)
        if i > j:
            continue
        tried: set[tuple[int, int]] = set()
        while (i, j) not in tried:  # until the series is that around its own median, or comes back to one it was
            tried.add((i, j))
            la, lo_ = np.median(lat[i : j + 1]), np.median(lon[i : j + 1])
            a, b = max(floor, i - 400), min(hi, j + 400)
            near = metres(la, lo_, lat[a : b + 1], lon[a : b + 1]) <= rules.radius_m
            inner = np.flatnonzero(near[i - a : j - a + 1])
            if not len(inner):
                i, j = 1, 0
                break
            # the longest series of near pings that meets the segment
            e = np.diff(np.concatenate([[0], near.astype(np.int8), [0]]))
            s0, s1 = a + np.flatnonzero(e == 1), a + np.flatnonzero(e == -1) - 1
            meets = np.flatnonzero((s0 <= j) & (s1 >= i))
            best = meets[np.argmax(us[s1[meets]] - us[s0[meets]])]
            ni, nj = int(s0[best]), int(s1[best])
            while ni == a and a > floor:  # the series reaches beyond the part that was looked at
                a = max(floor, a - 400)
                more = metres(la, lo_, lat[a:ni], lon[a:ni]) <= rules.radius_m
                ni = a if more.all() else a + len(more) - int(np.argmin(more[::-1]))
            while nj == b and b < hi:
                b = min(hi, b + 400)
                more = metres(la, lo_, lat[nj + 1 : b + 1], lon[nj + 1 : b + 1]) <= rules.radius_m
                nj = b if more.all() else nj + int(np.argmin(more))
            if (ni, nj) == (i, j):
                break
            i, j = ni, nj
        if i <= j and us[j] - us[i] >= rules.stop_seconds * MICROS:
            out.append((int(i), int(j)))
            floor = int(j) + 1
    return out


def segments_of(run: np.ndarray, us: np.ndarray, lat: np.ndarray, lon: np.ndarray, rules: TripRules) -> list[tuple[bool, int, int, float]]:
    """(is a stop, first row, last row, metres) of all stops and trips of pings that are sorted by run and time."""
    n = len(us)
    if not n:
        return []
    gap = np.diff(us)
    cut = np.concatenate([[True], (run[1:] != run[:-1]) | (gap >= rules.silence_s * MICROS)])
    start = np.flatnonzero(cut)
    length = np.diff(np.concatenate([start, [n]]))
    number = np.cumsum(cut) - 1
    origin = start[number]
    x = np.radians(lon - lon[origin]) * np.cos(np.radians(lat[origin])) * EARTH_M
    y = np.radians(lat - lat[origin]) * EARTH_M
    sec = (us - us[origin]) / 1e6
    st = Stretches(start, length)
    leg = np.concatenate([metres(lat[:-1], lon[:-1], lat[1:], lon[1:]), [0.0]])  # from each ping to the next
    pace = np.concatenate([leg[:-1] / np.maximum(gap / 1e6, 1e-3), [np.inf]]) if n > 1 else np.array([np.inf])
    pace[np.concatenate([start[1:] - 1, [n - 1]])] = np.inf
    before = np.concatenate([[np.inf], pace[:-1]])
    before[start] = np.inf
    lasts = np.concatenate([gap / 1e6, [0.0]])
    slow_s = np.where(before < pace, np.concatenate([[0.0], lasts[:-1]]), lasts)
    still = stationary(st, smoothed_speed(st, sec, x, y, rules), np.minimum(pace, before), slow_s, rules)
    so_far = np.concatenate([[0.0], np.cumsum(leg)])
    out = []
    for lo, hi in zip(start, start + length - 1, strict=True):
        lo, hi = int(lo), int(hi)
        at = lo
        for i, j in _stops_of(lo, hi, still, lat, lon, us, rules) if still[lo : hi + 1].any() else []:
            out.append((False, at, i, so_far[i] - so_far[at]))
            out.append((True, i, j, so_far[j] - so_far[i]))
            at = j
        out.append((False, at, hi, so_far[hi] - so_far[at]))
    return [s for s in out if s[0] or (s[3] >= rules.trip_m and s[2] > s[1])]


SEGMENTS = "vehicle_id string, is_stop boolean, started_us bigint, ended_us bigint, seconds double, metres double, pings int, latitude double, longitude double"


def stops_and_trips(df: DataFrame, rules: TripRules = TripRules(), lim: Limits = Limits()) -> DataFrame:
    """Stops and trips of each vehicle: start, end, duration, distance, pings, and for stops the place.

    Usable are the first-arrived rows of each vehicle and time with both coordinates whose latitude is no case of
    ``spikes.false_latitudes``. Nulls: rows without vehicle, time or a coordinate are not usable. Ties in time are copies. A
    vehicle with one ping has neither stop nor trip. An empty input gives no rows; other columns are ignored. A trip shares its first and last ping with the stops at its ends.
    """

    laid = kept_pings(df, ("latitude", "longitude", "speed"))
    times = impossible_times(laid, lim)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches):
            table, run, us = first_of_time(table, runs(table), table.column("event_us").to_numpy())
            lat, lon = floats(table, "latitude"), floats(table, "longitude")
            ok = ~false_latitudes(run, us, lat, lon, floats(table, "speed"), lim, of_runs(times, table, run)) & ~np.isnan(lat) & ~np.isnan(lon) & (np.abs(lon) <= 180)
            name = table.column("source_key").combine_chunks().filter(pa.array(ok))
            run, us, lat, lon = run[ok], us[ok], lat[ok], lon[ok]
            found = segments_of(run, us, lat, lon, rules)
            if not found:
                continue
            stop = np.array([s[0] for s in found])
            i, j = np.array([s[1] for s in found]), np.array([s[2] for s in found])
            place = [(float(np.median(lat[a : b + 1])), float(np.median(lon[a : b + 1]))) if s else (None, None) for s, a, b in zip(stop, i, j, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    name.take(pa.array(i)), pa.array(stop), pa.array(us[i]), pa.array(us[j]), pa.array((us[j] - us[i]) / 1e6), pa.array([s[3] for s in found], pa.float64()),
                    pa.array((j - i + 1).astype(np.int32)), pa.array([p[0] for p in place], pa.float64()), pa.array([p[1] for p in place], pa.float64()),
                ],
                ["vehicle_id", "is_stop", "started_us", "ended_us", "seconds", "metres", "pings", "latitude", "longitude"],
            )

    return laid.mapInArrow(decode, SEGMENTS)
