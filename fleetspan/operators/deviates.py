"""Robust seasonal-trend decomposition of many sources at once, and the generalised extreme studentised deviate test of what is left.

The trend is the median of a reading's period (two hours), or of its day or source where a period has too few readings; the season is
the median, over the days, of what is left in each hour of the day. Both are medians, so spikes do not bend them as long as most readings
of a period are sound. The test takes away the largest residual, one by one, and studentises each by the median and the median deviation of
those that are left; all residuals up to the last one beyond its limit are outliers. All sources are handled by the same array operations.
"""

from __future__ import annotations

import numpy as np

HOUR = 3_600_000_000
DAY = 24 * HOUR


def group_median(group: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """Median of x in each group 0..size-1 (NaN where empty)."""
    out = np.full(size, np.nan)
    if len(x):
        by = np.lexsort((x, group))
        g, v = group[by], x[by]
        start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        n = np.diff(np.concatenate([start, [len(g)]]))
        out[g[start]] = (v[start + (n - 1) // 2] + v[start + n // 2]) / 2
    return out


def _level(run: np.ndarray, span: np.ndarray, x: np.ndarray, least: int, rest: np.ndarray) -> np.ndarray:
    """Median of the readings of each run and span; ``rest`` where there are fewer than ``least``. Rows are sorted by run and span."""
    new = np.concatenate([[True], (run[1:] != run[:-1]) | (span[1:] != span[:-1])])
    group = np.cumsum(new) - 1
    return np.where(np.bincount(group)[group] >= least, group_median(group, x, group[-1] + 1)[group], rest)


def residuals(run: np.ndarray, us: np.ndarray, x: np.ndarray, period_us: int = 2 * HOUR, least: int = 8) -> np.ndarray:
    """What trend and season leave of each reading; rows are sorted by run and time."""
    if not len(x):
        return np.zeros(0)
    size = int(run[-1]) + 1
    whole = group_median(run, x, size)[run]
    trend = _level(run, us // period_us, x, least, _level(run, us // DAY, x, least, whole))
    left = x - trend
    slot = run * 24 + us % DAY // HOUR
    season = np.where(np.bincount(slot, minlength=size * 24)[slot] >= least, group_median(slot, left, size * 24)[slot], 0.0)
    return left - season


def normal_quantile(tail: np.ndarray) -> np.ndarray:
    """Quantile of the normal law above which the probability is ``tail`` (at most a half), by a rational approximation."""
    z = np.sqrt(np.maximum(-2 * np.log(np.maximum(tail, 1e-300)), 0.0))
    return np.maximum(z - (2.515517 + 0.802853 * z + 0.010328 * z * z) / (1 + 1.432788 * z + 0.189269 * z * z + 0.001308 * z**3), 0.0)


def deviate_limit(n: np.ndarray, level: float) -> np.ndarray:
    """Limit of the largest of ``n`` studentised deviates; infinite for fewer than three.

    ``level`` is the chance of a sound reading to be beyond it. It is not divided by the number of readings, so the limit does not
    grow with the source: what is an outlier of a hundred readings is one of a million.
    """
    ok = n >= 3
    m = np.where(ok, n, 3).astype(float)
    df = np.maximum(m - 2, 1)
    z = normal_quantile(np.full(len(m), level))
    t = z + (z**3 + z) / (4 * df) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * df**2)
    return np.where(ok, (m - 1) * t / np.sqrt((df + t * t) * m), np.inf)


def _kth_deviation(v: np.ndarray, start: np.ndarray, n: np.ndarray, mid: np.ndarray) -> np.ndarray:
    """Median of |v - mid| over v[start : start + n], sorted ascending, for each (start, n, mid) at once.

    Below and above ``mid`` the deviations are two sorted lists; a binary search finds how many of the lower list are among the smallest half.
    """
    below = start + _searched(v, start, n, mid)  # first place not below mid
    want = (n + 1) // 2
    lo = np.maximum(0, want - (start + n - below))
    hi = np.minimum(want, below - start)
    top = len(v) - 1
    while (lo < hi).any():
        k = (lo + hi) // 2  # k of the lower list: is the (k+1)-th lower one smaller than the last upper one taken?
        a = mid - v[np.clip(below - 1 - k, 0, top)]
        b = v[np.clip(below + want - k - 1, 0, top)] - mid
        more = (lo < hi) & (a < b)
        lo, hi = np.where(more, k + 1, lo), np.where(more | (lo >= hi), hi, k)
    low = np.where(lo > 0, mid - v[np.clip(below - lo, 0, top)], 0.0)
    high = np.where(want - lo > 0, v[np.clip(below + want - lo - 1, 0, top)] - mid, 0.0)
    return np.maximum(low, high)


def _searched(v: np.ndarray, start: np.ndarray, n: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Number of values below x in each v[start : start + n]."""
    lo, hi = np.zeros_like(n), n.copy()
    while (lo < hi).any():
        k = (lo + hi) // 2
        less = (lo < hi) & (v[np.minimum(start + k, len(v) - 1)] < x)
        lo, hi = np.where(less, k + 1, lo), np.where(less | (lo >= hi), hi, k)
    return lo


def outliers(run: np.ndarray, r: np.ndarray, level: float, most: float, least_scale: float) -> np.ndarray:
    """Mask of the residuals that the one-sided test calls outliers: at most the share ``most`` of a run, rounded up.

    A median deviation below ``least_scale`` counts as that, so a source that hardly varies has no outliers by rounding.
    """
    out = np.zeros(len(r), dtype=bool)
    if not len(r):
        return out
    by = np.lexsort((r, run))
    v = r[by]
    total = np.bincount(run)
    begin = np.cumsum(total) - total
    tries = np.minimum(np.ceil(most * total).astype(np.int64), total)
    g = np.repeat(np.arange(len(total)), tries)
    i = np.arange(len(g)) - np.repeat(np.cumsum(tries) - tries, tries)  # taken away before
    n, start = total[g] - i, begin[g]
    mid = (v[start + (n - 1) // 2] + v[start + n // 2]) / 2
    scale = np.maximum(1.4826 * _kth_deviation(v, start, n, mid), least_scale)
    beyond = (v[start + n - 1] - mid) / scale > deviate_limit(n, level)
    count = np.zeros(len(total), dtype=np.int64)
    np.maximum.at(count, g[beyond], i[beyond] + 1)
    rank = np.arange(len(v)) - begin[run[by]]
    out[by] = rank >= (total - count)[run[by]]
    return out
