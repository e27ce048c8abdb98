from datetime import datetime, timedelta

import numpy as np
import pytest

from fleetspan.operators import series
from fleetspan.operators.deviates import DAY, HOUR, deviate_limit, group_median, outliers, residuals
from fleetspan.operators.spikes import Limits, _kmh, false_line_speeds, false_places, false_positions, held_runs, kept_pings
from fleetspan.operators.spikes import false_speeds as false_speeds_at
from fleetspan.operators.trips import stops_and_trips

T0 = datetime(2018, 1, 1, 5)
DDL = "row_id bigint, vehicle_id string, timestamp timestamp, latitude double, longitude double, speed double, part string, source_key string"


def false_speeds(run, x, lim):
    """Readings 45 seconds apart."""
    return false_speeds_at(run, np.arange(len(x)) * 45_000_000, x, lim)


def drive(n, vehicle="1", seed=0, start=0):
    """A bus that drives north-east with speeds up to 40."""
    r = np.random.default_rng(seed)
    return [[start + i, vehicle, T0 + timedelta(seconds=45 * i), -23.9 + 0.0008 * i, -46.9 + 0.0008 * i, float(np.round(r.uniform(5, 40), 3))] for i in range(n)]


def found(spark, rows, lim=Limits()):
    df = spark.createDataFrame([(*r, "p", "q") for r in rows], DDL)
    out = false_positions(df, lim).collect()
    assert len({r["row_key"] for r in out}) == len(out)
    return sorted(r["row_key"] for r in out if r["false_speed"]), sorted(r["row_key"] for r in out if r["false_latitude"])


def test_speed_cases(spark):
    rows = drive(200)
    rows[10][5], rows[20][5], rows[30][5] = -1.0, 251.0, 90.0
    for i in range(50, 58):
        rows[i][5] = 12.5
    for i in range(80, 87):
        rows[i][5] = 13.5  # seven are too few
    rows[100][5] = None
    assert found(spark, rows) == ([10, 20, 30, *range(50, 58)], [])


def test_nulls_inside_a_held_run_do_not_break_it(spark):
    rows = drive(100)
    for i in range(40, 49):
        rows[i][5] = 12.5
    rows[44][5] = None
    assert found(spark, rows)[0] == [40, 41, 42, 43, 45, 46, 47, 48]


def test_standing_still_is_no_case(spark):
    rows = drive(100)
    for i in range(40, 60):
        rows[i][3], rows[i][4], rows[i][5] = rows[40][3], rows[40][4], 0.0
    for i in range(60, 100):
        rows[i][3] -= 0.0008 * 20
        rows[i][4] -= 0.0008 * 20
    assert found(spark, rows) == ([], [])


def test_latitude_cases(spark):
    rows = drive(200)
    rows[5][3] = -22.9
    rows[50][3] = -23.2  # needs over 120 km/h both ways
    rows[60][3], rows[61][3] = -23.1, -23.7  # two in a row, apart from each other
    for i in range(100, 108):
        rows[i][3] = rows[100][3]
    rows[150][3] = None
    assert found(spark, rows) == ([], [5, 50, 60, 61, *range(100, 108)])


def test_copies_nulls_and_empty(spark):
    rows = drive(50)
    rows += [[900, "1", rows[10][2], -10.0, 0.0, 500.0], [901, None, T0, -10.0, 0.0, 500.0], [902, "1", None, -10.0, 0.0, 500.0], [903, "2", T0, None, None, None], [904, "3", T0, -10.0, None, 500.0]]
    assert found(spark, rows) == ([904], [904])
    assert found(spark, []) == ([], [])


def test_usual_speeds_of_a_fast_vehicle_are_no_case(spark):
    fast = [[*r[:5], r[5] * 2.4] for r in drive(200, "2", 1, 1000)]
    assert found(spark, drive(200) + fast) == ([], [])


def test_lines(spark):
    r = np.random.default_rng(2)
    rows = [[i, "9", T0 + timedelta(minutes=10 * i), float(np.round(r.uniform(20, 40), 2)), 10.0] for i in range(150)]
    rows[3][3], rows[5][3], rows[7][3] = 300.0, 9.0, 95.0
    for i in range(20, 28):
        rows[i][3] = 33.0
    rows[60][3], rows[61][4] = None, None
    rows += [[500, None, T0, 300.0, 1.0], [501, None, T0, 30.0, 1.0], [502, "9", None, 5.0, 6.0]]
    df = spark.createDataFrame([(*x, "p") for x in rows], "id bigint, line_id string, timestamp timestamp, max_speed double, avg_speed double, source_key string")
    assert sorted(x[0] for x in false_line_speeds(df).collect()) == [3, 5, 7, *range(20, 28), 500, 502]
    assert false_line_speeds(df.limit(0)).count() == 0


def test_small_parts():
    g = np.array([0, 0, 1, 1, 1, 3])
    assert np.allclose(group_median(g, np.array([1.0, 3.0, 5.0, 1.0, 9.0, 2.0]), 4), [2, 5, np.nan, 2], equal_nan=True)
    assert held_runs(np.zeros(5, int), np.array([1.0, 1, 1, 2, 2]), 3).tolist() == [0, 0, 0, -1, -1]
    # published critical values for 54 readings at 0.05
    got = [deviate_limit(np.array([n]), 0.05 / (2 * n))[0] for n in (54, 50, 45)]
    assert np.allclose(got, [3.159, 3.120, 3.068], atol=0.03)
    assert not false_places(np.zeros(2, int), np.array([0, 1]), np.array([0.0, 50.0]), np.zeros(2), Limits()).any()


def test_a_spike_is_found_whatever_the_number_of_readings():
    lim = Limits()
    for n in (500, 5_000, 100_000):
        x = np.random.default_rng(n).uniform(5, 40, n)
        x[n // 2] = 1.9 * 40
        x[n // 3] = 1.7 * 40  # below the ratio: sound, though it lifts the bar
        assert not false_speeds(np.zeros(n, int), x, lim).any()
        x[n // 3] = 40.0
        assert np.flatnonzero(false_speeds(np.zeros(n, int), x, lim)).tolist() == [n // 2]


def broken_drive():
    """Seven drives with silences between; held values, false places and a spike at the cuts."""
    rows = []
    for k in range(7):
        part = drive(40, seed=k, start=1000 * k)
        for r in part:
            r[2] += timedelta(hours=6 * k)
        rows += part
    for i in (*range(36, 40), *range(40, 44)):
        rows[i][5] = 12.5  # 4 + 4
    for i in (*range(116, 120), *range(120, 124)):
        rows[i][3] = -23.85  # 4 + 4, longitude drifting
    for i, r in enumerate(rows):
        if i >= 240:
            r[5] = r[5] / 3  # 1.8 times the top of this part, not of the vehicle
    rows[250][5] = 38.0
    rows[160][2], rows[160][4] = rows[159][2] + timedelta(seconds=1300), 10.0  # first of its part, impossible both ways
    rows[199][4] = 10.0  # last of its part
    for r in rows[200:240]:
        r[2] = rows[199][2] + timedelta(seconds=1300 + 45 * (r[0] - 5000))
    return rows


@pytest.mark.parametrize("hot", [30, 90])
def test_a_hot_vehicle_has_the_cases_of_the_uncut_one(spark, hot, monkeypatch):
    rows = broken_drive()
    want = found(spark, rows)
    assert {4000, 4039} <= set(want[1]) and {36, 1003} <= set(want[0]) and 6010 not in want[0] and {2036, 3003} <= set(want[1])
    df = spark.createDataFrame([(*r, "p", "q") for r in rows], DDL)
    trips = sorted(map(tuple, stops_and_trips(df).collect()))
    monkeypatch.setattr(series.ordered, "__defaults__", (hot, True))
    assert kept_pings(df, ("latitude", "longitude", "speed")).select("part").distinct().count() > 1
    assert found(spark, rows) == want
    assert sorted(map(tuple, stops_and_trips(df).collect())) == trips


def test_a_hot_line_has_the_cases_of_the_uncut_one(spark):
    rows = [(r[0], "9", r[2], r[5], 1.0) for r in broken_drive()]
    df = spark.createDataFrame(rows, "id bigint, line_id string, timestamp timestamp, max_speed double, avg_speed double")
    want = sorted(x[0] for x in false_line_speeds(df).collect())
    assert 36 in want and 6010 not in want
    assert sorted(x[0] for x in false_line_speeds(df, hot_rows=30).collect()) == want


def test_an_excursion_of_any_length_is_impossible():
    n, lim = 400, Limits()
    us, lat, lon = np.arange(n) * 45_000_000, np.full(n, -23.5) + 1e-4 * np.arange(n), np.full(n, -46.6)
    for length in (1, 2, 5, 9, 80):
        away = lon.copy()
        away[100 : 100 + length] += 3.0  # 300 km
        assert np.flatnonzero(false_places(np.zeros(n, int), us, lat, away, lim)).tolist() == list(range(100, 100 + length))
    away = lon.copy()
    away[100:] += 3.0  # a step for good
    assert not false_places(np.zeros(n, int), us, lat, away, lim).any()
    away[100:390] -= 1.5
    away[390:] -= 3.0  # 150 km: in more than three hours it can drive there and back
    assert not false_places(np.zeros(n, int), us, lat, away, lim).any()
    two = np.concatenate([lon, lon])
    two[100:107] += 3.0
    two[n + 50 : n + 70] += 3.0
    two[n + 60] -= 9.0  # a lone place inside the excursion
    got = np.flatnonzero(false_places(np.repeat([0, 1], n), np.tile(us, 2), np.tile(lat, 2), two, lim)).tolist()
    assert got == [*range(100, 107), *range(n + 50, n + 70)]


def test_a_crowd_of_false_places_longer_than_64():
    n = 300
    us, lat, lon = np.arange(n) * 45_000_000, np.full(n, -23.5), np.full(n, -46.6)
    lon[100:180] += 20 + 10 * (np.arange(80) % 7)  # each far from the next
    assert np.flatnonzero(false_places(np.zeros(n, int), us, lat, lon, Limits())).tolist() == list(range(100, 180))


def test_a_spike_alone_on_its_day_is_found(spark):
    rows = drive(200)
    rows += [[900, "1", T0 + timedelta(days=900), None, None, 95.0]]
    assert found(spark, rows)[0] == [900]


def test_a_short_source_can_have_a_spike_and_a_tenth_is_the_most():
    lim = Limits()
    for n in (4, 5, 9):
        x = np.linspace(20, 40, n)
        x[1] = 90.0
        assert np.flatnonzero(false_speeds(np.zeros(n, int), x, lim)).tolist() == [1]
    assert not false_speeds(np.zeros(3, int), np.array([20.0, 90, 25]), lim).any()
    x = np.linspace(20, 40, 100)
    x[5:15] = 90.0 + np.arange(10)
    assert np.flatnonzero(false_speeds(np.zeros(100, int), x, lim)).tolist() == list(range(5, 15))
    x[15] = 90.0
    assert not false_speeds(np.zeros(100, int), x, lim).any()


def test_the_deviate_test_equals_one_that_starts_anew_after_each_removal():
    r = np.random.default_rng(5)
    for n in (1, 2, 3, 4, 7, 30, 90):
        x = np.round(r.normal(0, 3, n), 1) + np.where(r.random(n) < 0.1, 40, 0)
        left, count = list(x), 0
        for i in range(int(np.ceil(0.5 * n))):
            mid = np.median(left)
            scale = max(1.4826 * sorted(abs(np.array(left) - mid))[(len(left) + 1) // 2 - 1], 1.0)
            if (max(left) - mid) / scale > deviate_limit(np.array([len(left)]), 0.05)[0]:
                count = i + 1
            left.remove(max(left))
        want = np.sort(x)[n - count :].tolist()
        got = outliers(np.concatenate([np.zeros(n, int), np.ones(5, int)]), np.concatenate([x, np.zeros(5)]), 0.05, 0.5, 1.0)
        assert sorted(np.concatenate([x, np.zeros(5)])[got].tolist()) == want


def test_trend_and_season_are_taken_out():
    us = np.arange(0, 20 * DAY, 300_000_000)
    x = 20.0 + 10 * (us % DAY // HOUR == 8) + 15 * (us // DAY % 7 == 3)
    left = residuals(np.zeros(len(us), int), us, x)
    assert (np.abs(left) <= 1e-9).mean() > 0.97
    x[1000] += 50
    assert residuals(np.zeros(len(us), int), us, x)[1000] > 35


def longest_chain(us, lat, lon, lim):
    """By force: the longest chain of possible steps over all places; the others are false if impossible from and to their sound neighbours."""
    n = len(us)
    length, back = np.ones(n, int), np.full(n, -1)
    for k in range(1, n):
        ok = np.flatnonzero(_kmh(lat, lon, us, np.arange(k), np.full(k, k)) <= lim.kmh)
        if len(ok) and length[ok].max() + 1 > length[k]:
            back[k] = ok[np.argmax(length[ok])]
            length[k] = length[back[k]] + 1
    k, sound = int(np.argmax(length)), []
    while k >= 0:
        sound.append(k)
        k = back[k]
    good, out = np.array(sound[::-1]), []
    for x in sorted(set(range(n)) - set(sound)):
        at = np.searchsorted(good, x)
        if 0 < at < len(good) and all(_kmh(lat, lon, us, np.array([a]), np.array([b]))[0] > lim.kmh for a, b in ((good[at - 1], x), (x, good[at]))):
            out.append(x)
    return out


@pytest.mark.parametrize("second", [1, 45])
def test_false_places_equal_the_longest_chain_by_force(second):
    r, lim = np.random.default_rng(second), Limits()
    for trial in range(25):
        n = 480
        us = np.cumsum(r.integers(1, 3, n)) * second * 1_000_000
        lat, lon = -23.5 + 6e-6 * us / 1e6 / 10, np.full(n, -46.6)
        at = 40
        while at < n - 230:
            size = int(r.choice([1, 1, 2, 3, 5, 12, 60, 70, 130, 200]))
            kind = r.integers(3)
            size = min(size, n - 40 - at, 200)
            if kind == 0:
                lon[at : at + size] += 3.0  # all at one other place
            elif kind == 1:
                lon[at : at + size] += 9.0 + 7 * (np.arange(size) % 5)  # each far from the next
            else:
                lon[at : at + size : 2] += 5.0  # every other one
            at += size + int(r.integers(210, 260))
        assert np.flatnonzero(false_places(np.zeros(n, int), us, lat, lon, lim)).tolist() == longest_chain(us, lat, lon, lim)


@pytest.mark.parametrize("share", [0.05, 0.1, 0.2, 0.3])
def test_scattered_spikes_are_found_up_to_a_third(share):
    r, lim, n = np.random.default_rng(7), Limits(), 2000
    x = r.uniform(5, 40, n)
    at = np.sort(r.choice(n, int(share * n), replace=False))
    x[at] = r.uniform(75, 200, len(at))
    assert np.flatnonzero(false_speeds(np.zeros(n, int), x, lim)).tolist() == at.tolist()


def test_driving_of_a_mostly_parked_vehicle_is_usual():
    r, lim, n = np.random.default_rng(8), Limits(), 600
    x = r.uniform(0, 8, n)
    x[100:160], x[400:450] = r.uniform(25, 45, 60), r.uniform(25, 45, 50)
    assert not false_speeds(np.zeros(n, int), x, lim).any()
    x[300] = 95.0
    assert np.flatnonzero(false_speeds(np.zeros(n, int), x, lim)).tolist() == [300]
