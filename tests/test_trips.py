from datetime import datetime, timedelta

import numpy as np
import pytest

from fleetspan.functions.geo import metres
from fleetspan.operators import series
from fleetspan.operators.delivery import identified
from fleetspan.operators.trips import TripRules, segments_of, stops_and_trips

T0 = datetime(2018, 1, 1, 5)
DDL = "row_id bigint, vehicle_id string, timestamp timestamp, latitude double, longitude double, speed double, is_stop int"


def route(plan, vehicle="1", first=0, seed=0):
    """``plan``: (minutes, moving) in turn; pings every 40 s with 5 m of noise, 9 m/s when moving."""
    r = np.random.default_rng(seed)
    rows, t, lat = [], 0.0, -23.9
    for minutes, moving in plan:
        if moving is None:
            t += minutes * 60
            continue
        for _ in range(round(minutes * 60 / 40)):
            rows.append([first + len(rows), vehicle, T0 + timedelta(seconds=t), lat + r.normal(0, 5) / 111_000, -46.6 + r.normal(0, 5) / 102_000, 30.0 if moving else 0.0])
            t += 40
            lat += 9 * 40 / 111_000 if moving else 0
    return rows


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 1) for r in rows], DDL)
    return sorted((x["vehicle_id"], x["started_us"], "stop" if x["is_stop"] else "trip", x["ended_us"]) for x in stops_and_trips(df, **kw).collect())


def shape(segments):
    return [s[2] for s in segments]


def test_stops_and_trips_in_turn(spark):
    rows = route([(10, True), (8, False), (12, True), (6, False), (5, True)])
    got = found(spark, rows)
    assert shape(got) == ["trip", "stop", "trip", "stop", "trip"]
    assert all(a[3] == b[1] for a, b in zip(got[:-1], got[1:], strict=True))


def test_silence_splits_and_short_halts_are_no_stop(spark):
    assert shape(found(spark, route([(10, True), (25, None), (10, True)]))) == ["trip", "trip"]
    assert shape(found(spark, route([(10, True), (3, False), (10, True)]))) == ["trip"]
    assert shape(found(spark, route([(10, False)]))) == ["stop"]


def test_a_stop_of_two_pings(spark):
    rows = route([(10, True)])
    last = rows[-1]
    rows += [[500, "1", last[2] + timedelta(minutes=8), last[3], last[4], 0.0]]
    rows += [[600 + r[0], "1", r[2] + timedelta(minutes=18), r[3] + 0.054, r[4], 30.0] for r in route([(10, True)])]
    assert shape(found(spark, rows)) == ["trip", "stop", "trip"]


def test_false_places_nulls_copies_and_empty(spark):
    rows = route([(10, True), (8, False), (12, True)])
    clean = found(spark, rows)
    dirty = rows + [[900, "1", rows[3][2], -23.5, -46.6, 1.0], [901, None, T0, -23.5, -46.6, 1.0], [902, "1", None, -23.5, -46.6, 1.0], [903, "1", T0 + timedelta(seconds=15), None, -46.6, 1.0], [904, "1", T0 + timedelta(seconds=700), -10.0, -46.6, 1.0], [905, "2", T0, -23.5, -46.6, 1.0]]
    assert found(spark, dirty) == clean
    assert found(spark, []) == []


def test_every_stop_is_a_longest_series(spark):
    rows = np.array([[r[3], r[4]] for r in route([(6, True), (9, False), (7, True), (7, False), (6, True)], seed=3)])
    us = np.arange(len(rows)) * 40_000_000
    lat, lon = rows[:, 0], rows[:, 1]
    for stop, i, j, _ in segments_of(np.zeros(len(us), int), us, lat, lon, TripRules()):
        if not stop:
            continue
        c = np.median(lat[i : j + 1]), np.median(lon[i : j + 1])
        d = metres(c[0], c[1], lat, lon)
        assert (d[i : j + 1] <= 50).all() and us[j] - us[i] >= 300e6
        assert (i == 0 or d[i - 1] > 50) and (j == len(us) - 1 or d[j + 1] > 50)


@pytest.mark.parametrize("hot", [20, 60])
def test_a_hot_vehicle_is_cut_at_silences_with_the_same_result(spark, hot, monkeypatch):
    rows = route([(10, True), (8, False), (5, True), (45, None), (12, True), (6, False), (5, True), (50, None), (9, True)]) + route([(10, True)], "2", 5000, 1)
    want = found(spark, rows)
    monkeypatch.setattr(series, "HOT_ROWS", hot)
    monkeypatch.setattr(series.ordered, "__defaults__", (hot, True))
    assert found(spark, rows) == want
    df = spark.createDataFrame([(*r, 1) for r in rows], DDL)
    parts = series.with_parts(identified(df), hot).groupBy("source_key", "part").count().collect()
    assert len({p["part"] for p in parts if p["source_key"] == "00000001"}) > 1
    assert {p["part"] for p in parts if p["source_key"] == "00000002"} == {0}
