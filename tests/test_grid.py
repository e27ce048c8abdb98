from datetime import datetime, timedelta

import pytest

from fleetspan.operators.grid import empty_slots, regular_series

T0 = datetime(2018, 1, 1, 5)
DDL = "row_id bigint, vehicle_id string, timestamp timestamp, speed double, cell string, v int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1) for r in rows], DDL)


def series(df, **kw):
    return {(r["source_key"], (r["slot_us"] - 1514782800000000) // 60_000_000): r for r in regular_series(df, **kw).collect()}


def test_time_weights_and_coverage(spark):
    rows = [(1, "1", T0, 10.0), (2, "1", T0 + timedelta(seconds=30), 20.0), (3, "1", T0 + timedelta(seconds=180), 40.0)]
    s = series(frame(spark, rows))
    assert len(s) == 2
    assert s["00000001", 0]["mean_value"] == pytest.approx((10 * 30 + 20 * 90) / 120) and s["00000001", 0]["coverage"] == pytest.approx(1)
    assert s["00000001", 2]["mean_value"] == pytest.approx((20 * 60 + 40 * 60) / 120)


def test_gaps_are_filled_then_marked(spark):
    rows = [(1, "1", T0, 10.0), (2, "1", T0 + timedelta(minutes=20), 30.0)]
    s = series(frame(spark, rows), hold_seconds=300)
    assert [s["00000001", m]["filled"] for m in range(0, 21, 2)] == [False, *[True] * 9, False]
    assert s["00000001", 2]["mean_value"] == 10 and s["00000001", 4]["coverage"] == pytest.approx(0.5) and s["00000001", 6]["mean_value"] is None


def test_days_nulls_copies(spark):
    rows = [
        (1, "1", T0, None), (2, "1", T0, 50.0),  # the first copy counts, and it has no value
        (3, "1", T0 + timedelta(minutes=4), 1.0), (4, "1", T0 + timedelta(days=1), 1.0), (5, "1", T0 + timedelta(minutes=10), 2.0),
        (6, None, T0, 1.0), (7, "2", None, 1.0), (8, "3", T0, None),
    ]
    out = sorted((r["slot_us"] - 1514782800000000) // 60_000_000 for r in empty_slots(frame(spark, rows)).collect())
    assert out == [6, 8]


def test_empty_and_single(spark):
    assert series(frame(spark, [])) == {}
    one = series(frame(spark, [(1, "1", T0 + timedelta(seconds=119), 7.0)]))
    assert one["00000001", 0]["mean_value"] == 7 and one["00000001", 0]["coverage"] == pytest.approx(1 / 120)
