import random

import numpy as np
import pytest

from fleetspan.functions.geo import inside, metres, rings
from fleetspan.operators.near import containing_regions, near_pairs

DDL = "id string, latitude double, longitude double, k string, lat int, strip int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DDL)


def brute(rows, m):
    ok = [r for r in rows if None not in r and -90 <= r[1] <= 90 and -180 <= r[2] <= 180]
    out = set()
    for i, a in enumerate(ok):
        for b in ok[i + 1 :]:
            if a[0] != b[0] and metres(*map(np.float64, (a[1], a[2], b[1], b[2]))) <= m:
                out.add((min(a[0], b[0]), max(a[0], b[0])))
    return out


@pytest.mark.parametrize("tile_rows", [20_000, 7])
@pytest.mark.parametrize("within", [30.0, 900.0])
def test_pairs_against_brute_force(spark, within, tile_rows):
    r = random.Random(3)
    rows = [(f"v{i}", -23.5 + r.gauss(0, 0.01), -46.6 + r.gauss(0, 0.01)) for i in range(250)]
    rows += [(f"c{i}", -23.5, -46.6) for i in range(30)]  # one place
    rows += [(None, -23.5, -46.6), ("n1", None, -46.6), ("n2", -23.5, None), ("n3", 200.0, 0.0), rows[0], ("edge", -23.505, -46.6), ("edge2", -23.5050001, -46.6)]
    got = [(a, b) for a, b, _ in near_pairs(frame(spark, rows), "id", "latitude", "longitude", within, tile_rows=tile_rows).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, within)


def test_high_latitudes(spark):
    r = random.Random(4)
    rows = [(f"v{i}", 69.0 + r.random() * 0.02, 18.0 + r.random() * 0.05) for i in range(200)]
    got = {(a, b) for a, b, _ in near_pairs(frame(spark, rows), "id", "latitude", "longitude", 200.0).collect()}
    assert got == brute(rows, 200.0)


def test_no_points(spark):
    assert near_pairs(frame(spark, []), "id", "latitude", "longitude", 30.0).count() == 0


ZONES = [
    (1, "POLYGON ((-46.7 -23.6, -46.5 -23.6, -46.5 -23.4, -46.7 -23.4, -46.7 -23.6), (-46.62 -23.52, -46.58 -23.52, -46.58 -23.48, -46.62 -23.48, -46.62 -23.52))"),
    (2, "polygon((-46.6 -23.5, -46.55 -23.5, -46.6 -23.45, -46.6 -23.5))"), (3, "no polygon"), (4, None), (None, "POLYGON ((0 0, 1 0, 1 1, 0 0))"),
]


def test_regions(spark):
    r = random.Random(6)
    rows = [(f"v{i}", -23.65 + r.random() * 0.3, -46.75 + r.random() * 0.3) for i in range(500)] + [("null", None, -46.6), ("hole", -23.5, -46.6), ("edge", -23.6, -46.6)]
    zones = spark.createDataFrame([(*z, "c") for z in [*ZONES, ZONES[0]]], "zone_id int, wkt string, k string")
    got = sorted(tuple(x) for x in containing_regions(frame(spark, rows), "id", "latitude", "longitude", zones, "zone_id", "wkt").collect())
    want = sorted((k, str(z)) for k, a, b in rows if a is not None for z, w in ZONES if z and (s := rings(w)) and inside(np.array([b]), np.array([a]), s)[0])
    assert got == want and ("edge", "1") in got and ("hole", "1") not in got
    assert containing_regions(frame(spark, []), "id", "latitude", "longitude", zones, "zone_id", "wkt").count() == 0
