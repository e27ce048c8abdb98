"""Operators of the inventory on small inputs with known results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetspan.functions import columns as X
from fleetspan.functions.geo import haversine_km, heading_deg
from fleetspan.operators import clean, dedup, enrich, kpi, quality, telemetry
from fleetspan.schemas import SCHEMAS, schema
from fleetspan.settings import BOXES

T0 = datetime(2018, 1, 1, 8)


def one(df):
    return df.collect()[0]


def test_headway_fixture(spark):
    rows = [("8000-10", "S1", 0), ("8000-10", "S1", 10), ("8000-10", "S1", 20), ("8000-20", "S1", 0), ("8000-20", "S1", 25)]
    df = spark.createDataFrame([(i, a, b, T0 + timedelta(minutes=m)) for i, (a, b, m) in enumerate(rows)], "row_id int, line_id string, stop_id string, ts timestamp")
    got = {r["line_id"]: r for r in kpi.headway_summary(df).collect()}
    assert got["8000-10"]["avg_headway_minutes"] == 10 and got["8000-10"]["headway_quality"] == "good" and got["8000-10"]["sample_size"] == 2
    assert got["8000-20"]["avg_headway_minutes"] == 25 and got["8000-20"]["headway_quality"] == "poor"


@pytest.mark.parametrize(("tolerance", "percent"), [(3, 80.0), (5, 90.0)])
def test_punctuality_fixture(spark, tolerance, percent):
    df = spark.createDataFrame([("L", float(d)) for d in (0, 2, -1, 5, 1, 0, 3, -2, 6, 1)], "line_id string, d double")
    assert one(kpi.punctuality(df, "line_id", F.col("d"), tolerance))["on_time_percent"] == percent


def test_dedup_strategies(spark):
    df = spark.createDataFrame([(1, "V1", T0, 1.0), (2, "V1", T0, None), (3, "V1", T0 + timedelta(seconds=30), 0.5), (4, "V2", T0, 0.1), (5, None, T0, 0.2)], "row_id int, vehicle_id string, timestamp timestamp, score double")
    ids = lambda d: sorted(r["row_id"] for r in d.collect())
    assert ids(dedup.deduplicated(df, "first")) == [1, 3, 4, 5]
    assert ids(dedup.deduplicated(df, "last")) == [3, 4, 5]
    assert ids(dedup.deduplicated(df, "time_window")) == [3, 4, 5]
    assert ids(dedup.best_quality(df, ["vehicle_id"], "score", "row_id")) == [1, 4, 5]
    with pytest.raises(ValueError, match="unknown"):
        dedup.deduplicated(df, "other")
    assert [r["is_duplicate"] for r in dedup.flag_all(df, ["vehicle_id", "timestamp"]).orderBy("row_id").collect()] == [True, True, False, False, False]
    first = dedup.deduplicated(df, "first")
    assert ids(dedup.deduplicated(first, "first")) == ids(first)


def test_merge_is_idempotent_and_the_newer_row_wins(spark):
    ddl = "k string, v int, at timestamp"
    old = spark.createDataFrame([("a", 1, T0), ("b", 1, None), ("c", 1, T0)], ddl)
    new = spark.createDataFrame([("a", 2, T0), ("b", 2, T0), ("c", 2, T0 - timedelta(hours=1)), ("d", 2, T0)], ddl)
    m = dedup.merged_latest(old, new, ["k"], "at")
    want = [("a", 2), ("b", 2), ("c", 1), ("d", 2)]
    assert sorted((r["k"], r["v"]) for r in m.collect()) == want
    assert sorted((r["k"], r["v"]) for r in dedup.merged_latest(m, new, ["k"], "at").collect()) == want


def test_completeness_validity_uniqueness_fixture(spark):
    df = spark.createDataFrame([("A", 1, 40.0), ("B", None, 10.0), ("C", 3, None), (None, 4, 200.0)], "col1 string, col2 int, col3 double")
    out = one(quality.dimensions(df, {c: F.col(c) for c in df.columns}, F.col("col3").between(0, 120), ["col1"]))
    assert (out["completeness_col1"], out["completeness_col2"], out["completeness_col3"], out["validity"], out["uniqueness"]) == (75, 75, 75, 50, 100)


def test_flags_scores_and_empty_frames(spark):
    ddl = "vehicle_id string, latitude double, longitude double, speed double, ts timestamp"
    df = spark.createDataFrame([("a", -23.5, -46.6, 10.0, T0), ("b", None, -46.6, 10.0, T0), ("c", 0.0, 0.0, 10.0, T0), ("d", -23.5, -46.6, 121.0, T0), ("e", -23.5, -46.6, None, T0 - timedelta(days=2)), ("f", -23.5, -46.6, 120.0, T0)], ddl)
    flagged = quality.flags(df, ["vehicle_id", "latitude", "longitude", "ts"], F.lit(T0))
    assert [r["is_valid"] for r in flagged.orderBy("vehicle_id").collect()] == [True, False, False, False, False, True]
    s = one(quality.flag_summary(flagged))
    assert (s["total_records"], s["valid_records"], s["null_records"], s["out_of_range_records"]) == (6, 2, 1, 2)
    assert one(quality.flag_summary(flagged.limit(0)))["quality_score"] == 0
    checks = quality.checks(df.withColumn("now", F.lit(T0)), ["vehicle_id"], ["vehicle_id"], F.col("now"))
    got = {r["check_name"]: r["passed"] for r in checks.collect()}
    assert got == {"required_fields": True, "coordinates": False, "speed": False, "duplicates": True, "freshness_minutes": True, "record_count": True}
    with pytest.raises(quality.QualityError) as e:
        quality.enforce(checks)
    assert e.value.code == "coordinates"
    empty = {r["check_name"]: r["value"] for r in quality.checks(df.limit(0).withColumn("now", F.lit(T0)), ["vehicle_id"], ["vehicle_id"], F.col("now")).collect()}
    assert empty["freshness_minutes"] == 999999 and empty["record_count"] == 0


def test_alerts_health_recommendations(spark):
    m = spark.createDataFrame([("quality_score", 89.0), ("null_percent", 5.1), ("delay_minutes", 31.0), ("duplicate_percent", 1.0), ("success_percent", 98.0)], "metric string, value double")
    assert {(r["metric"], r["severity"]) for r in quality.alerts(m).collect()} == {("quality_score", "ERROR"), ("null_percent", "WARNING"), ("delay_minutes", "CRITICAL")}
    assert {(r["metric"], r["priority"]) for r in quality.recommendations(m).collect()} == {("quality_score", "HIGH"), ("success_percent", "MEDIUM")}
    h = lambda *s: one(quality.health(spark.createDataFrame([(x,) for x in s], "status string")))[0]
    assert (h("healthy", "healthy"), h("healthy", "unhealthy"), h("healthy", "unknown"), h()) == ("healthy", "degraded", "unknown", "unknown")


def test_telemetry(spark):
    rows = [(1, "a", 0, -23.5, -46.6), (2, "a", 60, -23.49, -46.6), (3, "a", 60, -23.48, -46.6), (4, "a", 61, -23.0, -46.6), (5, "b", 0, -23.5, None)]
    df = spark.createDataFrame([(i, v, T0 + timedelta(seconds=s), a, b) for i, v, s, a, b in rows], "row_id int, vehicle_id string, ts timestamp, latitude double, longitude double")
    got = {r["row_id"]: r for r in telemetry.steps(df).collect()}
    assert got[1]["speed_kmh"] is None and got[2]["speed_kmh"] == pytest.approx(66.7, abs=0.1) and got[3]["speed_kmh"] is None and got[4]["speed_kmh"] is None and got[5]["distance_km"] is None
    assert got[2]["heading"] == pytest.approx(0)


def test_snapshot_speed(spark):
    ddl = "vehicle_id string, latitude double, longitude double, ts timestamp"
    now = spark.createDataFrame([("a", -23.5, -46.6, T0), ("b", -23.5, -46.6, T0), ("c", -23.5, -46.6, T0), ("d", -23.5, -46.6, T0)], ddl)
    before = spark.createDataFrame([("a", -23.501, -46.6, T0 - timedelta(seconds=60)), ("b", -23.501, -46.6, T0 - timedelta(seconds=601)), ("c", -23.9, -46.6, T0 - timedelta(seconds=60))], ddl)
    got = {r["vehicle_id"]: r["computed_speed"] for r in telemetry.against_snapshot(now, before).collect()}
    assert got["a"] == pytest.approx(6.67, abs=0.01) and (got["b"], got["c"], got["d"]) == (0, 0, 0)


def test_nearest_stop_against_brute_force(spark):
    import random

    r = random.Random(2)
    pts = [(i, -23.5 + r.random() * 0.01, -46.6 + r.random() * 0.01) for i in range(300)] + [(999, None, -46.6)]
    stops = [(f"S{i}", -23.5 + r.random() * 0.01, -46.6 + r.random() * 0.01) for i in range(60)] + [("N", None, 1.0)]
    df, s = spark.createDataFrame(pts, "row_id int, latitude double, longitude double"), spark.createDataFrame(stops, "stop_id string, stop_lat double, stop_lon double")
    from fleetspan.functions.geo import metres

    want = {}
    for i, a, b in pts[:-1]:
        d = sorted((float(metres(a, b, x, y)), k) for k, x, y in stops[:-1])
        if d[0][0] <= 50:
            want[i] = d[0][1]
    assert {x["row_id"]: x["stop_id"] for x in enrich.nearest_stop(df, s, "row_id").collect()} == want
    assert enrich.nearest_stop(df, s, "row_id", how="left").count() == len(pts)


def test_expressions(spark):
    row = spark.range(1).select(
        haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)).alias("anti"), haversine_km(F.lit(1.0), F.lit(2.0), F.lit(1.0), F.lit(2.0)).alias("same"), heading_deg(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)).alias("east"),
        X.clock_hour(F.lit("25:10:00")).alias("h"), X.clock_hour(F.lit("x")).alias("hx"), X.congestion_index(F.lit(None).cast("double")).alias("ci"), X.truncated(F.lit("abcdef"), 5).alias("t"),
        X.valid_email(F.lit("a.b@c.org")).alias("e1"), X.valid_email(F.lit("a@b")).alias("e2"), X.valid_phone(F.lit("(11) 91234-5678")).alias("p"), X.valid_place(F.lit(0.0), F.lit(0.0)).alias("null_island"),
        X.valid_time(F.lit(T0), F.lit(T0 - timedelta(hours=1))).alias("ahead"), X.valid_vehicle(F.lit(" ")).alias("blank"), X.headway_quality(F.lit(15.0)).alias("q"),
    ).first()
    assert row["anti"] == pytest.approx(20015.09, abs=0.01) and row["same"] == 0 and row["east"] == 90
    assert (row["h"], row["hx"], row["ci"], row["t"]) == (1, None, 10, "ab...")
    assert (row["e1"], row["e2"], row["p"], row["null_island"], row["ahead"], row["blank"], row["q"]) == (True, False, True, False, True, False, "fair")


def test_cleaning(spark):
    assert clean.plain_name("Número da Linha ") == "numero_da_linha"
    df = spark.createDataFrame([(" a ", "x", 1.239)], "`Nome é` string, `nome e` string, v double")
    assert clean.plain_names(df).columns == ["nome_e", "nome_e_2", "v"]
    assert one(clean.rounded(df))["v"] == 1.24
    assert quality.type_mismatches(df, {"v": "int", "w": "int"}) == {"v": ("int", "double"), "w": ("int", None)}
    with pytest.raises(quality.SchemaError):
        quality.check_schema(df, {"v": "int"})
    routes = spark.createDataFrame([(" 8000-20 ", " Long "), ("", "x"), (None, "y"), ("a", None)], "route_short_name string, route_long_name string")
    assert sorted(r[0] for r in clean.clean_routes(routes).collect()) == ["8000-20", "A"]
    assert clean.inside_box(spark.createDataFrame([(-23.5, -46.6), (0.0, 0.0), (100.0, 200.0), (None, -46.6), (-24.0, -47.0)], "latitude double, longitude double"), box=BOXES["wide"]).count() == 2
    assert clean.profile(df)["rows"] == 1


def test_schemas(spark):
    for layer, names in SCHEMAS.items():
        for n in names:
            assert spark.createDataFrame([], schema(layer, n)).count() == 0
    with pytest.raises(ValueError, match="no schema"):
        schema("bronze", "nothing")


def test_windows_equal_a_plain_count(spark):
    df = spark.createDataFrame([("a", T0, "r", 10.0), ("a", T0 + timedelta(seconds=30), "r", 2.0), ("b", T0 + timedelta(minutes=4), "r", None)], "vehicle_id string, timestamp timestamp, route_code string, speed double")
    rows = kpi.windowed(df, "route_code").collect()
    top = max(rows, key=lambda r: r["position_count"])
    assert len(rows) == 9 and (top["vehicle_count"], top["position_count"], top["avg_speed"], top["moving_count"]) == (2, 3, 6.0, 1)


def test_service_quality_date_range_and_partition_path(spark):
    df = spark.createDataFrame([(0.95, 0.75, 35.0), (1.0, 1.0, 90.0), (0.5, None, 10.0)], "a double, b double, c double")
    got = [r[0] for r in df.select(X.service_quality(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got[:2] == pytest.approx([81.5, 100.0]) and got[2] is None
    df = spark.createDataFrame([(1, T0, T0 + timedelta(days=2, hours=1)), (2, T0, T0), (3, T0, T0 - timedelta(days=1)), (4, T0, None)], "k int, s timestamp, e timestamp")
    days = df.select("k", F.explode(X.days_between(F.col("s"), F.col("e"))).alias("t"))
    assert sorted(tuple(r) for r in days.collect()) == [(1, T0), (1, T0 + timedelta(days=1)), (1, T0 + timedelta(days=2)), (2, T0)]
    parts = one(df.where("k = 2").select(X.partition_path(F.col("s")), X.partition_path(F.col("s"), ("year", "month", "day", "hour")), X.partition_path(F.lit(None).cast("timestamp"))))
    assert tuple(parts) == ("year=2018/month=01/day=01", "year=2018/month=01/day=01/hour=08", None)
