import json
import zipfile
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetspan.operators import control
from fleetspan.sources import gtfs, rest, sinks, synthetic
from fleetspan.sources.adapters import Cache, jdbc_options

T0 = datetime(2018, 1, 1, 8)


def test_timetable_feed(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("routes.txt", "﻿route_id,agency_id,route_short_name,route_long_name,route_type,route_color,route_text_color\nR1,A,10,\"Long, name\",3,,\nR2,A,11,x,bus,,\n")
        z.writestr("stops.txt", "stop_id,stop_name,stop_lat,stop_lon\nS1,a,-23.5,-46.6\n")
        z.writestr("trips.txt", "route_id,trip_id\n")
    folder = str(tmp_path / "feed")
    assert gtfs.extract(str(tmp_path / "f.zip"), folder) == ["routes.txt", "stops.txt", "trips.txt"]
    routes = gtfs.load(spark, folder, "routes").orderBy("route_id").collect()
    assert routes[0]["route_type"] == 3 and routes[1]["route_type"] is None and routes[0]["route_long_name"] == "Long, name"
    assert gtfs.load(spark, folder, "stops").first()["stop_lat"] == -23.5
    r = gtfs.report(spark, folder)
    assert r["missing"] == ["stop_times"] and r["empty"] == ["trips"] and r["rows"]["routes"] == 2 and not r["valid"]


def test_an_archive_may_not_leave_its_folder(tmp_path):
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as z:
        z.writestr("../evil.txt", "x")
    with pytest.raises(ValueError, match="outside"):
        gtfs.extract(str(tmp_path / "f.zip"), str(tmp_path / "feed"))


def test_position_api_from_a_stored_response(spark, tmp_path):
    doc = {"hr": "08:00", "l": [{"cl": 1, "vs": [{"p": 7}]}]}
    (tmp_path / "r.json").write_text(json.dumps(doc))
    spark.dataSource.register(rest.PositionApi)
    row = spark.read.format("position_api").option("file", str(tmp_path / "r.json")).option("endpoint", "positions").load().first()
    assert row["response_status"] == 200 and json.loads(row["raw_json"]) == doc and rest.is_json(row["raw_json"])


def test_synthetic_tables_are_seeded_and_fit(spark):
    a, b = synthetic.positions(spark, 500), synthetic.positions(spark, 500)
    assert a.exceptAll(b).count() == 0 and a.select("vehicle_id").distinct().count() == 60
    s = a.agg(F.min("speed").alias("lo"), F.max("speed").alias("hi"), F.avg("speed").alias("m")).first()
    assert 0 <= s["lo"] and s["hi"] <= 60 and 25 < s["m"] < 32
    t = synthetic.timetable(spark)
    assert t["stop_times"].join(t["trips"], "trip_id", "left_anti").count() == 0 and t["stop_times"].join(t["stops"], "stop_id", "left_anti").count() == 0


def test_layers_upsert_quarantine_retention(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, T0), ("b", 2, T0 + timedelta(days=40))], "k string, v int, ts timestamp")
    lake = str(tmp_path / "lake")
    sinks.write_layer(df, lake, "bronze", "ts")
    sinks.write_layer(df, lake, "bronze", "ts", files_per_part=2)
    back = spark.read.parquet(lake)
    assert back.count() == 4 and {"year", "month", "day", "hour"} <= set(back.columns)
    assert sinks.drop_months(spark, lake, (2018, 2)) == ["2018-01"] and spark.read.parquet(lake).count() == 2
    t = str(tmp_path / "t")
    sinks.upsert(df, t, ["k"], "ts")
    sinks.upsert(df.withColumns({"v": F.col("v") + 10, "ts": F.col("ts") + F.expr("interval 1 hour")}), t, ["k"], "ts")
    sinks.upsert(df, t, ["k"], "ts")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(t).collect()) == [("a", 11), ("b", 12)]
    q = str(tmp_path / "q")
    sinks.write_quarantine(df.withColumn("is_valid", F.col("v") > 1), q)
    assert [r["k"] for r in spark.read.parquet(q).collect()] == ["a"]
    assert sinks.retain(df, "ts", T0 + timedelta(days=60), 30).count() == 1
    paths = sinks.write_figures({"x": df}, str(tmp_path / "fig"))
    assert list(paths) == ["x"] and sinks.load_serving(spark, str(tmp_path / "fig"), ["x", "y"]) == {"x": "loaded", "y": "missing"}
    assert spark.table("kpi_x").count() == 2


def test_run_log_metrics_and_retries(spark, tmp_path):
    log = str(tmp_path / "runs")
    with control.job_run(spark, "good", log, clock=lambda: datetime(2018, 1, 1, tzinfo=UTC)) as r:
        r["records_in"] = 5
    with pytest.raises(RuntimeError), control.job_run(spark, "bad", log):
        raise RuntimeError("boom")
    rows = {r["job"]: r for r in spark.read.parquet(log).collect()}
    assert rows["good"]["status"] == "success" and rows["good"]["records_in"] == 5 and rows["bad"]["status"] == "failed" and "boom" in rows["bad"]["error"]
    df, seen = control.observed(spark.range(10), "n", {"rows": F.count("*"), "top": F.max("id")})
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "top": 9}
    assert {(r["metric"], r["value"]) for r in control.long_metrics(spark.range(4), {"n": F.count("*"), "s": F.sum("id")}).collect()} == {("n", 4.0), ("s", 6.0)}
    waits, tries = [], iter([ValueError, ValueError, None])

    def call():
        if e := next(tries):
            raise e
        return "ok"

    assert control.with_retries(call, 3, 1, 1.5, waits.append) == "ok" and waits == [1, 1.5]


def test_cache():
    now = [0.0]
    c = Cache(lambda: now[0])
    c.put_position("7", {"lat": 1})
    c.put_many({"a": 1, "b": [2]})
    assert c.get("vehicle:position:7") == {"lat": 1} and c.get_many(["a", "b", "x"]) == {"a": 1, "b": [2]}
    now[0] = 181
    assert c.get("vehicle:position:7") is None and c.drop("a*") == 1 and c.stats()["keys"] == 1
    assert jdbc_options("u", "a", "b")["url"] == "u"
