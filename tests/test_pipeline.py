"""Consumer, geocoding, table care, jobs, control tables and metrics on small inputs."""

import json
import logging
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetspan import errors, jobs
from fleetspan.functions import columns as X
from fleetspan.operators import control, dedup, enrich, kpi, quality, telemetry
from fleetspan.session import STREAMING, build_session
from fleetspan.sources import consumer, geocode, lineage, maintenance, sinks

T0 = datetime(2018, 1, 1, 8)


def test_a_consumer_takes_each_message_once_and_stops_at_its_limit(spark, tmp_path):
    src, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    for k in range(3):
        spark.range(k * 10, k * 10 + 10).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(src)
    seen = []
    with consumer.PollConsumer(stream, cp) as c:
        stats = c.drain(lambda b, n: seen.extend(r["id"] for r in b.collect()), most=15)
    assert stats["messages"] == 20 and stats["batches"] == 2 and len(seen) == 20
    c = consumer.PollConsumer(stream, cp)
    assert c.drain(lambda b, n: seen.extend(r["id"] for r in b.collect()))["messages"] == 10 and sorted(seen) == list(range(30))

    def fails(b, n):
        raise RuntimeError("boom")

    spark.range(99, 100).write.mode("append").parquet(src)
    c = consumer.PollConsumer(stream, cp)
    with pytest.raises(Exception, match="boom"):
        c.drain(fails)
    assert c.stats()["failed"] == 1 and consumer.PollConsumer(stream, cp).drain(consumer.each_message(lambda r: None))["messages"] == 1
    assert consumer.PollRules().most_per_poll == 500


def test_geocoder_cache_failures_and_nulls(spark):
    asked = []

    def resolver(lat, lon):
        asked.append((lat, lon))
        if lat > 50:
            raise OSError("down")
        return {"address": f"{lat}", "road": "r", "suburb": None}

    waits = []
    g = geocode.Geocoder(resolver, capacity=2, delay_s=1.0, sleep=waits.append)
    assert g.batch([(1.0001, 2.0), (1.0004, 2.0), (None, 1.0), (60.0, 1.0), (3.0, 1.0), (4.0, 1.0), (1.0, 2.0)])[0]["address"] == "1.0"
    assert asked == [(1.0, 2.0), (60.0, 1.0), (3.0, 1.0), (4.0, 1.0), (1.0, 2.0)] and len(waits) == 4
    assert g.stats() == {"kept": 2, "hits": 1, "asked": 5, "failed": 1, "hit_rate": 1 / 6}
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, 60.0, 1.0)], "id int, latitude double, longitude double")
    rows = geocode.with_addresses(df, geocode.resolved(enrich.places_to_look_up(df), lambda a, b: {"address": "x"} if a < 50 else None))
    assert sorted((r["id"], r["address"]) for r in rows.collect()) == [(1, "x"), (2, None), (3, None)]
    assert geocode.success_rate(rows).first()["success_rate"] == 0.5


def test_table_care(spark, tmp_path):
    t = str(tmp_path / "t")
    spark.range(1000).withColumn("k", F.col("id") % 7).repartition(12).write.parquet(t)
    h = maintenance.table_health(spark, t).first()
    assert h["files"] == 12 and h["small_files"] == 12 and h["compact"]
    (tmp_path / "t" / "_temporary").mkdir()
    (tmp_path / "t" / "_temporary" / "left").write_text("x")
    assert maintenance.vacuum(spark, t, 1) == [] and len(maintenance.vacuum(spark, t, 0, now_ms=2**53)) >= 1
    assert spark.read.parquet(t).count() == 1000
    maintenance.write_skippable(spark.read.parquet(t), str(tmp_path / "o"), ["k"], ["id"], 3)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1000
    found = maintenance.lineage(spark.read.parquet(t).where("id > 5"))
    assert found["tables"][0].endswith("/t") and len(found["files"]) == 12 and found["columns"] == ["id, k"]
    maintenance.truncate(spark, t)
    assert spark.read.parquet(t).count() == 0 and spark.read.parquet(t).columns == ["id", "k"]


def test_upsert_replaces_only_touched_buckets(spark, tmp_path):
    t = str(tmp_path / "t")
    df = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), F.lit(T0).alias("at"))
    sinks.upsert(df, t, ["k"], "at", buckets=8)
    before = {p.name: sorted(f.name for f in p.iterdir() if f.suffix == ".parquet") for p in (tmp_path / "t").iterdir() if p.is_dir()}
    sinks.upsert(df.where("k = '7'").withColumns({"v": F.lit(2), "at": F.lit(T0 + timedelta(hours=1))}), t, ["k"], "at", buckets=8)
    after = {p.name: sorted(f.name for f in p.iterdir() if f.suffix == ".parquet") for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert sum(before[n] != after[n] for n in before) == 1
    rows = spark.read.parquet(t)
    assert rows.count() == 200 and rows.where("v = 2").count() == 1


def test_control_tables_counters_and_panels(spark, tmp_path):
    root = str(tmp_path / "c")
    control.record(spark.createDataFrame([("m", "a", 1.0, "extra")], "metric string, label string, value double, other string"), root, "metrics")
    row = control.recall(spark, root, "metrics").first()
    assert row["value"] == 1.0 and row["at"] is None and "other" not in row
    c = control.Counters(lambda: 5.0)
    assert c.stage("s")(lambda x: x + 1)(2) == 3 and c.values["stage_last_success", "s"] == 5.0
    lines = [r["line"] for r in control.exposition(spark.createDataFrame([("a b", 'x"\\y', 1.5), ("c", None, 2.0)], "metric string, label string, value double")).collect()]
    assert lines == ['fleet_a_b{label="x\\"\\\\y"} 1.5', 'fleet_c{label=""} 2.0']
    series = spark.createDataFrame([("n", "a", float(v), T0 + timedelta(seconds=10 * i)) for i, v in enumerate([1, 4, 2, 5])] + [("n", "b", 9.0, T0)], "metric string, label string, value double, at timestamp")
    got = {r["label"]: r for r in control.panels(series).collect()}
    assert got["a"]["increase"] == 3 + 2 + 3 and got["a"]["rate"] == 8 / 30 and got["a"]["last"] == 5 and got["b"]["place"] == 1 and got["b"]["rate"] is None
    assert control.panels(series, top=1).count() == 1
    inf = float("inf")
    b = spark.createDataFrame([("x", 1.0, 10), ("x", 2.0, 30), ("x", inf, 40), ("y", inf, 5)], "label string, le double, count bigint")
    assert {r["label"]: r["quantile"] for r in control.histogram_quantile(b, 0.5).collect()} == {"x": 1.5, "y": 0.0}
    assert control.histogram_quantile(b, 0.99).where("label = 'x'").first()["quantile"] == 2.0
    status = control.probe(spark, {"good": lambda: True, "bad": lambda: 1 / 0})
    assert quality.health(status).first()["status"] == "degraded" and "ZeroDivisionError" in status.where("component = 'bad'").first()["message"]
    into = {}
    with control.timed(into, "x"):
        pass
    assert into["x_seconds"] >= 0 and into["x_peak_bytes"] > 0


def test_small_helpers():
    assert control.env_flag("A", env={"A": "Yes"}) and not control.env_flag("A", env={"A": "0"}) and control.env_flag("B", True, {})
    assert control.url("http://h/", "a b", "c", q=1, z=None) == "http://h/a%20b/c?q=1"
    rec = logging.LogRecord("n", logging.INFO, "f", 1, "hi %s", ("x",), None)
    assert json.loads(control.JsonLines().format(rec))["message"] == "hi x"
    e = errors.SinkError("no", details={"p": 1})
    assert e.record() == {"error": "SinkError", "code": "sink", "message": "no", "details": {"p": 1}} and issubclass(errors.SchemaError, errors.QualityError)
    assert {j["name"] for j in jobs.summary()["jobs"]} == set(jobs.JOBS)


def test_labels_scores_paths(spark):
    df = spark.createDataFrame([(10.0,), (130.0,), (None,)], "s double")
    assert [r[0] for r in df.select(X.speed_label(F.col("s"))).collect()] == ["VALID", "INVALID", "INVALID"]
    assert [r[0] for r in df.select(X.is_peak_load(F.col("s"))).collect()] == [False, True, False]
    out = quality.pipeline_score(spark.createDataFrame([("V1", -23.5, -46.6, 45.0), ("V2", None, -46.6, 50.0), ("V3", -23.5, None, 50.0), ("V4", -23.5, -46.6, 150.0), ("V5", -23.5, -46.6, 42.0)], "v string, latitude double, longitude double, speed double"), ["latitude", "longitude"], {"speed": F.col("speed").between(0, 120)}).first()
    assert (out["known_latitude"], out["known_longitude"], out["valid_speed"]) == (0.8, 0.8, 0.8) and abs(out["score"] - 0.8) < 1e-12
    assert quality.pipeline_score(df.limit(0), ["s"], {}).first()["score"] == 0
    days = spark.range(1).select(F.explode(X.days_between(F.lit(T0), F.lit(T0 + timedelta(days=2)))).alias("d"))
    assert [r[0] for r in days.select(X.partition_path(F.col("d"), ("year", "month", "day", "hour"))).collect()] == [f"year=2018/month=01/day=0{k}/hour=08" for k in (1, 2, 3)]


def test_previous_rows_across_days_nulls_and_ties(spark):
    rows = [(1, "a", T0), (2, "a", T0 + timedelta(hours=1)), (3, "a", T0 + timedelta(days=3)), (4, "a", T0 + timedelta(days=3)), (5, "b", T0), (6, "a", None), (7, None, T0), (8, None, T0 + timedelta(days=1)), (9, "a", T0 + timedelta(days=9))]
    df = spark.createDataFrame(rows, "row_id int, k string, ts timestamp")
    got = {r["row_id"]: r["was"] for r in telemetry.with_previous(df, ["k"], "ts", "row_id", {"was": F.col("row_id")}).collect()}
    assert got == {6: None, 1: 6, 2: 1, 3: 2, 4: 3, 9: 4, 5: None, 7: None, 8: 7}
    assert telemetry.with_previous(df.limit(0), ["k"], "ts", "row_id", {"was": F.col("row_id")}).count() == 0


def test_steps_equal_one_window(spark):
    from pyspark.sql import Window

    from fleetspan.sources import synthetic

    p = synthetic.positions(spark, 3000, vehicles=5).withColumns({"row_id": F.monotonically_increasing_id(), "ts": F.col("timestamp") + F.make_dt_interval(hours=F.pmod(F.xxhash64("timestamp"), F.lit(200)).cast("int"))})
    got = telemetry.steps(p).select("row_id", F.round("distance_km", 9).alias("d"), "elapsed_s")
    by = Window.partitionBy("vehicle_id").orderBy("ts", "row_id")
    from fleetspan.functions.geo import haversine_km

    want = p.select("row_id", F.round(haversine_km(F.lag("latitude").over(by), F.lag("longitude").over(by), F.col("latitude"), F.col("longitude")), 9).alias("d"), (F.unix_timestamp("ts") - F.lag(F.unix_timestamp("ts")).over(by)).alias("elapsed_s"))
    assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_nearest_stop_at_high_latitudes(spark):
    import random

    r = random.Random(3)
    stops = [(f"s{i}", 60 + r.uniform(0, 0.02), 10 + r.uniform(0, 0.04)) for i in range(150)]
    rows = [(i, 60 + r.uniform(0, 0.02), 10 + r.uniform(0, 0.04), "x") for i in range(300)]
    df, st = spark.createDataFrame(rows, "row_id int, latitude double, longitude double, stop_lat string"), spark.createDataFrame(stops, "stop_id string, stop_lat double, stop_lon double")
    from math import asin, cos, radians, sin, sqrt

    def m(a, b, c, d):
        return 12_742_000 * asin(sqrt(sin(radians(c - a) / 2) ** 2 + cos(radians(a)) * cos(radians(c)) * sin(radians(d - b) / 2) ** 2))

    want = {i: min((m(a, b, y, x), s) for s, y, x in stops) for i, a, b, _ in rows}
    want = {i: s for i, (d, s) in want.items() if d <= 100}
    got = {x["row_id"]: x["stop_id"] for x in enrich.nearest_stop(df.drop("stop_lat"), st, "row_id", 100.0).collect()}
    assert got == want and len(want) > 50
    left = enrich.nearest_stop(df.drop("stop_lat"), st, "row_id", 100.0, "left")
    assert left.count() == 300 and {x["row_id"]: x["stop_id"] for x in left.where("stop_id is not null").collect()} == want


def test_first_of_with_nulls_and_percentiles(spark):
    df = spark.createDataFrame([(1, None, 5.0), (2, None, None), (3, "a", 1.0), (4, "a", 2.0), (5, "a", 2.0)], "id int, k string, x double")
    assert sorted(r["id"] for r in dedup.first_of(df, ["k"], ["x", "id"]).collect()) == [2, 3]
    assert sorted(r["id"] for r in dedup.first_of(df, ["k"], ["x", "id"], last=True).collect()) == [1, 5]
    p = {r["k"]: r["m"] for r in kpi.percentiles(df, ["k"], "x", {"m": 0.5}).collect()}
    assert p == {None: 5.0, "a": 2.0} and kpi.percentiles(df.limit(0), [], "x", {"m": 0.5}).first()["m"] is None


def test_folders_and_streaming_settings(spark):
    assert lineage.shared_folder(spark) and lineage.new_store(spark, "x") != lineage.new_store(spark, "x")
    assert "spark.sql.shuffle.partitions" in STREAMING and build_session.__doc__
    with pytest.raises(errors.JobError):
        jobs.run(spark, "nothing", "", "")
    assert set(jobs.components(spark)) == {"text", "delta", "kafka", "postgresql"}


def test_trip_marks_across_days(spark):
    rows = [(1, "a", T0), (2, "a", T0 + timedelta(days=2)), (3, "a", T0 + timedelta(days=2)), (4, "b", T0), (5, None, T0), (6, None, T0 + timedelta(minutes=3))]
    got = {r["row_id"]: (r["point"], r["is_trip_start"], r["is_trip_end"], r["elapsed_minutes"]) for r in telemetry.trip_marks(spark.createDataFrame(rows, "row_id int, trip string, ts timestamp"), "trip").collect()}
    assert got == {1: (1, True, False, 0), 2: (2, False, False, 2880), 3: (3, False, True, 2880), 4: (1, True, True, 0), 5: (1, True, False, 0), 6: (2, False, True, 3)}
