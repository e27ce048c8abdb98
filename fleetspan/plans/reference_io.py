"""Queries that go through sources, sinks, streams, jobs and the pipeline's own record. They write to stores in the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetspan import jobs
from fleetspan.functions import columns as X
from fleetspan.operators import clean, control, enrich, kpi, quality
from fleetspan.plans import layers
from fleetspan.plans.layers import positions, silver, with_clock
from fleetspan.plans.reference import DAILY, HOURLY, SILVER, TXT, P, query, r6, six, tel, text
from fleetspan.plans.reference_more import QUERIES, SQL
from fleetspan.session import table
from fleetspan.settings import DEFAULTS
from fleetspan.sources import consumer, geocode, gtfs, maintenance, sinks, synthetic
from fleetspan.sources.lineage import new_store
from fleetspan.streaming import positions as stream

__all__ = ["QUERIES", "SQL"]


# --- files, layers, figures ---------------------------------------------------------------------------------------------


def _feed(s, d) -> str:
    folder = new_store(s, "feed")
    routes = table(s, d, "routes").select(*[F.trim(c).alias(c) if k == "string" else F.col(c) for c, k in table(s, d, "routes").dtypes])
    routes.write.option("header", True).csv(f"{folder}/routes.txt")
    places = table(s, d, "vehicle_positions_latest").select(F.col("vehicle_id").alias("stop_id"), F.col("line_id").alias("stop_name"), F.col("latitude").alias("stop_lat"), F.col("longitude").alias("stop_lon"))
    places.write.option("header", True).csv(f"{folder}/stops.txt")
    return folder


@query("SELECT route_id, nullif(trim(agency_id), '') AS agency_id, nullif(trim(route_short_name), '') AS route_short_name, route_type::INT AS route_type FROM routes")
def a4_timetable_scan(s, d):
    return gtfs.load(s, _feed(s, d), "routes").select("route_id", "agency_id", "route_short_name", "route_type")


@query("SELECT 'routes' AS name, count(*) AS rows, false AS missing FROM routes UNION ALL SELECT 'stops', count(*), false FROM vehicle_positions_latest UNION ALL SELECT 'stop_times', 0, true UNION ALL SELECT 'trips', 0, true")
def a8_timetable_report(s, d):
    r = gtfs.report(s, _feed(s, d))
    return s.createDataFrame([(n, k, False) for n, k in r["rows"].items()] + [(n, 0, True) for n in r["missing"]], "name string, rows bigint, missing boolean")


@query()
def a11_synthetic_positions(s, d):
    return synthetic.positions(s, 10_000).select("vehicle_id", "line_id", "latitude", "longitude", text("timestamp").alias("at"), r6("speed"), "route_id")


@query("SELECT route_no AS route_id, 4 AS trips, 20 AS stop_times FROM (SELECT 'R' || lpad(i::VARCHAR, 3, '0') AS route_no FROM range(10) t(i))")
def a12_synthetic_timetable(s, d):
    t = synthetic.timetable(s)
    j = t["trips"].join(t["stop_times"], "trip_id").join(t["stops"], "stop_id").join(t["routes"], "route_id")
    return j.groupBy("route_id").agg(F.count_distinct("trip_id").cast("int").alias("trips"), F.count("*").cast("int").alias("stop_times"))


@query(f"WITH {P} SELECT year(t)::INT AS year, month(t)::INT AS month, day(t)::INT AS day, hour(t)::INT AS hour, 2 * count(*) AS n, round(2 * sum(speed), 4) AS speed_sum FROM (SELECT *, coalesce(ts, received_at) AS t FROM p) GROUP BY ALL")
def b1_bronze_append(s, d):
    path, rows = new_store(s, "bronze"), positions(s, d).withColumn("at", F.coalesce("ts", F.col("received_at").cast("timestamp")))
    for _ in range(2):
        sinks.write_layer(rows, path, "bronze", "at")
    return s.read.parquet(path).groupBy("year", "month", "day", "hour").agg(F.count("*").alias("n"), F.round(F.sum("speed"), 4).alias("speed_sum"))


@query("SELECT count(*) AS n, count(DISTINCT route_id) AS routes FROM routes")
def b2_timetable_overwrite(s, d):
    path = new_store(s, "routes")
    for _ in range(2):
        sinks.write_table(table(s, d, "routes"), path)
    return s.read.parquet(path).agg(F.count("*").alias("n"), F.count_distinct("route_id").alias("routes"))


@query(f"WITH {SILVER} SELECT year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day, count(*) AS n, count_if(is_duplicate) AS duplicates, round(avg(score), 6) AS score FROM silver GROUP BY ALL")
def b3_silver_append(s, d):
    path, rows = new_store(s, "silver"), silver(positions(s, d)).drop("__day")
    sinks.write_layer(rows, path, "silver", "ts", files_per_part=2)
    return sinks.read_layer(s, path, "silver", "ts", lambda: rows).groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.count_if("is_duplicate").alias("duplicates"), six(F.avg("data_quality_score")).alias("score"))


@query(f"WITH {HOURLY} SELECT year(hour_timestamp)::INT AS year, month(hour_timestamp)::INT AS month, count(*) AS n, sum(vehicles_active)::BIGINT AS vehicles, round(sum(total_distance_km), 3) AS km FROM hourly GROUP BY ALL")
def b4_gold_append(s, d):
    path, rows = new_store(s, "gold"), layers.gold_hourly(s, d)
    sinks.write_layer(rows, path, "gold", "hour_timestamp")
    return sinks.read_layer(s, path, "gold", "hour_timestamp", lambda: rows).groupBy("year", "month").agg(F.count("*").alias("n"), F.sum("vehicles_active").alias("vehicles"), F.round(F.sum("total_distance_km"), 3).alias("km"))


@query(f"WITH {DAILY} SELECT strftime(date, '%Y-%m-%d') AS date, total_vehicles, total_trips FROM daily")
def b9_merge_daily(s, d):
    path, g = new_store(s, "daily"), kpi.gold_daily(tel(s, d))
    for add in (1, 0):  # the second write has the same keys and wins
        sinks.merge_job(g.withColumn("total_trips", F.col("total_trips") + add), path, "daily", "date")
    return sinks.read_table(s, path, lambda: g).select(F.date_format("date", "yyyy-MM-dd").alias("date"), "total_vehicles", "total_trips")


@query(f"""WITH {P} SELECT 'coverage' AS kpi, {TXT.format("date_trunc('hour', ts)")} AS key, count(DISTINCT vehicle_id)::DOUBLE AS value FROM p GROUP BY 2
 UNION ALL SELECT 'speed', concat_ws(' ', line_id, {TXT.format("date_trunc('hour', ts)")}), round(avg(speed), 6) FROM p WHERE speed IS NOT NULL GROUP BY line_id, date_trunc('hour', ts)
 UNION ALL SELECT 'daily', strftime(ts, '%Y-%m-%d'), count(*)::DOUBLE FROM p GROUP BY 2""")
def b12_figures(s, d):
    path = new_store(s, "figures")
    sinks.write_figures(kpi.all_figures(positions(s, d), DEFAULTS.fleet_size), path)
    sinks.load_serving(s, path, ["coverage", "speed", "daily"])
    a = s.table("kpi_coverage").select(F.lit("coverage").alias("kpi"), text("hour").alias("key"), F.col("active_vehicles").cast("double").alias("value"))
    b = s.table("kpi_speed").select(F.lit("speed"), F.concat_ws(" ", "line_id", text("hour")), six("avg_speed"))
    return a.union(b).union(s.table("kpi_daily").select(F.lit("daily"), F.date_format("date", "yyyy-MM-dd"), F.col("total_records").cast("double")))


@query("SELECT 'before' AS state, count(*) AS n FROM routes UNION ALL SELECT 'after', 0")
def b14_truncated(s, d):
    path = new_store(s, "routes")
    sinks.write_table(table(s, d, "routes"), path)
    before = s.read.parquet(path).count()
    maintenance.truncate(s, path)
    maintenance.vacuum(s, path, 0)
    return s.createDataFrame([("before", before), ("after", s.read.parquet(path).count())], "state string, n bigint")


@query("SELECT line_id, count(*) AS n FROM vehicle_positions_latest GROUP BY 1")
def b15_serving_view(s, d):
    from fleetspan.plans import views

    (name,) = views.register({"latest": table(s, d, "vehicle_positions_latest")})
    return s.sql(f"SELECT line_id, count(*) AS n FROM {name} GROUP BY line_id")


@query("SELECT DISTINCT round(latitude, 3) AS lat_key, round(longitude, 3) AS lon_key, 'Zone ' || CAST(floor(round(latitude, 3) * 10 + 1e-9) AS INT) AS address, CASE WHEN latitude < -23.5 THEN 'south' ELSE 'north' END AS suburb FROM (SELECT round(latitude, 3) AS latitude, longitude FROM vehicle_positions_latest WHERE latitude IS NOT NULL AND longitude IS NOT NULL)")
def b19_lookup_table(s, d):
    return geocode.write_lookup(table(s, d, "vehicle_positions_latest"), new_store(s, "places"), _resolver).select("lat_key", "lon_key", "address", "suburb")


def _resolver(lat: float, lon: float) -> dict[str, str]:
    """Stands for a service: a zone by latitude."""
    import math

    return {"address": f"Zone {math.floor(lat * 10 + 1e-9)}", "road": f"Road {math.floor(lon * 10 + 1e-9)}", "suburb": "south" if lat < -23.5 else "north"}


@query("SELECT vehicle_id, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'Zone ' || CAST(floor(round(latitude, 3) * 10 + 1e-9) AS INT) END AS address FROM vehicle_positions_latest")
def m5_addresses(s, d):
    latest = table(s, d, "vehicle_positions_latest")
    return geocode.with_addresses(latest, geocode.write_lookup(latest, new_store(s, "places"), _resolver)).select("vehicle_id", "address")


@query("SELECT count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS placed, count(*) FILTER (WHERE latitude < -23.5 AND longitude IS NOT NULL) AS found, round(count(*) FILTER (WHERE latitude < -23.5 AND longitude IS NOT NULL) / count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL), 6) AS success_rate FROM (SELECT round(latitude, 3) AS latitude, longitude FROM vehicle_positions_latest)")
def m4_success_rate(s, d):
    latest, south = table(s, d, "vehicle_positions_latest"), lambda lat, lon: _resolver(lat, lon) if lat < -23.5 else None
    rows = geocode.with_addresses(latest, geocode.resolved(enrich.places_to_look_up(latest), south))
    return geocode.success_rate(rows).withColumn("success_rate", six("success_rate"))


# --- projections, checks ------------------------------------------------------------------------------------------------


@query("SELECT row_id, 'silver' AS processing_stage, 'job-1' AS job_id, strftime(received_at, '%Y-%m-%d %H:%M:%S') AS processed_at FROM vehicle_positions")
def c7_processing_marks(s, d):
    rows = clean.with_processing(table(s, d, "vehicle_positions"), "silver", "job-1", F.col("received_at"))
    return rows.select("row_id", "processing_stage", "job_id", text("processed_at").alias("processed_at"))


@query("SELECT count(*) AS rows, 8 AS columns FROM routes")
def c17_profile(s, d):
    p = clean.profile(table(s, d, "routes"))
    return s.createDataFrame([(p["rows"], p["columns"])], "rows bigint, columns int")


@query("SELECT route_id AS numero_da_linha, route_long_name AS nome, line_id AS nome_2 FROM routes")
def c18_plain_names(s, d):
    return clean.plain_names(table(s, d, "routes").select(F.col("route_id").alias("Número da Linha"), F.col("route_long_name").alias(" Nome!"), F.col("line_id").alias("nome")))


@query("SELECT route_code, round((on_time * 40 + occupancy * 30 + least(kmh, 1e9) / 50 * 30), 4) AS raw, round(least(100.0, greatest(0.0, on_time * 40 + occupancy * 30 + kmh / 50 * 30)), 4) AS score FROM (SELECT line_id || '/' || id AS route_code, coverage_area_km2 / 100 AS on_time, total_vehicles / 100.0 AS occupancy, avg_speed AS kmh FROM kpi_by_line) WHERE on_time IS NOT NULL AND kmh IS NOT NULL AND occupancy IS NOT NULL")
def j15_service_quality(s, d):
    k = table(s, d, "kpi_by_line").select(F.concat_ws("/", "line_id", "id").alias("route_code"), (F.col("coverage_area_km2") / 100).alias("on_time"), (F.col("total_vehicles") / 100.0).alias("occupancy"), F.col("avg_speed").alias("kmh"), "line_id")
    k = k.where("on_time is not null and occupancy is not null and kmh is not null and line_id is not null")
    raw = F.col("on_time") * 40 + F.col("occupancy") * 30 + F.col("kmh") / 50 * 30
    return k.select("route_code", F.round(raw, 4).alias("raw"), F.round(X.service_quality(F.col("on_time"), F.col("occupancy"), F.col("kmh")), 4).alias("score"))


SQL["j15_service_quality"] = SQL["j15_service_quality"].replace("WHERE on_time", "WHERE route_code IS NOT NULL AND on_time")


@query("SELECT vehicle_id, CASE WHEN speed BETWEEN 0 AND 120 THEN 'VALID' ELSE 'INVALID' END AS label, coalesce(speed > 40, false) AS peak FROM vehicle_positions_latest")
def j14_labels(s, d):
    return table(s, d, "vehicle_positions_latest").select("vehicle_id", X.speed_label(F.col("speed")).alias("label"), X.is_peak_load(F.col("speed")).alias("peak"))


@query("""WITH b AS (SELECT data_source, min("timestamp")::DATE AS a, max("timestamp")::DATE AS z FROM kpi_realtime WHERE data_source IS NOT NULL GROUP BY 1)
 SELECT data_source, strftime(day, 'year=%Y/month=%m/day=%d') AS path FROM (SELECT data_source, unnest(generate_series(a::TIMESTAMP, z::TIMESTAMP, INTERVAL 1 DAY)) AS day FROM b)""")
def j22_partition_paths(s, d):
    day = lambda f: F.to_date(f("timestamp")).cast("timestamp")
    span = table(s, d, "kpi_realtime").where("data_source is not null").groupBy("data_source").agg(day(F.min).alias("a"), day(F.max).alias("z"))
    return span.select("data_source", F.explode(X.days_between(F.col("a"), F.col("z"))).alias("day")).select("data_source", X.partition_path(F.col("day")).alias("path"))


@query("SELECT * FROM (VALUES ('route_id', 'string', 'string', true), ('route_type', 'bigint', 'int', false), ('stop_id', 'string', NULL, false)) t(column_name, expected, found, ok)")
def k3_schema_report(s, d):
    df = table(s, d, "routes").withColumn("route_type", F.col("route_type").cast("int"))
    assert quality.missing_columns(df, ["route_id", "stop_id"]) == ["stop_id"]
    return quality.schema_report(df, {"route_id": "string", "route_type": "bigint", "stop_id": "string"})


@query("SELECT round(count(latitude) / count(*), 6) AS known_latitude, round(count(longitude) / count(*), 6) AS known_longitude, round(count_if(speed BETWEEN 0 AND 120) / count(*), 6) AS valid_speed, round((count(latitude) + count(longitude) + count_if(speed BETWEEN 0 AND 120)) / 3.0 / count(*), 6) AS score FROM vehicle_positions")
def k15_pipeline_score(s, d):
    out = quality.pipeline_score(table(s, d, "vehicle_positions"), ["latitude", "longitude"], {"speed": F.col("speed").between(0, 120)})
    return out.select(*[r6(c) for c in out.columns])


# --- statistics of calls and loads ---------------------------------------------------------------------------------------


@query("SELECT data_source, count(*) AS calls, round(avg(x), 4) AS mean_s, round(min(x), 6) AS min_s, round(max(x), 6) AS max_s, round(stddev_samp(x), 3) AS std_s, round(count(stale_percentage) * 100.0 / count(*), 6) AS success_percent FROM (SELECT *, (epoch_us(created_at) - epoch_us(\"timestamp\")) / 1e6 AS x FROM kpi_realtime) GROUP BY 1")
def e33_latency_statistics(s, d):
    x = (F.unix_micros(F.col("created_at").cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))) / 1e6
    out = kpi.call_statistics(table(s, d, "kpi_realtime"), "data_source", x, F.col("stale_percentage").isNotNull())
    return out.select("data_source", "calls", F.round("mean_s", 4).alias("mean_s"), r6("min_s"), r6("max_s"), F.round("std_s", 3).alias("std_s"), r6("success_percent"))


@query("SELECT line_id, round(count_if(vehicles_0_20kmh = 0) * 100.0 / count(*), 6) AS utilization_percent, round(avg(vehicles_40_60kmh / nullif(total_vehicles, 0) * 100), 6) AS occupancy_percent FROM kpi_by_line GROUP BY 1")
def e23_load(s, d):
    out = kpi.utilization(table(s, d, "kpi_by_line"), "line_id", F.col("vehicles_0_20kmh") == 0, F.col("vehicles_40_60kmh"), F.col("total_vehicles"))
    return out.select("line_id", r6("utilization_percent"), r6("occupancy_percent"))


@query(f"""WITH {HOURLY}, n AS (SELECT max(received_at) AS now FROM p), {"dh AS" + DAILY.split(", dh AS", 1)[1]},
 c AS (SELECT sum(vehicles_active)::BIGINT AS vehicles_now, round(avg(avg_speed_kmh), 6) AS speed_now, count(DISTINCT line_id) AS lines_now FROM hourly, n WHERE hour_timestamp = date_trunc('hour', now)),
 h AS (SELECT round(avg(vehicles_active), 6) AS vehicles_24h_avg, round(avg(avg_speed_kmh), 6) AS speed_24h_avg, round(sum(total_distance_km), 4) AS distance_24h_total FROM hourly, n WHERE hour_timestamp > now - INTERVAL 24 HOURS),
 t AS (SELECT total_vehicles AS vehicles_today_total, total_lines AS lines_today_total, peak_hour_vehicles, peak_hour::INT AS peak_hour, round(data_quality_score, 6) AS dq_score_today FROM daily LEFT JOIN peak USING (date), n WHERE date = now::DATE)
 SELECT c.*, h.*, t.*, {TXT.format("now")} AS last_update FROM c CROSS JOIN h CROSS JOIN n LEFT JOIN t ON true""")
def n1_dashboard(s, d):
    return performance_dashboard(layers.gold_hourly(s, d), kpi.gold_daily(tel(s, d)), positions(s, d).agg(F.max(F.col("received_at").cast("timestamp")).alias("now")))


def performance_dashboard(hourly: DataFrame, daily: DataFrame, clock: DataFrame) -> DataFrame:
    """One row: the present hour, the last 24 hours and the present day (null where it has no figures), as of ``clock.now``."""
    h = hourly.join(F.broadcast(clock))
    this, recent = F.col("hour_timestamp") == F.date_trunc("hour", "now"), F.expr("hour_timestamp > now - interval 24 hours")
    of = lambda test, c: F.when(test, F.col(c))
    both = h.agg(
        F.sum(of(this, "vehicles_active")).alias("vehicles_now"), six(F.avg(of(this, "avg_speed_kmh"))).alias("speed_now"), F.count_distinct(of(this, "line_id")).alias("lines_now"),
        six(F.avg(of(recent, "vehicles_active"))).alias("vehicles_24h_avg"), six(F.avg(of(recent, "avg_speed_kmh"))).alias("speed_24h_avg"), F.round(F.sum(of(recent, "total_distance_km")), 4).alias("distance_24h_total"),
    )
    today = daily.join(F.broadcast(clock)).where(F.col("date") == F.to_date("now")).select(
        F.col("total_vehicles").alias("vehicles_today_total"), F.col("total_lines").alias("lines_today_total"), "peak_hour_vehicles", "peak_hour", r6("data_quality_score", "dq_score_today")
    )
    return both.join(F.broadcast(clock)).join(F.broadcast(today), F.lit(True), "left").withColumn("last_update", text("now")).drop("now")


# --- streams --------------------------------------------------------------------------------------------------------------

IN_STREAM = f"{P}, st AS (SELECT * FROM p WHERE vehicle_id IS NOT NULL AND ts IS NOT NULL AND latitude BETWEEN -24.0 AND -23.3 AND longitude BETWEEN -46.9 AND -46.3)"


def _messages(s, d) -> str:
    """Positions as JSON messages in files."""
    path = new_store(s, "messages")
    rows = positions(s, d).select("vehicle_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("timestamp"), "latitude", "longitude", "speed", F.col("route_id").alias("route_code"))
    rows.select(F.to_json(F.struct("*")).alias("value")).repartition(4).write.parquet(path)
    return path


@query(f"WITH {IN_STREAM} SELECT strftime(ts, '%Y-%m-%d') AS date, hour(ts)::INT AS hour, count(*) AS n, count_if(coalesce(speed > 5, false)) AS moving, round(sum(speed), 4) AS speed_sum FROM st GROUP BY 1, 2")
def l4_stream_to_files(s, d):
    path, out = _messages(s, d), new_store(s, "stream")
    rows = stream.transformed(stream.parsed(stream.file_stream(s, path, "value string"))).drop("processing_time")
    stream.to_files(rows, out, new_store(s, "cp"), every=None).awaitTermination()
    g = s.read.schema(rows.schema).parquet(out).groupBy(F.col("date").cast("string").alias("date"), F.col("hour").cast("int").alias("hour"))
    return g.agg(F.count("*").alias("n"), F.count_if("is_moving").alias("moving"), F.round(F.sum("speed"), 4).alias("speed_sum"))


@query(f"WITH {IN_STREAM} SELECT vehicle_id, {TXT.format('max(ts)')} AS last_seen FROM st GROUP BY 1")
def l6_last_positions(s, d):
    path, last = _messages(s, d), new_store(s, "last")
    rows = stream.transformed(stream.parsed(stream.file_stream(s, path, "value string", 1)))
    stream.keep_latest(rows.drop("processing_time"), last, new_store(s, "speeds"), new_store(s, "cp")).awaitTermination()
    like = lambda: positions(s, d).select("vehicle_id", "ts")
    return sinks.read_table(s, last, like).select("vehicle_id", text("ts").alias("last_seen"))


@query(f"WITH {P} SELECT count(*) AS messages, count(vehicle_id) AS with_vehicle FROM p")
def a15_poll_consumer(s, d):
    path, out = _messages(s, d), new_store(s, "taken")
    with consumer.PollConsumer(stream.file_stream(s, path, "value string", 1), new_store(s, "cp")) as c:
        stats = c.drain(lambda batch, n: batch.select(F.get_json_object("value", "$.vehicle_id").alias("v")).write.mode("overwrite").parquet(f"{out}/batch={n}"))
    return s.read.parquet(out).agg(F.lit(stats["messages"]).cast("bigint").alias("messages"), F.count("v").alias("with_vehicle"))


# --- jobs, control tables, metrics ----------------------------------------------------------------------------------------


@query(f"WITH {HOURLY} SELECT 'serving' AS job, count(*) AS n, 4 AS runs FROM (SELECT DISTINCT line_id, hour_timestamp FROM hourly)")
def n15_jobs(s, d):
    lake = new_store(s, "lake")
    out = jobs.run_all(s, d, lake)
    runs = control.recall(s, f"{lake}/control", "runs").where("status = 'success'").agg(F.count("*").cast("int").alias("runs"))
    return out.agg(F.lit("serving").alias("job"), F.count("*").alias("n")).join(F.broadcast(runs))


@query(f"""WITH {P}, a AS (SELECT count(DISTINCT vehicle_id)::DOUBLE AS v, count(DISTINCT line_id)::DOUBLE AS l, avg(speed) AS s, count(*)::DOUBLE AS n FROM p)
 SELECT 'fleet_size' AS metric, v AS value FROM a UNION ALL SELECT 'lines', l FROM a UNION ALL SELECT 'avg_speed', round(s, 6) FROM a UNION ALL SELECT 'rows', n FROM a""")
def n10_fleet_metrics(s, d):
    root = new_store(s, "control")
    control.record(kpi.fleet_metrics(positions(s, d)).withColumn("at", F.current_timestamp()), root, "metrics")
    return control.recall(s, root, "metrics").select("metric", r6("value"))


@query(SQL["k11_checks"].split(" SELECT 'required_fields'", 1)[0] + ", r AS (SELECT 'required_fields'" + SQL["k11_checks"].split(" SELECT 'required_fields'", 1)[1] + ") SELECT 'check_passed' AS metric, check_name AS label, passed::INT::DOUBLE AS value FROM r UNION ALL SELECT 'checks_passed_share', 'silver', round(avg(passed::INT), 6) FROM r")
def n9_check_metrics(s, d):
    root = new_store(s, "control")
    results = quality.checks(with_clock(positions(s, d)), ["vehicle_id", "ts"], ["vehicle_id", "ts"], F.col("now"))
    control.record(results.withColumns({"stage": F.lit("silver"), "checked_at": F.current_timestamp()}), root, "checks")
    return quality.check_metrics(control.recall(s, root, "checks"), "silver").select("metric", "label", r6("value"))


@query("SELECT 'fleet_records{label=\"' || data_source || '\"} ' || sum(records_processed)::DOUBLE AS line FROM kpi_realtime WHERE data_source IS NOT NULL GROUP BY data_source")
def n11_exposition(s, d):
    m = control.long_metrics(table(s, d, "kpi_realtime").where("data_source is not null"), {"records": F.sum("records_processed")}, ["data_source"])
    return control.exposition(m.select("metric", F.col("data_source").alias("label"), "value"))


@query("""WITH k AS (SELECT data_source AS label, "timestamp" AS tm, records_processed::DOUBLE AS value FROM kpi_realtime WHERE data_source IS NOT NULL AND records_processed IS NOT NULL),
 o AS (SELECT label, tm, max(value) AS value FROM k GROUP BY 1, 2), u AS (SELECT *, value - lag(value) OVER (PARTITION BY label ORDER BY tm) AS step FROM o)
 SELECT 'records' AS metric, label, round(avg(value), 6) AS mean, arg_max(value, tm) AS last, coalesce(sum(CASE WHEN step < 0 THEN value ELSE step END), 0.0) AS increase,
 round(coalesce(sum(CASE WHEN step < 0 THEN value ELSE step END), 0.0) / nullif(floor(epoch_us(max(tm)) / 1e6) - floor(epoch_us(min(tm)) / 1e6), 0), 6) AS rate FROM u GROUP BY label""")
def n12_series_panels(s, d):
    k = table(s, d, "kpi_realtime").where("data_source is not null and records_processed is not null")
    series = k.groupBy(F.lit("records").alias("metric"), F.col("data_source").alias("label"), F.col("timestamp").cast("timestamp").alias("at")).agg(F.max("records_processed").cast("double").alias("value"))
    return control.panels(series, top=1_000).select("metric", "label", r6("mean"), "last", "increase", r6("rate"))


@query("SELECT * FROM (VALUES ('events', 'healthy'), ('missing', 'unhealthy'), ('overall', 'degraded'), ('routes', 'healthy')) t(component, status)")
def n13_probes(s, d):
    asks = {n: lambda n=n: table(s, d, n).limit(1).count() == 1 for n in ("routes", "events")} | {"missing": lambda: table(s, d, "no_such_table").count() > 0}
    each = control.probe(s, asks)
    return each.select("component", "status").unionByName(quality.health(each).select(F.lit("overall").alias("component"), "status"))


@query("SELECT stage, metric, value FROM (VALUES ('a', 'stage_started', 2.0::DOUBLE), ('a', 'stage_succeeded', 2.0), ('b', 'stage_started', 1.0), ('b', 'stage_failed', 1.0)) t(stage, metric, value)")
def n8_stage_counters(s, d):
    c = control.Counters()
    good, bad = c.stage("a")(lambda: table(s, d, "routes").count()), c.stage("b")(lambda: table(s, d, "no_such_table"))
    good(), good()
    try:
        bad()
    except Exception as e:  # counted, then raised to here
        assert "no_such_table" in str(e)
    return c.frame(s).where("metric not in ('stage_seconds', 'stage_last_success')").select(F.col("label").alias("stage"), "metric", "value")


@query("SELECT count(*) AS n, count(DISTINCT line_id) AS lines FROM kpi_by_line WHERE line_id = (SELECT min(line_id) FROM kpi_by_line)")
def n14_skipping(s, d):
    path, k = new_store(s, "ordered"), table(s, d, "kpi_by_line")
    maintenance.write_skippable(k, path, ["line_id", "timestamp"], ["line_id"], 8)
    least = k.agg(F.min("line_id").alias("line_id"))
    return s.read.parquet(path).join(F.broadcast(least), "line_id").agg(F.count("*").alias("n"), F.count_distinct("line_id").alias("lines"))


@query("SELECT 1 AS files, true AS small, false AS compact")
def n5_table_health(s, d):
    path = new_store(s, "routes")
    sinks.write_table(table(s, d, "routes").coalesce(1), path)
    h = maintenance.table_health(s, path)
    return h.select(F.col("files").cast("int").alias("files"), (F.col("small_files") == F.col("files")).alias("small"), "compact")


@query("SELECT unnest(['bronze', 'silver', 'gold', 'serving']) AS job, unnest(['positions', 'bronze', 'silver', 'gold']) AS reads, true AS traced")
def n17_summary(s, d):
    found = maintenance.lineage(positions(s, d))
    traced = any("vehicle_positions" in f for f in found["files"])
    return s.createDataFrame([(j["name"], j["reads"], traced) for j in jobs.summary()["jobs"]], "job string, reads string, traced boolean")


@query("SELECT request_id, endpoint, response_status FROM api_raw WHERE request_timestamp IS NOT NULL ORDER BY request_timestamp DESC, request_id DESC LIMIT 100")
def g7_recent_runs(s, d):
    return control.recent_runs(table(s, d, "api_raw").where("request_timestamp is not null"), ["request_timestamp", "request_id"]).select("request_id", "endpoint", "response_status")


@query(f"WITH {P} SELECT line_id, round(quantile_cont(speed, 0.5), 6) AS p50, round(quantile_cont(speed, 0.95), 6) AS p95 FROM p WHERE speed IS NOT NULL GROUP BY 1")
def n12_percentiles(s, d):
    return kpi.percentiles(positions(s, d), ["line_id"], "speed", {"p50": 0.5, "p95": 0.95}).select("line_id", r6("p50"), r6("p95"))

