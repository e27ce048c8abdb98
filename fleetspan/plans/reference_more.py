"""Windows, top-k, sets, deduplication, expressions, quality and serving queries; a continuation of ``reference``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from fleetspan.functions import columns as X
from fleetspan.functions.geo import haversine_m, heading_deg
from fleetspan.operators import dedup, enrich, kpi, quality, telemetry
from fleetspan.plans import layers, views
from fleetspan.plans.layers import positions, silver, with_clock
from fleetspan.plans.reference import DAILY, FLAGS, HOURLY, LINES, QUERIES, SEC, SILVER, SQL, TEL, TXT, P, flagged, hav, query, r6, six, tel, text
from fleetspan.session import table
from fleetspan.settings import BOXES

__all__ = ["QUERIES", "SQL"]

# --- windows ---------------------------------------------------------------------------------------------------------


@query(f"WITH {TEL} SELECT row_id, vehicle_id, round(distance_km, 6) AS distance_km, elapsed_s::BIGINT AS elapsed_s, round(speed_kmh, 6) AS speed_kmh FROM tel")
def f1_telemetry(s, d):
    return tel(s, d).select("row_id", "vehicle_id", r6("distance_km"), "elapsed_s", r6("speed_kmh"))


@query(f"""WITH {P}, st AS (SELECT *, lag(latitude) OVER w AS la, lag(longitude) OVER w AS lo, lag(ts) OVER w AS t0 FROM p WHERE vehicle_id IS NOT NULL AND ts IS NOT NULL WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, row_id)),
 q AS (SELECT *, {hav("la", "lo", "latitude", "longitude")} * 1000 AS m, {SEC.format("ts")} - {SEC.format("t0")} AS e FROM st) SELECT row_id, CASE WHEN e > 0 THEN round(m / 1000 / (e / 3600.0), 4) END AS calculated_speed FROM q""")
def f2_calculated_speed(s, d):
    df = telemetry.steps(positions(s, d).where("vehicle_id is not null and ts is not null"), limit=None)
    return df.select("row_id", F.round("speed_kmh", 4).alias("calculated_speed"))


@query(f"""WITH {P} SELECT row_id, row_number() OVER w AS point, row_number() OVER w = 1 AS is_trip_start, row_number() OVER w = count(*) OVER (PARTITION BY trip) AS is_trip_end, round(({SEC.format("ts")} - first_value({SEC.format("ts")}) OVER w) / 60.0, 6) AS elapsed_minutes
 FROM (SELECT *, vehicle_id || '/' || route_id AS trip FROM p WHERE vehicle_id IS NOT NULL AND route_id IS NOT NULL AND ts IS NOT NULL) WINDOW w AS (PARTITION BY trip ORDER BY ts, row_id)""")
def f3_trip_marks(s, d):
    df = positions(s, d).where("vehicle_id is not null and route_id is not null and ts is not null").withColumn("trip", F.concat_ws("/", "vehicle_id", "route_id"))
    return telemetry.trip_marks(df, "trip").select("row_id", F.col("point").cast("bigint").alias("point"), "is_trip_start", "is_trip_end", r6("elapsed_minutes"))


@query(f"WITH {P} SELECT row_id, count(*) OVER (PARTITION BY vehicle_id, ts) > 1 AS is_duplicate FROM p WHERE vehicle_id IS NOT NULL AND ts IS NOT NULL")
def f5_flag_all_copies(s, d):
    return dedup.flag_all(positions(s, d).where("vehicle_id is not null and ts is not null"), ["vehicle_id", "ts"]).select("row_id", "is_duplicate")


@query(f"WITH {P} SELECT vehicle_id, row_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC NULLS LAST, row_id DESC) AS rn FROM p WHERE vehicle_id IS NOT NULL) WHERE rn = 1")
def f6_latest_position(s, d):
    return dedup.deduplicated(positions(s, d).where("vehicle_id is not null"), "last", ts="ts").select("vehicle_id", "row_id")


@query(f"WITH {DAILY} SELECT strftime(date, '%Y-%m-%d') AS date, peak_hour::INT AS peak_hour, peak_hour_vehicles FROM peak")
def f7_peak_hour(s, d):
    return kpi.peak_hours(tel(s, d)).select(F.date_format("date", "yyyy-MM-dd").alias("date"), "peak_hour", "peak_hour_vehicles")


@query(f"""WITH {P}, g AS (SELECT route_id, ({SEC.format("lead(ts) OVER (PARTITION BY route_id ORDER BY ts, row_id)")} - {SEC.format("ts")}) / 60.0 AS m FROM p WHERE ts IS NOT NULL) SELECT route_id, round(avg(m), 6) AS avg_gap FROM g WHERE m IS NOT NULL GROUP BY 1""")
def f9_lead_headway(s, d):
    gaps = kpi.headways(positions(s, d).where("ts is not null").select("route_id", "ts", "row_id"), "route_id", None)  # to the next is from the one before
    return gaps.groupBy("route_id").agg(six(F.avg("headway_minutes")).alias("avg_gap"))


@query(f"""WITH {P}, m AS (SELECT line_id, avg(speed) AS a, stddev_samp(speed) AS s FROM p GROUP BY 1) SELECT row_id, round((speed - a) / nullif(s, 0), 5) AS z, coalesce(abs((speed - a) / nullif(s, 0)) > 3, false) AS is_anomaly FROM p JOIN m USING (line_id)""")
def f10_speed_z_score(s, d):
    return telemetry.z_scores(positions(s, d), "speed", ["line_id"]).select("row_id", F.round("z", 5).alias("z"), "is_anomaly")


@query(f"""WITH {P}, mv AS (SELECT *, coalesce(({SEC.format("ts")} - lag({SEC.format("ts")}) OVER (PARTITION BY vehicle_id ORDER BY ts, row_id) > 300)::INT, 1) AS cut FROM p WHERE speed > 5 AND vehicle_id IS NOT NULL AND ts IS NOT NULL),
 n AS (SELECT *, sum(cut) OVER (PARTITION BY vehicle_id ORDER BY ts, row_id ROWS UNBOUNDED PRECEDING) AS session FROM mv) SELECT vehicle_id, session::BIGINT AS session, {TXT.format("min(ts)")} AS started_at, {TXT.format("max(ts)")} AS ended_at, count(*) AS points, round(avg(speed), 6) AS avg_speed FROM n GROUP BY 1, 2""")
def f11_moving_sessions(s, d):
    df = telemetry.sessions(positions(s, d).where("vehicle_id is not null and ts is not null"))
    return df.select("vehicle_id", "session", text("started_at").alias("started_at"), text("ended_at").alias("ended_at"), "points", r6("avg_speed"))


# --- top-k, snapshots ------------------------------------------------------------------------------------------------


@query("SELECT line_id, count(*) AS n FROM vehicle_positions WHERE line_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, line_id LIMIT 10")
def g1_top_lines(s, d):
    return table(s, d, "vehicle_positions").where("line_id is not null").groupBy("line_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "line_id").limit(10)


@query(f"""WITH {LINES} SELECT line_id, line_name, round(avg_speed_kmh, 6) AS avg_speed_kmh, CASE WHEN avg_speed_kmh < 10 THEN 'Critical' WHEN avg_speed_kmh < 15 THEN 'High' WHEN avg_speed_kmh < 20 THEN 'Medium' ELSE 'Low' END AS congestion_level
 FROM perf WHERE avg_speed_kmh < 20 ORDER BY round(avg_speed_kmh, 6), line_id, line_name NULLS LAST LIMIT 50""")
def g3_congestion_hotspots(s, d):
    g = kpi.gold_lines(tel(s, d)).where("avg_speed_kmh < 20").withColumn("congestion_level", X.congestion_level(F.col("avg_speed_kmh")))
    return g.select("line_id", "line_name", r6("avg_speed_kmh"), "congestion_level").orderBy("avg_speed_kmh", "line_id", F.asc_nulls_last("line_name")).limit(50)


@query("""SELECT line_id, round(avg_speed, 6) AS avg_speed, strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS at FROM kpi_by_line WHERE avg_speed < 15 AND "timestamp" > (SELECT max("timestamp") FROM kpi_by_line) - INTERVAL 2 HOURS""")
def g4_congested_lines(s, d):
    return views.congested_lines(s, table(s, d, "kpi_by_line"), below=15.0, hours=2)


@query(f"WITH {P} SELECT vehicle_id, latitude, longitude, {TXT.format('ts')} AS at FROM p WHERE vehicle_id = (SELECT min(vehicle_id) FROM p) AND ts IS NOT NULL ORDER BY ts DESC, row_id DESC LIMIT 1")
def g5_latest_of_vehicle(s, d):
    p = positions(s, d)
    one = p.agg(F.min("vehicle_id").alias("vehicle_id"))
    return p.join(F.broadcast(one), "vehicle_id").where("ts is not null").orderBy(F.desc("ts"), F.desc("row_id")).limit(1).select("vehicle_id", "latitude", "longitude", text("ts").alias("at"))


@query('SELECT total_vehicles, total_lines, coverage_percentage, stale_percentage, data_source FROM kpi_realtime ORDER BY "timestamp" DESC, id DESC LIMIT 1')
def g6_latest_snapshot(s, d):
    cols = ["total_vehicles", "total_lines", "coverage_percentage", "stale_percentage", "data_source"]
    return table(s, d, "kpi_realtime").agg(F.max_by(F.struct(*cols), F.struct("timestamp", "id")).alias("r")).select("r.*")


@query('SELECT line_id, total_vehicles, round(avg_speed, 1) AS avg_speed FROM kpi_by_line WHERE "timestamp" = (SELECT max("timestamp") FROM kpi_by_line) ORDER BY total_vehicles DESC, line_id LIMIT 15')
def g8_lines_at_latest(s, d):
    k = table(s, d, "kpi_by_line")
    at = k.join(F.broadcast(k.agg(F.max("timestamp").alias("timestamp"))), "timestamp")
    return at.select("line_id", "total_vehicles", F.round("avg_speed", 1).alias("avg_speed")).orderBy(F.desc("total_vehicles"), "line_id").limit(15)


@query("""SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS at, total_vehicles, stale_percentage FROM kpi_realtime WHERE "timestamp" > (SELECT max("timestamp") FROM kpi_realtime) - INTERVAL 2 HOURS""")
def g9_two_hours(s, d):
    k = table(s, d, "kpi_realtime")
    last = k.agg(F.max("timestamp").alias("last"))
    return k.join(F.broadcast(last)).where("timestamp > last - interval 2 hours").select(text("timestamp").alias("at"), "total_vehicles", "stale_percentage")


@query(f"WITH {DAILY} SELECT strftime(date, '%Y-%m-%d') AS date, total_vehicles, total_lines, round(avg_speed_kmh, 6) AS avg_speed_kmh, peak_hour::INT AS peak_hour FROM daily LEFT JOIN peak USING (date) WHERE date > (SELECT max(received_at)::DATE FROM p) - 7 AND date <= (SELECT max(received_at)::DATE FROM p)")
def g10_daily_trends(s, d):
    g = kpi.gold_daily(tel(s, d)).join(F.broadcast(positions(s, d).agg(F.to_date(F.max("received_at")).alias("today"))))
    return g.where("date > date_sub(today, 7) and date <= today").select(F.date_format("date", "yyyy-MM-dd").alias("date"), "total_vehicles", "total_lines", r6("avg_speed_kmh"), "peak_hour")


# --- sets and deduplication ------------------------------------------------------------------------------------------


@query("SELECT 'positions' AS source, count(*) AS n FROM vehicle_positions UNION ALL SELECT 'latest', count(*) FROM vehicle_positions_latest UNION ALL SELECT 'lines', count(*) FROM kpi_by_line")
def h1_union_all(s, d):
    names = {"positions": "vehicle_positions", "latest": "vehicle_positions_latest", "lines": "kpi_by_line"}
    return reduce(lambda a, b: a.unionByName(b), [table(s, d, t).agg(F.lit(n).alias("source"), F.count("*").alias("n")) for n, t in names.items()])


@query("SELECT DISTINCT round(latitude, 3) AS lat_key, round(longitude, 3) AS lon_key FROM vehicle_positions WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def h2_distinct_places(s, d):
    return enrich.places_to_look_up(table(s, d, "vehicle_positions"))


@query(f"WITH {P} SELECT row_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY row_id) AS rn FROM p) WHERE rn = 1")
def i1_first_by_key(s, d):
    return dedup.deduplicated(positions(s, d), "first", ts="ts").select("row_id")


@query(f"WITH {P} SELECT row_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY received_at DESC, row_id DESC) AS rn FROM p) WHERE rn = 1")
def i2_last_by_window(s, d):
    return dedup.first_of(positions(s, d), ["vehicle_id", "ts"], ["received_at", "row_id"], last=True).select("row_id")


@query(f"WITH {P} SELECT row_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, floor(epoch_us(ts) / 60000000) ORDER BY ts DESC, row_id DESC) AS rn FROM p WHERE ts IS NOT NULL) WHERE rn = 1")
def i3_latest_per_minute(s, d):
    return dedup.deduplicated(positions(s, d).where("ts is not null"), "time_window", ts="ts").select("row_id")


@query(f"WITH {SILVER} SELECT row_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY score DESC, row_id) AS rn FROM silver) WHERE rn = 1")
def i4_best_quality(s, d):
    return dedup.best_quality(silver(positions(s, d)), ["vehicle_id"], "data_quality_score", "row_id").select("row_id")


# --- expressions -----------------------------------------------------------------------------------------------------


@query(f"WITH {P} SELECT row_id, round({hav('latitude', 'longitude', '-23.55', '-46.63')} * 1000, 3) AS to_centre_m, round(((degrees(atan2(-46.63 - longitude, -23.55 - latitude)) % 360) + 360) % 360, 5) AS heading FROM p WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND latitude BETWEEN -24 AND -23")
def j1_distance_and_heading(s, d):
    p = positions(s, d).where("latitude between -24 and -23 and longitude is not null")
    a, b, c, e = F.col("latitude"), F.col("longitude"), F.lit(-23.55), F.lit(-46.63)
    return p.select("row_id", F.round(haversine_m(a, b, c, e), 3).alias("to_centre_m"), F.round(heading_deg(a, b, c, e), 5).alias("heading"))


@query(f"""WITH {P} SELECT row_id, hour(ts)::INT AS hour_of_day, (dayofweek(ts) + 1)::INT AS day_of_week, dayname(ts) AS day_name, dayofweek(ts) IN (6, 0) AS is_weekend, CASE WHEN hour(ts) BETWEEN 6 AND 11 THEN 'morning' WHEN hour(ts) BETWEEN 12 AND 17 THEN 'afternoon' WHEN hour(ts) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_period,
 (hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19) AND dayofweek(ts) NOT IN (6, 0) AS is_rush_hour, weekofyear(ts)::INT AS week_of_year, monthname(ts) AS month_name, quarter(ts)::INT AS quarter FROM p WHERE ts IS NOT NULL""")
def j5_calendar(s, d):
    df = enrich.with_calendar(positions(s, d).where("ts is not null"))
    return df.select("row_id", "hour_of_day", "day_of_week", "day_name", "is_weekend", "time_period", "is_rush_hour", "week_of_year", "month_name", "quarter")


@query("SELECT route_id, try_cast(split_part(split_part(trim(route_short_name), '-', 1), ':', 1) AS INT) % 24 AS hour FROM routes")
def j9_clock_hour(s, d):
    return table(s, d, "routes").select("route_id", X.clock_hour(F.split_part(F.trim("route_short_name"), F.lit("-"), F.lit(1))).alias("hour"))


@query("SELECT vehicle_id, coalesce(speed > 5, false) AS is_moving FROM vehicle_positions_latest")
def j10_is_moving(s, d):
    return table(s, d, "vehicle_positions_latest").select("vehicle_id", X.is_moving(F.col("speed")).alias("is_moving"))


@query("SELECT id, CASE WHEN avg_speed < 10 THEN 80 WHEN avg_speed < 15 THEN 50 WHEN avg_speed < 20 THEN 30 ELSE 10 END AS congestion_index, CASE WHEN avg_speed < 10 THEN 'Critical' WHEN avg_speed < 15 THEN 'High' WHEN avg_speed < 20 THEN 'Medium' ELSE 'Low' END AS congestion_level FROM kpi_by_line")
def j13_congestion(s, d):
    v = F.col("avg_speed")
    return table(s, d, "kpi_by_line").select("id", X.congestion_index(v).alias("congestion_index"), X.congestion_level(v).alias("congestion_level"))


@query("SELECT route_id, md5(route_short_name) AS digest, CASE WHEN length(route_long_name) > 20 THEN substr(route_long_name, 1, 17) || '...' ELSE route_long_name END AS short FROM routes")
def j17_strings(s, d):
    return table(s, d, "routes").select("route_id", F.md5("route_short_name").alias("digest"), X.truncated(F.col("route_long_name"), 20).alias("short"))


@query("SELECT event_id, (props ->> '$.k')::INT AS k FROM events")
def j18_json(s, d):
    return table(s, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT id, strftime(\"timestamp\" - INTERVAL 2 HOURS, '%Y-%m-%d %H:%M:%S') AS local_time FROM kpi_realtime")
def j21_local_time(s, d):
    return table(s, d, "kpi_realtime").select("id", text(F.from_utc_timestamp(F.col("timestamp").cast("timestamp"), "America/Sao_Paulo")).alias("local_time"))


@query(f"""WITH {P} SELECT row_id, coalesce(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AND NOT (latitude = 0 AND longitude = 0), false) AS place_ok, coalesce(speed BETWEEN 0 AND 120, false) AS speed_ok,
 coalesce(epoch_us(now) - epoch_us(ts) BETWEEN -3600000000 AND 86400000000, false) AS time_ok, coalesce(length(trim(vehicle_id)) BETWEEN 1 AND 50, false) AS vehicle_ok FROM p, clock""")
def j23_validators(s, d):
    p = with_clock(positions(s, d))
    return p.select("row_id", X.valid_place(F.col("latitude"), F.col("longitude")).alias("place_ok"), X.valid_speed(F.col("speed")).alias("speed_ok"), X.valid_time(F.col("ts"), F.col("now")).alias("time_ok"), X.valid_vehicle(F.col("vehicle_id")).alias("vehicle_ok"))


# --- quality ---------------------------------------------------------------------------------------------------------


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count_if({c} IS NULL) AS null_count, round(count_if({c} IS NULL) / count(*), 6) AS null_rate, count_if({c} IS NULL) / count(*) <= 0.05 AS passed FROM vehicle_positions" for c in ("vehicle_id", "latitude", "speed", "route_id")))
def k4_null_rates(s, d):
    return quality.null_rates(table(s, d, "vehicle_positions"), ["vehicle_id", "latitude", "speed", "route_id"]).withColumn("null_rate", six("null_rate"))


CHECKS = f"""{P}, a AS (SELECT count(*)::DOUBLE AS n, count_if(vehicle_id IS NOT NULL AND ts IS NOT NULL) / count(*) AS req, count_if(coalesce(latitude BETWEEN -23.9 AND -23.3 AND longitude BETWEEN -46.9 AND -46.3, false)) / count(*) AS pl,
 count_if(speed BETWEEN 5 AND 80) / count(*) AS pc, min(epoch_us(now) - epoch_us(ts)) / 60e6 AS age FROM p, clock), b AS (SELECT sum(c - 1) / sum(c) AS dup FROM (SELECT count(*) AS c FROM p GROUP BY vehicle_id, ts))"""


@query(f"""WITH {CHECKS} SELECT 'required_fields' AS check_name, round(req, 6) AS value, req >= 0.95 AS passed FROM a UNION ALL SELECT 'coordinates', round(pl, 6), pl >= 0.95 FROM a UNION ALL SELECT 'speed', round(pc, 6), pc >= 0.95 FROM a
 UNION ALL SELECT 'duplicates', round(dup, 6), dup <= 0.01 FROM b UNION ALL SELECT 'freshness_minutes', round(age, 6), age <= 10 FROM a UNION ALL SELECT 'record_count', n, n >= 1 FROM a""")
def k11_checks(s, d):
    return quality.checks(with_clock(positions(s, d)), ["vehicle_id", "ts"], ["vehicle_id", "ts"], F.col("now")).select("check_name", r6("value"), "passed")


@query(f"WITH {FLAGS} SELECT count(*) AS total_records, count_if(is_valid) AS valid_records, count_if(NOT is_valid) AS invalid_records, count_if(has_nulls) AS null_records, count_if(out_of_bounds OR invalid_speed) AS out_of_range_records, round(count_if(is_valid) * 100.0 / count(*), 6) AS quality_score FROM f")
def k12_flag_summary(s, d):
    return quality.flag_summary(flagged(s, d)).withColumn("quality_score", six("quality_score"))


@query(f"""WITH {P}, k AS (SELECT count(*) AS n FROM (SELECT DISTINCT vehicle_id, ts FROM p)) SELECT count(*) AS total, round(count(vehicle_id) * 100.0 / count(*), 6) AS completeness_vehicle, round(count(latitude) * 100.0 / count(*), 6) AS completeness_latitude, round(count_if(speed BETWEEN 0 AND 120) * 100.0 / count(*), 6) AS validity, round((SELECT n FROM k) * 100.0 / count(*), 6) AS uniqueness FROM p""")
def k14_dimensions(s, d):
    out = quality.dimensions(positions(s, d), {"vehicle": F.col("vehicle_id"), "latitude": F.col("latitude")}, F.col("speed").between(0, 120), ["vehicle_id", "ts"])
    return out.select("total", *[r6(c) for c in out.columns if c != "total"])


@query(f"""WITH {P}, a AS (SELECT count_if(vehicle_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND ts IS NOT NULL) * 100.0 / count(*) AS c, count_if(latitude BETWEEN -23.9 AND -23.3 AND longitude BETWEEN -46.9 AND -46.3) * 100.0 / count(*) AS x,
 count_if(epoch_us(now) - epoch_us(ts) <= 600000000) * 100.0 / count(*) AS t FROM p, clock), b AS (SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) * 100.0 / sum(n) AS k FROM (SELECT count(*) AS n FROM p GROUP BY vehicle_id, ts))
 SELECT round(c, 6) AS completeness, round(x, 6) AS accuracy, round(k, 6) AS consistency, round(t, 6) AS timeliness, round((c + x + k + t) / 4, 6) AS overall, CASE WHEN (c + x + k + t) / 4 >= 95 THEN 'EXCELLENT' WHEN (c + x + k + t) / 4 >= 90 THEN 'GOOD' ELSE 'NEEDS_ATTENTION' END AS status FROM a, b""")
def k16_four_dimensions(s, d):
    out = quality.four_dimensions(with_clock(positions(s, d)), F.col("now"), ["vehicle_id", "ts"])
    return out.select(*[r6(c) for c in ("completeness", "accuracy", "consistency", "timeliness", "overall")], "status")


@query(f"""WITH {FLAGS}, m AS (SELECT 'quality_score' AS metric, count_if(is_valid) * 100.0 / count(*) AS value FROM f UNION ALL SELECT 'null_percent', count_if(has_nulls) * 100.0 / count(*) FROM f UNION ALL SELECT 'out_of_bounds_percent', count_if(out_of_bounds) * 100.0 / count(*) FROM f
 UNION ALL SELECT 'invalid_speed_percent', count_if(invalid_speed) * 100.0 / count(*) FROM f UNION ALL SELECT 'stale_percent', count_if(stale_timestamp) * 100.0 / count(*) FROM f)
 SELECT metric, round(value, 6) AS value, CASE WHEN metric = 'quality_score' AND value < 90 THEN 'ERROR' ELSE 'WARNING' END AS severity FROM m WHERE (metric = 'quality_score' AND value < 95) OR (metric = 'null_percent' AND value > 5) OR (metric IN ('out_of_bounds_percent', 'invalid_speed_percent') AND value > 1) OR (metric = 'stale_percent' AND value > 10)""")
def k18_alerts(s, d):
    pct = lambda c: F.count_if(c) * 100.0 / F.count("*")
    one = flagged(s, d).agg(pct("is_valid").alias("a"), pct("has_nulls").alias("b"), pct("out_of_bounds").alias("c"), pct("invalid_speed").alias("d"), pct("stale_timestamp").alias("e"))
    long = one.select(F.expr("stack(5, 'quality_score', a, 'null_percent', b, 'out_of_bounds_percent', c, 'invalid_speed_percent', d, 'stale_percent', e) as (metric, value)"))
    return quality.alerts(long).select("metric", r6("value"), "severity")


@query("WITH m AS (SELECT 'latency_seconds' AS metric, avg((epoch_us(created_at) - epoch_us(\"timestamp\")) / 1e6) AS value FROM kpi_realtime) SELECT metric, round(value, 4) AS value, 'MEDIUM' AS priority FROM m WHERE value > 60")
def k21_recommendations(s, d):
    x = (F.unix_micros(F.col("created_at").cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))) / 1e6
    m = table(s, d, "kpi_realtime").agg(F.avg(x).alias("value")).select(F.lit("latency_seconds").alias("metric"), "value")
    return quality.recommendations(m).select("metric", F.round("value", 4).alias("value"), "priority")


# --- streaming plans on static input, serving views -------------------------------------------------------------------


@query(f"""WITH {P}, w AS (SELECT *, time_bucket(INTERVAL '1 minute', ts) - INTERVAL '1 minute' * i AS ws FROM p, range(5) r(i) WHERE ts IS NOT NULL AND vehicle_id IS NOT NULL)
 SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, route_id, count(DISTINCT vehicle_id) AS vehicle_count, count(*) AS position_count, round(sum(speed) / nullif(count(speed), 0), 6) AS avg_speed, max(speed) AS max_speed, count_if(coalesce(speed > 5, false)) AS moving_count FROM w GROUP BY 1, 2""")
def l3_sliding_windows(s, d):
    w = kpi.windowed(positions(s, d).where("ts is not null and vehicle_id is not null"), "route_id", ts="ts")
    return w.select(text("window_start").alias("window_start"), "route_id", "vehicle_count", "position_count", r6("avg_speed"), "max_speed", "moving_count")


@query("SELECT vehicle_id, round(latitude, 3) AS lat_key, 'Zone ' || CAST(floor(latitude * 10) AS INT) AS address FROM vehicle_positions_latest WHERE latitude IS NOT NULL AND longitude IS NOT NULL")
def m3_geocode_lookup(s, d):
    at = table(s, d, "vehicle_positions_latest").where("latitude is not null and longitude is not null")
    places = at.select("latitude", "longitude")
    lookup = enrich.places_to_look_up(places).withColumn("known", F.lit(1))
    out = enrich.geocoded(at, lookup).where("known = 1")
    return out.select("vehicle_id", F.round("latitude", 3).alias("lat_key"), F.concat(F.lit("Zone "), F.floor(F.col("latitude") * 10).cast("int").cast("string")).alias("address"))


@query(f"""WITH {DAILY} SELECT strftime(date, '%Y-%m-%d') AS date, total_vehicles AS v, total_lines AS l, round(avg_speed_kmh, 4) AS s, peak_hour::INT AS h FROM daily LEFT JOIN peak USING (date)""")
def m7_fleet_kpis_json(s, d):
    doc = views.fleet_document(kpi.gold_daily(tel(s, d)))
    j = F.from_json("document", "total_vehicles bigint, total_lines bigint, avg_speed_kmh double, peak_hour int")
    out = doc.select(F.date_format("date", "yyyy-MM-dd").alias("date"), j.alias("j"))
    return out.select("date", F.col("j.total_vehicles").alias("v"), F.col("j.total_lines").alias("l"), F.round("j.avg_speed_kmh", 4).alias("s"), F.col("j.peak_hour").alias("h"))




@query('SELECT r.total_vehicles, r.total_lines, r.coverage_percentage, r.data_source, q.lines FROM (SELECT * FROM kpi_realtime ORDER BY "timestamp" DESC, id DESC LIMIT 1) r LEFT JOIN (SELECT count(*) AS lines FROM kpi_by_line WHERE "timestamp" = (SELECT max("timestamp") FROM kpi_by_line)) q ON true')
def n2_dashboard_summary(s, d):
    return views.dashboard_summary(s, table(s, d, "kpi_realtime"), table(s, d, "kpi_by_line"))


@query('SELECT id FROM kpi_by_line WHERE "timestamp" >= (SELECT max("timestamp") FROM kpi_by_line) - INTERVAL 2 DAYS')
def n3_retained(s, d):
    k = table(s, d, "kpi_by_line")
    return k.join(F.broadcast(k.agg(F.max("timestamp").alias("last")))).where("timestamp >= last - interval 2 days").select("id")


@query("SELECT 'records' AS metric, data_source AS label, sum(records_processed)::DOUBLE AS value FROM kpi_realtime GROUP BY 2 UNION ALL SELECT 'polls', data_source, count(*)::DOUBLE FROM kpi_realtime GROUP BY 2")
def n11_metric_export(s, d):
    g = table(s, d, "kpi_realtime").groupBy("data_source").agg(F.sum("records_processed").cast("double").alias("a"), F.count("*").cast("double").alias("b"))
    return g.select("data_source", F.expr("stack(2, 'records', a, 'polls', b) as (metric, value)")).select("metric", F.col("data_source").alias("label"), "value")


@query("""SELECT data_source, round(quantile_cont(stale_percentage, 0.95), 6) AS p95, round(quantile_cont(stale_percentage, 0.99), 6) AS p99, round(avg(stale_percentage), 6) AS mean, (max(records_processed) - min(records_processed))::INT AS spread FROM kpi_realtime GROUP BY 1""")
def n12_panels(s, d):
    g = table(s, d, "kpi_realtime").groupBy("data_source")
    q = lambda x: six(F.percentile("stale_percentage", x))
    return g.agg(q(0.95).alias("p95"), q(0.99).alias("p99"), six(F.avg("stale_percentage")).alias("mean"), (F.max("records_processed") - F.min("records_processed")).alias("spread"))


@query("SELECT CASE WHEN bool_and(stale_percentage < 50) THEN 'healthy' WHEN bool_or(stale_percentage >= 50) THEN 'degraded' ELSE 'unknown' END AS status FROM kpi_realtime WHERE stale_percentage IS NOT NULL")
def n13_health(s, d):
    c = table(s, d, "kpi_realtime").where("stale_percentage is not null").select(F.when(F.col("stale_percentage") < 50, "healthy").otherwise("unhealthy").alias("status"))
    return quality.health(c)


@query("SELECT count_if(NOT (latitude BETWEEN -24 AND -23)) AS outside, count_if(latitude IS NULL OR longitude IS NULL) AS unplaced, count(*) AS n FROM vehicle_positions_latest")
def k6_places(s, d):
    lat, lon = F.col("latitude"), F.col("longitude")
    return table(s, d, "vehicle_positions_latest").agg(F.count_if(~lat.between(BOXES["wide"][0], BOXES["wide"][1])).alias("outside"), F.count_if(lat.isNull() | lon.isNull()).alias("unplaced"), F.count("*").alias("n"))


# --- the rest of the inventory ---------------------------------------------------------------------------------------


@query("SELECT line_id, count(*) AS measurements, round(avg(avg_speed), 6) AS avg_speed, round(stddev_samp(avg_speed), 5) AS std_speed, round(avg(coverage_area_km2) / nullif(avg(total_vehicles) / 60.0, 0), 5) AS area_per_vehicle_hour FROM kpi_by_line GROUP BY 1")
def e22_route_metrics(s, d):
    g = table(s, d, "kpi_by_line").groupBy("line_id")
    ratio = F.try_divide(F.avg("coverage_area_km2"), F.avg("total_vehicles") / 60.0)
    return g.agg(F.count("*").alias("measurements"), six(F.avg("avg_speed")).alias("avg_speed"), F.round(F.stddev_samp("avg_speed"), 5).alias("std_speed"), F.round(ratio, 5).alias("area_per_vehicle_hour"))


@query("SELECT data_source AS stage, CASE WHEN stale_percentage > 10 THEN 'WARNING' ELSE 'OK' END AS status, round(avg(coverage_percentage), 6) AS avg_score, count(*) AS checks, strftime(max(\"timestamp\"), '%Y-%m-%d %H:%M:%S') AS last_check FROM kpi_realtime GROUP BY 1, 2")
def e28_quality_summary(s, d):
    k = table(s, d, "kpi_realtime").withColumn("status", F.when(F.col("stale_percentage") > 10, "WARNING").otherwise("OK"))
    return k.groupBy(F.col("data_source").alias("stage"), "status").agg(six(F.avg("coverage_percentage")).alias("avg_score"), F.count("*").alias("checks"), text(F.max("timestamp")).alias("last_check"))


@query("SELECT endpoint, count(*) AS calls, round(count_if(response_status = 200) * 100.0 / count(*), 6) AS success_percent, max(length(raw_json)) AS longest FROM api_raw GROUP BY 1")
def e33_call_statistics(s, d):
    g = table(s, d, "api_raw").groupBy("endpoint")
    return g.agg(F.count("*").alias("calls"), six(F.count_if(F.col("response_status") == 200) * 100.0 / F.count("*")).alias("success_percent"), F.max(F.length("raw_json")).cast("bigint").alias("longest"))


@query("SELECT request_id, endpoint, response_status FROM api_raw ORDER BY request_timestamp DESC, request_id DESC LIMIT 100")
def g7_recent_calls(s, d):
    return table(s, d, "api_raw").orderBy(F.desc("request_timestamp"), F.desc("request_id")).limit(100).select("request_id", "endpoint", "response_status")


@query("SELECT id, data_source, stale_percentage FROM kpi_realtime WHERE stale_percentage > 10")
def g11_active_alerts(s, d):
    return table(s, d, "kpi_realtime").where("stale_percentage > 10").select("id", "data_source", "stale_percentage")


@query("""SELECT strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS at, line_id, avg_speed FROM kpi_by_line WHERE avg_speed IS NOT NULL""")
def g12_speed_series(s, d):
    return table(s, d, "kpi_by_line").where("avg_speed is not null").select(text("timestamp").alias("at"), "line_id", "avg_speed")


@query(f"""WITH {P}, f AS (SELECT *, (vehicle_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND ts IS NOT NULL) AS full_row FROM p), a AS (SELECT count_if(full_row) * 100.0 / count(*) AS c, count_if(latitude BETWEEN -23.9 AND -23.3 AND longitude BETWEEN -46.9 AND -46.3) * 100.0 / count(*) AS x,
 count_if(epoch_us(now) - epoch_us(ts) <= 600000000) * 100.0 / count(*) AS t FROM f, clock), b AS (SELECT sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) * 100.0 / sum(n) AS k, count(*) * 100.0 / sum(n) AS u FROM (SELECT count(*) AS n FROM p GROUP BY vehicle_id, ts)),
 w AS (SELECT 0.30 * c + 0.25 * x + 0.20 * k + 0.15 * t + 0.10 * u AS score FROM a, b) SELECT round(score, 6) AS score, CASE WHEN score >= 95 THEN 'Excellent' WHEN score >= 90 THEN 'Good' WHEN score >= 85 THEN 'Acceptable' ELSE 'Critical' END AS band FROM w""")
def k17_weighted_score(s, d):
    p = positions(s, d)
    four = quality.four_dimensions(with_clock(p), F.col("now"), ["vehicle_id", "ts"])
    unique = p.groupBy("vehicle_id", "ts").count().agg((F.count("*") * 100.0 / F.sum("count")).alias("uniqueness"))
    score = quality.weighted_score({c: F.col(c) for c in ("completeness", "accuracy", "consistency", "timeliness", "uniqueness")})
    return four.join(F.broadcast(unique)).select(six(score).alias("score"), quality.score_band(score).alias("band"))


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows, count(*) - count({k}) AS null_keys, (SELECT count(*) FROM (SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys FROM {t}" for t, k in (("routes", "route_id"), ("zones", "zone_id"), ("vehicle_positions_latest", "vehicle_id"), ("api_raw", "request_id"))))
def k19_table_report(s, d):
    out = []
    for t, k in (("routes", "route_id"), ("zones", "zone_id"), ("vehicle_positions_latest", "vehicle_id"), ("api_raw", "request_id")):
        df = table(s, d, t)
        repeated = df.where(F.col(k).isNotNull()).groupBy(k).count().where("count > 1").agg(F.count("*").alias("repeated_keys"))
        out.append(df.agg(F.lit(t).alias("table_name"), F.count("*").alias("rows"), (F.count("*") - F.count(k)).alias("null_keys")).join(F.broadcast(repeated)))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("SELECT line_id, count(DISTINCT vehicle_id) AS vehicles_active, round(avg(speed), 6) AS avg_speed FROM vehicle_positions_latest WHERE \"timestamp\" > (SELECT max(\"timestamp\") FROM vehicle_positions_latest) - INTERVAL 30 MINUTES GROUP BY 1")
def m6_active_lines(s, d):
    p = table(s, d, "vehicle_positions_latest").withColumn("ts", F.col("timestamp").cast("timestamp"))
    return views.active_lines(s, p, 30).select("line_id", "vehicles_active", six("avg_speed").alias("avg_speed"))


@query(f"WITH {P} SELECT year(ts)::INT AS year, month(ts)::INT AS month, count(*) AS n, ts < (SELECT max(received_at) FROM p) - INTERVAL 90 DAYS AS expired FROM p WHERE ts IS NOT NULL GROUP BY ALL")
def n4_month_partitions(s, d):
    p = with_clock(positions(s, d)).where("ts is not null")
    return p.groupBy(F.year("ts").alias("year"), F.month("ts").alias("month"), F.expr("ts < now - interval 90 days").alias("expired")).agg(F.count("*").alias("n"))
