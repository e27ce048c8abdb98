"""One query for each operator of the inventory that has a table to run on, with the SQL of the same rows for DuckDB.

Names begin with the operator's id. Times come out as text, floating figures rounded to six digits.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.operators import clean, dedup, enrich, kpi, quality, telemetry
from fleetspan.plans import layers
from fleetspan.plans.layers import positions, silver, with_clock, with_telemetry
from fleetspan.session import table
from fleetspan.settings import BOXES, DEFAULTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Pieces of SQL. {P}: positions; {SILVER}: silver rows; {TEL}: telemetry; {HOURLY}: gold per hour
P = """p AS (SELECT row_id, lpad(ltrim(trim(vehicle_id, E' \\t\\n\\r'), '0'), 8, '0') AS vehicle_id, "timestamp" AS ts,
 line_id, latitude, longitude, speed, route_id, received_at, batch_id FROM vehicle_positions),
 clock AS (SELECT max(received_at) AS now FROM p)"""
SILVER = f"""{P}, silver AS (SELECT *, CASE WHEN is_duplicate THEN 0.5 WHEN route_id IS NULL THEN 0.8 WHEN speed IS NULL THEN 0.9 ELSE 1.0 END::DOUBLE AS score FROM (
 SELECT *, row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY received_at, row_id) > 1 AS is_duplicate FROM p
 WHERE vehicle_id IS NOT NULL AND line_id IS NOT NULL AND ts IS NOT NULL AND latitude BETWEEN -23.9 AND -23.3 AND longitude BETWEEN -46.9 AND -46.3))"""


def hav(a: str, b: str, c: str, d: str) -> str:
    """Great-circle kilometres; null if any part is null (least and greatest skip nulls)."""
    return f"(CASE WHEN {a} + {b} + {c} + {d} IS NOT NULL THEN 12742.0 * asin(sqrt(least(1.0, greatest(0.0, pow(sin((radians({c}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin((radians({d}) - radians({b})) / 2), 2))))) END)"


SEC = "floor(epoch_us({0}) / 1000000)"
TEL = f"""{SILVER}, st AS (SELECT *, lag(latitude) OVER w AS la, lag(longitude) OVER w AS lo, lag(ts) OVER w AS t0 FROM silver WHERE NOT is_duplicate WINDOW w AS (PARTITION BY vehicle_id ORDER BY ts, row_id)),
 st2 AS (SELECT *, {hav("la", "lo", "latitude", "longitude")} AS distance_km, {SEC.format("ts")} - {SEC.format("t0")} AS elapsed_s FROM st),
 tel AS (SELECT *, CASE WHEN elapsed_s > 0 AND distance_km / (elapsed_s / 3600.0) BETWEEN 0 AND 120 THEN distance_km / (elapsed_s / 3600.0) END AS speed_kmh FROM st2)"""
HOURLY = f"""{TEL}, hourly AS (SELECT line_id, route_id AS line_name, date_trunc('hour', ts) AS hour_timestamp, count(DISTINCT vehicle_id) AS vehicles_active, count_if(row_id % 3 = 0) AS vehicles_accessible,
 avg(speed_kmh) AS avg_speed_kmh, min(speed_kmh) AS min_speed_kmh, max(speed_kmh) AS max_speed_kmh, stddev_samp(speed_kmh) AS std_speed_kmh, sum(distance_km) AS total_distance_km, avg(score) AS data_quality_score,
 count(*) AS total_records, count_if(score >= 0.9) AS valid_records FROM tel GROUP BY 1, 2, 3)"""
DAILY = f"""{TEL}, dh AS (SELECT ts::DATE AS date, hour(ts) AS h, count(DISTINCT vehicle_id) AS n FROM tel GROUP BY 1, 2),
 peak AS (SELECT date, arg_max(h, n * 100 - h) AS peak_hour, max(n) AS peak_hour_vehicles, CASE WHEN count(*) > 1 THEN (sum(n) - max(n)) / (count(*) - 1) END AS off_peak_avg_vehicles FROM dh GROUP BY 1),
 daily AS (SELECT ts::DATE AS date, count(DISTINCT vehicle_id) AS total_vehicles, count(DISTINCT line_id) AS total_lines, count(*) AS total_trips, avg(speed_kmh) AS avg_speed_kmh, sum(distance_km) AS total_distance_km, avg(score) AS data_quality_score FROM tel GROUP BY 1)"""
LINES = f"""{TEL}, lh AS (SELECT line_id, route_id AS line_name, date_trunc('hour', ts) AS h, count(DISTINCT vehicle_id) AS n, sum(speed_kmh) AS s, count(speed_kmh) AS c, sum(score) AS q, count(score) AS qn FROM tel GROUP BY 1, 2, 3),
 perf AS (SELECT line_id, line_name, sum(s) / nullif(sum(c), 0) AS avg_speed_kmh, avg(n) AS avg_vehicles_operating, sum(q) / sum(qn) AS data_quality_score FROM lh GROUP BY 1, 2)"""
TXT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def query(sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.replace("count_if(", "count(*) FILTER (WHERE ").replace(", 6)", " + 1e-9, 6)")  # a bigint in DuckDB; see six()
        return f

    return add


def text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def six(c: Column | str) -> Column:
    """Six digits; the tiny addend rounds ties up whatever the order of the sums was."""
    return F.round((F.col(c) if isinstance(c, str) else c) + 1e-9, 6)


def r6(c: Column | str, name: str | None = None) -> Column:
    return six(c).alias(name or c)


def tel(s: SparkSession, d: str) -> DataFrame:
    return with_telemetry(silver(positions(s, d)))


# --- scans, sinks -------------------------------------------------------------------------------------------------------


@query("SELECT row_id, line_id, speed FROM vehicle_positions WHERE speed > 60 AND line_id IS NOT NULL")
def a1_scan_pruned(s, d):
    return table(s, d, "vehicle_positions").where("speed > 60 and line_id is not null").select("row_id", "line_id", "speed")


@query("SELECT route_id, agency_id, route_short_name, route_long_name, route_type::INT AS route_type, route_color, route_text_color FROM routes")
def a5_routes_typed(s, d):
    kinds = dict.fromkeys(("route_id", "agency_id", "route_short_name", "route_long_name", "route_color", "route_text_color"), "string") | {"route_type": "int"}
    return clean.typed(table(s, d, "routes").select(*kinds), kinds)


@query(f"WITH {P} SELECT year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day, hour(ts)::INT AS hour, count(*) AS n FROM p GROUP BY ALL")
def b5_event_partitions(s, d):
    return clean.with_time_parts(positions(s, d), "ts").groupBy("year", "month", "day", "hour").agg(F.count("*").alias("n"))


@query(f"""WITH {P}, new AS (SELECT vehicle_id, line_id, latitude, longitude, speed, ts FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY ts DESC, row_id DESC) AS rn FROM p WHERE vehicle_id IS NOT NULL AND ts IS NOT NULL) WHERE rn = 1),
 b AS (SELECT vehicle_id, line_id, latitude, longitude, speed, "timestamp" AS ts, 0 AS side FROM vehicle_positions_latest UNION ALL SELECT *, 1 FROM new),
 m AS (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY (ts IS NOT NULL) DESC, ts DESC, side DESC) AS rn FROM b)
 SELECT vehicle_id, line_id, latitude, longitude, speed, {TXT.format("ts")} AS ts FROM m WHERE rn = 1""")
def b8_merge_latest(s, d):
    cols = ["vehicle_id", "line_id", "latitude", "longitude", "speed", "ts"]
    old = table(s, d, "vehicle_positions_latest").withColumn("ts", F.col("timestamp").cast("timestamp")).select(*cols)
    new = dedup.first_of(positions(s, d).where("vehicle_id is not null and ts is not null"), ["vehicle_id"], ["ts", "row_id"], last=True).select(*cols)
    return dedup.merged_latest(old, new, ["vehicle_id"], "ts").withColumn("ts", text("ts"))


FLAGS = f"""{P}, fl AS (SELECT p.*, (vehicle_id IS NULL OR latitude IS NULL OR longitude IS NULL OR ts IS NULL) AS has_nulls, coalesce(NOT (latitude BETWEEN -24 AND -23 AND longitude BETWEEN -47 AND -46), false) AS out_of_bounds,
 coalesce(NOT (speed BETWEEN 0 AND 120), false) AS invalid_speed, coalesce(epoch_us(now) - epoch_us(ts) > 24 * 3600000000, false) AS stale_timestamp FROM p, clock),
 f AS (SELECT *, NOT (has_nulls OR out_of_bounds OR invalid_speed OR stale_timestamp) AS is_valid FROM fl)"""


def flagged(s, d):
    return quality.flags(with_clock(positions(s, d)), ["vehicle_id", "latitude", "longitude", "ts"], F.col("now"))


@query(f"WITH {FLAGS} SELECT row_id, has_nulls, out_of_bounds, invalid_speed, stale_timestamp FROM f WHERE NOT is_valid")
def b11_quarantine(s, d):
    return flagged(s, d).where("not is_valid").select("row_id", "has_nulls", "out_of_bounds", "invalid_speed", "stale_timestamp")


# --- projections and filters -----------------------------------------------------------------------------------------


@query(f"WITH {SILVER} SELECT row_id, vehicle_id, is_duplicate, score AS data_quality_score FROM silver")
def c2_silver(s, d):
    return silver(positions(s, d)).select("row_id", "vehicle_id", "is_duplicate", "data_quality_score")


@query(f"WITH {P} SELECT row_id, trim(line_id) AS line_id, try_cast(line_id AS INT) AS line_number, try_cast(batch_id AS INT) AS batch_number FROM p WHERE latitude BETWEEN -24 AND -23 AND longitude BETWEEN -47 AND -46")
def c3_box_trim_types(s, d):
    df = clean.trimmed(clean.inside_box(positions(s, d), box=BOXES["wide"]), ["line_id"])
    df = clean.typed(df.withColumns({"line_number": F.col("line_id"), "batch_number": F.col("batch_id")}), {"line_number": "int", "batch_number": "int"})
    return df.select("row_id", "line_id", "line_number", "batch_number")


@query("SELECT id, round(avg_speed, 2) AS avg_speed, round(max_speed, 2) AS max_speed, round(coverage_area_km2, 2) AS coverage_area_km2 FROM kpi_by_line")
def c11_rounded(s, d):
    return clean.rounded(table(s, d, "kpi_by_line").select("id", "avg_speed", "max_speed", "coverage_area_km2"))


@query("SELECT vehicle_id, coalesce(line_id, '?') AS line_id, coalesce(speed, 0.0) AS speed FROM vehicle_positions_latest")
def c12_filled(s, d):
    return table(s, d, "vehicle_positions_latest").fillna({"line_id": "?", "speed": 0.0}).select("vehicle_id", "line_id", "speed")


@query("SELECT route_id, upper(trim(route_short_name)) AS route_short_name, trim(route_long_name) AS route_long_name FROM routes WHERE length(upper(trim(route_short_name))) > 0")
def c13_clean_routes(s, d):
    return clean.clean_routes(table(s, d, "routes")).select("route_id", "route_short_name", "route_long_name")


@query("SELECT vehicle_id AS stop_id, latitude AS stop_lat, longitude AS stop_lon FROM vehicle_positions_latest WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND length(line_id) > 0")
def c14_placed_stops(s, d):
    stops = table(s, d, "vehicle_positions_latest").select(F.col("vehicle_id").alias("stop_id"), F.col("latitude").alias("stop_lat"), F.col("longitude").alias("stop_lon"), F.col("line_id").alias("stop_name"))
    return clean.placed_stops(stops).drop("stop_name")


@query(f"""WITH {P} SELECT row_id, vehicle_id FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id, ts ORDER BY row_id) AS rn FROM p WHERE latitude BETWEEN -24 AND -23 AND longitude BETWEEN -47 AND -46 AND speed BETWEEN 0 AND 120) WHERE rn = 1""")
def c15_silver_by_test_rules(s, d):
    df = clean.inside_box(positions(s, d), box=BOXES["wide"]).where(F.col("speed").between(0, 120))
    return dedup.first_of(df.select("row_id", "vehicle_id", "ts"), ["vehicle_id", "ts"], ["row_id"]).select("row_id", "vehicle_id")


@query("SELECT row_id, 'stream' AS source FROM vehicle_positions WHERE vehicle_id IS NOT NULL AND \"timestamp\" IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL")
def c16_valid_messages(s, d):
    return clean.valid_messages(table(s, d, "vehicle_positions"), ["vehicle_id", "timestamp", "latitude", "longitude"], "stream", F.current_timestamp()).select("row_id", "source")


# --- joins -----------------------------------------------------------------------------------------------------------


@query(f"WITH {P} SELECT row_id, p.route_id, r.route_short_name, r.route_long_name, r.line_id AS route_line_id FROM p LEFT JOIN routes r ON r.route_id = p.route_id")
def d1_route_enrichment(s, d):
    return enrich.with_routes(positions(s, d), table(s, d, "routes")).select("row_id", "route_id", "route_short_name", "route_long_name", "route_line_id")


@query(f"WITH {P} SELECT count(*) AS rows, count(r.route_long_name) AS matched, round(count(r.route_long_name) / count(*), 6) AS match_rate FROM p LEFT JOIN routes r ON r.route_id = p.route_id")
def d1_match_rate(s, d):
    return enrich.match_rate(enrich.with_routes(positions(s, d), table(s, d, "routes"))).withColumn("match_rate", six("match_rate"))


def _stops(s, d):
    at = table(s, d, "vehicle_positions_latest").where("speed = 0 and latitude between -24 and -23 and longitude between -47 and -46")
    return at.select(F.col("vehicle_id").alias("stop_id"), F.col("latitude").alias("stop_lat"), F.col("longitude").alias("stop_lon"))


NEAR = f"""{P}, st AS (SELECT vehicle_id AS stop_id, latitude AS a, longitude AS b FROM vehicle_positions_latest WHERE speed = 0 AND latitude BETWEEN -24 AND -23 AND longitude BETWEEN -47 AND -46),
 hit AS (SELECT row_id, stop_id, {hav("latitude", "longitude", "a", "b")} * 1000 AS m FROM p JOIN st ON abs(latitude - a) < 0.002 AND abs(longitude - b) < 0.002),
 best AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY m, stop_id) AS rn FROM hit WHERE m <= 50)"""


@query(f"WITH {NEAR} SELECT row_id, stop_id, round(m, 3) AS stop_distance_m FROM best WHERE rn = 1")
def d2_nearest_stop(s, d):
    return enrich.nearest_stop(positions(s, d), _stops(s, d), "row_id").select("row_id", "stop_id", F.round("stop_distance_m", 3).alias("stop_distance_m"))


@query(f"WITH {NEAR} SELECT p.row_id, stop_id FROM p LEFT JOIN (SELECT * FROM best WHERE rn = 1) USING (row_id)")
def d10_nearest_stop_left(s, d):
    return enrich.nearest_stop(positions(s, d), _stops(s, d), "row_id", how="left").select("row_id", "stop_id")


@query(f"""WITH {P}, j AS (SELECT p.row_id, p.vehicle_id, {hav("l.latitude", "l.longitude", "p.latitude", "p.longitude")} AS km, {SEC.format("p.ts")} - {SEC.format('l."timestamp"')} AS gap FROM p LEFT JOIN vehicle_positions_latest l ON l.vehicle_id = p.vehicle_id)
 SELECT row_id, round(coalesce(CASE WHEN gap > 0 AND gap <= 600 AND km / (gap / 3600.0) BETWEEN 0 AND 100 THEN km / (gap / 3600.0) END, 0.0), 6) AS computed_speed FROM j""")
def d3_snapshot_speed(s, d):
    before = table(s, d, "vehicle_positions_latest").select("vehicle_id", "latitude", "longitude", F.col("timestamp").cast("timestamp").alias("ts"))
    return telemetry.against_snapshot(positions(s, d), before).select("row_id", r6("computed_speed"))


def _arrivals(s, d):
    due = table(s, d, "orders").select(F.col("o_orderkey").alias("trip_id"), F.col("o_orderpriority").alias("line_id"), F.col("o_orderdate").cast("timestamp").alias("due"))
    came = table(s, d, "lineitem").select(F.col("l_orderkey").alias("trip_id"), F.col("l_linenumber").alias("stop_no"), F.col("l_shipdate").cast("timestamp").alias("came"))
    return came.join(due, "trip_id")


@query("SELECT l_orderkey AS trip_id, l_linenumber AS stop_no, ((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 60000000)::DOUBLE AS delay_min FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def d4_schedule_adherence(s, d):
    return _arrivals(s, d).select("trip_id", "stop_no", ((F.unix_micros("came") - F.unix_micros("due")) / 60e6).alias("delay_min"))


@query(f"WITH {P} SELECT r.route_long_name, count(*) AS trips FROM p LEFT JOIN routes r ON r.route_id = p.route_id GROUP BY 1 ORDER BY trips DESC, r.route_long_name NULLS LAST LIMIT 20")
def d6_busiest_routes(s, d):
    j = enrich.with_routes(positions(s, d), table(s, d, "routes"))
    return j.groupBy("route_long_name").agg(F.count("*").alias("trips")).orderBy(F.desc("trips"), F.asc_nulls_last("route_long_name")).limit(20)


@query("SELECT r.route_id, k.n FROM routes r LEFT JOIN (SELECT line_id, count(*) AS n FROM kpi_by_line GROUP BY 1) k ON k.line_id = split_part(trim(r.route_short_name), '-', 1)")
def d9_join_by_short_name(s, d):
    per_line = table(s, d, "kpi_by_line").groupBy(F.col("line_id").alias("code")).agg(F.count("*").alias("n"))
    return table(s, d, "routes").withColumn("code", F.split_part(F.trim("route_short_name"), F.lit("-"), F.lit(1))).join(per_line, "code", "left").select("route_id", "n")


# --- aggregates ------------------------------------------------------------------------------------------------------


@query(f"WITH {P} SELECT {TXT.format('date_trunc(' + chr(39) + 'hour' + chr(39) + ', ts)')} AS hour, count(DISTINCT vehicle_id) AS active_vehicles, count(*) AS total_records, round(count(DISTINCT vehicle_id) * 100.0 / 15000, 6) AS coverage_percent FROM p GROUP BY 1")
def e1_fleet_coverage(s, d):
    return kpi.fleet_coverage(positions(s, d), DEFAULTS.fleet_size).select(text("hour").alias("hour"), "active_vehicles", "total_records", r6("coverage_percent"))


@query(f"WITH {P} SELECT line_id, round(avg(speed), 6) AS avg_speed, round(stddev_samp(speed), 6) AS stddev_speed, min(speed) AS min_speed, max(speed) AS max_speed, count(*) AS sample_count FROM p WHERE speed IS NOT NULL GROUP BY 1")
def e2_speed_by_line(s, d):
    return kpi.speed_stats(positions(s, d), ["line_id"]).select("line_id", r6("avg_speed"), r6("stddev_speed"), "min_speed", "max_speed", "sample_count")


HEAD = f"""{P}, g AS (SELECT route_id AS stop_id, line_id, ({SEC.format("ts")} - lag({SEC.format("ts")}) OVER (PARTITION BY route_id, line_id ORDER BY ts, row_id)) / 60.0 AS m FROM p WHERE ts IS NOT NULL)"""


@query(f"""WITH {HEAD} SELECT stop_id, line_id, round(avg(m), 6) AS avg_headway_minutes, round(stddev_samp(m), 4) AS stddev_headway, round(min(m), 6) AS min_headway, round(max(m), 6) AS max_headway, count(*) AS sample_size,
 CASE WHEN avg(m) <= 5 THEN 'excellent' WHEN avg(m) <= 10 THEN 'good' WHEN avg(m) <= 15 THEN 'fair' ELSE 'poor' END AS headway_quality FROM g WHERE m IS NOT NULL GROUP BY 1, 2""")
def e3_headway(s, d):
    df = positions(s, d).where("ts is not null").withColumn("stop_id", F.col("route_id"))
    out = kpi.headway_summary(df)
    return out.select("stop_id", "line_id", r6("avg_headway_minutes"), F.round("stddev_headway", 4).alias("stddev_headway"), r6("min_headway"), r6("max_headway"), "sample_size", "headway_quality")


@query("""WITH a AS (SELECT o_orderpriority AS line_id, (epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0 AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
 SELECT line_id, round(avg(x), 6) AS avg_delay_minutes, round(stddev_samp(x), 4) AS stddev_delay, count(*) AS total_arrivals, round(count_if(abs(x) <= 90) * 100.0 / count(*), 6) AS on_time_percent, count_if(x < -90) AS early, count_if(x > 90) AS late FROM a WHERE x IS NOT NULL GROUP BY 1""")
def e4_punctuality(s, d):
    delay = (F.unix_micros("came") - F.unix_micros("due")) / 86_400e6
    return kpi.punctuality(_arrivals(s, d), "line_id", delay, 90).select("line_id", r6("avg_delay_minutes"), F.round("stddev_delay", 4).alias("stddev_delay"), "total_arrivals", r6("on_time_percent"), "early", "late")


@query(f"""WITH {P}, t AS (SELECT route_id, line_id, vehicle_id, min(ts) AS a, max(ts) AS b, avg(speed) AS v FROM p GROUP BY 1, 2, 3)
 SELECT line_id, count(*) AS total_trips, round(avg(({SEC.format("b")} - {SEC.format("a")}) / 60.0), 4) AS avg_duration_minutes, round(avg(v), 6) AS avg_speed, count(DISTINCT vehicle_id) AS unique_vehicles FROM t GROUP BY 1""")
def e5_trip_stats(s, d):
    return kpi.trip_stats(positions(s, d), trip="route_id").select("line_id", "total_trips", F.round("avg_duration_minutes", 4).alias("avg_duration_minutes"), r6("avg_speed"), "unique_vehicles")


@query(f"""WITH {P} SELECT strftime(ts, '%Y-%m-%d') AS date, count(DISTINCT vehicle_id) AS total_vehicles, count(DISTINCT line_id) AS total_lines, count(DISTINCT route_id) AS total_trips, count(*) AS total_records, round(avg(speed), 6) AS avg_speed, max(speed) AS max_speed,
 round(({SEC.format("max(ts)")} - {SEC.format("min(ts)")}) / 3600.0, 6) AS operational_hours FROM p GROUP BY 1""")
def e6_daily_summary(s, d):
    return kpi.daily_figures(positions(s, d), trip="route_id").select(F.date_format("date", "yyyy-MM-dd").alias("date"), "total_vehicles", "total_lines", "total_trips", "total_records", r6("avg_speed"), "max_speed", r6("operational_hours"))


@query(f"""WITH {P}, trips AS (SELECT line_id, vehicle_id, route_id, min(ts) AS a, max(ts) AS b FROM p GROUP BY 1, 2, 3) SELECT 'coverage' AS kpi, {TXT.format("date_trunc('hour', ts)")} AS key, count(DISTINCT vehicle_id)::DOUBLE AS value FROM p GROUP BY 2
 UNION ALL SELECT 'daily', strftime(ts, '%Y-%m-%d'), count(DISTINCT line_id)::DOUBLE FROM p GROUP BY 2 UNION ALL SELECT 'trips', line_id, count(*)::DOUBLE FROM trips GROUP BY 2
 UNION ALL SELECT 'speed', concat_ws(' ', line_id, {TXT.format("date_trunc('hour', ts)")}), round(avg(speed), 6) FROM p WHERE speed IS NOT NULL GROUP BY line_id, date_trunc('hour', ts)
 UNION ALL SELECT 'punctuality', line_id, count(*)::DOUBLE FROM p WHERE speed IS NOT NULL GROUP BY 2""")
def e7_all_figures(s, d):
    rows = positions(s, d).withColumn("trip_id", F.col("route_id"))
    f = kpi.all_figures(rows, DEFAULTS.fleet_size, rows.withColumn("delay_min", F.col("speed") - 20))
    named = {
        "coverage": (text("hour"), F.col("active_vehicles")), "daily": (F.date_format("date", "yyyy-MM-dd"), F.col("total_lines")), "trips": (F.col("line_id"), F.col("total_trips")),
        "speed": (F.concat_ws(" ", "line_id", text("hour")), six("avg_speed")), "punctuality": (F.col("line_id"), F.col("total_arrivals")),
    }
    return reduce(DataFrame.unionByName, [f[n].select(F.lit(n).alias("kpi"), k.alias("key"), v.cast("double").alias("value")) for n, (k, v) in named.items()])


@query(f"""WITH {HOURLY} SELECT line_id, line_name, {TXT.format("hour_timestamp")} AS hour_timestamp, vehicles_active, vehicles_accessible, round(avg_speed_kmh, 6) AS avg_speed_kmh, round(min_speed_kmh, 6) AS min_speed_kmh, round(max_speed_kmh, 6) AS max_speed_kmh,
 round(std_speed_kmh, 4) AS std_speed_kmh, round(total_distance_km, 6) AS total_distance_km, round(total_distance_km / vehicles_active, 6) AS avg_distance_per_vehicle_km, round(data_quality_score, 6) AS data_quality_score, total_records, valid_records FROM hourly""")
def e8_gold_hourly(s, d):
    g = layers.gold_hourly(s, d)
    six = ("avg_speed_kmh", "min_speed_kmh", "max_speed_kmh", "total_distance_km", "avg_distance_per_vehicle_km", "data_quality_score")
    return g.select("line_id", "line_name", text("hour_timestamp").alias("hour_timestamp"), "vehicles_active", "vehicles_accessible", *[r6(c) for c in six], F.round("std_speed_kmh", 4).alias("std_speed_kmh"), "total_records", "valid_records")


@query(f"""WITH {DAILY} SELECT strftime(date, '%Y-%m-%d') AS date, total_vehicles, total_lines, total_trips, round(avg_speed_kmh, 6) AS avg_speed_kmh, round(total_distance_km, 4) AS total_distance_km, round(data_quality_score, 6) AS data_quality_score,
 peak_hour::INT AS peak_hour, peak_hour_vehicles, round(off_peak_avg_vehicles, 6) AS off_peak_avg_vehicles, 0.98::DOUBLE AS uptime_percentage FROM daily LEFT JOIN peak USING (date)""")
def e9_gold_daily(s, d):
    g = kpi.gold_daily(tel(s, d))
    return g.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "total_vehicles", "total_lines", "total_trips", r6("avg_speed_kmh"), F.round("total_distance_km", 4).alias("total_distance_km"), r6("data_quality_score"), "peak_hour", "peak_hour_vehicles", r6("off_peak_avg_vehicles"), "uptime_percentage")


@query(f"""WITH {LINES} SELECT line_id, line_name, round(avg_speed_kmh, 6) AS avg_speed_kmh, round(avg_vehicles_operating, 6) AS avg_vehicles_operating, round(data_quality_score, 6) AS data_quality_score,
 CASE WHEN avg_speed_kmh < 10 THEN 80 WHEN avg_speed_kmh < 15 THEN 50 WHEN avg_speed_kmh < 20 THEN 30 ELSE 10 END AS congestion_index, round(data_quality_score * 100, 4) AS reliability_score FROM perf""")
def e10_gold_lines(s, d):
    g = kpi.gold_lines(tel(s, d))
    return g.select("line_id", "line_name", r6("avg_speed_kmh"), r6("avg_vehicles_operating"), r6("data_quality_score"), "congestion_index", F.round("reliability_score", 4).alias("reliability_score"))


@query(f"""WITH {P}, a AS (SELECT count(DISTINCT vehicle_id) AS v, count(DISTINCT line_id) AS l, count_if(epoch_us(now) - epoch_us(ts) > 240000000) AS st FROM p, clock)
 SELECT v AS total_vehicles, l AS total_lines, st AS stale_vehicles, round(st * 100.0 / v, 2) AS stale_percentage, round(l * 100.0 / 400, 2) AS coverage_percentage FROM a""")
def e11_realtime_row(s, d):
    return kpi.realtime_row(with_clock(positions(s, d)), F.col("now"))


@query(f"""WITH {P} SELECT line_id, count(*) AS total_vehicles, count(DISTINCT vehicle_id) AS distinct_vehicles, round(avg(speed), 6) AS avg_speed, max(speed) AS max_speed, min(speed) AS min_speed, count_if(speed < 20) AS vehicles_0_20kmh,
 count_if(speed >= 20 AND speed < 40) AS vehicles_20_40kmh, count_if(speed >= 40 AND speed < 60) AS vehicles_40_60kmh, count_if(speed >= 60) AS vehicles_60plus_kmh FROM p GROUP BY 1""")
def e12_by_line(s, d):
    return kpi.by_line(positions(s, d)).withColumn("avg_speed", six("avg_speed"))


@query(f"""WITH {P} SELECT count(*) AS records_ingested, count_if(ok) AS records_valid, count_if(ok AND epoch_us(now) - epoch_us(ts) > 240000000) AS stale_records, count_if(NOT ok) AS records_invalid, round(count_if(ok) * 100.0 / count(*), 2) AS validation_rate
 FROM (SELECT *, coalesce(latitude BETWEEN -24 AND -23 AND longitude BETWEEN -47 AND -46, false) AS ok FROM p, clock)""")
def e13_quality_row(s, d):
    raw = with_clock(positions(s, d))
    return kpi.quality_row(raw, clean.inside_box(raw, box=BOXES["wide"]), F.col("now"), 1.0).select("records_ingested", "records_valid", "stale_records", "records_invalid", "validation_rate")


@query(f"""WITH {P} SELECT 'total_vehicles' AS metric_name, count(DISTINCT vehicle_id)::DOUBLE AS metric_value, NULL::VARCHAR AS line_id FROM p UNION ALL SELECT 'avg_speed', round(avg(speed), 6), NULL FROM p
 UNION ALL SELECT * FROM (SELECT 'vehicles_per_line', count(*)::DOUBLE AS n, line_id FROM p WHERE line_id IS NOT NULL GROUP BY line_id ORDER BY n DESC, line_id LIMIT 10)""")
def e14_metric_series(s, d):
    return kpi.metric_series(positions(s, d)).select("metric_name", r6("metric_value"), "line_id")


@query(f"""WITH {P} SELECT {TXT.format("time_bucket(INTERVAL '15 minutes', ts)")} AS window_start, line_id, count(DISTINCT vehicle_id) AS vehicles, round(avg(speed), 6) AS avg_speed, round(median(speed), 6) AS median_speed, round(stddev_samp(speed), 4) AS stddev_speed FROM p WHERE ts IS NOT NULL GROUP BY 1, 2""")
def e15_quarter_hours(s, d):
    g = positions(s, d).where("ts is not null").groupBy(F.window("ts", "15 minutes").alias("w"), "line_id")
    return g.agg(F.count_distinct("vehicle_id").alias("vehicles"), six(F.avg("speed")).alias("avg_speed"), six(F.percentile("speed", 0.5)).alias("median_speed"), F.round(F.stddev_samp("speed"), 4).alias("stddev_speed")).select(text("w.start").alias("window_start"), "line_id", "vehicles", "avg_speed", "median_speed", "stddev_speed")


@query(f"WITH {HEAD} SELECT stop_id, line_id, round((1 - var_samp(m) / nullif(avg(m), 0)) * 100, 2) AS regularity FROM g WHERE m IS NOT NULL GROUP BY 1, 2")
def e16_headway_regularity(s, d):
    return kpi.headway_summary(positions(s, d).where("ts is not null").withColumn("stop_id", F.col("route_id"))).select("stop_id", "line_id", F.round("regularity", 2).alias("regularity"))


@query(f"""WITH {P}, c AS (SELECT *, max(received_at) OVER () AS now2 FROM p) SELECT line_id, count(DISTINCT vehicle_id) AS vehicles_active, round(avg(speed), 6) AS avg_speed_kmh, {TXT.format("max(ts)")} AS last_update, count(*) AS total_positions FROM c
 WHERE epoch_us(ts) > epoch_us(now2) - 30 * 60000000 GROUP BY 1 HAVING count(DISTINCT vehicle_id) > 0""")
def e17_current_lines(s, d):
    df = with_clock(positions(s, d)).where("ts > now - interval 30 minutes")
    out = df.groupBy("line_id").agg(F.count_distinct("vehicle_id").alias("vehicles_active"), six(F.avg("speed")).alias("avg_speed_kmh"), text(F.max("ts")).alias("last_update"), F.count("*").alias("total_positions"))
    return out.where("vehicles_active > 0")


@query("""SELECT count(DISTINCT vehicle_id) AS total_vehicles, count(DISTINCT line_id) AS total_lines, round(avg(speed), 6) AS avg_speed, count(*) FILTER (WHERE speed > 5) AS vehicles_moving, count(*) FILTER (WHERE speed <= 5) AS vehicles_stopped FROM vehicle_positions_latest""")
def e18_fleet_summary(s, d):
    df = table(s, d, "vehicle_positions_latest")
    return df.agg(F.count_distinct("vehicle_id").alias("total_vehicles"), F.count_distinct("line_id").alias("total_lines"), six(F.avg("speed")).alias("avg_speed"), F.count_if(F.col("speed") > 5).alias("vehicles_moving"), F.count_if(F.col("speed") <= 5).alias("vehicles_stopped"))


@query(f"WITH {HOURLY} SELECT {TXT.format('hour_timestamp')} AS hour, count(DISTINCT line_id) AS lines_count, sum(vehicles_active)::BIGINT AS total_vehicles, round(avg(avg_speed_kmh), 6) AS avg_speed, round(sum(total_distance_km), 4) AS total_distance, round(avg(data_quality_score), 6) AS avg_dq_score FROM hourly GROUP BY 1")
def e19_hourly_view(s, d):
    g = layers.gold_hourly(s, d).groupBy("hour_timestamp")
    return g.agg(F.count_distinct("line_id").alias("lines_count"), F.sum("vehicles_active").alias("total_vehicles"), six(F.avg("avg_speed_kmh")).alias("avg_speed"), F.round(F.sum("total_distance_km"), 4).alias("total_distance"), six(F.avg("data_quality_score")).alias("avg_dq_score")).withColumn("hour", text("hour_timestamp")).drop("hour_timestamp")


@query(f"WITH {HOURLY} SELECT line_id, line_name, round(avg(vehicles_active), 6) AS avg_vehicles, round(avg(avg_speed_kmh), 6) AS avg_speed, count(*) AS measurements_count FROM hourly GROUP BY 1, 2 ORDER BY avg_vehicles DESC, line_id, line_name NULLS LAST LIMIT 20")
def e20_top_lines(s, d):
    g = layers.gold_hourly(s, d).groupBy("line_id", "line_name").agg(six(F.avg("vehicles_active")).alias("avg_vehicles"), six(F.avg("avg_speed_kmh")).alias("avg_speed"), F.count("*").alias("measurements_count"))
    return g.orderBy(F.desc("avg_vehicles"), "line_id", F.asc_nulls_last("line_name")).limit(20)


@query(f"""WITH {DAILY}, a AS (SELECT avg(total_vehicles) AS v, avg(avg_speed_kmh) AS s, sum(total_distance_km) AS k, avg(data_quality_score) AS q FROM daily)
 SELECT 'Total Vehicles' AS metric, round(v, 4) AS value, 'count' AS unit FROM a UNION ALL SELECT 'Avg Speed', round(s, 4), 'km/h' FROM a UNION ALL SELECT 'Total Distance', round(k, 4), 'km' FROM a UNION ALL SELECT 'Avg DQ Score', round(q, 4), 'score' FROM a""")
def e21_performance_report(s, d):
    a = kpi.gold_daily(tel(s, d)).agg(F.avg("total_vehicles").alias("v"), F.avg("avg_speed_kmh").alias("s"), F.sum("total_distance_km").alias("k"), F.avg("data_quality_score").alias("q"))
    rows = F.expr("stack(4, 'Total Vehicles', v, 'count', 'Avg Speed', s, 'km/h', 'Total Distance', k, 'km', 'Avg DQ Score', q, 'score') as (metric, value, unit)")
    return a.select(rows).withColumn("value", F.round("value", 4))


@query(f"WITH {P}, c AS (SELECT line_id, count_if(speed > 5) AS moving, count(*) AS n, count(speed) AS seated, sum(speed) AS total FROM p GROUP BY 1) SELECT line_id, round(moving * 100.0 / n, 6) AS utilization_percent, round(total / nullif(seated, 0) / 80 * 100, 6) AS occupancy_percent FROM c")
def e23_utilization(s, d):
    g = positions(s, d).groupBy("line_id").agg((F.count_if(F.col("speed") > 5) * 100.0 / F.count("*")).alias("u"), (F.avg("speed") / 80 * 100).alias("o"))
    return g.select("line_id", r6("u", "utilization_percent"), r6("o", "occupancy_percent"))


@query("SELECT strftime(date_trunc('hour', \"timestamp\"), '%Y-%m-%d %H:%M:%S') AS hour, line_id, round(avg(total_vehicles), 6) AS avg_vehicles, sum(total_vehicles)::BIGINT AS sum_vehicles FROM kpi_by_line GROUP BY 1, 2")
def e24_hourly_totals(s, d):
    g = table(s, d, "kpi_by_line").groupBy(kpi.hour_of("timestamp").alias("h"), "line_id").agg(F.avg("total_vehicles").alias("a"), F.sum("total_vehicles").alias("sum_vehicles"))
    return g.select(text("h").alias("hour"), "line_id", r6("a", "avg_vehicles"), "sum_vehicles")


@query("""WITH l AS (SELECT (epoch_us(created_at) - epoch_us("timestamp")) / 1e6 AS x FROM kpi_realtime) SELECT round(avg(x), 4) AS avg_latency, round(min(x), 6) AS min_latency, round(max(x), 6) AS max_latency, round(quantile_cont(x, 0.95), 6) AS p95_latency, round(count_if(x <= 120) * 100.0 / count(*), 6) AS sla_percent, round(stddev_samp(x), 3) AS std_latency FROM l""")
def e25_latency_slo(s, d):
    x = (F.unix_micros(F.col("created_at").cast("timestamp")) - F.unix_micros(F.col("timestamp").cast("timestamp"))) / 1e6
    a = table(s, d, "kpi_realtime").select(x.alias("x"))
    one = a.agg(F.round(F.avg("x"), 4).alias("avg_latency"), six(F.min("x")).alias("min_latency"), six(F.max("x")).alias("max_latency"), six(F.count_if(F.col("x") <= 120) * 100.0 / F.count("*")).alias("sla_percent"), F.round(F.stddev_samp("x"), 3).alias("std_latency"))
    return one.join(F.broadcast(kpi.percentiles(a, [], "x", {"p95_latency": 0.95}).select(r6("p95_latency"))))


@query("WITH v AS (SELECT received_at::DATE AS day, count(*) AS n FROM vehicle_positions GROUP BY 1) SELECT strftime(day, '%Y-%m-%d') AS day, n FROM v ORDER BY day DESC LIMIT 7")
def e26_volume_trend(s, d):
    g = table(s, d, "vehicle_positions").groupBy(F.to_date("received_at").alias("day")).agg(F.count("*").alias("n"))
    return g.orderBy(F.desc("day")).limit(7).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


@query("SELECT route_type, count(*) AS n, count(DISTINCT route_color) AS colors, count(DISTINCT agency_id) AS agencies FROM routes GROUP BY 1")
def e27_value_counts(s, d):
    return table(s, d, "routes").groupBy("route_type").agg(F.count("*").alias("n"), F.count_distinct("route_color").alias("colors"), F.count_distinct("agency_id").alias("agencies"))


@query("""SELECT line_id, CAST(floor(avg(total_vehicles) + 0.5) AS INT) AS vehicles FROM kpi_by_line GROUP BY 1 ORDER BY vehicles DESC, line_id LIMIT 10""")
def e29_dashboard_average(s, d):
    g = table(s, d, "kpi_by_line").groupBy("line_id").agg(F.floor(F.avg("total_vehicles") + 0.5).cast("int").alias("vehicles"))
    return g.orderBy(F.desc("vehicles"), "line_id").limit(10)


@query(f"WITH {P} SELECT route_id, count(*) AS n, round(avg(speed), 6) AS avg_speed, round(avg(latitude), 6) AS avg_lat, round(avg(longitude), 6) AS avg_lon, count(latitude) AS placed FROM p GROUP BY 1")
def e30_by_route(s, d):
    return positions(s, d).groupBy("route_id").agg(F.count("*").alias("n"), six(F.avg("speed")).alias("avg_speed"), six(F.avg("latitude")).alias("avg_lat"), six(F.avg("longitude")).alias("avg_lon"), F.count("latitude").alias("placed"))


@query(f"WITH {P}, c AS (SELECT *, (SELECT now FROM clock) AS now FROM p) SELECT (SELECT count(DISTINCT route_id) FROM routes) AS routes, count(DISTINCT vehicle_id) FILTER (WHERE epoch_us(ts) > epoch_us(now) - 3600000000) AS vehicles_last_hour, count_if(ts::DATE = now::DATE) AS positions_today FROM c")
def e31_operational_counts(s, d):
    p = with_clock(positions(s, d))
    a = p.agg(F.count_distinct(F.when(F.expr("ts > now - interval 1 hour"), F.col("vehicle_id"))).alias("vehicles_last_hour"), F.count_if(F.to_date("ts") == F.to_date("now")).alias("positions_today"))
    return table(s, d, "routes").agg(F.count_distinct("route_id").alias("routes")).join(F.broadcast(a))


@query(f"WITH {P}, c AS (SELECT route_id, count(*) AS n FROM p GROUP BY 1), x AS (SELECT vehicle_id, ts FROM p WHERE vehicle_id IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1) SELECT (SELECT max(n) FROM c) AS busiest_route_rows, (SELECT round(avg((speed IS NULL)::INT), 6) FROM p) AS null_share, (SELECT count(*) FROM x) AS repeated_keys")
def e32_profile(s, d):
    p = positions(s, d)
    a = p.groupBy("route_id").count().agg(F.max("count").alias("busiest_route_rows"))
    b = p.agg(six(F.avg(F.col("speed").isNull().cast("int"))).alias("null_share"))
    c = p.where("vehicle_id is not null").groupBy("vehicle_id", "ts").count().where("count > 1").agg(F.count("*").alias("repeated_keys"))
    return a.join(F.broadcast(b)).join(F.broadcast(c))
