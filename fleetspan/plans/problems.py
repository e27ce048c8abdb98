"""The training-data queries of the core: proximity, lateness, grids, spikes, deliveries, trips and nested records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspan.functions.clock import micros, milli_text, second_text
from fleetspan.functions.vehicle import bare_vehicle
from fleetspan.operators.delivery import surplus_rows
from fleetspan.operators.grid import empty_slots, regular_series
from fleetspan.operators.late import Lateness, PeriodStore
from fleetspan.operators.near import containing_regions, near_pairs
from fleetspan.operators.nested import record_rows
from fleetspan.operators.spikes import false_line_speeds, false_positions
from fleetspan.operators.trips import stops_and_trips
from fleetspan.session import table
from fleetspan.sources.lineage import new_store

API_LISTS = ("l", "l[].vs", "vs")  # a lone object there is a list of one
API_PATHS = ("l[]", "l[].vs[]", "vs[]")
API_LATENESS = Lateness(600, 120, 1800)
REALTIME_LATENESS = Lateness(1800, 120, 3600)
INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,9})?)?(Z|[+-][0-9]{2}:?[0-9]{2})?$"


def instant(text: Column) -> Column:
    """A reported time: with an offset it is that instant, without one UTC; null if it is no valid time."""
    return F.when(text.rlike(INSTANT), F.regexp_replace(text, r"([+-]\d{2})(\d{2})$", "$1:$2").try_cast("timestamp"))


def api_rows(spark: SparkSession, d: str, once: bool = True, raw: DataFrame | None = None, paths: tuple[str, ...] = ("", *API_PATHS), columns: tuple[str, ...] | None = None) -> DataFrame:
    """Rows of the objects of the tables in ``api_raw``; with ``once`` each response once.

    Copies of one ``request_id`` are identical; were they not, the first valid one by arrival and then by content counts, as a whole. Responses
    without an id are no copies of each other.
    """
    rows = record_rows(table(spark, d, "api_raw") if raw is None else raw, "request_id", "raw_json", API_LISTS, "request_timestamp", once, paths=paths, columns=columns)
    return rows.where("is_object")


def api_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """``responses``, ``lines`` and ``vehicles``, each child with its parent's key."""
    rows = api_rows(spark, d)
    field = lambda name: F.col("fields")[name]
    responses = rows.where("path = ''").select(F.col("record_key").alias("request_id"), F.timestamp_micros("record_time").alias("request_timestamp"), field("hr").alias("hr"))
    lines = rows.where("path = 'l[]'").where("map_contains_key(fields, 'cl') or map_contains_key(fields, 'sl') or map_contains_key(fields, 'vs')")
    lines = lines.select(
        F.col("record_key").alias("request_id"), F.col("ordinals")[0].alias("line_pos"), field("cl").alias("line_code"), field("sl").try_cast("int").alias("direction"),
        field("lt0").alias("terminal_a"), field("lt1").alias("terminal_b"), field("qv").try_cast("int").alias("reported_vehicles"),
    )
    nested = F.col("path") == "l[].vs[]"
    vehicles = rows.where("path in ('l[].vs[]', 'vs[]')").select(
        F.col("record_key").alias("request_id"),
        F.when(nested, F.col("ordinals")[0]).otherwise(-1).alias("line_pos"),
        F.when(nested, F.get("ordinals", F.lit(1))).otherwise(F.col("ordinals")[0]).alias("vehicle_pos"),
        F.when(nested, F.col("parent")["cl"]).alias("line_code"),
        field("p").alias("vehicle_prefix"),
        (field("a") == "true").alias("accessible"),
        instant(field("ta")).alias("position_at"),
        field("py").try_cast("double").alias("latitude"),
        field("px").try_cast("double").alias("longitude"),
        F.timestamp_micros("record_time").alias("request_timestamp"),
        nested.alias("under_line"),
    )
    return {"responses": responses, "lines": lines, "vehicles": vehicles}


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Vehicles at most 30 m apart, and the zones that contain each."""
    latest = table(spark, d, "vehicle_positions_latest").where("latitude between -24 and -23 and longitude between -47 and -46")
    near = near_pairs(latest, "vehicle_id", "latitude", "longitude", 30.0)
    within = containing_regions(latest, "vehicle_id", "latitude", "longitude", table(spark, d, "zones"), "zone_id", "polygon_wkt")
    return near.select(F.lit("near").alias("pair_type"), "key_a", "key_b").unionByName(within.select(F.lit("inside").alias("pair_type"), "key_a", "key_b"))


def api_reports(spark: SparkSession, d: str, raw: DataFrame) -> DataFrame:
    """Events of the vehicles of a line."""
    rows = api_rows(spark, d, False, raw, ("l[].vs[]",), ("cl", "p", "ta"))
    return rows.select(F.col("parent")["cl"].alias("series_key"), F.unix_micros(instant(F.col("fields")["ta"])).alias("event_us"), F.col("record_time").alias("arrival_us"), F.col("fields")["p"].alias("member"))


def realtime_polls(spark: SparkSession, d: str, polls: DataFrame) -> DataFrame:
    """Events of the stale percentage of each poll."""
    return polls.select(
        F.col("data_source").alias("series_key"), micros("timestamp").alias("event_us"), micros("created_at").alias("arrival_us"),
        F.col("id").alias("version"), micros("timestamp").cast("string").alias("member"), F.col("stale_percentage").alias("figure"),
    )


LATE = {"api_raw": ("request_timestamp", api_reports, API_LATENESS, True), "kpi_realtime": ("created_at", realtime_polls, REALTIME_LATENESS, False)}


def late_periods(spark: SparkSession, d: str, deliveries: int = 2) -> DataFrame:
    """The periods of both sources, read from stores that were filled in ``deliveries`` of arrival (so this writes)."""
    out = []
    for name, (arrival, events, rule, presence) in LATE.items():
        raw = table(spark, d, name)
        lo, hi = raw.agg(F.min(micros(arrival)), F.max(micros(arrival))).first()  # one row
        store = PeriodStore(new_store(spark, name), rule, presence)
        lo, hi = (0, 0) if lo is None else (lo, hi)
        edges = [None, *(lo + (hi - lo) * k // deliveries for k in range(1, deliveries)), hi]
        for n, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            at = F.col(arrival).cast("timestamp")
            part = raw.where(at <= F.timestamp_micros(F.lit(b))) if a is None else raw.where((at > F.timestamp_micros(F.lit(a))) & (at <= F.timestamp_micros(F.lit(b))))
            store.ingest(events(spark, d, part), n, b, a)
        found = store.periods(spark, deliveries - 1)
        if found is not None:
            out.append(found.select(F.lit(name).alias("source_name"), "series_key", second_text(F.col("period_us")).alias("period_start"), "n_published", "n_corrected", "mean_published", "mean_corrected", "changed"))
    kinds = "source_name string, series_key string, period_start string, n_published bigint, n_corrected bigint, mean_published double, mean_corrected double, changed boolean"
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], kinds)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Periods whose figure changed between publication and cut-off."""
    return late_periods(spark, d).where("changed").select("source_name", "series_key", "period_start")


def p2_figures(spark: SparkSession, d: str) -> DataFrame:
    """The published and the corrected figures of every period of both sources."""
    f = late_periods(spark, d)
    return f.select("source_name", "series_key", "period_start", "n_published", "n_corrected", F.round("mean_published", 6).alias("mean_published"), F.round("mean_corrected", 6).alias("mean_corrected"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Two-minute slots without a reading."""
    slots = empty_slots(table(spark, d, "vehicle_positions"))
    return slots.select(F.col("source_key").alias("vehicle_id"), second_text(F.col("slot_us")).alias("slot_start"))


def p3_series(spark: SparkSession, d: str) -> DataFrame:
    """The regular speed series. The tiny addend rounds ties up whatever the order of the sums."""
    s = regular_series(table(spark, d, "vehicle_positions"))
    return s.select(F.col("source_key").alias("vehicle_id"), second_text(F.col("slot_us")).alias("slot_start"), "readings", F.round(F.col("mean_value") + 1e-9, 6).alias("mean_speed"), F.round("coverage", 6).alias("coverage"), "filled")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """False readings of vehicles and lines."""
    positions = false_positions(table(spark, d, "vehicle_positions")).select(F.lit("vehicle_positions").alias("source_name"), "row_key")
    return positions.unionByName(false_line_speeds(table(spark, d, "kpi_by_line")).select(F.lit("kpi_by_line").alias("source_name"), "row_key"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Surplus deliveries."""
    return surplus_rows(table(spark, d, "vehicle_positions")).select(F.col("arrival").alias("row_id"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Stops and trips."""
    s = stops_and_trips(table(spark, d, "vehicle_positions"))
    return s.select(F.when(F.col("is_stop"), "stop").otherwise("trip").alias("segment"), "vehicle_id", milli_text(F.col("started_us")).alias("started_at"), milli_text(F.col("ended_us")).alias("ended_at"))


def p6_segments(spark: SparkSession, d: str) -> DataFrame:
    """Stops and trips with duration and distance."""
    s = stops_and_trips(table(spark, d, "vehicle_positions"))
    return s.select("vehicle_id", "is_stop", milli_text(F.col("started_us")).alias("started_at"), milli_text(F.col("ended_us")).alias("ended_at"), F.round("seconds", 3).alias("seconds"), F.round("metres", 3).alias("metres"), "pings")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the flat line and vehicle tables, from one pass over the texts."""
    path, own, up = F.col("path"), F.col("fields"), F.col("parent")
    is_line = F.map_contains_key(own, "cl") | F.map_contains_key(own, "sl") | F.map_contains_key(own, "vs")
    rows = api_rows(spark, d, paths=API_PATHS, columns=("cl", "sl", "vs", "p")).where((path != "l[]") | is_line)
    line_code = F.when(path == "l[]", own["cl"]).when(path == "l[].vs[]", up["cl"])
    at, top = F.col("ordinals"), path == "vs[]"
    return rows.select(
        F.col("record_key").alias("request_id"),
        F.when(top, -1).otherwise(at[0]).alias("line_pos"),
        F.when(top, at[0]).when(path == "l[]", -1).otherwise(F.get(at, F.lit(1))).alias("vehicle_pos"),
        F.coalesce(line_code, F.lit("")).alias("line_code"),
        F.coalesce(F.when(path != "l[]", own["p"]), F.lit("")).alias("vehicle_prefix"),
    )


def p7_vehicles(spark: SparkSession, d: str) -> DataFrame:
    """The flat vehicle table with types; times as text."""
    v = api_tables(spark, d)["vehicles"]
    return v.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS") for c in ("position_at", "request_timestamp")})


PROBLEMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p1_found, p2_found, p2_figures, p3_found, p3_series, p4_found, p5_found, p6_found, p6_segments, p7_found, p7_vehicles)
}


# The same rows in SQL, written from the definitions; p4 and p6 (iterative) are held against brute force in the tests.
_KEPT = """k0 AS (SELECT row_id, lpad(ltrim(trim(vehicle_id, E' \\t\\n\\r'), '0'), 8, '0') AS v, "timestamp" AS ts, speed FROM vehicle_positions),
 k1 AS (SELECT *, row_number() OVER (PARTITION BY v, ts ORDER BY row_id) AS rn FROM k0 WHERE v IS NOT NULL AND ts IS NOT NULL)"""
_JSON = """j0 AS (SELECT request_id, request_timestamp AS came, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS j FROM api_raw),
 j1 AS (SELECT request_id, came, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN (j ->> '$')::JSON END ELSE j END AS j FROM j0),
 j2 AS (SELECT request_id, min(came) AS came, arg_min(j, came) AS j FROM j1 WHERE j IS NOT NULL GROUP BY 1),
 l0 AS (SELECT request_id, came, CASE json_type(j, '$.l') WHEN 'ARRAY' THEN json_extract(j, '$.l[*]') WHEN 'OBJECT' THEN [json_extract(j, '$.l')] END AS a FROM j2),
 l1 AS (SELECT request_id, came, unnest(a) AS m, generate_subscripts(a, 1) - 1 AS i FROM l0),
 v0 AS (SELECT request_id, came, i, m, CASE json_type(m, '$.vs') WHEN 'ARRAY' THEN json_extract(m, '$.vs[*]') WHEN 'OBJECT' THEN [json_extract(m, '$.vs')] END AS a FROM l1 WHERE json_type(m) = 'OBJECT'),
 v1 AS (SELECT request_id, came, i, m, unnest(a) AS o, generate_subscripts(a, 1) - 1 AS k FROM v0),
 t0 AS (SELECT request_id, CASE json_type(j, '$.vs') WHEN 'ARRAY' THEN json_extract(j, '$.vs[*]') WHEN 'OBJECT' THEN [json_extract(j, '$.vs')] END AS a FROM j2),
 t1 AS (SELECT request_id, unnest(a) AS o, generate_subscripts(a, 1) - 1 AS k FROM t0)"""
_EVENTS = f"""{_JSON}, e AS (SELECT m ->> '$.cl' AS s, o ->> '$.p' AS p, came, CASE WHEN regexp_full_match(o ->> '$.ta', '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]+)?)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?') THEN
 try_cast(replace(regexp_replace(o ->> '$.ta', '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', ''), 'T', ' ') AS TIMESTAMP) - to_minutes(coalesce(try_cast(regexp_extract(o ->> '$.ta', ':[0-9.]+([+-][0-9]{{2}}):?[0-9]{{2}}$', 1) AS INT), 0) * 60) END AS ta FROM v1 WHERE json_type(o) = 'OBJECT'),
 f AS (SELECT s, time_bucket(INTERVAL 10 MINUTES, ta) AS b, p, min(came) AS came FROM e WHERE s IS NOT NULL AND p IS NOT NULL AND ta IS NOT NULL GROUP BY 1, 2, 3),
 k AS (SELECT data_source AS s, "timestamp" AS ts, time_bucket(INTERVAL 30 MINUTES, "timestamp") AS b, stale_percentage AS x, created_at AS came, id FROM kpi_realtime WHERE data_source IS NOT NULL),
 kp AS (SELECT *, row_number() OVER (PARTITION BY s, ts ORDER BY came DESC, id DESC) AS rn FROM k WHERE came <= b + INTERVAL 32 MINUTES), kc AS (SELECT *, row_number() OVER (PARTITION BY s, ts ORDER BY came DESC, id DESC) AS rn FROM k WHERE came <= b + INTERVAL 90 MINUTES)"""
SQL: dict[str, str] = {
    "p1_found": """WITH l AS (SELECT vehicle_id AS k, latitude AS a, longitude AS b FROM vehicle_positions_latest WHERE latitude BETWEEN -24 AND -23 AND longitude BETWEEN -47 AND -46),
 r AS (SELECT zone_id, unnest(x) AS ring, generate_subscripts(x, 1) AS rn FROM (SELECT zone_id, regexp_extract_all(polygon_wkt, '\\(([^()]+)\\)', 1) AS x FROM zones)),
 q AS (SELECT zone_id, rn, unnest(y) AS t, generate_subscripts(y, 1) AS i FROM (SELECT zone_id, rn, string_split(ring, ',') AS y FROM r)),
 c AS (SELECT zone_id, rn, i, split_part(trim(t), ' ', 1)::DOUBLE AS x, split_part(trim(t), ' ', 2)::DOUBLE AS y FROM q),
 e AS (SELECT zone_id, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM c WINDOW w AS (PARTITION BY zone_id, rn ORDER BY i))
 SELECT 'near' AS pair_type, p.k AS key_a, o.k AS key_b FROM l p JOIN l o ON p.k < o.k AND abs(p.a - o.a) < 0.0004 AND abs(p.b - o.b) < 0.0004
 WHERE 12742000.0 * asin(sqrt(pow(sin(radians(o.a - p.a) / 2), 2) + cos(radians(p.a)) * cos(radians(o.a)) * pow(sin(radians(o.b - p.b) / 2), 2))) <= 30
 UNION ALL SELECT 'inside', k, zone_id::VARCHAR FROM l, e WHERE x2 IS NOT NULL AND (y1 > a) <> (y2 > a) AND b < x1 + (a - y1) * (x2 - x1) / (y2 - y1) GROUP BY k, zone_id HAVING count(*) % 2 = 1""",
    "p2_found": f"""WITH {_EVENTS} SELECT DISTINCT 'api_raw' AS source_name, s AS series_key, strftime(b, '%Y-%m-%d %H:%M:%S') AS period_start FROM f WHERE came > b + INTERVAL 12 MINUTES AND came <= b + INTERVAL 40 MINUTES
 UNION ALL SELECT DISTINCT 'kpi_realtime', c.s, strftime(c.b, '%Y-%m-%d %H:%M:%S') FROM (SELECT * FROM kc WHERE rn = 1) c LEFT JOIN (SELECT * FROM kp WHERE rn = 1) p ON p.s = c.s AND p.ts = c.ts WHERE p.x IS DISTINCT FROM c.x""",
    "p2_figures": f"""WITH {_EVENTS}, a AS (SELECT s, b, count(*) FILTER (WHERE came <= b + INTERVAL 12 MINUTES) AS p, count(*) FILTER (WHERE came <= b + INTERVAL 40 MINUTES) AS c FROM f GROUP BY 1, 2)
 SELECT 'api_raw' AS source_name, s AS series_key, strftime(b, '%Y-%m-%d %H:%M:%S') AS period_start, p AS n_published, c AS n_corrected, CASE WHEN p > 0 THEN 1.0::DOUBLE END AS mean_published, 1.0::DOUBLE AS mean_corrected FROM a WHERE c > 0
 UNION ALL SELECT 'kpi_realtime', c.s, strftime(c.b, '%Y-%m-%d %H:%M:%S'), count(p.x), count(c.x), round(avg(p.x), 6), round(avg(c.x), 6) FROM (SELECT * FROM kc WHERE rn = 1) c LEFT JOIN (SELECT * FROM kp WHERE rn = 1) p ON p.s = c.s AND p.ts = c.ts GROUP BY c.s, c.b""",
    "p3_series": f"""WITH {_KEPT}, r AS (SELECT v, ts, speed AS x, time_bucket(INTERVAL 2 MINUTES, ts) AS c, date_trunc('day', ts) AS d FROM k1 WHERE rn = 1 AND speed IS NOT NULL),
 n AS (SELECT *, lead(ts) OVER (PARTITION BY v, d ORDER BY ts) AS nx FROM r),
 g AS (SELECT *, unnest(generate_series(c, coalesce(time_bucket(INTERVAL 2 MINUTES, nx), c), INTERVAL 2 MINUTES)) AS s, least(coalesce(epoch_us(nx), epoch_us(c) + 120000000), epoch_us(ts) + 600000000) AS e FROM n),
 o AS (SELECT v, s, s = c AS own, x, greatest(0, least(e, epoch_us(s) + 120000000) - greatest(epoch_us(ts), epoch_us(s))) AS w FROM g)
 SELECT v AS vehicle_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS slot_start, count(*) FILTER (WHERE own) AS readings, round(CASE WHEN sum(w) > 0 THEN sum(x * w) / sum(w) ELSE avg(x) FILTER (WHERE own) END + 1e-9, 6) AS mean_speed, round(sum(w) / 120000000.0, 6) AS coverage, count(*) FILTER (WHERE own) = 0 AS filled FROM o GROUP BY v, s""",
    "p3_found": f"""WITH {_KEPT}, s AS (SELECT DISTINCT v, date_trunc('day', ts) AS d, time_bucket(INTERVAL 2 MINUTES, ts) AS s FROM k1 WHERE rn = 1 AND speed IS NOT NULL),
 g AS (SELECT v, unnest(generate_series(min(s), max(s), INTERVAL 2 MINUTES)) AS s FROM s GROUP BY v, d) SELECT v AS vehicle_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS slot_start FROM g ANTI JOIN s USING (v, s)""",
    "p5_found": f"WITH {_KEPT} SELECT row_id FROM k1 WHERE rn > 1",
    "p7_found": f"""WITH {_JSON} SELECT request_id, i::INT AS line_pos, -1 AS vehicle_pos, coalesce(m ->> '$.cl', '') AS line_code, '' AS vehicle_prefix FROM l1 WHERE json_type(m) = 'OBJECT' AND (json_exists(m, '$.cl') OR json_exists(m, '$.sl') OR json_exists(m, '$.vs'))
 UNION ALL SELECT request_id, i::INT, k::INT, coalesce(m ->> '$.cl', ''), coalesce(o ->> '$.p', '') FROM v1 WHERE json_type(o) = 'OBJECT' UNION ALL SELECT request_id, -1, k::INT, '', coalesce(o ->> '$.p', '') FROM t1 WHERE json_type(o) = 'OBJECT'""",
    "p7_vehicles": f"""WITH {_JSON}, r AS (SELECT request_id, min(came) AS came FROM j1 WHERE j IS NOT NULL GROUP BY 1), o AS (SELECT request_id, i::INT AS line_pos, k::INT AS vehicle_pos, m ->> '$.cl' AS line_code, o, true AS under_line FROM v1 WHERE json_type(o) = 'OBJECT'
 UNION ALL SELECT request_id, -1, k::INT, NULL, o, false FROM t1 WHERE json_type(o) = 'OBJECT'), x AS (SELECT *, o ->> '$.ta' AS ta FROM o JOIN r USING (request_id))
 SELECT request_id, line_pos, vehicle_pos, line_code, o ->> '$.p' AS vehicle_prefix, (o ->> '$.a') = 'true' AS accessible, try_cast(o ->> '$.py' AS DOUBLE) AS latitude, try_cast(o ->> '$.px' AS DOUBLE) AS longitude, under_line,
 left(strftime(came, '%Y-%m-%d %H:%M:%S.%f'), 23) AS request_timestamp, CASE WHEN regexp_full_match(ta, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}([.][0-9]+)?)?(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?') THEN
 left(strftime(try_cast(replace(regexp_replace(ta, '(Z|[+-][0-9]{{2}}:?[0-9]{{2}})$', ''), 'T', ' ') AS TIMESTAMP) - to_minutes(coalesce(try_cast(regexp_extract(ta, ':[0-9.]+([+-][0-9]{{2}}):?[0-9]{{2}}$', 1) AS INT), 0) * 60), '%Y-%m-%d %H:%M:%S.%f'), 23) END AS position_at FROM x""",
}
