"""Declared schemas by layer and name."""

from __future__ import annotations

VEHICLE = "struct<p: string, a: boolean, ta: string, py: double, px: double>"
# Columns and types that readers of the layers rely on.
SCHEMAS: dict[str, dict[str, str]] = {
    "bronze": {
        "positions": f"hr string, l array<struct<cl: string, sl: int, lt0: string, lt1: string, qv: int, vs: array<{VEHICLE}>>>, ingestion_timestamp timestamp, ingestion_date string, year int, month int, day int, hour int",
        "line_positions": "hr string, vs array<struct<p: string, a: boolean, ta: string, py: double, px: double, sv: int, is: int>>",
        "envelope": "endpoint string, request_timestamp timestamp, response_status int, raw_json string",
    },
    "silver": {
        "vehicle_positions": "vehicle_id string, line_id int, line_direction int, line_name string, line_destination string, latitude double, longitude double, accessible boolean, position_timestamp timestamp, processed_timestamp timestamp, year int, month int, day int, data_quality_score double, is_duplicate boolean",
        "loop_positions": "vehicle_id string, line_id string, latitude double, longitude double, timestamp timestamp, speed double, route_id string",
    },
    "gold": {
        "hourly_metrics": "line_id int, line_name string, hour_timestamp timestamp, vehicles_active int, vehicles_accessible int, avg_speed_kmh double, min_speed_kmh double, max_speed_kmh double, std_speed_kmh double, total_distance_km double, avg_distance_per_vehicle_km double, data_quality_score double, total_records bigint, valid_records bigint, year int, month int",
        "daily_summary": "date string, total_vehicles int, total_lines int, total_trips bigint, avg_speed_kmh double, total_distance_km double, peak_hour int, peak_hour_vehicles int, off_peak_avg_vehicles double, data_quality_score double, uptime_percentage double, year int, month int",
        "line_performance": "line_id int, line_name string, analysis_period string, period_start timestamp, period_end timestamp, avg_speed_kmh double, avg_vehicles_operating double, congestion_index int, reliability_score double, avg_headway_minutes double, std_headway_minutes double, utilization_rate double, data_quality_score double, year int, month int",
    },
    "gtfs": {
        "stops": "stop_id string, stop_name string, stop_desc string, stop_lat double, stop_lon double",
        "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int, route_color string, route_text_color string",
        "trips": "route_id string, service_id string, trip_id string, trip_headsign string, direction_id int, shape_id string",
        "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int",
        "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, shape_dist_traveled double",
    },
    "stream": {"positions": "vehicle_id string, timestamp timestamp, latitude double, longitude double, speed double, route_code string, direction int, accessibility boolean"},
}


def schema(layer: str, name: str) -> str:
    """DDL of a declared schema; ValueError for an unknown one."""
    if layer not in SCHEMAS or name not in SCHEMAS[layer]:
        raise ValueError(f"no schema {layer}.{name}; known: {[f'{a}.{b}' for a, n in SCHEMAS.items() for b in n]}")
    return SCHEMAS[layer][name]
