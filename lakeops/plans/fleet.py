"""Fence, trip and lineage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.operators import lineage, search, spatial
from lakeops.plans.fraud import great_circle, rounded
from lakeops.registry import query

# a polygon fence is a square of side 2 x radius around its centre
D_LAT = "radius_meters / 111320.0"
D_LON = "radius_meters / (111320.0 * cos(radians(center_latitude)))"


def fences(lake):
    def corner(lat: str, lon: str):
        return F.struct(F.expr(f"center_latitude {lat} {D_LAT}").alias("lat"), F.expr(f"center_longitude {lon} {D_LON}").alias("lon"))

    square = F.array(corner("-", "-"), corner("-", "+"), corner("+", "+"), corner("+", "-"))
    return lake("v_geofence").withColumn("vertices", F.when(F.col("geofence_type") == "polygon", square))


INSIDE = f"""CASE WHEN geofence_type = 'circle' THEN {great_circle('latitude', 'longitude', 'center_latitude', 'center_longitude', '6371000.0')} <= radius_meters
 ELSE longitude > center_longitude - {D_LON} AND longitude <= center_longitude + {D_LON} AND latitude > center_latitude - {D_LAT} AND latitude <= center_latitude + {D_LAT} END"""


@query("points_in_fences", f"SELECT seq, geofence_id FROM v_gps, v_geofence WHERE {INSIDE}")
def points_in_fences(lake):
    return spatial.points_in_fences(lake("v_gps"), fences(lake))


ALERTS_SQL = f"""WITH state AS (SELECT g.*, f.geofence_id, f.name, f.alert_on, {INSIDE} AS is_in FROM v_gps g, v_geofence f),
moved AS (SELECT *, lag(is_in) OVER (PARTITION BY truck_id, geofence_id ORDER BY ts, seq) AS was_in FROM state)
SELECT truck_id, seq, ts, latitude, longitude, geofence_id, name AS geofence_name, CASE WHEN is_in THEN 'enter' ELSE 'exit' END AS alert_type
FROM moved WHERE was_in IS NOT NULL AND was_in <> is_in AND (alert_on = 'both' OR alert_on = CASE WHEN is_in THEN 'enter' ELSE 'exit' END)"""


@query("geofence_alerts", ALERTS_SQL)
def geofence_alerts(lake):
    return spatial.geofence_alerts(lake("v_gps"), fences(lake))


SEGMENT_SQL = f"""seg AS (SELECT *, lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon, lag(ts) OVER w AS p_ts FROM v_gps WINDOW w AS (PARTITION BY truck_id ORDER BY ts, seq)),
dist AS (SELECT *, coalesce({great_circle('p_lat', 'p_lon', 'latitude', 'longitude', '6371000.0')}, 0.0) AS m, CASE WHEN engine_status = 'idle' AND p_ts IS NOT NULL THEN epoch_us(ts) - epoch_us(p_ts) ELSE 0 END AS idle FROM seg)"""
TRIP_COLS = """min(ts) AS period_start, max(ts) AS period_end, round(sum(m) / 1000, 5) AS total_distance_km,
 round(CAST(sum(speed_kmh) AS DOUBLE) / count(*), 9) AS average_speed_kmh, max(speed_kmh) AS max_speed_kmh,
 round(CAST(sum(idle) AS DOUBLE) / 60000000.0, 6) AS idle_time_minutes, count(*) AS coordinates_count"""


def neat_trips(df):
    out = rounded(rounded(df, ["total_distance_km"], 5), ["idle_time_minutes"])
    return rounded(out, ["average_speed_kmh"], 9)


@query("trip_stats", f"WITH {SEGMENT_SQL} SELECT truck_id, {TRIP_COLS} FROM dist GROUP BY truck_id")
def trip_stats(lake):
    return neat_trips(spatial.trip_stats(lake("v_gps")))


@query(
    "fleet_summary",
    f"""WITH {SEGMENT_SQL}, t AS (SELECT truck_id, sum(m) / 1000 AS km, CAST(sum(speed_kmh) AS DOUBLE) / count(*) AS mean, max(speed_kmh) AS top, count(*) AS n FROM dist GROUP BY truck_id)
SELECT round(sum(km), 3) AS total_km, round(avg(mean), 6) AS mean_truck_speed, max(top) AS max_speed_kmh, CAST(sum(n) AS BIGINT) AS fixes FROM t""",
)
def fleet_summary(lake):
    out = spatial.fleet_summary(spatial.trip_stats(lake("v_gps")))
    return rounded(rounded(out, ["total_km"], 3), ["mean_truck_speed"])


@query("latest_position", "SELECT truck_id, ts, seq, latitude, longitude, speed_kmh, engine_status FROM v_gps QUALIFY row_number() OVER (PARTITION BY truck_id ORDER BY ts DESC, seq DESC) = 1")
def latest_position(lake):
    out = search.latest_per_key(lake("v_gps"), ["truck_id"], ["ts", "seq"])
    return out.select("truck_id", "ts", "seq", "latitude", "longitude", "speed_kmh", "engine_status")


@query(
    "lineage_downstream",
    """WITH RECURSIVE walk(job, hop) AS (SELECT CAST(0 AS BIGINT), 0 UNION ALL SELECT r.job_execution_id, hop + 1 FROM walk JOIN v_lineage w ON w.job_execution_id = walk.job JOIN v_lineage r ON r.input_path = w.output_path WHERE hop < 8)
SELECT job AS job_execution_id, hop FROM walk WHERE hop > 0""",
)
def lineage_downstream(lake):
    return lineage.downstream(lake("v_lineage"), [0], depth=8)


@query(
    "lineage_lists",
    """WITH RECURSIVE walk(job, hop) AS (SELECT CAST(0 AS BIGINT), 0 UNION ALL SELECT r.job_execution_id, hop + 1 FROM walk JOIN v_lineage w ON w.job_execution_id = walk.job JOIN v_lineage r ON r.input_path = w.output_path WHERE hop < 8)
SELECT job AS job_execution_id, hop FROM walk WHERE hop > 0""",
)
def lineage_lists(lake):
    """Runs with lists of paths, as the jobs of this package record them."""
    aside = F.concat(F.lit("/aside/"), F.col("job_execution_id").cast("string"))
    runs = lake("v_lineage").select("job_execution_id", F.array("input_path", aside).alias("input_paths"), F.array(F.concat(aside, F.lit("/out")), F.col("output_path")).alias("output_paths"))
    return lineage.downstream(runs, [0], depth=8, inputs="input_paths", outputs="output_paths")


@query(
    "lineage_history",
    """SELECT job_execution_id, input_path, output_path FROM v_lineage WHERE starts_with(input_path, '/p7/') OR starts_with(output_path, '/p7/')
 ORDER BY start_time DESC, job_execution_id LIMIT 100""",
)
def lineage_history(lake):
    return lineage.history(lake("v_lineage"), "/p7", 100).select("job_execution_id", "input_path", "output_path")
