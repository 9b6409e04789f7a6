"""Fences on grids of several levels, fence transitions and trip statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.exprs import EARTH_KM, haversine, ratio
from lakeops.operators import timeline as tl
from lakeops.session import materialize

METRES_PER_DEGREE = 111_195.0
EARTH_M = EARTH_KM * 1000


#: Cells of level k are 180 / 2**k degrees wide; a fence spans at most ``SPAN`` of them each way, so it has few cells whatever its size.
LEVELS, SPAN = 22, 8
FENCE = ("geofence_id", "geofence_type", "center_latitude", "center_longitude", "radius_meters", "vertices")


def _cell_of(degrees: Column, level: Column | int, offset: float) -> Column:
    """Number of the cell of a level; ``offset`` is 90 for rows and 180 for columns."""
    scale = F.lit(2.0**level / 180.0) if isinstance(level, int) else F.pow(F.lit(2.0), level) / 180.0
    return F.floor((degrees + offset) * scale)


def fence_cells(fences: DataFrame) -> DataFrame:
    """Fences with the cells that cover their bounding box: ``level``, ``cell_y``, ``cell_x`` and ``inner``.

    The level follows the fence's size, so a fence has at most (SPAN + 2) ** 2 cells. ``inner`` marks cells that surely lie
    inside a circle as a whole; columns wrap at 180 degrees.
    """
    lat, lon, radius = F.col("center_latitude"), F.col("center_longitude"), F.col("radius_meters")
    corner = F.col("vertices")
    circle = F.col("geofence_type") == "circle"
    d_lat = radius / METRES_PER_DEGREE * 1.01
    widest = F.least(F.abs(lat) + d_lat, F.lit(89.9))
    d_lon = F.least(d_lat / F.cos(F.radians(widest)), F.lit(180.0))

    def edge(of_circle: Column, of_corners: Column) -> Column:
        return F.when(circle, of_circle).otherwise(of_corners)

    lats, lons = F.transform(corner, lambda v: v["lat"]), F.transform(corner, lambda v: v["lon"])
    box = {
        "_south": F.greatest(edge(lat - d_lat, F.array_min(lats)), F.lit(-90.0)), "_north": F.least(edge(lat + d_lat, F.array_max(lats)), F.lit(90.0)),
        "_west": edge(lon - d_lon, F.array_min(lons)), "_east": edge(lon + d_lon, F.array_max(lons)),
    }
    extent = F.greatest(F.col("_north") - F.col("_south"), F.col("_east") - F.col("_west"), F.lit(1e-9))
    level = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.floor(F.log2(SPAN * 180.0 / extent)))).cast("int")
    boxed = fences.withColumns(box).withColumn("level", level)
    at = lambda name, offset: _cell_of(F.col(name), F.col("level"), offset)
    rows = boxed.withColumn("cell_y", F.explode(F.sequence(at("_south", 90.0), at("_north", 90.0))))
    rows = rows.withColumn("_x", F.explode(F.sequence(at("_west", 180.0), at("_east", 180.0))))
    columns = F.pow(F.lit(2.0), F.col("level") + 1).cast("bigint")
    width = F.lit(180.0) / F.pow(F.lit(2.0), F.col("level"))
    corners = [haversine(lat, lon, F.col("cell_y") * width - 90 + i * width, F.col("_x") * width - 180 + j * width, EARTH_M) for i in (0, 1) for j in (0, 1)]
    # cells below a degree are nearly flat, so the farthest point of one is a corner, up to a fifth of a percent
    inner = circle & (width <= 1.0) & (F.greatest(*corners) <= radius * 0.998)
    placed = rows.withColumns({"inner": F.coalesce(inner, F.lit(False)), "cell_x": F.pmod("_x", columns)})
    return placed.drop("_south", "_north", "_west", "_east", "_x").dropDuplicates(["geofence_id", "level", "cell_y", "cell_x"])


def fences_by_cell(fences: DataFrame) -> DataFrame:
    """The fences of every cell as one array: cells shrink with their fences, so only fences that crowd one place share one."""
    fence = F.struct(*FENCE, "inner")
    return fence_cells(fences).groupBy("level", "cell_y", "cell_x").agg(F.collect_list(fence).alias("near"))


def with_fences(points: DataFrame, fences: DataFrame) -> DataFrame:
    """Points with ``inside``, the sorted ids of the fences around them; batch or stream.

    One left join per level that occurs (at most 23), each by the point's cell of that level, against a table that is
    usually small enough to travel to the points; the points themselves are not regrouped.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    cells = materialize(fences_by_cell(fences), "fence-cells")
    id_type = dict(fences.dtypes)["geofence_id"]

    def holds(f: Column) -> Column:
        near = f["inner"] | (haversine(lat, lon, f["center_latitude"], f["center_longitude"], EARTH_M) <= f["radius_meters"])
        return F.when(f["geofence_type"] == "circle", near).otherwise(inside_polygon(lat, lon, f["vertices"]))

    out, found = points, []
    for (level,) in sorted(cells.select("level").distinct().collect()):
        keys = {f"_y{level}": _cell_of(lat, level, 90.0), f"_x{level}": F.pmod(_cell_of(lon, level, 180.0), F.lit(2 ** (level + 1)))}
        own = cells.filter(F.col("level") == level).select(F.col("cell_y").alias(f"_y{level}"), F.col("cell_x").alias(f"_x{level}"), F.col("near").alias(f"_near{level}"))
        out = out.withColumns(keys).join(own, list(keys), "left")
        found.append(F.coalesce(F.transform(F.filter(f"_near{level}", holds), lambda f: f["geofence_id"]), F.array().cast(f"array<{id_type}>")))
    inside = F.sort_array(F.concat(*found)) if found else F.array().cast(f"array<{id_type}>")
    return out.withColumn("inside", inside).select(*points.columns, "inside")


def inside_polygon(lat: Column, lon: Column, vertices: Column) -> Column:
    """Odd number of edges crossed by a ray towards growing latitude."""
    ends = F.concat(F.slice(vertices, 2, F.size(vertices) - 1), F.slice(vertices, 1, 1))

    def crossed(e: Column) -> Column:
        a, b = e["a"], e["b"]
        spans = (lon > F.least(a["lon"], b["lon"])) & (lon <= F.greatest(a["lon"], b["lon"]))
        slope = F.try_divide(b["lat"] - a["lat"], b["lon"] - a["lon"])
        return F.coalesce(spans & (lat <= a["lat"] + (lon - a["lon"]) * slope), F.lit(False))

    edges = F.zip_with(vertices, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.pmod(F.size(F.filter(edges, crossed)), F.lit(2)) == 1


def points_in_fences(points: DataFrame, fences: DataFrame, key: str = "seq") -> DataFrame:
    """(point key, fence id) for every point inside a fence."""
    return with_fences(points, fences).select(key, F.explode("inside").alias("geofence_id"))


def transitions(df: DataFrame, fences: DataFrame) -> DataFrame:
    """Alerts from rows that carry ``inside`` and ``_was`` fence arrays; each fence tells which kind it wants."""
    moves = F.concat(
        F.transform(F.array_except("inside", "_was"), lambda f: F.struct(f.alias("geofence_id"), F.lit("enter").alias("alert_type"))),
        F.transform(F.array_except("_was", "inside"), lambda f: F.struct(f.alias("geofence_id"), F.lit("exit").alias("alert_type"))),
    )
    out = df.select("truck_id", "seq", "ts", "latitude", "longitude", F.explode(moves).alias("_m")).select("*", "_m.*").drop("_m")
    wanted = fences.select("geofence_id", F.col("name").alias("geofence_name"), "alert_on")
    return out.join(wanted, "geofence_id").filter((F.col("alert_on") == "both") | (F.col("alert_on") == F.col("alert_type"))).drop("alert_on")


def geofence_alerts(points: DataFrame, fences: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Enter and exit alerts against the previous fix of each truck; a first fix gives none. The fixes are shuffled once."""
    placed = with_fences(points, fences)
    paired = tl.previous_row(placed, ["truck_id"], ["ts", "seq"], {"inside": "_was"}, floor)
    return transitions(paired.filter(F.col("_was").isNotNull()), fences)


def with_segments(points: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    """Distance and idle seconds between a fix and the one before it."""
    carry = {"latitude": "_lat", "longitude": "_lon", "ts": "_ts"}
    paired = tl.previous_row(points, ["truck_id"], ["ts", "seq"], carry, floor)
    return segments_of(paired)


def segments_of(paired: DataFrame) -> DataFrame:
    metres = haversine(F.col("_lat"), F.col("_lon"), F.col("latitude"), F.col("longitude"), EARTH_M)
    micros = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("_ts").cast("timestamp"))
    return paired.withColumns(
        {
            "segment_m": F.coalesce(metres, F.lit(0.0)),
            "idle_us": F.when((F.col("engine_status") == "idle") & F.col("_ts").isNotNull(), micros).otherwise(F.lit(0).cast("bigint")),
        }
    ).drop("_lat", "_lon", "_ts")


def trip_aggregate(segments: DataFrame, group: list) -> DataFrame:
    return segments.groupBy(*group).agg(
        F.min("ts").alias("period_start"), F.max("ts").alias("period_end"),
        (F.sum("segment_m") / 1000).alias("total_distance_km"),
        ratio(F.sum("speed_kmh"), F.count("speed_kmh")).alias("average_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        (F.sum("idle_us") / 60_000_000.0).alias("idle_time_minutes"),
        F.count(F.lit(1)).alias("coordinates_count"),
    )


def trip_stats(points: DataFrame, floor: int = tl.HOT_ROWS) -> DataFrame:
    return trip_aggregate(with_segments(points, floor), ["truck_id"])


def fleet_summary(trips: DataFrame) -> DataFrame:
    """Fleet totals; the speed is the mean of the trucks' means."""
    return trips.agg(
        F.sum("total_distance_km").alias("total_km"),
        ratio(F.sum("average_speed_kmh"), F.count(F.lit(1))).alias("mean_truck_speed"),
        F.max("max_speed_kmh").alias("max_speed_kmh"),
        F.sum("coordinates_count").alias("fixes"),
    )
