"""Queries on tables that go out to files and come back: CSV by year, land cover by dataset, artifacts, kept tables, dense samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from emberline.operators import rasters as ra
from emberline.operators import training
from emberline.operators import regions as rg
from emberline.operators import window_cells as wc
from emberline.operators import window_join as wj
from emberline.operators.lineage import shared_folder
from emberline.plans import points as pq
from emberline.plans import regions, views
from emberline.plans.land_cover import EVT, METADATA, metadata, vegetation
from emberline.plans.views import detections, raster_cells, sql, weather
from emberline.sources import catalogue, chains, hourly, months
from emberline.sources import detections as sd

#: Layers and width of the dense samples: the detections now, half a day ago, and a day on, in wide cells.
DENSE, WIDE = [w for w in wj.standard_windows() if w[0] in (0, 1, 8)], 2250
SIDE = 22_500 // WIDE


def fresh(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def detections_from_csv(spark, sf):
    """Detections written as the file of their year and read by dataset and years."""
    folder = fresh(spark, "csv")
    rows = detections(spark, sf).select("type", "acq_date", "acq_time", "longitude", "latitude", "frp")
    rows.write.option("header", True).csv(f"{folder}/viirs_375m/2024.csv")
    return sd.with_times(sd.read_csv(spark, folder, "viirs_375m", [2024])).select("type", "acq_datetime", "longitude", "latitude", "frp")


def land_cover_from_store(spark, sf):
    folder = fresh(spark, "cover")
    vegetation(spark, sf).write.parquet(f"{folder}/{catalogue.land_cover_path('landfire_evt')}")
    raster_cells(spark, sf).select("row", "col", F.floor("dem").cast("int").alias("value")).write.parquet(f"{folder}/{catalogue.land_cover_path('landfire_dem')}")
    return catalogue.read_land_cover(spark, folder, ["landfire_dem", "landfire_evt"])


def layer_units(spark, sf):
    """Brands of parts stand for units of layers; nations have none."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    wanted = part.select(F.col("p_type").alias("name")).distinct().unionByName(spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_name").alias("name")))
    return catalogue.units(part.select(F.col("p_type").alias("name"), F.col("p_brand").alias("units")), wanted)


def artifacts_round_trip(spark, sf):
    folder = fresh(spark, "artifacts")
    made = chains.artifacts(sd.of_types(detections(spark, sf), (0, 1, 2, 3)), "2024-01-05", "2024-01-20", 63, 123)
    catalogue.write_dataset(made, folder, {"start": "2024-01-05"})
    found = catalogue.read_dataset(spark, folder, ["points", "search_table"])
    table = found["search_table"]
    return table.join(found["points"].select(F.col("point_id").alias("det_id"), F.lit(True).alias("is_point")), "det_id", "left").select("det_id", "position", F.coalesce("is_point", F.lit(False)).alias("is_point"))


def class_metadata(spark, sf):
    folder = fresh(spark, "classes")
    rows = metadata(spark, sf).select(F.col("at").cast("int").alias("OID_"), "VALUE", "EVT_LF")
    rows.write.option("header", True).csv(folder)
    return catalogue.read_classes(spark, folder)


def weather_slice(spark, sf):
    """Hours from one to another, both included, of a table that marks missing ones."""
    folder = fresh(spark, "weather")
    months.with_missing(weather(spark, sf), "2024-01-01", "2024-02-01").write.parquet(folder)
    return catalogue.read_weather(spark, folder, "2024-01-10 00:00:00", "2024-01-12 06:00:00", ["temperature"])


def weather_hours_by_path(spark, sf):
    """The weather as a file for each hour, read by path, with hours that have none."""
    folder = fresh(spark, "hours")
    hourly.write_hours(weather(spark, sf).drop("precipitation_rate"), folder).count()
    return hourly.read_hours(spark, folder, "2024-01-01 00:00", "2024-02-01 00:00", ["temperature", "wind_u"], hours=24)


def kept_table(spark, sf):
    """A table that is made once under a path which tells its parameters, and then read."""
    path = sd.table_path(fresh(spark, "kept"), "filtered", start="2024-01-05", end="2024-01-20", types=[0, 1])
    make = lambda: sd.between(sd.of_types(detections(spark, sf), (0, 1)), "2024-01-05", "2024-01-20").select("det_id", "type")
    sd.kept(spark, path, make)
    return sd.kept(spark, path, lambda: make().limit(0))


def region_from_store(spark, sf):
    """Polygons written and read, and the outlines of their regions."""
    folder = fresh(spark, "polygons")
    catalogue.write_polygons(regions.polygons(spark, sf), folder)
    rings = catalogue.read_polygons(spark, folder, "region long, name string")
    found = rg.outlines(rg.union(rg.edges(rings, "region", "polygon"), regions.BAND))
    return found.select("region", F.round("perimeter", 3).alias("perimeter"), F.round("area", 1).alias("area"))


def missing_to_null(spark, sf):
    return vegetation(spark, sf).withColumn("value", ra.without_missing(F.col("value")))


def raster_bounds(spark, sf):
    """West, south, east and north of the raster, by its rows."""
    rows = raster_cells(spark, sf).agg((F.max("row") + 1).alias("rows")).first().rows  # the raster's own size
    bounds = views.RASTER_GRID.bounds(rows, 40)
    cells = raster_cells(spark, sf).agg(F.count("*").alias("cells"))
    return cells.select("cells", *[F.lit(float(v)).alias(n) for n, v in zip(("west", "south", "east", "north"), bounds)])


def dense_samples(spark, sf):
    """Dense tensors of each point, written and read, cut into observed and target layers."""
    p = views.points(spark, sf)
    cells = wc.rasterized(p, wj.halo(p, views.detections(spark, sf), DENSE), DENSE, cell=WIDE)
    place = F.element_at(F.create_map(*[F.lit(v) for k, w in enumerate(DENSE) for v in (w[0], k)]), F.col("layer"))
    folder = fresh(spark, "dense")
    training.dense(cells.withColumn("layer", place), len(DENSE), SIDE).write.parquet(folder)
    split = training.split_tensor(spark.read.parquet(folder), len(DENSE), 2, SIDE)
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("int").cast("string")), "").alias(c)
    return split.select("point_id", text("observed"), text("target"))


QUERIES = {
    f.__name__: f
    for f in (detections_from_csv, land_cover_from_store, layer_units, artifacts_round_trip, class_metadata, weather_slice, weather_hours_by_path, kept_table, region_from_store, missing_to_null, raster_bounds, dense_samples)
}

_VEG = f"SELECT CAST(floor(p_partkey/40) AS INT) AS row, CAST(p_partkey%40 AS INT) AS col, {EVT} AS value FROM part"
_BITS = lambda a, b: f"string_agg(CASE WHEN d.k IS NULL THEN '0' ELSE '1' END, '' ORDER BY s.k) FILTER (s.k >= {a} AND s.k < {b})"
ORACLES = {
    "detections_from_csv": sql("SELECT type, date_trunc('minute', acq_datetime) AS acq_datetime, longitude, latitude, frp FROM detections", "detections"),
    "land_cover_from_store": sql(f"SELECT 'landfire_dem' AS layer, row, col, CAST(floor(dem) AS INT) AS value FROM raster_cells UNION ALL SELECT 'landfire_evt', row, col, value FROM ({_VEG})", "raster_cells"),
    "layer_units": "SELECT w.name, coalesce(min(p_brand), 'none') AS units FROM (SELECT DISTINCT p_type AS name FROM part UNION ALL SELECT n_name FROM nation) w LEFT JOIN part ON p_type = w.name GROUP BY w.name",
    "artifacts_round_trip": sql("""SELECT det_id, CAST(row_number() OVER (ORDER BY acq_datetime, x, y, det_id) - 1 AS BIGINT) AS position,
        hour(acq_datetime)*60 + minute(acq_datetime) BETWEEN 390 AND 749 AND acq_datetime >= TIMESTAMP '2024-01-05' AND acq_datetime < TIMESTAMP '2024-01-20' AS is_point
        FROM detections WHERE type < 4 AND acq_datetime >= TIMESTAMP '2024-01-05' - INTERVAL 63 HOUR AND acq_datetime < TIMESTAMP '2024-01-20' + INTERVAL 123 HOUR""", "detections"),
    "class_metadata": f"SELECT VALUE, EVT_LF FROM ({METADATA})",
    "weather_slice": sql("SELECT time, wrow, wcol, temperature FROM weather WHERE time BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12 06:00:00'", "detections", "weather"),
    "weather_hours_by_path": sql("SELECT h.time, w.wrow, w.wcol, w.temperature, w.wind_u, w.time IS NULL AS missing FROM (SELECT unnest(range(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-01', INTERVAL 1 HOUR)) AS time) h LEFT JOIN weather w ON w.time = h.time", "detections", "weather"),
    "kept_table": sql("SELECT det_id, type FROM detections WHERE type < 2 AND acq_datetime >= TIMESTAMP '2024-01-05' AND acq_datetime < TIMESTAMP '2024-01-20'", "detections"),
    "region_from_store": regions.ORACLES["region_outlines"],
    "missing_to_null": f"SELECT row, col, CASE WHEN value NOT IN (-32768, -9999) THEN value END AS value FROM ({_VEG})",
    "raster_bounds": sql("SELECT count(*) AS cells, 0.0::DOUBLE AS west, 60000.0::DOUBLE - (max(row) + 1)*1500 AS south, 60000.0::DOUBLE AS east, 60000.0::DOUBLE AS north FROM raster_cells", "raster_cells"),
    "dense_samples": sql(f""", hits AS (SELECT DISTINCT p.point_id, (CASE w.layer WHEN 8 THEN 2 ELSE w.layer END*{SIDE} + CAST(floor({SIDE} - (d.y - p.y + 11250)/{WIDE}) AS INT))*{SIDE} + CAST(floor((d.x - p.x + 11250)/{WIDE}) AS INT) AS k
          FROM points p CROSS JOIN windows w JOIN detections d ON {pq.IN} WHERE w.layer IN (0, 1, 8) AND floor({SIDE} - (d.y - p.y + 11250)/{WIDE}) BETWEEN 0 AND {SIDE - 1} AND floor((d.x - p.x + 11250)/{WIDE}) BETWEEN 0 AND {SIDE - 1})
        SELECT h.point_id, {_BITS(0, 2 * SIDE * SIDE)} AS observed, {_BITS(2 * SIDE * SIDE, 3 * SIDE * SIDE)} AS target
        FROM (SELECT DISTINCT point_id FROM hits) h CROSS JOIN range({3 * SIDE * SIDE}) s(k) LEFT JOIN hits d ON d.point_id = h.point_id AND d.k = s.k GROUP BY h.point_id""", "detections", "points", "windows"),
}
