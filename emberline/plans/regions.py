"""Queries on regions: choosing and joining polygons, and rasters by region."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.operators import regions as rg
from emberline.plans import views
from emberline.plans.views import detections, raster_cells, sql, weather

BAND, PADDING = 2000.0, 2500
WIDE, TALL, SLANT = 9011, 10007, 1507
X0, Y0 = f"1003 + (n_nationkey//5)*2517 + (n_nationkey%5)*{WIDE}", f"4021 + (n_nationkey//5)*{TALL}"
CORNERS = [(X0, Y0), (f"{X0} + {WIDE}", Y0), (f"{X0} + {WIDE + SLANT}", f"{Y0} + {TALL}"), (f"{X0} + {SLANT}", f"{Y0} + {TALL}")]
PICKED = ("NATION_6", "NATION_7", "NATION_8", "NATION_12", "NATION_13")


def polygons(spark, sf):
    """Leaning bricks in courses, one a nation; the nations of a region are its parts."""
    ring = "array(" + ", ".join(f"struct({x} AS x, {y} AS y)" for x, y in CORNERS) + ")"
    rows = spark.read.parquet(f"{sf}/nation.parquet").selectExpr("n_nationkey AS polygon", "n_regionkey AS region", "n_name AS name", f"{ring.replace('//', ' div ')} AS ring")
    return rows.withColumn("part", F.expr("cast(polygon % 3 as int)"))


def region_edges(spark, sf):
    return rg.edges(polygons(spark, sf), "region", "polygon")


def region_by_name(spark, sf):
    sides = rg.edges(rg.chosen(polygons(spark, sf), "name", "NATION_7"), "region", "polygon")
    return rg.inside(detections(spark, sf), sides, ["region"], "det_id", "x", "y", BAND)


def region_by_part(spark, sf):
    sides = rg.edges(rg.chosen(polygons(spark, sf), "region", [1, 2, 3], part=1), "region", "polygon")
    return rg.inside(detections(spark, sf), rg.union(sides, BAND), ["region"], "det_id", "x", "y", BAND)


def region_of_several(spark, sf):
    """One region of polygons chosen by name, joined together, with the padded ring around it."""
    sides = rg.edges(rg.chosen(polygons(spark, sf), "name", list(PICKED)), "polygon").withColumn("region", F.lit("picked"))
    return rg.within_padded(detections(spark, sf), rg.union(sides, BAND), PADDING, BAND).select("det_id", "within_region")


def region_padded(spark, sf):
    return rg.within_padded(detections(spark, sf), rg.union(region_edges(spark, sf), BAND), PADDING, BAND)


def region_outlines(spark, sf):
    found = rg.outlines(rg.union(region_edges(spark, sf), BAND))
    return found.select("region", F.round("perimeter", 3).alias("perimeter"), F.round("area", 1).alias("area"))


def crop(spark, sf, touched):
    cells = raster_cells(spark, sf).select("row", "col", "nlcd")
    return rg.masked(cells, rg.row_ranges(region_edges(spark, sf), views.RASTER_GRID, touched), ["nlcd"], -32768).drop("outside")


def region_crop(spark, sf):
    return crop(spark, sf, True)


def region_crop_centres(spark, sf):
    return crop(spark, sf, False)


def region_mask(spark, sf):
    cells = raster_cells(spark, sf).select("row", "col")
    return rg.masked(cells, rg.row_ranges(region_edges(spark, sf), views.RASTER_GRID, True), [], crop=False)


def weather_by_region(spark, sf):
    """Hours cropped to each region, cells that it doesn't touch without values."""
    ranges = rg.row_ranges(region_edges(spark, sf), views.WEATHER_GRID, True)
    return rg.masked(weather(spark, sf).drop("precipitation_rate"), ranges, ["temperature", "wind_u"], row="wrow", col="wcol").drop("outside")


def weather_by_region_centres(spark, sf):
    ranges = rg.row_ranges(region_edges(spark, sf), views.WEATHER_GRID, False)
    return rg.masked(weather(spark, sf).drop("precipitation_rate"), ranges, ["temperature", "wind_u"], row="wrow", col="wcol").drop("outside")


QUERIES = {
    f.__name__: f
    for f in (
        region_by_name, region_by_part, region_of_several, region_padded, region_outlines, region_crop, region_crop_centres, region_mask, weather_by_region,
        weather_by_region_centres,
    )
}

_SIDES = " UNION ALL ".join(f"SELECT n_nationkey AS polygon, n_regionkey AS region, n_name AS name, CAST({a} AS DOUBLE) AS x1, CAST({b} AS DOUBLE) AS y1, CAST({c} AS DOUBLE) AS x2, CAST({d} AS DOUBLE) AS y2 FROM nation" for (a, b), (c, d) in zip(CORNERS, CORNERS[1:] + CORNERS[:1]))
SIDES = f", sides AS ({_SIDES})"
HELD = SIDES + ", held AS (SELECT DISTINCT region, name, det_id, polygon FROM (SELECT det_id, region, name, polygon FROM detections JOIN sides ON (y1 <= y) <> (y2 <= y) AND x < x1 + (y - y1) / (y2 - y1) * (x2 - x1) GROUP BY ALL HAVING count(*) % 2 = 1))"
_T = "least(greatest(((x - x1)*(x2 - x1) + (y - y1)*(y2 - y1)) / ((x2 - x1)**2 + (y2 - y1)**2), 0), 1)"
AROUND = HELD + f", around AS (SELECT DISTINCT region, name, det_id FROM detections, sides WHERE (x - x1 - {_T}*(x2 - x1))**2 + (y - y1 - {_T}*(y2 - y1))**2 <= {PADDING}**2)"


def _cells(source: str, cells: str, size: float, touched: bool, row: str = "row", col: str = "col") -> str:
    """Cells that a region holds, each tested by itself: its centre, and whether an edge passes through it."""
    c1, c2, r1, r2 = f"x1/{size}", f"x2/{size}", f"(60000 - y1)/{size}", f"(60000 - y2)/{size}"
    part = lambda at, a, b: (f"CASE WHEN {a} <> {b} THEN least(({at} - {a})/({b} - {a}), ({at} + 1 - {a})/({b} - {a})) WHEN {a} BETWEEN {at} AND {at} + 1 THEN 0 ELSE 2 END", f"CASE WHEN {a} <> {b} THEN greatest(({at} - {a})/({b} - {a}), ({at} + 1 - {a})/({b} - {a})) ELSE 1 END")
    (a, b), (c, d) = part(col, c1, c2), part(row, r1, r2)
    middle = f"SELECT region, {row}, {col} FROM places JOIN sides ON (({r1}) <= {row} + 0.5) <> (({r2}) <= {row} + 0.5) AND {col} + 0.5 < {c1} + ({row} + 0.5 - {r1}) / ({r2} - {r1}) * ({c2} - {c1}) GROUP BY region, polygon, {row}, {col} HAVING count(*) % 2 = 1"
    crossed = f" UNION SELECT region, {row}, {col} FROM places, sides WHERE greatest({a}, {c}, 0) <= least({b}, {d}, 1)" if touched else ""
    return SIDES + f""", places AS (SELECT CAST(i AS INT) AS {row}, CAST(j AS INT) AS {col} FROM range(-2, {cells}) a(i), range(-2, {cells}) b(j)), mine AS ({middle}{crossed}),
        box AS (SELECT region, min({row}) AS r0, max({row}) AS r1, min({col}) AS c0, max({col}) AS c1 FROM mine GROUP BY region)"""


def _crop(touched: bool) -> str:
    return sql(_cells("raster_cells", "60", 1500.0, touched) + """ SELECT b.region, c.row - r0 AS row, c.col - c0 AS col, CASE WHEN m.region IS NULL THEN -32768 ELSE nlcd END AS nlcd
        FROM raster_cells c JOIN box b ON c.row BETWEEN r0 AND r1 AND c.col BETWEEN c0 AND c1 LEFT JOIN mine m ON m.region = b.region AND m.row = c.row AND m.col = c.col""", "raster_cells")


def _weather(touched: bool) -> str:
    return sql(_cells("weather", "9", 11250.0, touched, "wrow", "wcol") + """ SELECT b.region, time, c.wrow - r0 AS wrow, c.wcol - c0 AS wcol, CASE WHEN m.region IS NOT NULL THEN temperature END AS temperature, CASE WHEN m.region IS NOT NULL THEN wind_u END AS wind_u
        FROM weather c JOIN box b ON c.wrow BETWEEN r0 AND r1 AND c.wcol BETWEEN c0 AND c1 LEFT JOIN mine m ON m.region = b.region AND m.wrow = c.wrow AND m.wcol = c.wcol""", "detections", "weather")


ORACLES = {
    "region_by_name": sql(HELD + " SELECT det_id, region FROM held WHERE name = 'NATION_7'", "detections"),
    "region_by_part": sql(HELD + " SELECT DISTINCT det_id, region FROM held WHERE region IN (1, 2, 3) AND polygon % 3 = 1", "detections"),
    "region_of_several": sql(AROUND + f" SELECT det_id, max(own) AS within_region FROM (SELECT det_id, name, true AS own FROM held UNION ALL SELECT det_id, name, false FROM around) WHERE name IN {PICKED} GROUP BY det_id", "detections"),
    "region_padded": sql(AROUND + " SELECT det_id, region, max(own) AS within_region FROM (SELECT det_id, region, true AS own FROM held UNION ALL SELECT det_id, region, false FROM around) GROUP BY det_id, region", "detections"),
    # borders of neighbours that overlap, all of them level or the same slant
    "region_outlines": "WITH" + SIDES[1:] + """, size AS (SELECT region, polygon, sqrt((x2 - x1)**2 + (y2 - y1)**2) AS len, x1*y2 - x2*y1 AS twice FROM sides),
        common AS (SELECT a.region, CASE WHEN a.y1 = a.y2 THEN greatest(least(greatest(a.x1, a.x2), greatest(b.x1, b.x2)) - greatest(least(a.x1, a.x2), least(b.x1, b.x2)), 0) ELSE sqrt((a.x2 - a.x1)**2 + (a.y2 - a.y1)**2) END AS len
          FROM sides a JOIN sides b ON a.region = b.region AND a.polygon <> b.polygon AND (a.y1 = a.y2 AND b.y1 = b.y2 AND a.y1 = b.y1 OR a.y1 <> a.y2 AND least(a.x1, a.x2) = least(b.x1, b.x2) AND least(a.y1, a.y2) = least(b.y1, b.y2) AND b.y1 <> b.y2))
        SELECT s.region, round(s.len - coalesce(c.len, 0), 3) AS perimeter, round(s.area, 1) AS area FROM (SELECT region, sum(len) AS len, sum(twice)/2 AS area FROM size GROUP BY region) s LEFT JOIN (SELECT region, sum(len) AS len FROM common GROUP BY region) c USING (region)""",
    "region_crop": _crop(True),
    "region_crop_centres": _crop(False),
    "region_mask": sql(_cells("raster_cells", "60", 1500.0, True) + " SELECT b.region, c.row, c.col, m.region IS NULL AS outside FROM raster_cells c CROSS JOIN box b LEFT JOIN mine m ON m.region = b.region AND m.row = c.row AND m.col = c.col", "raster_cells"),
    "weather_by_region": _weather(True),
    "weather_by_region_centres": _weather(False),
}
