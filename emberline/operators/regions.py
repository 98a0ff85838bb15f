"""Regions of polygons: choosing them from a table, union, padding, and the raster cells they hold.

A table of polygons has a row for each ring: ``polygon`` (its number), ``part`` of the
polygon, ``ring`` (array of (x, y); a hole is a ring inside another), and any columns to
choose by. All work is on edges, ``region, polygon, x1, y1, x2, y2``: edges meet points,
rasters and each other in bands of y, so that none is held against all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.geo import Affine

#: How far beside an edge its two sides are looked at, as a share of its coordinates.
BESIDE = 1e-9


def chosen(polygons: DataFrame, column: str | None = None, value=None, part: int | None = None) -> DataFrame:
    """The rings of a region: of the first polygon whose column has a value, of all whose column has one of
    several (list, tuple or set), of all without column; of these, with ``part``, the rings of that part alone."""
    rows = polygons
    if column is not None:
        if isinstance(value, (list, tuple, set)):
            rows = rows.where(F.col(column).isin(*value))
        else:
            rows = rows.where(F.col(column) == F.lit(value))
            first = rows.agg(F.min("polygon").alias("_first"))
            rows = rows.join(F.broadcast(first), F.col("polygon") == F.col("_first")).drop("_first")  # one row
    return rows if part is None else rows.where(F.col("part") == part)


def edges(rings: DataFrame, *keys: str) -> DataFrame:
    """``keys, x1, y1, x2, y2`` of rings, which may repeat their first point at the end."""
    n = F.size("ring")
    pairs = F.transform("ring", lambda p, i: F.struct(p["x"].cast("double").alias("x1"), p["y"].cast("double").alias("y1"), F.get("ring", (i + 1) % n)["x"].cast("double").alias("x2"), F.get("ring", (i + 1) % n)["y"].cast("double").alias("y2")))
    rows = rings.select(*keys, F.explode(pairs).alias("e")).select(*keys, "e.*")
    return rows.where("x1 <> x2 or y1 <> y2")


def _bands(lo: Column, hi: Column, band: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / band), F.floor(hi / band)))


def _reach(lo: Column, hi: Column) -> tuple[Column, Column]:
    """Least and greatest x of an edge between two heights that it meets."""
    at = lambda y: F.least(F.greatest((y - F.col("y1")) / (F.col("y2") - F.col("y1")), F.lit(0.0)), F.lit(1.0))
    x = lambda y: F.col("x1") + at(y) * (F.col("x2") - F.col("x1"))
    flat = F.col("y1") == F.col("y2")
    return F.when(flat, F.least("x1", "x2")).otherwise(F.least(x(lo), x(hi))), F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(x(lo), x(hi)))


def inside(points: DataFrame, sides: DataFrame, keys: list[str], id_col: str, x: str, y: str, band: float) -> DataFrame:
    """``id_col, keys`` of the points within the edges of each key, by crossings at the point's height; a point on an
    edge that runs up or down to its right counts with what is left of it."""
    rows = points.select(id_col, F.col(x).alias("_x"), F.col(y).alias("_y")).withColumn("_band", F.floor(F.col("_y") / band))
    tall = sides.where("y1 <> y2").withColumn("_band", _bands(F.least("y1", "y2"), F.greatest("y1", "y2"), band))
    met = rows.join(tall, "_band").where((F.col("y1") <= F.col("_y")) != (F.col("y2") <= F.col("_y")))
    met = met.where(F.col("_x") < F.col("x1") + (F.col("_y") - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1")))
    return met.groupBy(id_col, *keys).agg(F.count("*").alias("_n")).where("_n % 2 = 1").select(id_col, *keys)


def _crossing(a: str, b: str) -> Column:
    """Where two edges meet: ends of one on the other, or the point they share, from the same sums whichever is first."""
    c = lambda e, n: F.col(f"{e}.{n}")
    side = lambda e, x, y: (c(e, "x2") - c(e, "x1")) * (y - c(e, "y1")) - (c(e, "y2") - c(e, "y1")) * (x - c(e, "x1"))
    on = lambda e, x, y: (side(e, x, y) == 0) & x.between(F.least(c(e, "x1"), c(e, "x2")), F.greatest(c(e, "x1"), c(e, "x2"))) & y.between(F.least(c(e, "y1"), c(e, "y2")), F.greatest(c(e, "y1"), c(e, "y2")))
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    ends = [F.when(on(a, c(b, f"x{k}"), c(b, f"y{k}")), point(c(b, f"x{k}"), c(b, f"y{k}"))) for k in (1, 2)]
    p, q = side(b, c(a, "x1"), c(a, "y1")), side(b, c(a, "x2"), c(a, "y2"))
    r, s = side(a, c(b, "x1"), c(b, "y1")), side(a, c(b, "x2"), c(b, "y2"))
    cross = (F.signum(p) * F.signum(q) < 0) & (F.signum(r) * F.signum(s) < 0)
    ta, tb = p / (p - q), r / (r - s)
    first = F.col(a) <= F.col(b)
    x = F.when(first, c(a, "x1") + ta * (c(a, "x2") - c(a, "x1"))).otherwise(c(b, "x1") + tb * (c(b, "x2") - c(b, "x1")))
    y = F.when(first, c(a, "y1") + ta * (c(a, "y2") - c(a, "y1"))).otherwise(c(b, "y1") + tb * (c(b, "y2") - c(b, "y1")))
    return F.filter(F.array(*ends, F.when(cross, point(x, y))), lambda v: v.isNotNull())


def union(sides: DataFrame, band: float, key: str = "region") -> DataFrame:
    """Outlines of the union of each region's polygons: ``region, x1, y1, x2, y2``, the region to the left of every edge.

    Edges are split where they meet others; of the pieces those stay that have the region
    on one side alone. Borders that polygons share have it on both, so they go, and so does
    all that lies within another polygon. Pieces that several polygons have are one.
    """
    own = sides.select(key, "polygon", F.struct(*[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")]).alias("a"))
    lo, hi = lambda e: F.least(f"{e}.y1", f"{e}.y2"), lambda e: F.greatest(f"{e}.y1", f"{e}.y2")
    left, right = lambda e: F.least(f"{e}.x1", f"{e}.x2"), lambda e: F.greatest(f"{e}.x1", f"{e}.x2")
    once = own.select(key, "a").distinct()
    rows = once.withColumn("_band", _bands(lo("a"), hi("a"), band))
    both = rows.join(rows.withColumnRenamed("a", "b"), [key, "_band"]).where("a <> b")
    both = both.where((left("a") <= right("b")) & (left("b") <= right("a")) & (lo("a") <= hi("b")) & (lo("b") <= hi("a")))
    cuts = both.select(key, "a", F.explode(_crossing("a", "b")).alias("p")).groupBy(key, "a").agg(F.collect_set("p").alias("cuts"))  # as many as edges cross one edge
    e = lambda n: F.col(f"a.{n}")
    end = lambda k: F.struct(e(f"x{k}").alias("x"), e(f"y{k}").alias("y"))
    along = lambda p: (p["x"] - e("x1")) * (e("x2") - e("x1")) + (p["y"] - e("y1")) * (e("y2") - e("y1"))
    rows = once.join(cuts, [key, "a"], "left")
    every = F.array_union(F.array(end(1), end(2)), F.coalesce("cuts", F.array().cast("array<struct<x:double,y:double>>")))
    rows = rows.select(key, F.transform(F.array_sort(F.transform(every, lambda p: F.struct(along(p).alias("t"), p["x"].alias("x"), p["y"].alias("y")))), lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y"))).alias("ps"))
    rows = rows.select(key, F.explode(F.arrays_zip(F.slice("ps", F.lit(1), F.size("ps") - 1).alias("p"), F.slice("ps", F.lit(2), F.size("ps") - 1).alias("q"))).alias("s"))
    pieces = rows.select(key, F.least("s.p", "s.q").alias("p"), F.greatest("s.p", "s.q").alias("q")).where("p <> q").distinct()
    # the two sides of a piece, seen from its lesser end
    dx, dy = F.col("q.x") - F.col("p.x"), F.col("q.y") - F.col("p.y")
    size = F.sqrt(dx * dx + dy * dy)
    off = BESIDE * F.greatest(F.abs(F.col("p.x")), F.abs(F.col("p.y")), F.abs(F.col("q.x")), F.abs(F.col("q.y")), size)
    mx, my = (F.col("p.x") + F.col("q.x")) / 2, (F.col("p.y") + F.col("q.y")) / 2
    beside = lambda s: F.struct(F.lit(s).alias("side"), (mx - s * off * dy / size).alias("x"), (my + s * off * dx / size).alias("y"))
    looked = pieces.withColumn("at", F.explode(F.array(beside(1), beside(-1)))).select(F.struct(key, "p", "q", F.col("at.side").alias("side")).alias("piece"), F.col("at.x").alias("px"), F.col("at.y").alias("py"))
    within = inside(looked, own.select(F.col(key).alias("_region"), "polygon", "a.*"), ["_region", "polygon"], "piece", "px", "py", band)
    found = within.where(F.col(f"piece.{key}") == F.col("_region")).groupBy(F.col(f"piece.{key}").alias(key), "piece.p", "piece.q").agg(F.min("piece.side").alias("lo"), F.max("piece.side").alias("hi")).where("lo = hi")
    way = lambda a, b: F.when(F.col("lo") > 0, F.col(a)).otherwise(F.col(b))
    return found.select(key, way("p.x", "q.x").alias("x1"), way("p.y", "q.y").alias("y1"), way("q.x", "p.x").alias("x2"), way("q.y", "p.y").alias("y2"))


def outlines(sides: DataFrame, key: str = "region") -> DataFrame:
    """``region, perimeter, area`` of edges that have their region to the left."""
    length = F.sqrt(F.pow(F.col("x2") - F.col("x1"), 2) + F.pow(F.col("y2") - F.col("y1"), 2))
    return sides.groupBy(key).agg(F.sum(length).alias("perimeter"), (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"))


def near(points: DataFrame, sides: DataFrame, distance: float, key: str, id_col: str, x: str = "x", y: str = "y") -> DataFrame:
    """``id_col, key`` of points at most ``distance`` from an edge of the key; they meet in squares of that size."""
    d = float(distance)
    rows = points.select(id_col, F.col(x).alias("_x"), F.col(y).alias("_y")).withColumn("_gx", F.floor(F.col("_x") / d)).withColumn("_gy", F.floor(F.col("_y") / d))
    wide = sides.withColumn("_gy", F.explode(F.sequence(F.floor(F.least("y1", "y2") / d) - 1, F.floor(F.greatest("y1", "y2") / d) + 1)))
    lo, hi = _reach(F.col("_gy") * d - d, F.col("_gy") * d + 2 * d)
    wide = wide.withColumn("_gx", F.explode(F.sequence(F.floor(lo / d) - 1, F.floor(hi / d) + 1)))
    met = rows.join(wide, ["_gx", "_gy"])
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.least(F.greatest(((F.col("_x") - F.col("x1")) * dx + (F.col("_y") - F.col("y1")) * dy) / (dx * dx + dy * dy), F.lit(0.0)), F.lit(1.0))
    gap = F.pow(F.col("_x") - (F.col("x1") + t * dx), 2) + F.pow(F.col("_y") - (F.col("y1") + t * dy), 2)
    return met.where(gap <= d * d).select(id_col, key).distinct()


def within_padded(points: DataFrame, sides: DataFrame, padding: float, band: float, key: str = "region", id_col: str = "det_id", x: str = "x", y: str = "y") -> DataFrame:
    """``id_col, region, within_region`` of points in a region or at most ``padding`` from it, which is what a padded
    polygon holds; the flag is for the region itself. Edges are those of ``union``, or of polygons that don't overlap."""
    own = inside(points, sides, [key], id_col, x, y, band).withColumn("within_region", F.lit(True))
    around = near(points, sides, padding, key, id_col, x, y).withColumn("within_region", F.lit(False))
    return own.unionByName(around).groupBy(id_col, key).agg(F.max("within_region").alias("within_region"))


def row_ranges(sides: DataFrame, grid: Affine, touched: bool, key: str = "region") -> DataFrame:
    """``region, row, lo, hi``: the columns of each raster row that a region's polygons hold, as ranges that don't meet.

    A cell is held if its centre is within a polygon; with ``touched`` also if an edge crosses it.
    """
    c1, r1 = grid.index(F.col("x1"), F.col("y1"))
    c2, r2 = grid.index(F.col("x2"), F.col("y2"))
    own = sides.select(key, "polygon", c1.alias("x1"), r1.alias("y1"), c2.alias("x2"), r2.alias("y2"))
    top, bottom = F.least("y1", "y2"), F.greatest("y1", "y2")
    # centres: rows of which an edge passes the middle, half-open; the crossings of a row make pairs
    high = own.withColumn("row", F.explode(F.when(F.ceil(top - 0.5) < F.ceil(bottom - 0.5), F.sequence(F.ceil(top - 0.5), F.ceil(bottom - 0.5) - 1)).otherwise(F.array().cast("array<bigint>"))))
    high = high.withColumn("at", F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1")))
    order = Window.partitionBy(key, "polygon", "row").orderBy("at")  # the crossings of one row of one polygon
    pairs = high.withColumn("n", F.row_number().over(order)).withColumn("next", F.lead("at").over(order)).where("n % 2 = 1")
    ranges = pairs.select(key, "row", F.ceil(F.col("at") - 0.5).alias("lo"), (F.ceil(F.col("next") - 0.5) - 1).alias("hi")).where("lo <= hi")
    if touched:
        crossed = own.withColumn("row", F.explode(F.sequence(F.floor(top), F.floor(bottom))))
        lo, hi = _reach(F.col("row").cast("double"), F.col("row") + 1.0)
        ranges = ranges.unionByName(crossed.select(key, "row", F.floor(lo).alias("lo"), F.floor(hi).alias("hi")))
    seen = Window.partitionBy(key, "row").orderBy("lo", "hi")
    ranges = ranges.distinct().withColumn("before", F.max("hi").over(seen.rowsBetween(Window.unboundedPreceding, -1)))
    ranges = ranges.withColumn("run", F.sum(F.when(F.col("lo") > F.col("before") + 1, 1).otherwise(0)).over(seen.rowsBetween(Window.unboundedPreceding, 0)))
    return ranges.groupBy(key, "row", "run").agg(F.min("lo").cast("int").alias("lo"), F.max("hi").cast("int").alias("hi")).select(key, F.col("row").cast("int").alias("row"), "lo", "hi")


def masked(raster: DataFrame, ranges: DataFrame, values: list[str], fill=None, crop: bool = True, key: str = "region", row: str = "row", col: str = "col") -> DataFrame:
    """The raster once for each region: ``region, row, col``, other columns, and the values, which are ``fill`` outside.

    With ``crop`` the cells within the region's bounds alone, counted from their corner.
    Cells that the raster lacks stay away. Ranges are as many as a region has rows, so
    they meet the raster by row and by range of columns.
    """
    r = ranges.select(F.col(key).alias("_key"), F.col("row").alias("_row"), "lo", "hi")
    box = r.groupBy("_key").agg(F.min("_row").alias("_r0"), F.max("_row").alias("_r1"), F.min("lo").alias("_c0"), F.max("hi").alias("_c1"))
    if crop:
        asked = box.withColumn("_row", F.explode(F.sequence("_r0", "_r1")))
        cells = raster.join(asked, (F.col(row) == F.col("_row")) & F.col(col).between(F.col("_c0"), F.col("_c1"))).drop("_row")
    else:
        cells = raster.crossJoin(F.broadcast(box))  # every region has the whole raster: one row a region
    held = r.withColumnRenamed("_key", "_k")
    cells = cells.join(held, (F.col("_key") == F.col("_k")) & (F.col(row) == F.col("_row")) & F.col(col).between(F.col("lo"), F.col("hi")), "left")
    outside = F.col("lo").isNull()
    place = {row: (F.col(row) - F.col("_r0")).cast("int"), col: (F.col(col) - F.col("_c0")).cast("int")} if crop else {}
    kept = {v: F.when(outside, F.lit(fill).cast(raster.schema[v].dataType)).otherwise(F.col(v)) for v in values}
    return cells.select(F.col("_key").alias(key), *[place.get(c, kept.get(c, F.col(c))).alias(c) for c in raster.columns], outside.alias("outside"))
