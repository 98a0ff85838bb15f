"""Points in polygons: even-odd crossing counts against a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def edges(spark: SparkSession, rings: dict[str, list[list[tuple[float, float]]]]) -> DataFrame:
    """``region, x1, y1, x2, y2`` of regions made of rings; a hole is a ring inside another."""
    rows = [(name, *map(float, a), *map(float, b)) for name, parts in rings.items() for ring in parts for a, b in zip(ring, ring[1:] + ring[:1])]
    return spark.createDataFrame(rows, "region string, x1 double, y1 double, x2 double, y2 double")


def inside(points: DataFrame, edges: DataFrame, id_col: str, x: str = "longitude", y: str = "latitude", band: float = 0.05) -> DataFrame:
    """``id_col, region`` of the points in each region.

    Points and edges meet by bands of y, so a point is tested against the edges at its own
    height alone; an edge is half-open in y, so a vertex counts once. The regions' bounds
    are tested first.
    """
    box = edges.agg(F.min(F.least("x1", "x2")).alias("bx0"), F.max(F.greatest("x1", "x2")).alias("bx1"), F.min(F.least("y1", "y2")).alias("by0"), F.max(F.greatest("y1", "y2")).alias("by1"))
    rows = points.select(id_col, F.col(x).alias("_x"), F.col(y).alias("_y")).crossJoin(F.broadcast(box))  # one row
    rows = rows.where("_x between bx0 and bx1 and _y between by0 and by1").withColumn("_band", F.floor(F.col("_y") / band))
    sides = edges.where("y1 <> y2").withColumn("_band", F.explode(F.sequence(F.floor(F.least("y1", "y2") / band), F.floor(F.greatest("y1", "y2") / band))))
    met = rows.join(sides, "_band").where((F.col("y1") <= F.col("_y")) != (F.col("y2") <= F.col("_y")))
    met = met.where(F.col("_x") < F.col("x1") + (F.col("_y") - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1")))
    return met.groupBy(id_col, "region").agg(F.count("*").alias("n")).where("n % 2 = 1").select(id_col, "region")


def within_region(detections: DataFrame, padded: DataFrame, region: DataFrame, id_col: str = "det_id") -> DataFrame:
    """The detections in the padded region, with ``within_region`` telling which are in the region itself."""
    near = inside(detections, padded, id_col).select(id_col).distinct()
    own = inside(detections, region, id_col).select(id_col).distinct().withColumn("_in", F.lit(True))
    return detections.join(near, id_col, "left_semi").join(own, id_col, "left").withColumn("within_region", F.coalesce("_in", F.lit(False))).drop("_in")
