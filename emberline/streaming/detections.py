"""Detections as a stream: counts by time window and grid cell, and what burned after a point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import tables


def cell_counts(stream: DataFrame, window: str = "6 hours", slide: str | None = None, late: str = "1 hour", cell: float = tables.CELL) -> DataFrame:
    """``start, row, col, n`` by event time; what comes later than ``late`` is left out."""
    rows = stream.withColumn("t", F.col("acq_datetime").cast("timestamp")).withWatermark("t", late)
    key = [F.window("t", window, slide) if slide else F.window("t", window), F.floor(F.col("y") / cell).alias("row"), F.floor(F.col("x") / cell).alias("col")]
    return rows.groupBy(*key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "row", "col", "n")


def followed(points: DataFrame, detections: DataFrame, lo_hours: int, hi_hours: int, late: str = "1 hour", size: float = tables.WINDOW) -> DataFrame:
    """Stream-stream join of points with the detections from ``lo_hours`` to before ``hi_hours`` after them, in the square around them.

    Grid cells are part of the join's key, and watermarks let Spark drop what no window can reach any more.
    """
    half = size / 2
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - half) / size), F.floor((F.col(c) + half) / size)))
    p = points.withColumn("pt", F.col("ts").cast("timestamp")).withWatermark("pt", late).select("point_id", "pt", F.col("x").alias("cx"), F.col("y").alias("cy"), span("x").alias("pgx"), "y").withColumn("pgy", span("y")).drop("y")
    d = detections.withColumn("dt", F.col("acq_datetime").cast("timestamp")).withWatermark("dt", late).select("det_id", "dt", "x", "y", F.floor(F.col("x") / size).alias("gx"), F.floor(F.col("y") / size).alias("gy"))
    when = F.expr(f"dt >= pt + interval {lo_hours} hours and dt < pt + interval {hi_hours} hours")
    near = (F.abs(F.col("x") - F.col("cx")) <= half) & (F.abs(F.col("y") - F.col("cy")) <= half)
    return p.join(d, (F.col("pgx") == F.col("gx")) & (F.col("pgy") == F.col("gy")) & when & near).select("point_id", "det_id")
