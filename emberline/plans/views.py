"""Inputs of the registered queries, made from the tables at hand: for Spark, and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions import tables
from emberline.functions.geo import Affine
from emberline.operators.window_join import standard_windows

RASTER_GRID = Affine.grid(1500, 0, 60000)
WEATHER_GRID = Affine.grid(tables.WEATHER_CELL, 0, 60000)

X, Y = "(CAST(round(value*100) AS BIGINT)*7919)%60000", "(user_id*397+(event_id%97)*613)%60000"
DETECTIONS = [
    "event_id AS det_id", "ts AS acq_datetime", "CAST(CAST(ts AS DATE) AS STRING) AS acq_date", "CAST(hour(ts)*100+minute(ts) AS INT) AS acq_time",
    "CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 WHEN 'error' THEN 3 ELSE 4 END AS type",
    f"CAST({X} AS DOUBLE) AS x", f"CAST({Y} AS DOUBLE) AS y",
    f"CAST(-124.0 AS DOUBLE) + CAST({X} AS DOUBLE)/100000 AS longitude", f"CAST(34.0 AS DOUBLE) + CAST({Y} AS DOUBLE)/100000 AS latitude",
    "value AS frp", "CAST(event_id%101 AS INT) AS conf",
]
NLCD = "CASE p_size%17 " + " ".join(f"WHEN {k} THEN {code}" for k, code in enumerate(sorted(tables.NLCD_LIFE_FORM))) + " END"
CELLS = ["CAST(floor(p_partkey/40) AS INT) AS row", "CAST(p_partkey%40 AS INT) AS col", "p_retailprice AS dem", f"{NLCD} AS nlcd"]
WEATHER = [
    "date_trunc('hour', acq_datetime) AS time", "CAST(floor((60000-y)/11250) AS INT) AS wrow", "CAST(floor(x/11250) AS INT) AS wcol",
    "frp",
]
POINTS = "hour(acq_datetime)*60+minute(acq_datetime) >= 390 AND hour(acq_datetime)*60+minute(acq_datetime) < 750 AND type IN (0,1,2,3)"

SQL = {
    "detections": f"SELECT {', '.join(DETECTIONS)} FROM events",
    "raster_cells": f"SELECT {', '.join(CELLS)} FROM part",
    "weather": f"SELECT {', '.join(WEATHER[:3])}, round(avg(frp), 6) AS temperature, max(frp) AS wind_u, count(*) AS precipitation_rate FROM detections GROUP BY 1, 2, 3",
    "points": f"SELECT det_id AS point_id, acq_datetime AS ts, x, y FROM detections WHERE {POINTS}",
    "windows": "SELECT * FROM (VALUES " + ", ".join(f"({k}, '{kind}', {lo}, {hi})" for k, kind, lo, hi in standard_windows()) + ") AS w(layer, kind, lo, hi)",
}


def sql(body: str, *names: str) -> str:
    """DuckDB SQL over the views named; the body is a SELECT, or further views and a SELECT after a comma."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({SQL[n]})" for n in names) + ("" if body.startswith(",") else " ") + body


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(*DETECTIONS)


def raster_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*CELLS)


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = detections(spark, sf_dir).selectExpr("CAST(date_trunc('hour', acq_datetime) AS TIMESTAMP_NTZ) AS time", *WEATHER[1:])
    return rows.groupBy("time", "wrow", "wcol").agg(F.round(F.avg("frp"), 6).alias("temperature"), F.max("frp").alias("wind_u"), F.count("*").alias("precipitation_rate"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detections(spark, sf_dir).where(POINTS).selectExpr("det_id AS point_id", "acq_datetime AS ts", "x", "y")
