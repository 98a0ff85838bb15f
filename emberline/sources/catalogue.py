"""Where rasters and weather are found, and how tables are read and written."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions import tables


def land_cover_path(dataset: str) -> str:
    if dataset not in tables.LAND_COVER:
        raise ValueError(f"no such land-cover dataset: {dataset!r}")
    category, short, version = tables.LAND_COVER[dataset]
    return f"land_cover/{category}/{dataset}/US_{version}{short}"


def read_land_cover(spark: SparkSession, folder: str, datasets: list[str]) -> DataFrame:
    """``layer, row, col, value`` of the datasets' cell tables."""
    parts = [spark.read.parquet(f"{folder}/{land_cover_path(d)}").select(F.lit(d).alias("layer"), "row", "col", "value") for d in datasets]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_weather(spark: SparkSession, path: str, first: str, last: str, variables: list[str]) -> DataFrame:
    """Hours from first to last, both included, that aren't marked missing; the filter reaches the scan."""
    rows = spark.read.parquet(path).where(F.col("time").between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz")))
    return rows.where(~F.coalesce("missing", F.lit(False)) if "missing" in rows.columns else F.lit(True)).select("time", "wrow", "wcol", *variables)


def read_classes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("header", True).schema("OID_ int, VALUE int, EVT_LF string").csv(path).drop("OID_")


def write_polygons(polygons: DataFrame, path: str) -> None:
    """Polygons as lines of JSON, each ring a list of [x, y]."""
    polygons.withColumn("ring", F.transform("ring", lambda p: F.array(p["x"].cast("double"), p["y"].cast("double")))).write.mode("overwrite").json(path)


def read_polygons(spark: SparkSession, path: str, columns: str = "name string") -> DataFrame:
    """``polygon, part, ring`` and the columns to choose by, from lines of JSON; positions beyond x and y are dropped."""
    rows = spark.read.schema(f"polygon long, part int, {columns}, ring array<array<double>>").json(path)
    return rows.withColumn("ring", F.transform("ring", lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def units(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """``name, units`` of the wanted layers; "none" for those that aren't found."""
    return wanted.select("name").join(found.groupBy("name").agg(F.min("units").alias("units")), "name", "left").na.fill("none", ["units"])


def write_dataset(tables_by_name: dict[str, DataFrame], folder: str, attributes: dict | None = None) -> None:
    """Each table as Parquet, and attributes as one row of JSON beside them."""
    for name, df in tables_by_name.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
    spark = next(iter(tables_by_name.values())).sparkSession
    spark.createDataFrame([(json.dumps(attributes or {}),)], "attributes string").coalesce(1).write.mode("overwrite").json(f"{folder}/attributes")


def read_dataset(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}


def read_inputs(spark: SparkSession, folder: str, needed: list[str], optional: list[str] = (), points: str | None = None) -> dict[str, DataFrame]:
    """The tables of a folder by name; an optional one that isn't there is left out, a needed one raises.

    ``points`` names a table to take points from instead, such as a case study's.
    """
    found = {}
    for name in [*needed, *optional]:
        try:
            found[name] = spark.read.parquet(f"{folder}/{name}")
        except AnalysisException as e:
            if name in needed or e.getCondition() != "PATH_NOT_FOUND":
                raise
    if points:
        found["points"] = spark.read.parquet(f"{folder}/{points}").select("point_id", "ts", "x", "y")
    return found
