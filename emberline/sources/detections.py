"""Detections and points: scans, filters, preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions.geo import Albers
from emberline.functions.times import acquired, day_minute

SCHEMA = T.StructType([T.StructField("type", T.IntegerType()), T.StructField("acq_date", T.StringType()), T.StructField("acq_time", T.IntegerType()), T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()), T.StructField("frp", T.DoubleType())])
DATASETS = ("viirs_375m",)


def years(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The years with a full day in [start, end)."""
    return spark.sql(f"SELECT explode(sequence(year(timestamp '{start}'), year(timestamp '{end}' - interval 24 hours))) AS year")


def years_of(df: DataFrame, time: str = "acq_datetime") -> DataFrame:
    """The years that the rows' times span with a full day."""
    span = df.agg(F.min(time).alias("a"), F.max(time).alias("b")).where("a is not null")  # one row
    last = F.greatest(F.year(F.col("b") - F.expr("interval 24 hours")), F.year("a"))
    return span.select(F.explode(F.sequence(F.year("a"), last)).alias("year"))


def read_csv(spark: SparkSession, folder: str, dataset: str, of_years: list[int]) -> DataFrame:
    """One scan over the files of all years."""
    if dataset not in DATASETS:
        raise ValueError(f"no such dataset: {dataset!r}")
    return spark.read.schema(SCHEMA).option("header", True).csv([f"{folder}/{dataset}/{y}.csv" for y in of_years])


def with_times(df: DataFrame) -> DataFrame:
    return df.withColumn("acq_datetime", acquired(F.col("acq_date"), F.col("acq_time")))


def of_types(df: DataFrame, types) -> DataFrame:
    return df.where(F.col("type").isin(*types))


def between(df: DataFrame, start: str, end: str, time: str = "acq_datetime") -> DataFrame:
    return df.where((F.col(time) >= F.lit(start).cast("timestamp_ntz")) & (F.col(time) < F.lit(end).cast("timestamp_ntz")))


def in_box(df: DataFrame, west: float, south: float, east: float, north: float) -> DataFrame:
    """Closed bounds, in single precision as files have it."""
    f = lambda v: (F.lit(v) if isinstance(v, (int, float)) else F.col(v)).cast("float")
    return df.where(f("longitude").between(f(west), f(east)) & f("latitude").between(f(south), f(north)))


def halo(df: DataFrame, start: str, end: str, before_hours: int, after_hours: int) -> DataFrame:
    """All that windows of points in [start, end) can reach."""
    t = lambda s, h: F.lit(s).cast("timestamp_ntz") + F.expr(f"interval {h} hours")
    return df.where((F.col("acq_datetime") >= t(start, -before_hours)) & (F.col("acq_datetime") < t(end, after_hours)))


def points(df: DataFrame, start: str | None = None, end: str | None = None, minutes: tuple[int, int] | None = (390, 750), within: Column | None = None) -> DataFrame:
    """``point_id, ts, x, y`` of the detections in the region, period and part of the day."""
    if within is not None:
        df = df.where(within)
    if start and end:
        df = between(df, start, end)
    if minutes:
        m = day_minute(F.col("acq_datetime"))
        df = df.where((m >= minutes[0]) & (m < minutes[1]))
    return df.select(F.col("det_id").alias("point_id"), F.col("acq_datetime").alias("ts"), "x", "y")


def fire_season(df: DataFrame, date: Column, first: int = 514, last: int = 831) -> DataFrame:
    """Days of any year from May 14 to August 31, both included (as month * 100 + day)."""
    return df.where((F.month(date) * 100 + F.dayofmonth(date)).between(first, last))


def projected(df: DataFrame, projection: Albers = Albers()) -> DataFrame:
    x, y = projection.project(F.col("longitude"), F.col("latitude"))
    return df.withColumn("x", x).withColumn("y", y)


def union_years(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_path(folder: str, node: str, **params) -> str:
    """Where a node's table is kept: parameters are part of the name."""
    told = [f"{k}={'_'.join(map(str, v)) if isinstance(v, (list, tuple)) else v}" for k, v in sorted(params.items())]
    return "/".join([folder.rstrip("/"), node, *told])


def kept(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at the path; made and written first if it isn't there."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
