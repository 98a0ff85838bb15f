"""Weather kept month by month: each month is made and replaced by itself, all are read as one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.operators import regions
from emberline.operators.weather import zero_masked


def month_ranges(df: DataFrame, time: str) -> DataFrame:
    """``start, stop`` (dates) of each month that the rows' days span, the outer ones cut off at the first day and after the last."""
    day = F.to_date(time)
    span = df.agg(F.min(day).alias("a"), F.date_add(F.max(day), 1).alias("b")).where("a is not null")  # one row
    months = F.explode(F.sequence(F.trunc("a", "MM"), F.date_sub("b", 1), F.expr("interval 1 month"))).alias("m")
    return span.select("a", "b", months).select(F.greatest("m", "a").alias("start"), F.least(F.add_months("m", 1), "b").alias("stop"))


def with_missing(weather: DataFrame, first: str, last: str) -> DataFrame:
    """The rows from first to before last with ``missing``; an hour without rows, or marked so, is one row without cell."""
    spark = weather.sparkSession
    hours = spark.sql(f"SELECT explode(sequence(timestamp_ntz '{first}', timestamp_ntz '{last}' - interval 1 hour, interval 1 hour)) AS time")
    rows = weather.where((F.col("time") >= F.lit(first).cast("timestamp_ntz")) & (F.col("time") < F.lit(last).cast("timestamp_ntz")))
    if "missing" in rows.columns:
        rows = rows.where(~F.coalesce("missing", F.lit(False))).drop("missing")
    return hours.join(rows.withColumn("_there", F.lit(True)), "time", "left").withColumn("missing", F.col("_there").isNull()).drop("_there")


def month_name(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM")


def write_months(weather: DataFrame, path: str, first: str, last: str, variables: list[str], ranges: DataFrame | None = None, layers: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Writes the hours from first to before last below ``path``, a folder for each month; months outside stay as they are.

    With ``ranges`` (of one region, see ``regions.row_ranges``) cells outside it are cropped
    or without values; ``layers`` may change the rows before, such as to another grid. A
    month whose hours are all missing is written too, since its hours are.
    """
    rows = weather.select("time", "wrow", "wcol", *variables, *(["missing"] if "missing" in weather.columns else []))
    if ranges is not None:
        gone = rows.where("missing") if "missing" in rows.columns else None
        rows = regions.masked(rows if gone is None else rows.where("not missing"), ranges, variables, row="wrow", col="wcol").select(*rows.columns)
        rows = rows if gone is None else rows.unionByName(gone)
    if layers:
        rows = layers(rows)
    rows = with_missing(rows, first, last).withColumn("month", month_name(F.col("time")))
    rows.repartition("month", F.pmod(F.xxhash64("time"), F.lit(8))).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def read_months(spark: SparkSession, path: str, first: str, last: str, variables: list[str], zero: str | None = None) -> DataFrame:
    """``time, wrow, wcol, variables, missing`` of all months in one, by folder: months outside first to last aren't read.

    With ``zero``, cells in which that variable is 0 at their first hour have no values at any.
    """
    time = lambda t: F.lit(t).cast("timestamp_ntz")
    rows = spark.read.parquet(path).where(F.col("month").cast("string").between(month_name(time(first)), month_name(time(last))))
    rows = rows.where((F.col("time") >= time(first)) & (F.col("time") < time(last)))
    there = rows.where("not missing").select("time", "wrow", "wcol", *variables)
    there = zero_masked(there, zero, variables) if zero else there
    return there.withColumn("missing", F.lit(False)).unionByName(rows.where("missing").select("time", "wrow", "wcol", *variables, "missing"))
