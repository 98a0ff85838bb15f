"""Dense numbers in a global order without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.operators.lineage import checkpointed


def numbered(df: DataFrame, order: list[Column], name: str = "position", partitions: int | None = None) -> DataFrame:
    """The rows with their place, from 0, in the order: each range of it is numbered by itself
    and moved by the number of rows before it. The order should leave no ties."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id())
    rows = checkpointed(rows.withColumn("_at", F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    # one row for each partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + F.col("_at")).cast("long")).drop("_part", "_at", "_before")


def gathered(numbered_rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows at the wanted positions (column ``position``), once for each time it is wanted; positions beyond the rows give none."""
    return wanted.select("position").join(numbered_rows, "position")
