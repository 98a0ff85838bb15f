"""The range join of points with detections over time windows and a square around each point.

Both sides get a key of time bucket and grid cell, so Spark joins by equality and tests
only what shares a bucket. Windows of all kinds go through one join: each takes the
finest of a few bucket widths that covers it with few buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline.functions import tables
from emberline.functions.times import HOUR, micros
from emberline.operators.window_counts import counted

#: Bucket widths in hours; a window takes the first that covers it with SPAN buckets, or else the last.
LEVELS, SPAN = (2, 6, 48, 720, 8760), 4
#: Grid cells along the square's side: with more, fewer pairs are only looked at, but a point has more keys.
SIDE = 2


def standard_windows() -> list[tuple[int, str, int, int]]:
    """Layer, kind, from, to in hours relative to the point."""
    out = [("current", -3, 3)] + [("lag", -lag - 3, -lag + 3) for lag in tables.LAGS]
    out += [("aggregate", -b, -a) for a, b in tables.AGGREGATES] + [("target", f - 15, f + 3) for f in tables.FORECASTS]
    return [(k, *w) for k, w in enumerate(out)]


def windows_table(spark: SparkSession, windows: list[tuple[int, str, int, int]]) -> DataFrame:
    """``layer, kind, lo, hi`` in microseconds, and the bucket width ``wide``."""
    schema = T.StructType([T.StructField("layer", T.IntegerType()), T.StructField("kind", T.StringType()), *[T.StructField(n, T.LongType()) for n in ("lo", "hi", "wide")]])
    width = lambda hours: next((w for w in LEVELS if hours <= w * SPAN), LEVELS[-1])
    return spark.createDataFrame([(k, kind, lo * HOUR, hi * HOUR, width(hi - lo) * HOUR) for k, kind, lo, hi in windows], schema)


def requests(points: DataFrame, windows: DataFrame) -> DataFrame:
    """A row for each point and window: ``point_id, layer, kind, begin, end, x, y``; windows are a handful of constants."""
    return points.crossJoin(F.broadcast(windows)).select("point_id", "layer", "kind", (micros(F.col("ts")) + F.col("lo")).alias("begin"), (micros(F.col("ts")) + F.col("hi")).alias("end"), "wide", "x", "y")


def halo(points: DataFrame, detections: DataFrame, windows: list[tuple[int, str, int, int]]) -> DataFrame:
    """The detections that any window of the points' period can reach; the bound reaches the scan."""
    first, last = points.agg(F.min("ts"), F.max("ts")).first()
    if first is None:
        return detections.where(F.lit(False))
    lo, hi = min(w[2] for w in windows), max(w[3] for w in windows)
    bound = lambda t, hours: F.lit(t).cast("timestamp_ntz") + F.expr(f"interval {hours} hours")
    return detections.where((F.col("acq_datetime") >= bound(first, lo)) & (F.col("acq_datetime") < bound(last, hi)))


def _buckets(lo: Column, hi: Column, width: Column | float) -> Column:
    return F.explode(F.sequence(F.floor(lo / width), F.floor(hi / width)))


def window_join(points: DataFrame, detections: DataFrame, windows: list[tuple[int, str, int, int]], size: float = tables.WINDOW) -> DataFrame:
    """Every detection in a window and square of a point: ``point_id, layer, kind, det_id, dx, dy, us, end``.

    ``points``: point_id, ts, x, y; ``detections``: det_id, acq_datetime, x, y. Windows are
    half-open, the square is closed. A detection has one bucket and one cell, so no pair
    comes twice.
    """
    table = windows_table(points.sparkSession, windows)
    return _joined(requests(points, table), table, detections, size)


def _joined(asked: DataFrame, table: DataFrame, detections: DataFrame, size: float) -> DataFrame:
    """The join of what is asked; detections that are its ``last_id``, if it has one, are left out."""
    half, side = size / 2, float(size) / SIDE
    asked = asked.withColumn("gx", _buckets(F.col("x") - half, F.col("x") + half, F.lit(side)))
    asked = asked.withColumn("gy", _buckets(F.col("y") - half, F.col("y") + half, F.lit(side)))
    # integer division: doubles don't hold all microseconds
    asked = asked.withColumn("bucket", F.explode(F.sequence(F.expr("begin div wide - 1"), F.expr("(end - 1) div wide"))))
    asked = asked.where("(bucket + 1) * wide > begin")
    widths = sorted({r.wide for r in table.select("wide").collect()})  # constants of this call
    found = detections.select("det_id", micros(F.col("acq_datetime")).alias("us"), F.col("x").alias("px"), F.col("y").alias("py"))
    found = found.withColumn("wide", F.explode(F.array(*[F.lit(w).cast("long") for w in widths])))
    found = found.withColumn("bucket", F.expr("us div wide")).withColumn("gx", F.floor(F.col("px") / side)).withColumn("gy", F.floor(F.col("py") / side))
    # a shuffle, not a broadcast: pairs come of as many tasks as there are partitions, not as few as a file has
    both = asked.join(found.hint("merge"), ["wide", "bucket", "gx", "gy"])
    dx, dy = F.col("px") - F.col("x"), F.col("py") - F.col("y")
    inside = (F.col("us") >= F.col("begin")) & (F.col("us") < F.col("end")) & F.col("px").between(F.col("x") - half, F.col("x") + half) & F.col("py").between(F.col("y") - half, F.col("y") + half)
    if "last_id" in asked.columns:
        inside = inside & (F.col("last_id").isNull() | (F.col("det_id") != F.col("last_id")))
    return both.where(inside).select("point_id", "layer", "kind", "det_id", dx.alias("dx"), dy.alias("dy"), "px", "py", "us", "end")


def last_before(ends: DataFrame, detections: DataFrame, bucket_hours: int = 24) -> DataFrame:
    """For each ``end`` the last detection before it by (time, x, y): ``end, last`` (struct).

    The last of each time bucket, carried forward over the buckets, answers for those
    before the end's own; a bucket's own rows are joined by equality.
    """
    wide = bucket_hours * HOUR
    place = F.struct(micros(F.col("acq_datetime")).alias("us"), F.col("x").alias("x"), F.col("y").alias("y"), F.col("det_id").alias("det_id"))
    rows = detections.select(place.alias("d")).withColumn("bucket", F.expr(f"d.us div {wide}"))
    per = rows.groupBy("bucket").agg(F.max("d").alias("top"))
    # one row for each bucket of the period: as many as it has days, however many detections
    span = per.agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).where("a is not null").select(F.explode(F.sequence("a", F.col("b") + 1)).alias("bucket"))
    carried = span.join(per, "bucket", "left").withColumn("before", F.max("top").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).select("bucket", "before")
    asked = ends.select("end").distinct().withColumn("bucket", F.expr(f"(end - 1) div {wide}"))
    top = carried.agg(F.max("bucket").alias("most"))
    asked = asked.crossJoin(F.broadcast(top)).withColumn("bucket", F.least("bucket", "most"))  # one row
    # ends come before detections of their time
    both = rows.where("d.us is not null").select("bucket", F.col("d.us").alias("at"), F.lit(1).alias("kind"), "d")
    both = both.unionByName(asked.select("bucket", F.col("end").alias("at"), F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["d"].dataType).alias("d")))
    so_far = Window.partitionBy("bucket").orderBy("at", "kind", "d").rowsBetween(Window.unboundedPreceding, 0)
    own = both.withColumn("own", F.last("d", ignorenulls=True).over(so_far)).where("kind = 0").select(F.col("at").alias("end"), "own")
    return asked.join(own.hint("merge"), "end", "left").join(carried, "bucket", "left").select("end", F.coalesce("own", "before").alias("last"))


def window_join_drop_last(points: DataFrame, detections: DataFrame, windows: list[tuple[int, str, int, int]], size: float = tables.WINDOW) -> DataFrame:
    """``window_join`` without the last detection, by (time, x, y), before each window's end."""
    table = windows_table(points.sparkSession, windows)
    asked = requests(points, table)
    last = last_before(asked.select("end"), detections).select("end", F.col("last.det_id").alias("last_id"))
    # joined to what is asked, not to the pairs
    return _joined(asked.join(last.hint("merge"), "end", "left"), table, detections, size)


def window_counts(points: DataFrame, detections: DataFrame, windows: list[tuple[int, str, int, int]]) -> DataFrame:
    """``point_id, layer, n`` for every point and window, those without detections included."""
    n = counted(points, detections, windows).hint("merge")
    every = points.select("point_id").crossJoin(F.broadcast(windows_table(points.sparkSession, windows).select("layer")))
    return every.join(n, ["point_id", "layer"], "left").select("point_id", "layer", F.coalesce("n", F.lit(0)).alias("n"))
