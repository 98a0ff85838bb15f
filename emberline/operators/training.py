"""Samples for training: normalised values, labels, joined channels, dense rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _plain(value: Column) -> Column:
    """NaN and null count as 0."""
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def normalized_topography(samples: DataFrame, std: float | None = None) -> DataFrame:
    """Each sample's values less their mean, over the deviation of all (or a given one)."""
    rows = samples.withColumn("value", _plain(F.col("value")))
    means = rows.groupBy("sample_id").agg(F.avg("value").alias("_mean"))
    spread = rows.agg(F.stddev_pop("value").alias("_std"))
    rows = rows.join(means, "sample_id")
    rows = rows.withColumn("_std", F.lit(std)) if std is not None else rows.crossJoin(F.broadcast(spread))  # one row
    return rows.withColumn("value", (F.col("value") - F.col("_mean")) / F.col("_std")).drop("_mean", "_std")


def normalized(samples: DataFrame, known: tuple[float, float] | None = None) -> DataFrame:
    """Values less the mean of all, over their deviation, or with coefficients already known."""
    rows = samples.withColumn("value", _plain(F.col("value")))
    if known:
        return rows.withColumn("value", _plain((F.col("value") - known[0]) / known[1]))
    stats = rows.agg(F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_std"))
    return rows.crossJoin(F.broadcast(stats)).withColumn("value", _plain(F.try_divide(F.col("value") - F.col("_mean"), "_std"))).drop("_mean", "_std")


def normalized_channels(samples: DataFrame) -> DataFrame:
    """The same for each channel; a deviation of 0 counts as 1. Missing values become 0 after that."""
    stats = samples.groupBy("channel").agg(F.avg("value").alias("_mean"), F.stddev_pop("value").alias("_std"))
    stats = stats.withColumn("_std", F.when(F.col("_std") == 0, 1.0).otherwise(F.col("_std")))
    return samples.join(stats, "channel").withColumn("value", _plain((F.col("value") - F.col("_mean")) / F.col("_std"))).drop("_mean", "_std")


def target_cells(cells: DataFrame, first_target: int, horizon: int) -> DataFrame:
    """``point_id, row, col`` where any target layer up to the horizon has a detection."""
    return cells.where(F.col("layer").between(first_target, first_target + horizon - 1)).select("point_id", "row", "col").distinct()


def dense(cells: DataFrame, layers: int, width: int, value: Column | None = None) -> DataFrame:
    """One row for each point with ``tensor``, its layers x width x width values in order, 0 where no cell is.

    A point's array has one place for each cell of its window, so it is bounded.
    """
    size = layers * width * width
    at = ((F.col("layer") * width + F.col("row")) * width + F.col("col")).alias("k")
    held = cells.select("point_id", at, (value if value is not None else F.lit(1.0)).cast("float").alias("v"))
    lists = held.where("k is not null").groupBy("point_id").agg(F.collect_list("k").alias("k"), F.collect_list(F.coalesce("v", F.lit(0.0).cast("float"))).alias("v"))

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, (1 << 22) // size)
        for whole in batches:
            for first in range(0, whole.num_rows, rows):
                batch = whole.slice(first, rows)
                n, k = batch.num_rows, batch.column("k")
                out = np.zeros((n, size), np.float32)
                out[np.repeat(np.arange(n), np.diff(k.offsets.to_numpy())), k.flatten().to_numpy()] = batch.column("v").flatten().to_numpy()
                tensor = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), pa.array(out.ravel()))
                yield pa.record_batch([batch.column("point_id"), tensor], names=["point_id", "tensor"])

    return lists.mapInArrow(filled, f"point_id {cells.schema['point_id'].dataType.simpleString()}, tensor array<float>")


def split_tensor(rows: DataFrame, layers: int, observed: int, width: int) -> DataFrame:
    """``observed`` layers and the ``target`` layers after them."""
    cut = observed * width * width
    return rows.select("point_id", F.slice("tensor", 1, cut).alias("observed"), F.slice("tensor", cut + 1, (layers - observed) * width * width).alias("target"))


def joined_channels(*parts: DataFrame, id_col: str = "sample_id", values: str = "channels") -> DataFrame:
    """Arrays of the samples that all parts have, one after the other."""
    rows = parts[0].select(id_col, F.col(values).alias("_0"))
    for k, part in enumerate(parts[1:], 1):
        rows = rows.join(part.select(id_col, F.col(values).alias(f"_{k}")), id_col)
    return rows.select(id_col, F.concat(*[F.col(f"_{k}") for k in range(len(parts))]).alias(values))


def batch(points: DataFrame, start: int, size: int, most: int = 320, position: str = "position") -> DataFrame:
    """The points from ``start`` on, ``size`` of them."""
    if size > most:
        raise ValueError(f"a batch takes {most} points at most")
    return points.where(F.col(position).between(start, start + size - 1))


def first_kept(points: DataFrame, n: int, reason: str = "reason") -> DataFrame:
    """The first ``n`` points by id that nothing speaks against."""
    return points.where(F.col(reason) == 0).orderBy("point_id").limit(n)


def gathered_channels(tensors: DataFrame, wanted: DataFrame, first: int, stop: int, column: str = "channels") -> DataFrame:
    """The tensors at the wanted positions with channels ``first`` to before ``stop`` alone; arrays are cut whole, not exploded.

    Both sides have ``position``; positions that are wanted again come again. Tensors with
    fewer channels have those that they have.
    """
    length = F.greatest(F.least(F.lit(stop), F.size(column)) - first, F.lit(0))
    return wanted.select("position").join(tensors, "position").withColumn(column, F.slice(column, F.lit(first + 1), length))
