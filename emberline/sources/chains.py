"""The sources of a dataset from files to tables, each as one chain of lazy steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions import tables
from emberline.functions.geo import Affine, Albers
from emberline.operators import land_cover, regions
from emberline.operators import rasters as ra
from emberline.operators.ranks import numbered
from emberline.sources import catalogue, hourly, months
from emberline.sources import detections as sd


def detections(rows: DataFrame, start: str, end: str, types: tuple[int, ...], region: DataFrame, padding: float, band: float, projection: Albers = Albers(), id_col: str = "det_id") -> DataFrame:
    """Detections of the types and the period in a padded region, with ``within_region``, their time, and x and y.

    ``region`` has edges in degrees, as ``regions.union`` makes them; ``padding`` is in degrees.
    """
    rows = rows if "acq_datetime" in rows.columns else sd.with_times(rows)
    rows = sd.between(sd.of_types(rows, types), start, end)
    near = regions.within_padded(rows, region, padding, band, "region", id_col, "longitude", "latitude")
    own = near.groupBy(id_col).agg(F.max("within_region").alias("within_region"))
    return sd.projected(rows.join(own, id_col), projection)


def detections_of_years(spark: SparkSession, folder: str, dataset: str, start: str, end: str, **steps) -> DataFrame:
    """``detections`` from the files of all years with a full day in the period, numbered in order of file and row."""
    years = [r.year for r in sd.years(spark, start, end).collect()]  # a row a year
    rows = sd.read_csv(spark, folder, dataset, years).withColumn("det_id", F.monotonically_increasing_id())
    return detections(rows, start, end, **steps)


def land_cover_layer(cells: DataFrame, dataset_category: str, grid: Affine, region: DataFrame, ocean: DataFrame, target: Affine, rows: int, cols: int, pad: int = 0, to_source: Callable | None = None) -> DataFrame:
    """One layer (row, col, value) cropped to a region, padded, with its ocean told, on the target grid.

    A cell that the region's edges touch is within it. Missing cells are ocean where the
    ocean's edges hold or touch the cell. The target takes the nearest cell.
    """
    ranges = regions.row_ranges(region, grid, True)
    box = ranges.agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("lo").alias("c0"), F.max("hi").alias("c1")).first()  # one row
    if box is None or box.r0 is None:
        return ra.grid_cells(cells.sparkSession, rows, cols).withColumn("value", F.lit(None).cast(cells.schema["value"].dataType))
    own = regions.masked(cells.select("row", "col", "value"), ranges, ["value"], ra.MISSING).select("row", "col", "value")
    own = ra.padded(own, box.r1 - box.r0 + 1, box.c1 - box.c0 + 1, pad)
    corner = Affine(grid.a, grid.b, grid.c + grid.a * box.c0 + grid.b * box.r0, grid.d, grid.e, grid.f + grid.d * box.c0 + grid.e * box.r0).padded(pad)
    sea = regions.row_ranges(ocean, corner, True).select(F.col("row").alias("_r"), "lo", "hi")
    own = own.join(sea, (F.col("row") == F.col("_r")) & F.col("col").between(F.col("lo"), F.col("hi")), "left")
    told = ra.ocean_masked(own, F.col("lo").isNotNull(), dataset_category).select("row", "col", "value")
    return ra.resampled(told, corner, target, rows, cols, to_source=to_source)


def land_cover_of_datasets(spark: SparkSession, folder: str, datasets: list[str], **steps) -> DataFrame:
    """A stack with a column for each land-cover dataset, all through ``land_cover_layer``."""
    layers = {}
    for name in datasets:
        cells = catalogue.read_land_cover(spark, folder, [name]).drop("layer")
        layers[name] = land_cover_layer(cells, tables.LAND_COVER[name][0], **steps)
    return land_cover.stacked(layers)


def weather_of_hours(spark: SparkSession, folder: str, kept: str, first: str, last: str, variables: list[str], region: DataFrame | None = None, grid: Affine | None = None, zero: str | None = None) -> DataFrame:
    """Hourly files into months below ``kept``, cropped to a region, and all months as one table with ``missing``."""
    rows = hourly.read_hours(spark, folder, first, last, variables)
    ranges = regions.row_ranges(region, grid, True) if region is not None else None
    months.write_months(rows, kept, first, last, variables, ranges)
    return months.read_months(spark, kept, first, last, variables, zero)


def dataset(parts: dict[str, Callable[[], DataFrame]], components: tuple[str, ...]) -> dict[str, DataFrame]:
    """The tables of the components asked for, by name; chains that aren't asked for are not begun."""
    unknown = set(components) - set(parts)
    if unknown:
        raise ValueError(f"no such component: {', '.join(sorted(unknown))}")
    return {name: parts[name]() for name in components}


def artifacts(rows: DataFrame, start: str, end: str, before_hours: int, after_hours: int, minutes: tuple[int, int] | None = (390, 750), given: DataFrame | None = None) -> dict[str, DataFrame]:
    """``points`` of the period and part of the day, or those ``given``, and the ``search_table`` that their windows reach, by rank in (time, x, y)."""
    table = sd.halo(rows, start, end, before_hours, after_hours).select("det_id", "acq_datetime", "x", "y")
    points = given if given is not None else sd.points(rows, start, end, minutes, F.col("within_region") if "within_region" in rows.columns else None)
    return {"points": points, "search_table": numbered(table, [F.col(c) for c in ("acq_datetime", "x", "y", "det_id")])}


