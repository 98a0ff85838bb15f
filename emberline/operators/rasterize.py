"""Matches as cells of the grid around their point; rows count from the north."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import tables
from emberline.functions.times import HOUR

KEY = ["point_id", "layer"]


def with_cells(matches: DataFrame, cell: float = tables.CELL, size: float = tables.WINDOW) -> DataFrame:
    """The matches with ``row, col``; those on the far edge, which have no cell, go."""
    width = int(size // cell)
    rows = matches.withColumn("row", F.floor(width - (F.col("dy") + size / 2) / cell).cast("int")).withColumn("col", F.floor((F.col("dx") + size / 2) / cell).cast("int"))
    return rows.where(F.col("row").between(0, width - 1) & F.col("col").between(0, width - 1))


def exact(matches: DataFrame, cell: float = tables.CELL, size: float = tables.WINDOW) -> DataFrame:
    """Cells with a detection: ``point_id, layer, row, col``."""
    return with_cells(matches, cell, size).select(*KEY, "row", "col").distinct()


def recency(matches: DataFrame, cell: float = tables.CELL, size: float = tables.WINDOW) -> DataFrame:
    """``hours`` from a cell's last detection to the window's end."""
    last = with_cells(matches, cell, size).groupBy(*KEY, "row", "col").agg(F.min(F.col("end") - F.col("us")).alias("age"))
    return last.select(*KEY, "row", "col", F.expr(f"age div {HOUR}").cast("int").alias("hours"))


def disc(radius: int) -> list[tuple[int, int]]:
    """Offsets of the cells whose centres are at most so many cells away."""
    return [(a, b) for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius]


def circle(matches: DataFrame, cell: float = tables.CELL, size: float = tables.WINDOW, radius: float = tables.CELL) -> DataFrame:
    """Cells within ``radius`` metres of a cell with a detection."""
    width, r = int(size // cell), max(1, math.floor(radius / cell))
    around = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in disc(r)]))
    rows = exact(matches, cell, size).withColumn("o", around).select(*KEY, (F.col("row") + F.col("o.a")).alias("row"), (F.col("col") + F.col("o.b")).alias("col"))
    return rows.where(F.col("row").between(0, width - 1) & F.col("col").between(0, width - 1)).distinct()


def fractional(matches: DataFrame, cell: float = tables.CELL, size: float = tables.WINDOW, parts: int = tables.PARTS, radius: float = tables.CELL) -> DataFrame:
    """The ``share`` of a cell within ``radius`` of a detection, from ``parts`` x ``parts`` cells in each.

    A row of small cells in a cell is a number of ``parts`` bits, at most 62; each row of a
    disc marks some of them, so a small cell is never a row.
    """
    if parts > 62:
        raise ValueError("more parts than bits")
    small, width = cell / parts, int(size // cell)
    r = max(1, math.floor(radius / small))
    rows = with_cells(matches, small, size).select(*KEY, "row", "col").distinct()
    # of each row of the disc the first and last column, then those in each cell that it reaches
    lines = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(math.isqrt(r * r - a * a)).alias("b")) for a in range(-r, r + 1)]))
    rows = rows.withColumn("o", lines).select(*KEY, (F.col("row") + F.col("o.a")).alias("row"), F.greatest(F.col("col") - F.col("o.b"), F.lit(0)).alias("lo"), F.least(F.col("col") + F.col("o.b"), F.lit(width * parts - 1)).alias("hi"))
    rows = rows.where(F.col("row").between(0, width * parts - 1)).withColumn("c", F.explode(F.sequence(F.expr(f"lo div {parts}"), F.expr(f"hi div {parts}"))))
    bits = F.expr(f"shiftleft(1L, cast(least(hi - c * {parts}, {parts - 1}) as int) + 1) - shiftleft(1L, cast(greatest(lo - c * {parts}, 0) as int))")
    held = rows.groupBy(*KEY, "row", F.col("c").cast("int").alias("col")).agg(F.bit_or(bits).alias("bits"))
    return held.groupBy(*KEY, F.expr(f"row div {parts}").cast("int").alias("row"), "col").agg((F.sum(F.bit_count("bits")) / F.lit(float(parts * parts))).alias("share"))


METHODS: dict[str, Callable[..., DataFrame]] = {"exact": exact, "date": recency, "circle": circle, "fractional": fractional}


def rasterize(matches: DataFrame, method: str = "exact", **options) -> DataFrame:
    if method not in METHODS:
        raise ValueError(f"no rasterizer {method!r}; there are {', '.join(METHODS)}")
    return METHODS[method](matches, **options)
