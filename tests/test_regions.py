"""Regions: choosing, union of polygons that touch, overlap and hold each other, padding, raster rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from emberline.functions.geo import Affine
from emberline.operators import regions as rg

RING = "polygon int, part int, name string, ring array<struct<x:double,y:double>>"


def table(spark, polygons):
    return spark.createDataFrame([(i, p, n, r) for i, p, n, r in polygons], RING)


def square(x, y, w, h=None):
    h = w if h is None else h
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def sides_of(spark, polygons):
    return rg.edges(table(spark, [(i, 0, "n", r) for i, r in polygons]), "polygon").withColumn("region", F.lit("r"))


def outline(spark, polygons, band=1.0):
    sides = rg.union(sides_of(spark, polygons), band)
    found = {(r.x1, r.y1, r.x2, r.y2) for r in sides.collect()}
    size = rg.outlines(sides).first()
    return found, size and (round(size.perimeter, 9), round(size.area, 9))


def test_choosing(spark):
    rows = table(spark, [(1, 0, "a", square(0.0, 0.0, 1.0)), (1, 1, "a", square(5.0, 0.0, 1.0)), (2, 0, "a", square(0.0, 5.0, 1.0)), (3, 0, "b", square(9.0, 9.0, 1.0)), (4, 0, None, square(0.0, 9.0, 1.0))])
    got = lambda *a, **k: sorted((r.polygon, r.part) for r in rg.chosen(rows, *a, **k).collect())
    assert got("name", "a") == [(1, 0), (1, 1)] and got("name", ["a", "b"]) == [(1, 0), (1, 1), (2, 0), (3, 0)]
    assert got("name", "a", part=1) == [(1, 1)] and got(part=1) == [(1, 1)] and got("name", "none") == [] and len(got()) == 5


def test_union_of_neighbours_overlaps_and_copies(spark):
    # side by side, the second taller: the border goes but for what stands out
    assert outline(spark, [(1, square(0.0, 0.0, 2.0)), (2, square(2.0, 0.0, 2.0, 3.0))])[1] == (14, 10)
    # crossing
    assert outline(spark, [(1, square(0.0, 0.0, 4.0)), (2, square(2.0, 2.0, 4.0))])[1] == (24, 28)
    # within, and twice the same
    assert outline(spark, [(1, square(0.0, 0.0, 4.0)), (2, square(1.0, 1.0, 1.0)), (3, square(0.0, 0.0, 4.0))])[1] == (16, 16)
    # apart; and touching in a corner alone
    assert outline(spark, [(1, square(0.0, 0.0, 1.0)), (2, square(5.0, 5.0, 1.0)), (3, square(1.0, 1.0, 1.0))])[1] == (12, 3)
    assert outline(spark, [(1, [])]) == (set(), None)


def test_holes_stay_and_are_filled(spark):
    ring = [(1, square(0.0, 0.0, 6.0)), (1, square(2.0, 2.0, 2.0))]
    assert outline(spark, ring)[1] == (32, 32)
    assert outline(spark, [*ring, (2, square(2.0, 2.0, 2.0))])[1] == (24, 36)
    assert outline(spark, [*ring, (2, square(2.0, 2.0, 1.0, 2.0))])[1] == (30, 34)


def test_crossing_triangles_hold_the_same_points(spark):
    rng = random.Random(4)
    polygons = [(k, [(rng.uniform(0, 30), rng.uniform(0, 30)) for _ in range(3)]) for k in range(12)]
    points = spark.createDataFrame([(i, rng.uniform(-1, 31), rng.uniform(-1, 31)) for i in range(1500)], "det_id int, x double, y double")
    sides = sides_of(spark, polygons)
    want = sorted(r.det_id for r in rg.inside(points, sides, ["polygon"], "det_id", "x", "y", 2.0).select("det_id").distinct().collect())
    got = sorted(r.det_id for r in rg.inside(points, rg.union(sides, 2.0), ["region"], "det_id", "x", "y", 2.0).collect())
    assert got == want and 300 < len(got) < 1500


def test_padding_is_distance(spark):
    rng = random.Random(6)
    polygons = [(1, [(0.0, 0.0), (20.0, 3.0), (8.0, 17.0)]), (2, square(30.0, 2.0, 0.5, 25.0))]
    points = [(i, rng.uniform(-9, 40), rng.uniform(-9, 40)) for i in range(800)]
    frame = spark.createDataFrame(points, "det_id int, x double, y double")
    sides = sides_of(spark, polygons)
    got = {r.det_id: r.within_region for r in rg.within_padded(frame, sides, 2.5, 4.0).collect()}

    def gap(x, y, a, b):
        t = ((x - a[0]) * (b[0] - a[0]) + (y - a[1]) * (b[1] - a[1])) / math.dist(a, b) ** 2
        t = min(max(t, 0), 1)
        return math.dist((x, y), (a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])))

    own = {r.det_id for r in rg.inside(frame, sides, ["region"], "det_id", "x", "y", 4.0).collect()}
    near = {i for i, x, y in points if any(gap(x, y, a, b) <= 2.5 for _, r in polygons for a, b in zip(r, r[1:] + r[:1]))}
    assert got == {i: i in own for i in own | near} and len(near - own) > 50


@pytest.mark.parametrize("touched", [False, True])
def test_rows_of_a_polygon(spark, touched):
    rng = random.Random(8)
    polygons = [(k, [(rng.uniform(-5, 45), rng.uniform(-5, 45)) for _ in range(rng.choice((3, 4, 7)))]) for k in range(6)]
    grid = Affine.grid(2.0, -3.0, 41.0)
    got = {(r.row, c) for r in rg.row_ranges(sides_of(spark, polygons), grid, touched).collect() for c in range(r.lo, r.hi + 1)}
    want = set()
    for row in range(-5, 30):
        for col in range(-5, 30):
            x0, y1 = -3 + 2 * col, 41 - 2 * row
            middle = (x0 + 1, y1 - 1)
            for _, ring in polygons:
                pairs = list(zip(ring, ring[1:] + ring[:1]))
                odd = sum((a[1] <= middle[1]) != (b[1] <= middle[1]) and middle[0] < a[0] + (middle[1] - a[1]) / (b[1] - a[1]) * (b[0] - a[0]) for a, b in pairs) % 2
                if odd or touched and any(any(x0 <= a[0] + t / 2000 * (b[0] - a[0]) < x0 + 2 and y1 - 2 < a[1] + t / 2000 * (b[1] - a[1]) <= y1 for t in range(2001)) for a, b in pairs):
                    want.add((row, col))
    # sampling an edge misses corners that it cuts by less than a step
    assert want <= got and len(got - want) <= (6 if touched else 0) and len(want) > 100


def test_masking_crops_and_fills(spark):
    raster = spark.createDataFrame([(r, c, 10 * r + c) for r in range(5) for c in range(5)], "row int, col int, v int")
    ranges = spark.createDataFrame([("a", 1, 1, 2), ("a", 2, 3, 3), ("b", 7, 0, 9)], "region string, row int, lo int, hi int")
    got = sorted(tuple(r) for r in rg.masked(raster, ranges, ["v"], -1).collect())
    assert got == [("a", 0, 0, 11, False), ("a", 0, 1, 12, False), ("a", 0, 2, -1, True), ("a", 1, 0, -1, True), ("a", 1, 1, -1, True), ("a", 1, 2, 23, False)]
    whole = rg.masked(raster, ranges, ["v"], crop=False)
    assert whole.count() == 50 and whole.where("not outside").count() == 3 and whole.where("outside and v is not null").count() == 0
