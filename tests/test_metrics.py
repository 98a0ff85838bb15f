"""Outlines and their losses against all empty circles, tried one by one."""

import itertools
import random

import numpy as np
import pytest

from emberline.operators import metrics


def held(points, alpha, height, width):
    """Cells whose centres lie in a triangle of three points whose circle is small and holds no other point."""
    out = np.zeros((height, width), bool)
    points = [(int(r), int(c)) for r, c in points]
    for a, b, c in itertools.combinations(points, 3):
        twice = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        if not twice:
            continue
        sa, sb, sc = (q[0] ** 2 + q[1] ** 2 for q in (a, b, c))
        y = (sa * (b[1] - c[1]) + sb * (c[1] - a[1]) + sc * (a[1] - b[1])) / (2 * twice)
        x = (sa * (c[0] - b[0]) + sb * (a[0] - c[0]) + sc * (b[0] - a[0])) / (2 * twice)
        radius = ((a[0] - y) ** 2 + (a[1] - x) ** 2) ** 0.5
        if len(points) > 3 and (radius >= 1 / alpha or any((q[0] - y) ** 2 + (q[1] - x) ** 2 < radius**2 - 1e-9 for q in points)):
            continue
        for r, q in itertools.product(range(height), range(width)):
            sides = [(v[0] - u[0]) * (q + 0.5 - u[1]) - (v[1] - u[1]) * (r + 0.5 - u[0]) for u, v in ((a, b), (b, c), (c, a))]
            out[r, q] |= min(sides) >= 0 or max(sides) <= 0
    return out


def outline(grid, thresh, alpha):
    points = np.argwhere(grid > thresh)
    flat = len(points) < 3 or np.linalg.matrix_rank(points - points[0]) < 2
    found = np.zeros(grid.shape, bool) if flat else held(points, alpha, *grid.shape)
    # a shape without any triangle gives way to the cells themselves
    small = len(points) <= 3 or any_triangle(points, alpha)
    return found if not flat and small else grid > thresh


def any_triangle(points, alpha):
    return len(metrics.alpha_shape(np.array(points), alpha)) > 0


def grids(seed, n, size=12):
    rng = random.Random(seed)
    for k in range(n):
        made = {name: np.zeros((size, size)) for name in ("y", "y_hat", "x_hist")}
        for name, grid in made.items():
            r, c = rng.randrange(size), rng.randrange(size)
            for _ in range(rng.choice((1, 3, 5, 9, 14))):
                r, c = min(max(r + rng.randrange(-3, 4), 0), size - 1), min(max(c + rng.randrange(-3, 4), 0), size - 1)
                grid[r, c] = 1.0
        yield k, made


@pytest.mark.parametrize("alpha", [0.1, 0.4])
def test_shapes_are_the_small_empty_circles(alpha):
    for k, made in grids(int(alpha * 100), 60):
        points = np.argwhere(made["y"] > 0.5)
        if len(points) > 3:
            assert (metrics.drawn(metrics.alpha_shape(points, alpha), 12, 12) == held(points, alpha, 12, 12)).all(), k


@pytest.mark.parametrize("new", [False, True])
def test_losses_equal_plain_ones(spark, new):
    alpha, thresh, rows, want = 0.3, 0.05, [], {}
    for k, made in grids(11, 40):
        rows += [(k, int(r), int(c), *(float(made[n][r, c]) for n in ("y", "y_hat", "x_hist"))) for r, c in np.argwhere(sum(made.values()) > 0)]
        y, y_hat, x = made["y"], made["y_hat"], made["x_hist"]
        if (y > 0.5).sum() < 3:
            continue
        if (y_hat > thresh).sum() < 3:
            want[k] = (1.0, None)
            continue
        truth, guess = outline(y, 0.5, alpha), outline(y_hat, thresh, alpha)
        outside = guess
        if new:
            before = outline(x, 0.5, alpha)
            truth = before != (outline(x + y, 0.5, alpha) | before | truth)
            outside = guess & ~before
        if (truth | outside).any():
            want[k] = (1 - (truth & guess).sum() / (truth | outside).sum(), int(truth.sum()))
    cells = spark.createDataFrame(rows, "example_id int, row int, col int, y double, y_hat double, x_hist double")
    got = {r.example_id: (r.error, r.weight) for r in metrics.perimeter_losses(cells, 12, 12, alpha, thresh, new).collect()}
    assert got.keys() == want.keys() and len(want) > 15
    assert all(abs(got[k][0] - want[k][0]) < 1e-12 and got[k][1] == want[k][1] for k in want)


def test_outlines_of_many_grids_are_those_of_their_triangles():
    rng = np.random.default_rng(3)
    for size, share, n in ((60, 0.02, 12), (60, 0.3, 3), (24, 0.9, 4), (9, 0.1, 60)):
        held = rng.random((n, size, size)) < share
        held[0, 2 : size // 2, 3 : size // 2 + 2] = False
        got = metrics.outlines(held, 0.1)
        for k in range(n):
            shape = metrics.alpha_shape(np.argwhere(held[k]), 0.1)
            assert (got[k] == (metrics.drawn(shape, size, size) if len(shape) else held[k])).all(), (size, share, k)


def test_a_circle_of_just_the_greatest_size_is_too_large():
    ring = np.zeros((1, 31, 31), bool)
    for r, c in itertools.product(range(-10, 11), repeat=2):
        ring[0, 15 + r, 15 + c] = r * r + c * c == 100
    assert ring.sum() == 12 and (metrics.outlines(ring, 0.1) == ring).all()
    ring[0, 15, 15] = True
    assert metrics.outlines(ring, 0.1).sum() > 250


@pytest.mark.parametrize("new", [False, True])
def test_losses_of_dense_grids_equal_those_of_their_cells(spark, new):
    """A hundred grids of a third of 3,600 cells: some 0.5 s a grid when triangles were made one by one."""
    rng, rows, cells = np.random.default_rng(5), [], []
    for k in range(100):
        bits = (rng.random((60, 60)) < 0.3) * 1 + (rng.random((60, 60)) < 0.2) * 2 + (rng.random((60, 60)) < 0.3) * 4
        bits[rng.integers(0, 40) :, rng.integers(0, 40) :] = 0
        rows.append((k, bytes(bits.astype(np.uint8).ravel().tolist())))
        if k < 20:
            cells += [(k, int(r), int(c), float(bits[r, c] >> 2 & 1), float(bits[r, c] >> 1 & 1), float(bits[r, c] & 1)) for r, c in np.argwhere(bits)]
    grids = spark.createDataFrame(rows, "example_id int, grid binary")
    got = {r.example_id: (r.error, r.weight) for r in metrics.perimeter_losses_of_grids(grids, 60, 60, new=new).collect()}
    one = spark.createDataFrame(cells, "example_id int, row int, col int, y double, y_hat double, x_hist double")
    want = {r.example_id: (r.error, r.weight) for r in metrics.perimeter_losses(one, 60, 60, new=new).collect()}
    assert len(got) > 90 and len(want) > 15 and {k: v for k, v in got.items() if k < 20} == want


def test_a_point_of_a_border_is_held_against_few_neighbours():
    """All 1,244 neighbours in reach were tried for each point with a free sector; a free sector has some 20."""
    o = metrics._circles(0.1)
    assert len(o.r) == 1244 and max(len(t) for t in o.touch) < 60 and sum(len(t) for t in o.touch) < 1.1 * len(o.r)
    assert [len(t) for _, t in o.tables] == [1, 1 << 8, 1 << 12]
    rng = np.random.default_rng(9)
    for alpha, share in ((0.1, 0.97), (0.4, 0.9), (1.0, 0.8), (0.3, 0.1)):
        held = rng.random((4, 20, 26)) < share
        got = metrics.outlines(held, alpha)
        for k in range(4):
            shape = metrics.alpha_shape(np.argwhere(held[k]), alpha)
            assert (got[k] == (metrics.drawn(shape, 20, 26) if len(shape) else held[k])).all(), (alpha, share, k)
