"""How well predicted cells meet the true ones: squared error, overlap, overlap of outlines.

Outlines are alpha shapes: the triangles of a Delaunay triangulation whose circumcircle
is small enough. Points stand on whole cells, so the shapes of many grids are found
together and without triangles: an edge of a shape has an empty circle of just the
greatest size on its outer side, and what is blocked around a point is looked up by where
its neighbours lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Tasks for each of the session's shuffle partitions: examples are few bytes and much work.
TASKS = 4
#: Grids whose outlines are found together, and cells that are looked up at once.
TOGETHER, LOOKED_UP = 128, 1 << 18
#: The nearest neighbours are asked by tables of so many of them, the next in rings of these radii; circles wider than the last number of cells go by triangles.
TABLES, RINGS, WIDEST = (8, 20), (5, 10), 24


def mean_squared_error(pairs: DataFrame, by: str) -> DataFrame:
    return pairs.groupBy(by).agg(F.avg(F.pow(F.col("y") - F.col("y_hat"), 2)).alias("mse"))


def triangles(points: np.ndarray) -> np.ndarray:
    """Delaunay triangles of distinct points, one point after the other put into a hull that is large enough."""
    n = len(points)
    if n < 3:
        return np.zeros((0, 3), int)
    lo, hi = points.min(0), points.max(0)
    mid, far = (lo + hi) / 2, max(1.0, float((hi - lo).max())) * 1e4
    p = np.vstack([points, mid + [[-far, -far], [far, -far], [0, far]]]).astype(float)
    tri, place = np.array([(n, n + 1, n + 2)]), p.tolist()
    for k, (y, x) in enumerate(place[:n]):
        # all triangles at once: is the point within the circle around each
        d = p[tri] - p[k]
        far = (d * d).sum(axis=2)
        (ar, ac), (br, bc), (cr, cc) = (d[:, j].T for j in range(3))
        around = far[:, 0] * (br * cc - bc * cr) - far[:, 1] * (ar * cc - ac * cr) + far[:, 2] * (ar * bc - ac * br) > 1e-9
        sides = {e for a, b, c in tri[around].tolist() for e in ((a, b), (b, c), (c, a))}
        new = []
        for a, b in sides:
            if (b, a) not in sides:
                (ay, ax), (by, bx) = place[a], place[b]
                if (by - ay) * (x - ax) - (bx - ax) * (y - ay) > 0:
                    new.append((a, b, k))
        tri = np.concatenate((tri[~around], np.array(new, int).reshape(-1, 3)))
    return tri[(tri < n).all(axis=1)]


def alpha_shape(points: np.ndarray, alpha: float) -> np.ndarray:
    """Triangles (m, 3, 2) of the shape; of fewer than 4 points, their hull."""
    found = triangles(points)
    if len(points) < 4:
        return points[found]
    corners = points[found].astype(float)
    a, b, c = (np.linalg.norm(corners[:, i] - corners[:, j], axis=1) for i, j in ((0, 1), (1, 2), (2, 0)))
    u, v = corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0]
    area = np.abs(u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]) / 2
    radius = np.where(area > 0, a * b * c / np.where(area > 0, 4 * area, 1), 0)
    return points[found[radius < 1 / alpha]]


def drawn(shape: np.ndarray, height: int, width: int) -> np.ndarray:
    """Cells whose centres are in a triangle; a point stands at its cell's upper corner."""
    out = np.zeros((height, width), bool)
    t = shape.astype(float).reshape(-1, 3, 2)
    lo = np.maximum(np.floor(t.min(axis=1) - 0.5).astype(int), 0)
    size = np.maximum(np.minimum(np.ceil(t.max(axis=1) + 0.5).astype(int), (height, width)) - lo, 0)
    count = size.prod(axis=1)
    # the cells within the bounds of every triangle, one after the other
    of = np.repeat(np.arange(len(t)), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    row, col = lo[of, 0] + k // size[of, 1], lo[of, 1] + k % size[of, 1]
    u = t[of]
    v = np.roll(u, -1, axis=1)
    side = (v[:, :, 0] - u[:, :, 0]) * (col[:, None] + 0.5 - u[:, :, 1]) - (v[:, :, 1] - u[:, :, 1]) * (row[:, None] + 0.5 - u[:, :, 0])
    held = (side >= 0).all(axis=1) | (side <= 0).all(axis=1)
    out[row[held], col[held]] = True
    return out


@cache
def _circles(alpha: float) -> SimpleNamespace:
    """What a neighbour at each offset does to the circles of radius 1 / alpha through a point.

    ``blocks``: the sectors, of 64, in which no circle's centre can lie, for the neighbour would be
    in the circle. ``touch``: those that may hold the centre of the circle through both that lies to the right of the way to the neighbour.
    ``empty``: the offsets at which nothing may lie if that circle is to be empty. Whole numbers
    throughout, so points on a circle are known from those in it.
    """
    wide = 4 / alpha**2 if (1 / alpha) ** 2 != round((1 / alpha) ** 2) else 4 * round((1 / alpha) ** 2)
    reach = int(wide**0.5)
    r, c = (v.ravel() for v in np.mgrid[-reach : reach + 1, -reach : reach + 1])
    size = r * r + c * c
    order = np.argsort(size, kind="stable")
    order = order[(size[order] > 0) & (size[order] < wide - 1e-6)]
    r, c, size = r[order], c[order], size[order]
    to, half, step, eps = np.arctan2(c, r), np.arccos(np.sqrt(size / wide)), 2 * np.pi / 64, 1e-9
    sectors, bits = np.arange(64) * step, np.uint64(1) << np.arange(64, dtype=np.uint64)
    after = lambda a, b: (a - b) % (2 * np.pi)
    begin = after(sectors[None], (to - half)[:, None])
    blocks = np.where((begin > eps) & (begin + step < 2 * half[:, None] - eps), bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
    touch = np.where(after((to - half)[:, None] + eps, sectors[None]) <= step + 2 * eps, True, False)
    tables = [(0, np.zeros(1, np.uint64))]
    for n in TABLES:
        table, first = np.zeros(1, np.uint64), tables[-1][0]
        for one in blocks[first:n]:
            table = np.concatenate((table, table | one))
        tables.append((min(n, len(blocks)), table))
    # to a neighbour v, and another u
    v, u = (r[:, None], c[:, None], size[:, None]), (r[None], c[None], size[None])
    left = v[0] * u[1] - v[1] * u[0]
    ahead = u[2] - u[0] * v[0] - u[1] * v[1]
    beyond = np.sign(ahead) * ahead.astype(float) ** 2 * v[2] + np.sign(left) * left.astype(float) ** 2 * (wide - v[2])
    held = (beyond < -1e-3) | ((np.abs(beyond) <= 1e-3) & (left > 0))
    # in any order: most circles aren't empty, which few looks tell
    order = np.random.default_rng(0).permutation(len(r))
    held = held[:, order]
    most = held.sum(axis=1).max(initial=1)
    empty = order[np.argsort(~held, axis=1, kind="stable")[:, :most]]
    n = held.sum(axis=1)
    empty = np.where(np.arange(most) < n[:, None], empty, np.where(n > 0, empty[:, 0], -1)[:, None])
    back = np.empty(len(r), int)
    back[np.lexsort((-c, -r))] = np.lexsort((c, r))
    return SimpleNamespace(reach=reach, r=r, c=c, size=size, blocks=blocks, tables=tables, touch=[np.flatnonzero(t) for t in touch.T], empty=empty, back=back)


def _edges(held: np.ndarray, alpha: float):
    """``grid, row, col, rows, cols`` of the edges of the shapes of a stack of grids, the shape to their left."""
    o, (n, height, width) = _circles(alpha), held.shape
    pad = o.reach
    tall, wide = height + 2 * pad, width + 2 * pad
    flat = np.zeros((n, tall, wide), bool)
    flat[:, pad : pad + height, pad : pad + width] = held
    flat = flat.ravel()
    off = o.r * wide + o.c
    at = np.flatnonzero(flat)
    blocked = np.zeros(len(at), np.uint64)
    edge, near = pad * (wide + 1), flat.view(np.uint8)
    for (a, _), (b, table) in zip(o.tables, o.tables[1:]):
        code = np.zeros(len(flat) - 2 * edge, np.uint16)
        for k in range(a, b):
            code |= near[edge + off[k] : len(flat) - edge + off[k]].astype(np.uint16) << np.uint16(k - a)
        blocked |= table[code[at - edge]]
    some = blocked != ~np.uint64(0)
    at, blocked = at[some], blocked[some]
    ends = [o.tables[-1][0], *np.searchsorted(o.size, np.square(RINGS), "right").tolist()]
    for a, b in zip(ends, ends[1:]):
        many = max(1, LOOKED_UP // max(1, b - a))
        for k in range(0, len(at) if b > a else 0, many):
            there = flat[at[k : k + many, None] + off[a:b]]
            blocked[k : k + many] |= np.bitwise_or.reduce(np.where(there, o.blocks[a:b], np.uint64(0)), axis=1)
        some = blocked != ~np.uint64(0)
        at, blocked = at[some], blocked[some]
    begins, ways = [], []
    # a neighbour has one sector, or two where it lies between them
    for sector, to in enumerate(o.touch):
        free = at[blocked >> np.uint64(sector) & np.uint64(1) == 0]
        many = max(1, LOOKED_UP // max(1, len(to)))
        for k in range(0, len(free) if len(to) else 0, many):
            i, way = np.nonzero(flat[free[k : k + many, None] + off[to]])
            begins.append(free[k + i])
            ways.append(to[way])
    begin, way = np.concatenate([np.zeros(0, int), *begins]), np.concatenate([np.zeros(0, int), *ways])
    for a, b in ((0, 48), (48, o.empty.shape[1])):
        clear, many = np.ones(len(begin), bool), max(1, LOOKED_UP // max(1, b - a))
        for k in range(0, len(begin) if b > a else 0, many):
            must = o.empty[way[k : k + many], a:b]
            clear[k : k + many] = ~(flat[begin[k : k + many, None] + off[must]] & (must >= 0)).any(axis=1)
        begin, way = begin[clear], way[clear]
    begin, way = np.divmod(np.unique(begin * len(off) + way), len(off))
    # an edge with an empty circle on either side has the shape on neither
    single = ~np.isin(begin * len(off) + way, (begin + off[way]) * len(off) + o.back[way])
    begin, way = begin[single], way[single]
    return begin // (tall * wide), begin // wide % tall - pad, begin % wide - pad, o.r[way], o.c[way]


def outlines(held: np.ndarray, alpha: float) -> np.ndarray:
    """The outlines of a stack of grids (n, height, width): cells whose centres are in the alpha shape of the cells
    that are held; those cells themselves where there is no shape."""
    out, n = held.copy(), held.sum(axis=(1, 2))
    for k in np.flatnonzero(n == 3 if 2 / alpha <= WIDEST else n > 2):
        shape = alpha_shape(np.argwhere(held[k]), alpha)
        out[k] = drawn(shape, *held.shape[1:]) if len(shape) else held[k]
    many = np.flatnonzero(n > 3) if 2 / alpha <= WIDEST else np.zeros(0, int)
    if len(many):
        height, width = held.shape[1:]
        grid, row, col, dr, dc = _edges(held[many], alpha)
        # along each row of centres the shape is entered and left
        of = np.repeat(np.arange(len(grid)), np.abs(dr))
        line = np.minimum(row, row + dr)[of] + np.arange(len(of)) - np.repeat(np.cumsum(np.abs(dr)) - np.abs(dr), np.abs(dr))
        sign = np.sign(dr)[of]
        twice = 2 * (2 * col[of] * dr[of] + (2 * (line - row[of]) + 1) * dc[of]) * sign - 2 * np.abs(dr)[of]
        by = 4 * np.abs(dr)[of]
        first = np.where(sign > 0, -(-twice // by), twice // by + 1)
        where = (grid[of] * height + line) * (width + 1) + first
        size = len(many) * height * (width + 1)
        turns = np.bincount(where[sign > 0], minlength=size) - np.bincount(where[sign < 0], minlength=size)
        filled = np.cumsum(turns.reshape(len(many), height, width + 1), axis=2)[:, :, :width] > 0
        some = np.unique(grid)
        out[many[some]] = filled[some]
    return out


def losses(y: np.ndarray, y_hat: np.ndarray, x_hist: np.ndarray | None, alpha: float, thresh: float):
    """``number, error, weight`` of those of a stack of grids that have a loss; a weight of -1 is none."""
    some = np.flatnonzero((y > 0.5).sum(axis=(1, 2)) > 2)
    guessed = (y_hat[some] > thresh).sum(axis=(1, 2)) > 2
    error, weight = np.ones(len(some)), np.full(len(some), -1)
    at = some[guessed]
    truth, guess = outlines(y[at] > 0.5, alpha), outlines(y_hat[at] > thresh, alpha)
    outside = guess
    if x_hist is not None:
        before = outlines(x_hist[at] > 0.5, alpha)
        truth = before != (outlines(x_hist[at] + y[at] > 0.5, alpha) | before | truth)
        outside = guess & ~before
    union = (truth | outside).sum(axis=(1, 2))
    error[guessed] = 1 - (truth & guess).sum(axis=(1, 2)) / np.maximum(union, 1)
    weight[guessed] = truth.sum(axis=(1, 2))
    kept = np.ones(len(some), bool)
    kept[guessed] = union > 0
    return some[kept], error[kept], weight[kept]


def _grids(rows: pd.DataFrame, columns: list[str], height: int, width: int) -> list[np.ndarray]:
    out = []
    for name in columns:
        grid = np.zeros((height, width))
        grid[rows["row"], rows["col"]] = rows[name].fillna(0)
        out.append(grid)
    return out


def perimeter_losses(cells: DataFrame, height: int, width: int, alpha: float = 0.1, thresh: float = 0.05, new: bool = False) -> DataFrame:
    """``example_id, error, weight`` from cells (example_id, row, col, y, y_hat and, with ``new``, x_hist).

    The error is 1 less the overlap of the outlines; with ``new``, of what the truth adds to
    the outline before with the prediction outside of it. Examples with fewer than 3 true
    cells, or nothing in either outline, have no row; those with fewer than 3 predicted
    cells have the error 1 and no weight. Cells that are not listed are 0.
    """
    columns = ["y", "y_hat", *["x_hist"] * new]

    def loss(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        y, y_hat, x_hist = (*(g[None] for g in _grids(rows, columns, height, width)), None)[:3]
        _, error, weight = losses(y, y_hat, x_hist, alpha, thresh)
        return pd.DataFrame({"example_id": [key[0]] * len(error), "error": error, "weight": pd.array(weight, "Int64")}).replace({"weight": {-1: pd.NA}})

    kind = cells.schema["example_id"].dataType.simpleString()
    tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")) * TASKS
    return cells.select("example_id", "row", "col", *columns).repartition(tasks, "example_id").groupBy("example_id").applyInPandas(loss, f"example_id {kind}, error double, weight long")


def perimeter_losses_of_grids(grids: DataFrame, height: int, width: int, alpha: float = 0.1, thresh: float = 0.05, new: bool = False) -> DataFrame:
    """The same of examples that have a row each: ``example_id`` and ``grid``, a byte for each cell, row after row,
    whose bits 0, 1 and 2 are x_hist, y_hat and y. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(a, TOGETHER) for whole in batches for a in range(0, whole.num_rows, TOGETHER)):
            bits = np.frombuffer(b"".join(batch.column("grid").to_pylist()), np.uint8).reshape(-1, height, width)
            x_hist, y_hat, y = (bits >> k & 1 == 1 for k in range(3))
            number, error, weight = losses(y, y_hat, x_hist if new else None, alpha, thresh)
            yield pa.record_batch([batch.column("example_id").take(pa.array(number)), pa.array(error), pa.array(weight, mask=weight < 0)], names=["example_id", "error", "weight"])

    kind = grids.schema["example_id"].dataType.simpleString()
    return grids.select("example_id", "grid").mapInArrow(run, f"example_id {kind}, error double, weight long")


def total_loss(losses: DataFrame) -> DataFrame:
    return losses.agg(F.coalesce(F.sum("error"), F.lit(0.0)).alias("total"), F.count("*").alias("examples"))
