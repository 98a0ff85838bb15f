"""Window cells and weather means against plain counts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from emberline.functions.geo import Affine
from emberline.operators import rasterize
from emberline.operators import weather as we
from emberline.operators import window_cells as wc
from emberline.operators import window_join as wj

T0 = dt.datetime(2024, 1, 10, 12)
HOUR = dt.timedelta(hours=1)
POINT = "point_id long, ts timestamp_ntz, x double, y double"
DETECTION = "det_id long, acq_datetime timestamp_ntz, x double, y double"


def made(spark, seed, n, m, place=4e4):
    rng = random.Random(seed)
    p = [(i, T0 + rng.uniform(-300, 300) * HOUR, rng.uniform(-place, place), rng.uniform(-place, place)) for i in range(n)]
    d = [(i, T0 + rng.uniform(-9500, 600) * HOUR, rng.uniform(-place, place), rng.uniform(-place, place)) for i in range(m)]
    p += [(n, None, 0.0, 0.0), (n + 1, T0, None, 0.0)]
    d += [(m, None, 0.0, 0.0), (m + 1, T0, 0.0, None)]
    return spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION)


@pytest.mark.parametrize("most", [500, 3])
def test_equals_the_join(spark, monkeypatch, most):
    monkeypatch.setattr(wc, "POINTS", most)
    p, d = made(spark, 7, 60, 1500)
    windows = wj.standard_windows()
    got = sorted(tuple(r) for r in wc.by_layer(wc.window_cells(p, d, windows), windows).collect())
    want = sorted(tuple(r) for r in rasterize.exact(wj.window_join(p, d, windows)).collect())
    assert got == want and len(got) > 1000


def test_small_batches_and_last_times(spark):
    p, d = made(spark, 3, 40, 4000, 1.5e4)
    windows = [(0, "a", -9000, -24), (1, "b", -5, 5)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        rows = wc.window_cells(p, d, windows, latest=(0,)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = rasterize.with_cells(wj.window_join(p, d, windows)).groupBy("point_id", "row", "col").agg(F.max(F.when(F.col("layer") == 0, F.col("us"))).alias("last"), F.sum_distinct(F.pow(F.lit(2), F.col("layer"))).cast("long").alias("windows"))
    assert sorted((r.point_id, r.row, r.col, r.windows, r.last_0) for r in rows) == sorted((r.point_id, r.row, r.col, r.windows, r["last"]) for r in found.collect())


def test_edges_and_empty_inputs(spark):
    p = spark.createDataFrame([(1, T0, 20000.0, 20000.0)], POINT)
    rows = [(1, T0 - 3 * HOUR, 0, 0), (2, T0 + 3 * HOUR, 5000, 0), (3, T0, 11250, 0), (4, T0, 0, -11250), (5, T0, -11250, 11250), (6, T0, 0, 187.5), (7, T0, 11251, 0)]
    d = spark.createDataFrame([(i, t, 20000.0 + x, 20000.0 + y) for i, t, x, y in rows], DETECTION)
    windows = [(0, "current", -3, 3)]
    assert sorted((r.row, r.col) for r in wc.window_cells(p, d, windows).collect()) == [(0, 0), (29, 30), (30, 30)]
    assert wc.window_cells(p.limit(0), d, windows).count() == 0 and wc.window_cells(p, d.limit(0), windows).count() == 0
    with pytest.raises(ValueError):
        wc.window_cells(p, d, windows * 64)


def test_running_means_over_gaps(spark):
    rng = random.Random(1)
    grid = Affine.grid(10.0, 0.0, 0.0)
    hours = [(T0 + k * HOUR, r, c, rng.choice([None, float("nan"), 1.0, 2.5, -4.0]) if c else 3.0, float(k)) for r in range(2) for c in range(3) for k in range(-60, 60) if rng.random() < 0.5 and not (r == 1 and c == 2)]
    weather = spark.createDataFrame(hours, "time timestamp_ntz, wrow int, wcol int, t double, w double")
    points = [(k, T0 + dt.timedelta(minutes=rng.randrange(-6000, 6000)), rng.uniform(0, 29), rng.uniform(-19, 0)) for k in range(60)] + [(90, T0, 5.0, -5.0)]
    pairs = ((0, 24), (5, 6), (24, 48))
    for interval in (False, True):
        got = we.window_means(spark.createDataFrame(points, POINT), weather, grid, pairs, ["t", "w"], interval=interval).collect()
        assert len(got) == len(points) * 3 * 4
        at = {p[0]: p for p in points}
        for r in got:
            _, ts, x, y = at[r.point_id]
            a, b = pairs[r.pair]
            row, col = int(-y // 10) + r.i, int(x // 10) + r.j
            some = [h for h in hours if h[1:3] == (row, col) and ts + (a if interval else -a) * HOUR <= h[0] < ts + b * HOUR]
            for v, k in ((r.t, 3), (r.w, 4)):
                one = [h[k] for h in some if h[k] is not None]
                want = sum(one) / len(one) if one else 0.0
                assert v == pytest.approx(want, abs=1e-9, nan_ok=True)


@pytest.mark.parametrize("method", ["exact", "date", "circle", "fractional"])
@pytest.mark.parametrize("like", [1, 5])
def test_rasterized_equals_the_join_where_points_share_full_cells(spark, monkeypatch, method, like):
    monkeypatch.setattr(wc, "LIKE", like)
    monkeypatch.setattr(wc, "STEP", 60)
    rng = random.Random(12)
    windows, place = [(3, "a", -100, -2), (5, "b", -6, 6)], lambda: rng.choice([rng.uniform(0, 2e4), 1125.0 * rng.randrange(18)])
    p = spark.createDataFrame([(i, T0 + rng.uniform(0, 2) * HOUR, place(), place()) for i in range(80)], POINT)
    d = spark.createDataFrame([(i, T0 + rng.choice([rng.uniform(-110, 12), -2, 6]) * HOUR, place(), place()) for i in range(4000)], DETECTION)
    got = wc.rasterized(p, d, windows, method, 22500, 2250)
    want = rasterize.rasterize(wj.window_join(p, d, windows), method, cell=2250, **({"radius": 2250} if method in ("circle", "fractional") else {}))
    assert got.dtypes == want.dtypes
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.collect())


def test_dense_tensors_of_many_cells(spark):
    from emberline.operators import training

    cells = spark.createDataFrame([(i, k % 3, k // 3 % 4, k // 12) for i in range(5) for k in range(0, 36, i + 1)], "point_id long, layer int, row int, col int")
    for r in training.dense(cells, 3, 4).collect():
        held = {(k % 3) * 16 + (k // 3 % 4) * 4 + k // 12 for k in range(0, 36, r.point_id + 1)}
        assert r.tensor == [float(n in held) for n in range(48)]


def test_grids_hold_the_cells(spark):
    rng = random.Random(12)
    at = lambda: T0 + dt.timedelta(minutes=rng.randrange(4000))
    p = spark.createDataFrame([(k, at(), rng.uniform(0, 9000), rng.uniform(0, 9000)) for k in range(40)] + [(40, None, 1.0, 1.0)], POINT)
    d = spark.createDataFrame([(k, at(), rng.uniform(0, 9000), rng.uniform(0, 9000)) for k in range(600)], DETECTION)
    windows = [(0, "a", -6, 0), (1, "b", 0, 6), (2, "c", -30, -6)]
    want = sorted((r.point_id, r.at, r.row, r.col, r.windows) for r in wc.window_cells(p, d, windows, 4000, 250).collect())
    got = [(r.point_id, r.at, k // 16, k % 16, bits) for r in wc.window_grids(p, d, windows, 4000, 250).collect() for k, bits in enumerate(r.grid) if bits]
    assert sorted(got) == want and len(want) > 500
    with pytest.raises(ValueError):
        wc.window_grids(p, d, [(k, "w", 0, 1) for k in range(9)])


def test_layers_of_cells_without_an_array_for_each(spark, capsys):
    windows = wj.standard_windows()
    rng = random.Random(2)
    rows = [(k, k % 60, k % 7, rng.randrange(1 << len(windows))) for k in range(200)] + [(200, 0, 0, 0)]
    found = wc.by_layer(spark.createDataFrame(rows, "point_id long, row int, col int, windows long"), windows)
    want = sorted((p, w[0], r, c) for p, r, c, bits in rows for k, w in enumerate(windows) if bits >> k & 1)
    assert sorted(map(tuple, found.collect())) == want
    capsys.readouterr()
    found.explain()
    assert "lambda" not in capsys.readouterr().out


def test_pairs_of_the_window_join_come_from_a_shuffle(spark, capsys):
    rng = random.Random(9)
    at = lambda: T0 + dt.timedelta(minutes=15 * rng.randrange(200))
    p = [(k, at(), 125.0 * rng.randrange(80), 125.0 * rng.randrange(80)) for k in range(60)]  # some on the square's and the grid's edges
    d = [(k, at(), 125.0 * rng.randrange(80), 125.0 * rng.randrange(80)) for k in range(300)]
    windows = [(0, "a", -3, 3), (1, "b", 1, 2), (2, "c", -40, -20)]
    found = wj.window_join(spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION), windows, 4000)
    want = sorted((i, w[0], j) for i, t, x, y in p for j, u, a, b in d for w in windows if t + w[2] * HOUR <= u < t + w[3] * HOUR and abs(a - x) <= 2000 and abs(b - y) <= 2000)
    assert sorted((r.point_id, r.layer, r.det_id) for r in found.collect()) == want and len(want) > 300
    capsys.readouterr()
    found.explain()
    assert "SortMergeJoin" in capsys.readouterr().out


def test_cells_of_points_in_turn_are_those_of_points_by_themselves(spark, capsys):
    """Last times are kept from one hour's points to the next; rows come of compiled steps."""
    rng = random.Random(21)
    at = lambda: T0 + dt.timedelta(minutes=rng.randrange(6000))
    p = [(k, at(), 1000.0 + rng.uniform(0, 900), 1000.0 + 250 * rng.randrange(8)) for k in range(60)]
    d = [(k, at(), rng.uniform(0, 4000), 125.0 * rng.randrange(32)) for k in range(3000)]
    options = dict(lags=(0, 1), step_hours=12, burn_hours=40, size=2000, cell=250)
    found = wc.dated_stack(spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION), **options)
    windows = [("observed", 0, -3, 3), ("observed", 1, -15, -9), ("target", 1, 9, 15), ("target", 2, 21, 27), ("burned", 0, -49, -9)]
    want = {}
    for i, t, x, y in p:
        for kind, step, lo, hi in windows:
            for _, u, a, b in d:
                col = int((a - x + 1000) // 250)
                row = int((8 - (b - y + 1000) / 250) // 1)
                if t + lo * HOUR <= u < t + hi * HOUR and max(abs(a - x), abs(b - y)) <= 1000 and 0 <= row < 8 and 0 <= col < 8:
                    key, hours = (i, kind, step, 7 - row, col), (t - u) // HOUR if kind == "burned" else None
                    want[key] = min(want.get(key, hours), hours) if hours is not None else None
    assert {tuple(r)[:5]: r.hours for r in found.collect()} == want and len(want) > 3000
    for plan in (found, wc.rasterized(spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION), [(0, "a", -3, 3), (1, "b", 3, 9)], "date")):
        capsys.readouterr()
        plan.explain()
        assert "lambda" not in capsys.readouterr().out
