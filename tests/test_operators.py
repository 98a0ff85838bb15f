"""Small made-up cases: edges of windows and cells, ties, gaps, shapes; and properties."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from emberline.functions import geo, tables
from emberline.operators import clusters, metrics, polygons, ranks, rasterize, reasons, training
from emberline.operators import rasters as ra
from emberline.operators import weather as we
from emberline.operators import window_join as wj
from emberline.sources import catalogue as sc
from emberline.sources import detections as sd
from emberline.streaming import detections as live

T0 = dt.datetime(2024, 1, 10, 12)
HOUR = dt.timedelta(hours=1)
NOW = [(0, "current", -3, 3)]
POINT = "point_id long, ts timestamp_ntz, x double, y double"
DETECTION = "det_id long, acq_datetime timestamp_ntz, x double, y double"


def pairs(df):
    return sorted((r.point_id, r.det_id) for r in df.select("point_id", "det_id").collect())


def test_window_and_square_edges(spark):
    p = spark.createDataFrame([(1, T0, 20000.0, 20000.0)], POINT)
    rows = [(1, T0 - 3 * HOUR, 0, 0), (2, T0 + 3 * HOUR - dt.timedelta(microseconds=1), 0, 0), (3, T0 + 3 * HOUR, 0, 0), (4, T0 - 3 * HOUR - dt.timedelta(microseconds=1), 0, 0)]
    rows += [(5, T0, 11250, -11250), (6, T0, 11250.5, 0), (7, T0, -11250, 11250), (8, T0, 0, 187.5)]
    d = spark.createDataFrame([(i, t, 20000.0 + x, 20000.0 + y) for i, t, x, y in rows], DETECTION)
    found = wj.window_join(p, d, NOW)
    assert pairs(found) == [(1, 1), (1, 2), (1, 5), (1, 7), (1, 8)]
    # the last before the window's end goes, by time; the far edges have no cell; rows hold their upper edge
    assert pairs(wj.window_join_drop_last(p, d, NOW)) == [(1, 1), (1, 5), (1, 7), (1, 8)]
    assert sorted(tuple(r) for r in rasterize.exact(found).select("row", "col").collect()) == [(0, 0), (29, 30), (30, 30)]
    assert rasterize.with_cells(found).where("det_id = 5").count() == 0
    none = wj.window_join_drop_last(p, d.where("det_id = 3"), NOW)
    assert none.count() == 0


def test_join_equals_plain_join(spark):
    rng = random.Random(3)
    p = [(i, T0 + rng.uniform(-300, 300) * HOUR, rng.uniform(-4e4, 4e4), rng.uniform(-4e4, 4e4)) for i in range(60)]
    d = [(i, T0 + rng.uniform(-900, 600) * HOUR, rng.uniform(-4e4, 4e4), rng.uniform(-4e4, 4e4)) for i in range(900)]
    windows = wj.standard_windows()
    got = wj.window_join(spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION), windows)
    want = sorted((i, k, j) for i, t, x, y in p for k, _, lo, hi in windows for j, u, v, w in d if t + lo * HOUR <= u < t + hi * HOUR and abs(v - x) <= 11250 and abs(w - y) <= 11250)
    assert sorted((r.point_id, r.layer, r.det_id) for r in got.collect()) == want
    counts = wj.window_counts(spark.createDataFrame(p, POINT), spark.createDataFrame(d, DETECTION), windows)
    assert counts.count() == 60 * 13 and counts.agg(F.sum("n")).first()[0] == len(want)


def test_halo_keeps_all_that_windows_reach(spark):
    p = spark.createDataFrame([(1, T0, 0.0, 0.0), (2, T0 + 5 * HOUR, 0.0, 0.0)], POINT)
    d = spark.createDataFrame([(i, T0 + h * HOUR, 0.0, 0.0) for i, h in enumerate((-4, -3, 0, 7, 8))], DETECTION)
    assert sorted(r.det_id for r in wj.halo(p, d, NOW).collect()) == [1, 2, 3]
    assert wj.halo(p.limit(0), d, NOW).count() == 0


def test_reasons(spark):
    rows = [(1, 0, 0, 0), (2, 0, 4, 3), (3, 0, 4, 1), (4, 0, 2, 2)]
    counts = spark.createDataFrame(rows, "point_id long, layer int, n long, n_valid long")
    assert [r.reason for r in reasons.by_land_cover(counts).orderBy("point_id").collect()] == [1, 0, 2, 0]
    assert [r.reason for r in reasons.few_detections(counts).orderBy("point_id").collect()] == [1, 1, 1, 1]
    many = spark.createDataFrame([(1, 0, 2), (1, 1, 0), (2, 0, 1), (2, 1, 2), (2, 5, 0), (3, 0, 1)], "point_id long, layer int, reason int")
    assert {r.point_id: r.reason for r in reasons.combined(many).collect()} == {1: 0, 2: 2, 3: 1}


def test_rasterizer_names(spark):
    with pytest.raises(ValueError, match="no rasterizer"):
        rasterize.rasterize(spark.range(1), "other")


def test_pooling(spark):
    assert ra.pool_edges(750, 60)[:2] == [(0, 13), (12, 25)] and len(ra.pool_edges(750, 60)) == 60
    grid = geo.Affine.grid(10, 0, 300)
    cells = spark.createDataFrame([(r, c, float(r * 31 + c)) for r in range(30) for c in range(30) if (r, c) != (3, 3)], "row int, col int, v double")
    p = spark.createDataFrame([(1, T0, 155.0, 145.0), (2, T0, 45.0, 255.0), (3, T0, 5.0, 5.0)], POINT)
    got = {(r.point_id, r.pi, r.pj): r.v for r in ra.pooled(p, cells, grid, 5, 2, ["v"]).collect()}
    full = np.array([[r * 31 + c for c in range(30)] for r in range(30)], float)
    full[3, 3] = np.nan
    for k, (row, col) in {1: (15, 15), 2: (4, 4), 3: (29, 0)}.items():
        for i, (a, b) in enumerate([(0, 3), (2, 5)]):
            for j, (c, d) in enumerate([(0, 3), (2, 5)]):
                part = [full[row - 2 + u, col - 2 + v] if 0 <= row - 2 + u < 30 and 0 <= col - 2 + v < 30 else np.nan for u in range(a, b) for v in range(c, d)]
                want = float(np.mean(part))
                assert got[k, i, j] == pytest.approx(want) if not math.isnan(want) else got[k, i, j] is None
    flat = cells.withColumn("v", F.lit(7.0))
    assert {r.v for r in ra.pooled(p.where("point_id = 1"), flat, grid, 5, 2, ["v"]).collect()} == {7.0}
    assert {r.v for r in ra.pooled(p.where("point_id = 1"), flat, grid, 5, 2, ["v"], inverse_sides=True).collect()} == {7.0 * 9 / 6}


def test_codes_and_one_hot(spark):
    codes = spark.createDataFrame([(c,) for c in (*tables.NLCD_LIFE_FORM, 33)], "c int")
    got = {r.c: (r.f, r.k) for r in codes.select("c", ra.life_form(F.col("c")).alias("f"), ra.compact_class(F.col("c")).alias("k")).collect()}
    assert got[33] == (9, 9) and got[42] == (1, 9) and got[0] == (9, 0) and got[95] == (0, 16)
    chips = spark.createDataFrame([(1, 0, 0, 3), (1, 0, 1, -32768)], "point_id long, i int, j int, value int")
    assert sorted(sum(r[3:]) for r in ra.one_hot(chips, 17).collect()) == [0, 1]
    with pytest.raises(ValueError):
        ra.ocean_masked(codes.withColumn("value", F.col("c")), F.lit(True), "other")


def test_asof_tolerance_and_gaps(spark):
    grid = geo.Affine.grid(100, 0, 100)
    w = spark.createDataFrame([(T0, 0, 0, 5.0)], "time timestamp_ntz, wrow int, wcol int, t double")
    p = spark.createDataFrame([(1, T0 + 6 * HOUR, 5.0, 5.0), (2, T0 + 6 * HOUR + dt.timedelta(minutes=1), 5.0, 5.0)], POINT)
    assert {r.point_id: r.t for r in we.nearest(p, w, grid, ["t"]).collect()} == {1: 5.0, 2: None}
    means = we.window_means(p, w, grid, [(0, 24), (12, 24)], ["t"], width=1)
    assert {(r.point_id, r.pair): r.t for r in means.collect()} == {(1, 0): 0.0, (1, 1): 5.0, (2, 0): 0.0, (2, 1): 5.0}
    assert [r.missing for r in we.expected_hours(w, "2024-01-10 11:00:00", "2024-01-10 14:00:00").orderBy("time").collect()] == [True, False, True]
    gone = we.between(w, F.lit(T0), F.lit(T0), spark.createDataFrame([(T0, True)], "time timestamp_ntz, missing boolean"))
    assert gone.count() == 0


def test_projection(spark):
    # Snyder's worked example for the ellipsoid (Clarke 1866)
    a = geo.Albers(lat0=23.0, radius=6378206.4, flattening=1 / 294.9786982)
    df = spark.createDataFrame([(-75.0, 35.0)], "lon double, lat double")
    x, y = a.project(F.col("lon"), F.col("lat"))
    r = df.select(x.alias("x"), y.alias("y")).first()
    assert (r.x, r.y) == (pytest.approx(1885472.7, abs=0.1), pytest.approx(1535925.0, abs=0.1))
    lon, lat = geo.Albers().unproject(*geo.Albers().project(F.col("lon"), F.col("lat")))
    assert tuple(df.select(lon, lat).first()) == (pytest.approx(-75.0, abs=1e-9), pytest.approx(35.0, abs=1e-7))


def test_polygon_with_hole(spark):
    rings = {"a": [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (3, 1), (3, 3), (1, 3)]]}
    rows = [(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 5.0, 2.0), (4, 0.5, 1.0), (5, 3.5, 3.0)]
    p = spark.createDataFrame(rows, "id long, longitude double, latitude double")
    assert sorted(r.id for r in polygons.inside(p, polygons.edges(spark, rings), "id", band=0.7).collect()) == [1, 4, 5]


def walk(rows, km, hours):
    """Clusters one row after the other."""
    of, n = {}, 0
    for i, t, x, y in rows:
        near = [((t - u).total_seconds(), math.hypot(x - v, y - w) / 1000, j) for j, u, v, w in rows if j < i and u <= t and (t - u) < hours * HOUR and math.hypot(x - v, y - w) / 1000 <= km]
        if near:
            of[i] = of[min(near)[2]]
        else:
            of[i], n = n, n + 1
    return of


def test_neighbours_near_poles_and_across_180(spark):
    rng = random.Random(6)
    places = [(rng.choice([70, 80, 89.9]) + rng.random() * 0.1, rng.choice([-180, 179.7]) + rng.random() * 0.3) for _ in range(60)]
    places += [(70.0, 10.0), (70.0, 10.25), (89.99, 0.0), (89.99, 180.0), (-70.0, -179.9), (-70.0, 179.9)]
    rows = [(i, T0, 0.0, 0.0, a, b) for i, (a, b) in enumerate(places)]
    got = clusters.neighbours(spark.createDataFrame(rows, DETECTION + ", latitude double, longitude double"), 10, 6)

    def km(p, q):
        (a, b), (c, d) = (map(math.radians, x) for x in (p, q))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 2 * geo.EARTH_KM * math.asin(math.sqrt(h))

    want = {(i, j) for i, p in enumerate(places) for j, q in enumerate(places) if i != j and km(p, q) <= 10}
    found = [(r.det_id, r.other_id) for r in got.collect()]
    assert set(found) == want and len(found) == len(want)
    assert {(60, 61), (62, 63), (64, 65)} <= want


def test_clusters_equal_a_walk(spark):
    rng = random.Random(8)
    rows = [(i, T0 + (i // 2) * HOUR, rng.randrange(20) * 1000.0, rng.randrange(20) * 1000.0) for i in range(150)]  # ties in time and distance
    d = spark.createDataFrame([(*r, 0.0, 0.0) for r in rows], DETECTION + ", latitude double, longitude double")
    got = {r.det_id: r.cluster_id for r in clusters.clusters(d, 5, 6, clusters.planar).collect()}
    assert got == walk(rows, 5, 6)


@pytest.mark.parametrize("pairs", [1 << 19, 7])
def test_pairs_of_clusters_are_whole_and_not_sent_through_the_driver(spark, monkeypatch, pairs):
    monkeypatch.setattr(clusters, "PAIRS", pairs)
    rng = random.Random(4)
    rows = [(i, T0 + rng.randrange(-40, 40) * HOUR, rng.randrange(-15, 15) * 1000.0, rng.randrange(-15, 15) * 1000.0, 0.0, 0.0) for i in rng.sample(range(1000), 300)]
    rows += [(2000, None, 0.0, 0.0, 0.0, 0.0), (2001, T0, None, 0.0, 0.0, 0.0)]
    d = spark.createDataFrame(rows, DETECTION + ", latitude double, longitude double")
    near = clusters.neighbours(d, 5, 6, clusters.planar)
    held = rows[:-2]
    want = sorted((a[0], b[0]) for a in held for b in held if a[0] != b[0] and b[1] <= a[1] < b[1] + 6 * HOUR and math.hypot(a[2] - b[2], a[3] - b[3]) <= 5000)
    assert sorted((r.det_id, r.other_id) for r in near.collect()) == want and len(want) > 300
    best = {i: min(((a[1] - b[1]).total_seconds(), math.hypot(a[2] - b[2], a[3] - b[3]) / 1000, b[0]) for a in held if a[0] == i for b in held if b[0] < i and (i, b[0]) in set(want))[2] for i in {i for i, j in want if j < i}}
    found = clusters.parents(d, 5, 6, clusters.planar)
    assert {r.det_id: r.parent for r in found.collect()} == {r[0]: best.get(r[0]) for r in rows}
    for df in (near, found):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_calendar_gap(spark):
    d = spark.createDataFrame([(1, T0, 0.0, 0.0, 0.0, 2.0, 50), (2, T0 + 72 * HOUR, 6.0, 0.0, 0.0, 4.0, 70)], DETECTION + ", longitude double, frp double, conf int")
    ids = spark.createDataFrame([(1, 0), (2, 0)], "det_id long, cluster_id long")
    fixed = clusters.daily(d, ids).orderBy("date_local").collect()
    assert [(r.num_det, r.avg_frp, r.x) for r in fixed] == [(1, 2.0, 3.0), (0, None, 3.0), (0, None, 3.0), (1, 4.0, 3.0)]
    assert [r.x for r in clusters.daily(d, ids, False).orderBy("date_local").collect()] == [0.0, 0.0, 0.0, 6.0]


def test_numbers(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = ranks.numbered(df, [F.col("v")], partitions=5).collect()
    assert all(r.v == r.position for r in got) and len(got) == 1000


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=3, max_size=25))
def test_triangles_cover_the_hull(points):
    p = np.array(sorted(points))
    t = metrics.triangles(p)
    area = sum(abs(np.linalg.det(np.array([p[b] - p[a], p[c] - p[a]]))) / 2 for a, b, c in t)

    def cross(o, a, b):
        return (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    hull = []
    for line in (p.tolist(), p.tolist()[::-1]):
        side = []
        for q in line:
            while len(side) > 1 and cross(side[-2], side[-1], q) <= 0:
                side.pop()
            side.append(q)
        hull += side[:-1]
    want = abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(hull, hull[1:] + hull[:1]))) / 2
    assert area == pytest.approx(want, abs=1e-6)


def test_perimeter_losses(spark):
    square = [(r, c) for r in range(2, 8) for c in range(2, 8)]
    rows = [(1, r, c, 1.0, 1.0, 0.0) for r, c in square]  # as it should be
    rows += [(2, r, c, 1.0, 0.0, 0.0) for r, c in square]  # nothing predicted
    rows += [(3, 1, 1, 1.0, 1.0, 0.0)]  # too few cells
    rows += [(4, r, c, 1.0, 0.0, 0.0) for r, c in square] + [(4, r, c + 10, 0.0, 1.0, 0.0) for r, c in square]
    df = spark.createDataFrame(rows, "example_id long, row int, col int, y double, y_hat double, x_hist double")
    for new in (False, True):
        got = {r.example_id: (r.error, r.weight) for r in metrics.perimeter_losses(df, 20, 20, new=new).collect()}
        assert set(got) == {1, 2, 4} and got[1][0] == 0 and got[2] == (1.0, None) and got[4][0] == 1
    total = metrics.total_loss(metrics.perimeter_losses(df, 20, 20)).first()
    assert (total.total, total.examples) == (2.0, 3)


def test_training(spark):
    s = spark.createDataFrame([(1, 1, 2.0), (1, 2, None), (2, 1, float("nan")), (2, 2, 4.0)], "sample_id long, channel int, value double")
    topo = {(r.sample_id, r.channel): r.value for r in training.normalized_topography(s).collect()}
    std = float(np.std([2, 0, 0, 4]))
    assert topo[1, 1] == pytest.approx(1 / std) and topo[2, 2] == pytest.approx(2 / std)
    flat = training.normalized_channels(s.withColumn("value", F.lit(3.0)))
    assert {r.value for r in flat.collect()} == {0.0}
    assert {round(r.value, 6) for r in training.normalized(s, (1.0, 2.0)).where("channel = 1").collect()} == {0.5, -0.5}
    cells = spark.createDataFrame([(1, 0, 0, 1), (1, 1, 1, 0), (2, 0, 1, 1)], "point_id long, layer int, row int, col int")
    tensors = training.split_tensor(training.dense(cells, 2, 2), 2, 1, 2).orderBy("point_id").collect()
    assert list(tensors[0].observed) == [0, 1, 0, 0] and list(tensors[0].target) == [0, 0, 1, 0] and list(tensors[1].observed) == [0, 0, 0, 1]
    with pytest.raises(ValueError):
        training.batch(cells, 0, 1000)


def test_sources(spark, tmp_path):
    for y in (2012, 2013):
        (tmp_path / "viirs_375m").mkdir(exist_ok=True)
        (tmp_path / "viirs_375m" / f"{y}.csv").write_text(f"type,acq_date,acq_time,longitude,latitude,frp\n0,{y}-05-09,730,-120.5,38.1,2.5\n2,{y}-05-09,5,-120.5,38.1,2.5\n")
    d = sd.with_times(sd.of_types(sd.read_csv(spark, str(tmp_path), "viirs_375m", [2012, 2013]), (0,)))
    assert sorted(r.acq_datetime for r in d.collect()) == [dt.datetime(2012, 5, 9, 7, 30), dt.datetime(2013, 5, 9, 7, 30)]
    with pytest.raises(ValueError):
        sd.read_csv(spark, str(tmp_path), "other", [2012])
    with pytest.raises(ValueError):
        sc.land_cover_path("other")
    path = sd.table_path(str(tmp_path), "kept", region="a", lags=(1, 2))
    assert sd.kept(spark, path, lambda: d).count() == sd.kept(spark, path, lambda: 1 / 0).count() == 2
    sc.write_dataset({"a": d}, str(tmp_path / "out"), {"unit": "m"})
    assert sc.read_dataset(spark, str(tmp_path / "out"), ["a"])["a"].count() == 2
    layers = spark.createDataFrame([(0, 0, 1)], "row int, col int, value int")
    for name in ("landfire_evt", "landfire_dem"):
        layers.write.parquet(f"{tmp_path}/{sc.land_cover_path(name)}")
    assert sc.read_land_cover(spark, str(tmp_path), ["landfire_evt", "landfire_dem"]).count() == 2


def test_streams_equal_batches(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, T0 + (i // 4) * dt.timedelta(minutes=30), rng.uniform(0, 3e4), rng.uniform(0, 3e4)) for i in range(200)]
    d = spark.createDataFrame(rows, DETECTION)
    for k in range(4):
        d.where(f"det_id div 50 = {k}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(d.schema).parquet(f"{tmp_path}/in")

    def run(df, name, mode):
        q = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        assert q.awaitTermination(120) and q.exception() is None
        return sorted(map(tuple, spark.table(name).collect()))

    assert run(live.cell_counts(stream, cell=10000.0), "counts", "complete") == sorted(map(tuple, live.cell_counts(d, cell=10000.0).collect()))
    p = d.where("det_id % 5 = 0").selectExpr("det_id AS point_id", "acq_datetime AS ts", "x", "y")
    ps = stream.where("det_id % 5 = 0").selectExpr("det_id AS point_id", "acq_datetime AS ts", "x", "y")
    want = pairs(wj.window_join(p, d, [(0, "target", 1, 4)]))
    assert run(live.followed(ps, stream, 1, 4), "followed", "append") == want and want
