"""Hourly files by path, months apart, chains of sources, optional inputs, steps of weather, channels by position."""

import datetime as dt
import glob
import os
import random

import pyarrow as pa
import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from emberline.functions.geo import Affine, Albers
from emberline.operators import regions, training
from emberline.operators import weather as we
from emberline.sources import catalogue, chains, hourly, months
from emberline.sources import detections as sd

T0 = dt.datetime(2024, 1, 31, 20)
HOUR = dt.timedelta(hours=1)
NAMES = ["temperature", "wind_u"]


def write_hour(folder, k, table=None):
    path = hourly.hour_path(str(folder), T0 + k * HOUR)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if isinstance(table, bytes):
        with open(path, "wb") as f:
            f.write(table)
    else:
        parquet.write_table(table or pa.table({"wrow": [0, 0], "wcol": [0, 1], "temperature": [k, k + 0.5], "wind_u": [1.0, None], "other": ["x", "y"]}), path)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    out = tmp_path_factory.mktemp("hours")
    for k in (0, 1, 4, 6):
        write_hour(out, k)
    write_hour(out, 3, b"PAR1 broken")
    write_hour(out, 5, pa.table({"wrow": [0], "wcol": [0], "temperature": [1.0]}))
    return out


def test_absent_and_broken_hours_are_missing(spark, folder):
    rows = hourly.read_hours(spark, str(folder), "2024-01-31 20:00", "2024-02-01 04:00", NAMES)
    found = rows.groupBy("time").agg(F.max("missing").alias("missing"), F.count("*").alias("n"), F.sum("temperature").alias("t")).orderBy("time").collect()
    assert [(r.time, r.missing, r.n, r.t) for r in found] == [(T0 + k * HOUR, k not in (0, 1, 4, 6), 2 if k in (0, 1, 4, 6) else 1, 2 * k + 0.5 if k in (0, 1, 4, 6) else None) for k in range(8)]
    assert rows.where("wind_u is null and not missing").count() == 4 and rows.schema["time"].dataType.simpleString() == "timestamp_ntz"


def test_written_hours_come_back(spark, tmp_path):
    rows = [(T0 + k * HOUR, 0, c, float(k), None if c else 1.0) for k in (0, 2, 3) for c in range(2)]
    made = hourly.write_hours(spark.createDataFrame(rows, "time timestamp_ntz, wrow int, wcol int, temperature double, wind_u double"), f"file://{tmp_path}")
    assert sorted((r.time, r.cells) for r in made.collect()) == [(T0 + k * HOUR, 2) for k in (0, 2, 3)]
    found = hourly.read_hours(spark, f"file://{tmp_path}", "2024-01-31 20:00", "2024-02-01 01:00", NAMES, hours=3)
    assert found.rdd.getNumPartitions() == 2
    want = [(*r, False) for r in rows] + [(T0 + k * HOUR, None, None, None, None, True) for k in (1, 4)]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(want, key=str)


def test_times_are_pushed_to_the_list_of_hours(spark, folder):
    reader = hourly.HourlyReader({"path": str(folder), "first": "2024-01-01 00:00", "last": "2025-01-01 00:00"}, hourly.HourlyWeather({"variables": "a"}).schema() and spark.createDataFrame([], "time timestamp_ntz, a double, missing boolean").schema)
    ds = hourly.ds
    other = ds.EqualTo(("wrow",), 1)
    left = list(reader.pushFilters([ds.GreaterThanOrEqual(("time",), T0), ds.LessThan(("time",), T0 + 2.5 * HOUR), ds.IsNotNull(("time",)), other]))
    assert left == [ds.IsNotNull(("time",)), other] and [p.value for p in reader.partitions()] == [[T0], [T0 + HOUR], [T0 + 2 * HOUR]]
    list(reader.pushFilters([ds.GreaterThan(("time",), T0), ds.LessThanOrEqual(("time",), T0 + HOUR)]))
    assert [p.value for p in reader.partitions()] == [[T0 + HOUR]]
    list(reader.pushFilters([ds.EqualTo(("time",), T0 + 9 * HOUR)]))
    assert [p.value for p in reader.partitions()] == [[]]
    rows = hourly.read_hours(spark, str(folder), "2024-01-01 00:00", "2024-03-01 00:00", NAMES).where((F.col("time") >= F.lit(T0).cast("timestamp_ntz")) & (F.col("time") < F.lit(T0 + 2 * HOUR).cast("timestamp_ntz")))
    assert rows.rdd.getNumPartitions() == 2 and rows.count() == 4
    assert rows.where("time > timestamp_ntz'2024-05-01 00:00:00'").count() == 0


def files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/month=*/*.parquet")}


def test_one_month_is_made_again_alone(spark, folder, tmp_path):
    path, first, last = str(tmp_path / "kept"), "2024-01-31 20:00", "2024-02-01 04:00"
    rows = hourly.read_hours(spark, str(folder), first, last, NAMES)
    months.write_months(rows, path, first, last, NAMES)
    before = files(path)
    months.write_months(rows.withColumn("temperature", F.col("temperature") + 100), path, "2024-02-01 00:00", last, NAMES)
    after = files(path)
    january = {p: t for p, t in before.items() if "2024-01" in p}
    assert january and january == {p: t for p, t in after.items() if "2024-01" in p} and not {p for p in before if "2024-02" in p} & set(after)
    got = sorted(((r.time, r.temperature, r.missing) for r in months.read_months(spark, path, first, last, NAMES).collect()), key=str)
    want = [(T0 + k * HOUR, v + (100 if k >= 4 else 0), False) for k in (0, 1, 4, 6) for v in (k, k + 0.5)] + [(T0 + k * HOUR, None, True) for k in (2, 3, 5, 7)]
    assert got == sorted(want, key=str)
    assert months.read_months(spark, path, "2024-02-01 00:00", last, NAMES).count() == 6


def test_weather_chain_crops_to_a_region(spark, folder, tmp_path):
    ring = spark.createDataFrame([(1, "r", [(10.5, -0.2), (19.0, -0.2), (19.0, -0.8), (10.5, -0.8)])], "polygon int, region string, ring array<struct<x:double,y:double>>")
    edges = regions.edges(ring, "region", "polygon")
    got = chains.weather_of_hours(spark, str(folder), str(tmp_path / "m"), "2024-01-31 20:00", "2024-02-01 04:00", NAMES, edges, Affine.grid(10.0, 0.0, 0.0), "temperature")
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert [r[:2] for r in rows if not r[5]] == [(T0 + k * HOUR, 0) for k in (0, 1, 4, 6)] and {r[3] for r in rows if not r[5]} == {0.5, 1.5, 4.5, 6.5} and sum(r[5] for r in rows) == 4


def test_detections_of_years(spark, tmp_path):
    os.makedirs(tmp_path / "viirs_375m")
    for year in (2019, 2020):
        with open(tmp_path / "viirs_375m" / f"{year}.csv", "w") as f:
            f.write("type,acq_date,acq_time,longitude,latitude,frp\n")
            for t, lon, lat in ((0, -120.0, 35.0), (0, -120.0, 36.05), (9, -120.0, 35.0), (1, -110.0, 35.0)):
                f.write(f"{t},{year}-07-01,905,{lon},{lat},1.5\n")
    ring = spark.createDataFrame([(1, "r", [(-121.0, 34.0), (-119.0, 34.0), (-119.0, 36.0), (-121.0, 36.0)])], "polygon int, region string, ring array<struct<x:double,y:double>>")
    region = regions.union(regions.edges(ring, "region", "polygon"), 0.5)
    found = chains.detections_of_years(spark, str(tmp_path), "viirs_375m", "2019-01-01", "2020-12-31", types=(0, 1), region=region, padding=0.1, band=0.5).collect()
    assert sorted((r.acq_datetime, r.latitude, r.within_region) for r in found) == [(dt.datetime(y, 7, 1, 9, 5), lat, lat == 35.0) for y in (2019, 2020) for lat in (35.0, 36.05)]
    lon, lat = (spark.createDataFrame([(found[0].x, found[0].y)], "x double, y double").select(*[c.alias(n) for c, n in zip(Albers().unproject(F.col("x"), F.col("y")), ("a", "b"))]).first())
    assert abs(lon - found[0].longitude) < 1e-9 and abs(lat - found[0].latitude) < 1e-7  # by a series


def test_components_and_artifacts(spark):
    began = []
    parts = {n: lambda n=n: began.append(n) or n for n in ("detections", "land_cover", "weather")}
    assert chains.dataset(parts, ("weather", "detections")) == {"weather": "weather", "detections": "detections"} and began == ["weather", "detections"]
    with pytest.raises(ValueError):
        chains.dataset(parts, ("clusters",))
    rows = spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + 5 * k * HOUR, float(-k), 0.0, k % 2 == 0) for k in range(40)], "det_id long, acq_datetime timestamp_ntz, x double, y double, within_region boolean")
    made = chains.artifacts(rows, "2024-01-03", "2024-01-05", 24, 12)
    table = made["search_table"].orderBy("position").collect()
    assert [r.position for r in table] == list(range(len(table))) and [r.acq_datetime for r in table] == sorted(r.acq_datetime for r in table)
    assert table[0].acq_datetime >= dt.datetime(2024, 1, 2) and table[-1].acq_datetime < dt.datetime(2024, 1, 5, 12)
    assert {r.point_id % 2 for r in made["points"].collect()} == {0}
    given = rows.select(F.col("det_id").alias("point_id")).limit(3)
    assert chains.artifacts(rows, "2024-01-03", "2024-01-05", 24, 12, given=given)["points"].count() == 3


def test_land_cover_layers_of_files(spark, tmp_path):
    for name, scale in (("landfire_dem", 10), ("landfire_evt", 1)):
        cells = spark.createDataFrame([(r, c, -9999 if r == c else scale * (10 * r + c)) for r in range(8) for c in range(8)], "row int, col int, value int")
        cells.write.parquet(f"{tmp_path}/{catalogue.land_cover_path(name)}")
    ring = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    schema = "polygon int, region string, ring array<struct<x:double,y:double>>"
    land = regions.edges(spark.createDataFrame([(1, "r", ring(2.5, -5.5, 3.0))], schema), "region", "polygon")
    ocean = regions.edges(spark.createDataFrame([(1, "o", ring(-9.5, -3.5, 13.0))], schema), "region", "polygon")
    stack = chains.land_cover_of_datasets(spark, str(tmp_path), ["landfire_dem", "landfire_evt"], grid=Affine.grid(1.0, 0.0, 0.0), region=land, ocean=ocean, target=Affine.grid(1.0, 0.0, 0.0), rows=8, cols=8, pad=1)
    got = {(r.row, r.col): (r.landfire_dem, r.landfire_evt) for r in stack.collect()}
    for r in range(8):
        for c in range(8):
            own, there = 2 <= r <= 5 and 2 <= c <= 5, 1 <= r <= 6 and 1 <= c <= 6
            sea = r <= 3 and c <= 3
            want = (10 * (10 * r + c), 10 * r + c) if own and r != c else ((0, 3292) if sea else (-32768, 3000)) if there else (None, None)
            assert got[r, c] == want, (r, c)


def test_inputs_that_may_be_absent(spark, tmp_path):
    spark.createDataFrame([(1, T0, 0.0, 1.0, 5)], "point_id int, ts timestamp_ntz, x double, y double, more int").write.parquet(f"{tmp_path}/case")
    spark.range(3).write.parquet(f"{tmp_path}/table")
    found = catalogue.read_inputs(spark, str(tmp_path), ["table"], ["filters"], points="case")
    assert set(found) == {"table", "points"} and found["points"].columns == ["point_id", "ts", "x", "y"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        catalogue.read_inputs(spark, str(tmp_path), ["nothing"])


def test_steps_take_the_nearest_hour(spark):
    rng = random.Random(3)
    hours = sorted(rng.sample(range(200), 30))
    weather = spark.createDataFrame([(T0 + h * HOUR, 0, c, float(h)) for h in hours for c in range(2) if h % 5 or c], "time timestamp_ntz, wrow int, wcol int, t double")
    points = [(k, T0 + dt.timedelta(minutes=30 * rng.randrange(-40, 440)), 15.0 * (k % 2) + 2, -5.0) for k in range(120)]
    got = {(r.point_id, r.step): (r.time, r.t) for r in we.step_stack(spark.createDataFrame(points, "point_id int, ts timestamp_ntz, x double, y double"), weather, Affine.grid(10.0, 0.0, 0.0), ["t"], (-2, 0, 1)).collect()}
    assert len(got) == 360
    for k, ts, x, _ in points:
        for step in (-2, 0, 1):
            at = ts + 24 * step * HOUR
            near = min(((abs(T0 + h * HOUR - at), h) for h in hours), default=None)
            want = (T0 + near[1] * HOUR, float(near[1]) if near[1] % 5 or x > 10 else None) if near[0] <= 6 * HOUR else (None, None)
            assert got[k, step] == want


def test_channels_by_position(spark):
    rows = spark.createDataFrame([(0, [1, 2, 3]), (1, [4]), (2, []), (3, None)], "position long, channels array<int>")
    wanted = spark.createDataFrame([(0,), (0,), (1,), (2,), (9,)], "position long")
    assert sorted(tuple(r) for r in training.gathered_channels(rows, wanted, 1, 3).collect()) == [(0, [2, 3]), (0, [2, 3]), (1, []), (2, [])]


def test_years_and_months_of_rows(spark):
    rows = spark.createDataFrame([(dt.datetime(2012, 5, 9, 3),), (dt.datetime(2012, 7, 31, 5),), (None,)], "t timestamp_ntz")
    got = months.month_ranges(rows, "t").orderBy("start").collect()
    assert [(str(r.start), str(r.stop)) for r in got] == [("2012-05-09", "2012-06-01"), ("2012-06-01", "2012-07-01"), ("2012-07-01", "2012-08-01")]
    assert months.month_ranges(rows.limit(0), "t").count() == 0 and sd.years_of(rows.limit(0), "t").count() == 0
    more = rows.unionByName(spark.createDataFrame([(dt.datetime(2014, 1, 1, 5),)], "t timestamp_ntz"))
    assert sorted(r.year for r in sd.years_of(more, "t").collect()) == [2012, 2013]


def test_polygons_come_back(spark, tmp_path):
    schema = "polygon long, part int, name string, ring array<struct<x:double,y:double>>"
    rows = [(1, 0, "a", [(0.0, 0.5), (1.25, 0.0), (1.0, 1.0)]), (2, 1, None, [])]
    catalogue.write_polygons(spark.createDataFrame(rows, schema), str(tmp_path / "p"))
    assert sorted((r.polygon, r.part, r.name, [tuple(p) for p in r.ring]) for r in catalogue.read_polygons(spark, str(tmp_path / "p")).collect()) == rows
