"""Hourly weather files as a Spark data source: a partition for each hour, read by its path; and their writer.

``spark.read.format("hourly_weather")`` with the options ``path`` (folder), ``first`` and
``last`` (half-open, as ``yyyy-MM-dd HH:mm``), ``variables`` (names, comma between) and,
if need be, ``offset`` and ``hours`` (so many hours a partition, 1 otherwise). An hour's file is found by its time alone; nothing is listed. An
hour whose file is absent, broken, or without a variable asked for is one row with
``missing``. Bounds on ``time`` are pushed to the list of hours, so hours beyond them are
not opened.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds

HOUR = dt.timedelta(hours=1)
TIME = "%Y-%m-%d %H:%M"


def hour_path(folder: str, time: dt.datetime, offset: int = 0) -> str:
    """Year, month and day as folders, then a file for the hour and the offset of its forecast."""
    return f"{folder.rstrip('/')}/{time:%Y}/{time:%Y%m}/{time:%Y%m%d}/weather_{time:%Y%m%d}_{time:%H}00_{offset:03}.parquet"


class Hours(ds.InputPartition):
    """The hours (``value``, a list) that one task reads."""


class HourlyReader(ds.DataSourceReader):
    def __init__(self, options: dict, schema):
        self.folder, self.offset, self.hours = options["path"], int(options.get("offset", "0")), int(options.get("hours", "1"))
        self.first, self.last = (dt.datetime.strptime(options[n], TIME) for n in ("first", "last"))
        self.names = [f.name for f in schema.fields if f.name not in ("time", "missing")]

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Narrows the hours by bounds on ``time``; other filters are left to Spark."""
        for f in filters:
            value = getattr(f, "value", None)
            if getattr(f, "attribute", None) != ("time",) or not isinstance(value, dt.datetime) or value.tzinfo:
                yield f
            elif isinstance(f, (ds.GreaterThanOrEqual, ds.EqualTo, ds.GreaterThan)):
                self.first = max(self.first, value + HOUR * isinstance(f, ds.GreaterThan) if value == _hour(value) else _hour(value) + HOUR)
                if isinstance(f, ds.EqualTo):
                    self.last = min(self.last, value + HOUR)
            elif isinstance(f, (ds.LessThan, ds.LessThanOrEqual)):
                self.last = min(self.last, value + HOUR * isinstance(f, ds.LessThanOrEqual) if value == _hour(value) else _hour(value) + HOUR)
            else:
                yield f

    def partitions(self) -> list[Hours]:
        first = _hour(self.first) if self.first == _hour(self.first) else _hour(self.first) + HOUR
        times = [first + k * HOUR for k in range(max(0, -(-(self.last - first) // HOUR)))]
        return [Hours(times[k : k + self.hours]) for k in range(0, len(times), self.hours)] or [Hours([])]

    def read(self, partition: Hours) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs, parquet

        for time in partition.value:
            path = hour_path(self.folder, time, self.offset)
            try:
                where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
                table = parquet.read_table(inner, columns=self.names, filesystem=where, partitioning=None, use_threads=False)
                cells = [table.column(n).cast(_kind(n)).combine_chunks() for n in self.names]
                yield self._rows(time, cells, table.num_rows, False)
            except (OSError, pa.ArrowException, KeyError):
                yield self._rows(time, [pa.nulls(1, _kind(n)) for n in self.names], 1, True)

    def _rows(self, time, cells, n, missing) -> pa.RecordBatch:
        cells = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cells]
        return pa.record_batch([pa.array([time] * n, pa.timestamp("us")), *cells, pa.array([missing] * n)], names=["time", *self.names, "missing"])


def _hour(time: dt.datetime) -> dt.datetime:
    return time.replace(minute=0, second=0, microsecond=0)


def _kind(name: str) -> pa.DataType:
    return pa.int32() if name in ("wrow", "wcol") else pa.float64()


class HourlyWeather(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "hourly_weather"

    def schema(self) -> str:
        names = [n.strip() for n in self.options["variables"].split(",")]
        return "time timestamp_ntz, wrow int, wcol int, " + ", ".join(f"{n} double" for n in names) + ", missing boolean"

    def reader(self, schema) -> HourlyReader:
        return HourlyReader(self.options, schema)


def write_hours(weather: DataFrame, folder: str, offset: int = 0) -> DataFrame:
    """Writes each hour (``time, wrow, wcol`` and variables) as the file of its path; ``time, cells`` of the files, which
    are written as these rows are asked for. A file is complete once it has its name."""

    def put(table: pa.Table) -> pa.Table:
        from pyarrow import fs, parquet

        time = table["time"][0].as_py()
        path = hour_path(folder, time, offset)
        where, inner = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
        where.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        part = f"{inner}.{uuid.uuid4().hex}"
        parquet.write_table(table.drop_columns(["time"]), part, filesystem=where)
        where.move(part, inner)
        return pa.table({"time": table["time"][:1], "cells": [table.num_rows]})

    return weather.groupBy("time").applyInArrow(put, "time timestamp_ntz, cells long")


def read_hours(spark: SparkSession, folder: str, first: str, last: str, variables: list[str], offset: int = 0, hours: int = 1) -> DataFrame:
    """``time, wrow, wcol, variables, missing`` of all hours from first to before last; a task reads ``hours`` of them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(HourlyWeather)
    return spark.read.format("hourly_weather").options(path=folder, first=first, last=last, variables=",".join(variables), offset=offset, hours=hours).load()
