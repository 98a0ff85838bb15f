"""Geometry as Column arithmetic: affine grids, great circles, the Albers projection."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from emberline.functions.tables import EARTH_KM


@dataclass(frozen=True)
class Affine:
    """x = a * col + b * row + c, y = d * col + e * row + f."""

    a: float
    b: float
    c: float
    d: float
    e: float
    f: float

    @staticmethod
    def grid(cell: float, west: float, north: float) -> Affine:
        """North-up square cells."""
        return Affine(cell, 0.0, west, 0.0, -cell, north)

    def inverse(self) -> Affine:
        det = self.a * self.e - self.b * self.d
        return Affine(self.e / det, -self.b / det, (self.b * self.f - self.e * self.c) / det, -self.d / det, self.a / det, (self.d * self.c - self.a * self.f) / det)

    def apply(self, col: Column, row: Column) -> tuple[Column, Column]:
        return col * F.lit(self.a) + row * F.lit(self.b) + F.lit(self.c), col * F.lit(self.d) + row * F.lit(self.e) + F.lit(self.f)

    def index(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Column and row of a point, with fractions."""
        if self.b == self.d == 0:  # exact at the edges of cells
            return (x - F.lit(self.c)) / F.lit(self.a), (y - F.lit(self.f)) / F.lit(self.e)
        return self.inverse().apply(x, y)

    def cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column of the cell that holds a point."""
        col, row = self.index(x, y)
        return F.floor(row).cast("int"), F.floor(col).cast("int")

    def centre(self, row: Column, col: Column) -> tuple[Column, Column]:
        return self.apply(col + F.lit(0.5), row + F.lit(0.5))

    def padded(self, cells: int) -> Affine:
        """The grid that begins so many cells further out."""
        return Affine(self.a, self.b, self.c - cells * (self.a + self.b), self.d, self.e, self.f - cells * (self.d + self.e))

    def bounds(self, rows: int, cols: int) -> tuple[float, float, float, float]:
        """West, south, east, north of a north-up grid."""
        return self.c, self.f + rows * self.e, self.c + cols * self.a, self.f


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p, q = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((q - p) / 2), 2) + F.cos(p) * F.cos(q) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * EARTH_KM * F.atan2(F.sqrt(h), F.sqrt(1 - h))


@dataclass(frozen=True)
class Albers:
    """Equal-area conic projection on an ellipsoid (Snyder, USGS PP 1395, equations 14-1 to 14-21)."""

    lat1: float = 29.5
    lat2: float = 45.5
    lat0: float = 37.5
    lon0: float = -96.0
    radius: float = 6378137.0
    flattening: float = 1 / 298.257222101

    @property
    def e2(self) -> float:
        return self.flattening * (2 - self.flattening)

    def _q(self, s: float) -> float:
        e = math.sqrt(self.e2)
        return (1 - self.e2) * (s / (1 - self.e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def _constants(self) -> tuple[float, float, float]:
        m = lambda lat: math.cos(math.radians(lat)) / math.sqrt(1 - self.e2 * math.sin(math.radians(lat)) ** 2)
        q = lambda lat: self._q(math.sin(math.radians(lat)))
        n = (m(self.lat1) ** 2 - m(self.lat2) ** 2) / (q(self.lat2) - q(self.lat1))
        c = m(self.lat1) ** 2 + n * q(self.lat1)
        return n, c, self.radius * math.sqrt(c - n * q(self.lat0)) / n

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, c, rho0 = self._constants()
        e, s = math.sqrt(self.e2), F.sin(F.radians(lat))
        q = (1 - self.e2) * (s / (1 - self.e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
        rho, theta = self.radius * F.sqrt(c - n * q) / n, n * F.radians(lon - self.lon0)
        return rho * F.sin(theta), rho0 - rho * F.cos(theta)

    def unproject(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Longitude and latitude, by the series for the authalic latitude."""
        n, c, rho0 = self._constants()
        rho, theta = F.sqrt(x * x + (rho0 - y) * (rho0 - y)), F.atan2(x, rho0 - y)
        q = (c - F.pow(rho * n / self.radius, 2)) / n
        beta = F.asin(q / self._q(1.0))
        e2, e4, e6 = self.e2, self.e2**2, self.e2**3
        lat = beta + (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta) + 761 * e6 / 45360 * F.sin(6 * beta)
        return F.degrees(theta / n) + self.lon0, F.degrees(lat)


def vapour_pressure_deficit(kelvin: Column, humidity: Column) -> Column:
    """kPa, none below 0."""
    saturated = 0.611 * F.pow(F.lit(10.0), (7.5 * kelvin - 2048.6) / (kelvin - 35.85))
    return F.greatest(saturated - humidity / 100 * saturated, F.lit(0.0))
