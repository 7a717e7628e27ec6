"""Map projections as column arithmetic: Transverse Mercator and Lambert conformal conic on an ellipsoid, both ways.

Series and closed forms after Snyder, "Map Projections: A Working Manual" (1987).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The GRS 1980 ellipsoid.
A, FLATTENING = 6378137.0, 1 / 298.257222101
E2 = FLATTENING * (2 - FLATTENING)
E = math.sqrt(E2)


@dataclass(frozen=True)
class Mercator:
    """Transverse Mercator: origin, scale on the central meridian, false easting and northing."""

    lon0: float
    lat0: float = 0.0
    scale: float = 1.0
    easting: float = 0.0
    northing: float = 0.0

    @staticmethod
    def _arc(f):
        """Length of the meridian to a latitude (number or column)."""
        sin = F.sin if isinstance(f, Column) else math.sin
        c0 = 1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256
        c2, c4, c6 = 3 * E2 / 8 + 3 * E2**2 / 32 + 45 * E2**3 / 1024, 15 * E2**2 / 256 + 45 * E2**3 / 1024, 35 * E2**3 / 3072
        return (f * c0 - sin(f * 2) * c2 + sin(f * 4) * c4 - sin(f * 6) * c6) * A

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        f, lam = F.radians(lat), F.radians(lon - self.lon0)
        ep = E2 / (1 - E2)
        n = A / F.sqrt(1 - E2 * F.sin(f) * F.sin(f))
        t, c, a = F.tan(f) * F.tan(f), ep * F.cos(f) * F.cos(f), lam * F.cos(f)
        a2 = a * a
        x = self.scale * n * a * (1 + a2 / 6 * ((1 - t + c) + a2 / 20 * (5 - 18 * t + t * t + 72 * c - 58 * ep)))
        up = a2 / 2 * (1 + a2 / 12 * ((5 - t + 9 * c + 4 * c * c) + a2 / 30 * (61 - 58 * t + t * t + 600 * c - 330 * ep)))
        y = self.scale * (self._arc(f) - self._arc(math.radians(self.lat0)) + n * F.tan(f) * up)
        return x + self.easting, y + self.northing

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        m = (y - self.northing) / self.scale + self._arc(math.radians(self.lat0))
        mu = m / (A * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256))
        e1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
        f = mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu) + 151 * e1**3 / 96 * F.sin(6 * mu) + 1097 * e1**4 / 512 * F.sin(8 * mu)
        ep = E2 / (1 - E2)
        s2 = 1 - E2 * F.sin(f) * F.sin(f)
        c, t, n, r = ep * F.cos(f) * F.cos(f), F.tan(f) * F.tan(f), A / F.sqrt(s2), A * (1 - E2) / (s2 * F.sqrt(s2))
        d = (x - self.easting) / (n * self.scale)
        d2 = d * d
        lat = f - n * F.tan(f) / r * d2 / 2 * (1 - d2 / 12 * ((5 + 3 * t + 10 * c - 4 * c * c - 9 * ep) - d2 / 30 * (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep - 3 * c * c)))
        lon = d * (1 - d2 / 6 * ((1 + 2 * t + c) - d2 / 20 * (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep + 24 * t * t))) / F.cos(f)
        return F.degrees(lon) + self.lon0, F.degrees(lat)


@dataclass(frozen=True)
class Conic:
    """Lambert conformal conic with two standard parallels."""

    lon0: float
    lat0: float
    lat1: float
    lat2: float
    easting: float = 0.0
    northing: float = 0.0

    def _constants(self):
        f0, f1, f2 = (math.radians(v) for v in (self.lat0, self.lat1, self.lat2))
        m = lambda f: math.cos(f) / math.sqrt(1 - E2 * math.sin(f) ** 2)
        t = lambda f: math.tan(math.pi / 4 - f / 2) / ((1 - E * math.sin(f)) / (1 + E * math.sin(f))) ** (E / 2)
        n = math.log(m(f1) / m(f2)) / math.log(t(f1) / t(f2))
        big_f = m(f1) / (n * t(f1) ** n)
        return n, big_f, A * big_f * t(f0) ** n

    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        n, big_f, rho0 = self._constants()
        f = F.radians(lat)
        t = F.tan(math.pi / 4 - f / 2) / F.pow((1 - E * F.sin(f)) / (1 + E * F.sin(f)), F.lit(E / 2))
        rho, theta = A * big_f * F.pow(t, F.lit(n)), F.radians(lon - self.lon0) * n
        return rho * F.sin(theta) + self.easting, rho0 - rho * F.cos(theta) + self.northing

    def inverse(self, x: Column, y: Column) -> tuple[Column, Column]:
        n, big_f, rho0 = self._constants()
        u, v = x - self.easting, rho0 - (y - self.northing)
        t = F.pow(F.sqrt(u * u + v * v) / (A * big_f), F.lit(1 / n))
        c = math.pi / 2 - 2 * F.atan(t)  # the conformal latitude
        s2, s4 = E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360, 7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520
        s6, s8 = 7 * E2**3 / 120 + 81 * E2**4 / 1120, 4279 * E2**4 / 161280
        f = c + F.sin(c * 2) * s2 + F.sin(c * 4) * s4 + F.sin(c * 6) * s6 + F.sin(c * 8) * s8
        return F.degrees(F.atan2(u, v)) / n + self.lon0, F.degrees(f)


class Geographic:
    def forward(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        return lon, lat

    inverse = forward


#: Parameters of the registered projections.
SYSTEMS = {
    "EPSG:4326": Geographic(),
    "EPSG:3400": Mercator(-115.0, 0.0, 0.9992, 500000.0, 0.0),
    "EPSG:3402": Mercator(-115.0, 0.0, 0.9992, 500000.0, 0.0),
    "EPSG:3978": Conic(-95.0, 49.0, 49.0, 77.0, 0.0, 0.0),
    "EPSG:3348": Conic(-91.86666666666666, 63.390675, 49.0, 77.0, 6200000.0, 3000000.0),
}


def transform_crs(x: Column, y: Column, source: str, target: str) -> tuple[Column, Column]:
    """Coordinates of one system in another (all on one datum)."""
    if source == target:
        return x, y
    return SYSTEMS[target].forward(*SYSTEMS[source].inverse(x, y))
