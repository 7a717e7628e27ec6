"""Spectral indices, written once over band roles; a sensor profile names the columns and says whether to clamp."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.expr import clamp, normalized_difference, ratio, unmask
from rasterloom.model import CELL


@dataclass(frozen=True)
class Sensor:
    """Columns by role, whether indices are clamped, and which indices the sensor has."""

    name: str
    roles: dict[str, str]
    clamped: bool
    indices: tuple[str, ...] = field(default=())

    def __getitem__(self, role: str) -> Column:
        return F.col(self.roles[role])


LANDSAT = Sensor(
    "landsat", {"blue": "SR_B1", "green": "SR_B2", "red": "SR_B3", "nir": "SR_B4", "swir1": "SR_B5", "swir2": "SR_B7"}, True,
    ("BSI", "DSWI", "DRS", "EVI", "GNDVI", "LAI", "NBR", "NDMI", "NDSI", "NDVI", "NDWI", "SAVI", "SI"),
)
SENTINEL2 = Sensor(
    "sentinel2",
    {"blue": "B2", "green": "B3", "red": "B4", "re1": "B5", "re2": "B6", "re3": "B7", "nir": "B8", "re4": "B8A", "swir1": "B11", "swir2": "B12"}, False,
    ("CRE", "DSWI", "DRS", "EVI", "GNDVI", "LAI", "NBR", "NDRE1", "NDRE2", "NDRE3", "NDVI", "NDWI", "RDI"),
)


def _evi(s: Sensor, epsilon: float = 0.0) -> Column:
    return 2.5 * ratio(s["nir"] - s["red"], s["nir"] + 6 * s["red"] - 7.5 * s["blue"] + 1 + epsilon)


def _bounded(s: Sensor, c: Column, lo: float, hi: float) -> Column:
    return clamp(c, lo, hi) if s.clamped else c


INDICES: dict[str, Callable[[Sensor], Column]] = {
    "BSI": lambda s: normalized_difference(s["red"] + s["swir1"], s["nir"] + s["blue"]),
    "DSWI": lambda s: _bounded(s, ratio(s["nir"] + s["green"], s["swir1"] + s["red"]), 0.0, 3.0),
    "DRS": lambda s: F.sqrt(s["red"] * s["red"] + s["swir1"] * s["swir1"]),
    "EVI": lambda s: _bounded(s, _evi(s), -2.0, 2.0),
    "GNDVI": lambda s: normalized_difference(s["nir"], s["green"]),
    "LAI": lambda s: _bounded(s, 3.618 * _evi(s, 1e-10 if s.clamped else 0.0) - 0.118, 0.0, 10.0),
    "NBR": lambda s: normalized_difference(s["nir"], s["swir2"]),
    "NDMI": lambda s: normalized_difference(s["nir"], s["swir1"]),
    "NDSI": lambda s: normalized_difference(s["green"], s["swir1"]),
    "NDVI": lambda s: normalized_difference(s["nir"], s["red"]),
    "NDWI": lambda s: normalized_difference(s["green"], s["nir"]),
    "SAVI": lambda s: ratio(s["nir"] - s["red"], s["nir"] + s["red"] + 0.428) * 1.428,
    "SI": lambda s: (1 - s["blue"]) * (1 - s["green"]) * (1 - s["red"]),
    "CRE": lambda s: ratio(s["re3"], s["re1"]) - 1,
    "NDRE1": lambda s: normalized_difference(s["re2"], s["re1"]),
    "NDRE2": lambda s: normalized_difference(s["re3"], s["re1"]),
    "NDRE3": lambda s: normalized_difference(s["re4"], s["re3"]),
    "RDI": lambda s: ratio(s["swir2"], s["re4"]),
}
#: Roles without which an index is left out (a band that some images lack), not an error.
OPTIONAL = {"NDRE3": ("re4", "re3"), "RDI": ("swir2", "re4")}


def add_indices(df: DataFrame, sensor: Sensor, names: Sequence[str] | None = None) -> DataFrame:
    """Adds the named indices (all of the sensor's by default) in one projection; an unknown name is an error."""
    names = list(sensor.indices if names is None else names)
    if wrong := [n for n in names if n not in sensor.indices]:
        raise ValueError(f"{sensor.name} has no index {', '.join(wrong)}; it has {', '.join(sensor.indices)}")
    there = set(df.columns)
    use = [n for n in names if all(sensor.roles[r] in there for r in OPTIONAL.get(n, ()))]
    return df.withColumns({n: INDICES[n](sensor) for n in use})


def add_snow_flag(df: DataFrame, sensor: Sensor = LANDSAT, above: float = 0.4) -> DataFrame:
    return df.withColumn("snow", (INDICES["NDSI"](sensor) > above).cast("int"))


#: Suffix of the index by land-cover class.
SUFFIX = {210: "coni", 220: "deci"}


def ndrs_name(classes: Sequence[int]) -> str:
    return f"NDRS_{SUFFIX.get(classes[0], 'mixed') if len(classes) == 1 else 'mixed'}"


def add_ndrs(df: DataFrame, landcover: DataFrame, classes: Sequence[int], image: str = "image_id", drs: str = "DRS", cover: str = "b1", last_year: int = 2019, stride: int = 1) -> DataFrame:
    """DRS normalised by its range over an image's forest pixels, for all pixels; ``df`` has year, col, row.

    Land cover is that of the image's year, at most ``last_year``. The range comes from every ``stride``-th cell that is
    forest, which are picked out before anything is joined or grouped, and is one row per image, joined back on the
    image. A flat or missing range gives null.
    """
    on_stride = (F.col("col") % stride == 0) & (F.col("row") % stride == 0)
    forest = landcover.where(F.col(cover).isin(list(classes))).select(F.col("year").alias("_y"), *CELL)
    name = ndrs_name(classes)
    slim = df.select(image, F.least(F.col("year"), F.lit(last_year)).alias("_y"), *CELL, drs)
    slim, forest = (slim.where(on_stride), forest.where(on_stride)) if stride > 1 else (slim, forest)
    stats = slim.join(forest, ["_y", *CELL], "left_semi").groupBy(image).agg(F.min(drs).alias("_lo"), F.max(drs).alias("_hi"))
    k = df.join(stats, image, "left")
    x = F.when(F.col(drs).isNotNull() & F.col("_lo").isNotNull(), F.least(F.greatest(F.col(drs), F.col("_lo")), F.col("_hi")))
    return k.withColumn(name, ratio(x - F.col("_lo"), F.col("_hi") - F.col("_lo"))).drop("_lo", "_hi")


def add_ndrs_stressed(df: DataFrame, landcover: DataFrame, band: str, year: int = 2019, cls: int = 210, above: float = 0.5, cover: str = "b1") -> DataFrame:
    """1 where the forest-masked index exceeds ``above``, else 0 (masked pixels too)."""
    chosen = landcover.where(F.col("year") == year).select(*CELL, F.col(cover).alias("_cls"))
    j = df.join(chosen, CELL, "left")
    value = unmask(F.when(F.col("_cls") == cls, F.col(band)), 0.0)
    return j.withColumn(f"{band}_stressed", (value > above).cast("int")).drop("_cls")
