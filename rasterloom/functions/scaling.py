"""From digital numbers to physical values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.expr import to_int16

#: Published coefficients of the sensor products.
OPTICAL_SCALE, OPTICAL_OFFSET = 0.0000275, -0.2
THERMAL_SCALE, THERMAL_OFFSET = 0.00341802, 149.0
OLI_TO_ETM_BANDS = {"SR_B2": "SR_B1", "SR_B3": "SR_B2", "SR_B4": "SR_B3", "SR_B5": "SR_B4", "SR_B6": "SR_B5", "SR_B7": "SR_B7"}
OLI_SLOPES = (0.9785, 0.9542, 0.9825, 1.0073, 1.0171, 0.9949)
OLI_INTERCEPTS = (-0.0095, -0.0016, -0.0022, -0.0021, -0.0030, 0.0029)
PHENOLOGY = {"EVI_Minimum_1": 0.0001, "EVI_Minimum_2": 0.0001, "EVI_Amplitude_1": 0.0001, "EVI_Amplitude_2": 0.0001, "EVI_Area_1": 0.1, "EVI_Area_2": 0.1}
SOIL_DIVISORS = {"bdod": 100, "cec": 10, "cfvo": 10, "clay": 10, "nitrogen": 100, "ocd": 10, "ocs": 10, "phh2o": 10, "sand": 10, "silt": 10, "soc": 10}


def apply_scale_factors(df: DataFrame, optical: Sequence[str], thermal: Sequence[str] = ("ST_B6",)) -> DataFrame:
    return df.withColumns({b: F.col(b) * OPTICAL_SCALE + OPTICAL_OFFSET for b in optical} | {b: F.col(b) * THERMAL_SCALE + THERMAL_OFFSET for b in thermal})


def scale_reflectance(df: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Reflectance bands only; flag bands keep their bits."""
    return df.withColumns({b: F.col(b) * OPTICAL_SCALE + OPTICAL_OFFSET for b in bands})


def harmonize_oli_to_etm(df: DataFrame, slopes: Sequence[float] = OLI_SLOPES, intercepts: Sequence[float] = OLI_INTERCEPTS, intercept_scale: float = 10000.0) -> DataFrame:
    """Bands of the newer instrument renamed to the older one's and regressed to it: (x - intercept * scale) / slope."""
    made = {new: (F.col(old) - F.lit(i * intercept_scale)) / F.lit(s) for (old, new), s, i in zip(OLI_TO_ETM_BANDS.items(), slopes, intercepts)}
    rest = [c for c in df.columns if c not in OLI_TO_ETM_BANDS and c not in made]
    return df.select(*rest, *[c.alias(n) for n, c in made.items()])


def harmonize_where(df: DataFrame, newer: Column, slopes: Sequence[float] = OLI_SLOPES, intercepts: Sequence[float] = OLI_INTERCEPTS, intercept_scale: float = 10000.0) -> DataFrame:
    """The same for the rows of the newer instrument in a table of several, in one projection: no split and union."""
    return df.withColumns({
        new: F.when(newer, (F.col(old) - F.lit(i * intercept_scale)) / F.lit(s)).otherwise(F.col(new)) for (old, new), s, i in zip(OLI_TO_ETM_BANDS.items(), slopes, intercepts)
    })


def scale_modis_phenology(df: DataFrame, factors: Mapping[str, float] = PHENOLOGY) -> DataFrame:
    """Scales the bands that are there, as float; others are unchanged."""
    return df.withColumns({b: (F.col(b) * f).cast("float") for b, f in factors.items() if b in df.columns})


def scale_soil(df: DataFrame, divisors: Mapping[str, float] = SOIL_DIVISORS) -> DataFrame:
    """Divides each band by its variable's factor; a band is named <variable>_<depth>..."""
    of = {b: divisors[b.split("_")[0]] for b in df.columns if b.split("_")[0] in divisors}
    return df.withColumns({b: (F.col(b) / F.lit(float(d))).cast("float") for b, d in of.items()})


def scale_hydrosoil(df: DataFrame, continuous: Sequence[str], categorical: Sequence[str], factor: float = 0.0001) -> DataFrame:
    return df.withColumns({b: (F.col(b) * factor).cast("float") for b in continuous} | {b: to_int16(F.col(b)) for b in categorical})
