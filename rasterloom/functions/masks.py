"""Quality masks: predicates on flag bands that mask all other bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.functions.expr import argmax, where_mask
from rasterloom.model import CELL

#: Bits of the quality bands and scene classes.
FILL, CLOUD, SHADOW, SNOW = 1 << 0, 1 << 3, 1 << 4, 1 << 5
RADSAT_9, S2_CLOUD, S2_CIRRUS = 1 << 9, 1 << 10, 1 << 11
SCL_VEGETATION, SCL_WATER, SCL_SNOW = 4, 6, 11
SR_BANDS = ["SR_B1", "SR_B2", "SR_B3", "SR_B4", "SR_B5", "SR_B7"]
CLASSES = ["water", "trees", "grass", "flooded_vegetation", "crops", "shrub_and_scrub", "built", "bare", "snow_and_ice"]


def bits_clear(c: Column, bits: int) -> Column:
    return c.cast("bigint").bitwiseAND(F.lit(bits)) == 0


def mask_cloud_snow(df: DataFrame, bands: Sequence[str], qa: str = "QA_PIXEL") -> DataFrame:
    return where_mask(df, bits_clear(F.col(qa), CLOUD | SHADOW | SNOW), bands)


def mask_cloud(df: DataFrame, bands: Sequence[str], qa: str = "QA_PIXEL") -> DataFrame:
    return where_mask(df, bits_clear(F.col(qa), CLOUD | SHADOW), bands)


def mask_fill(df: DataFrame, bands: Sequence[str], qa: str = "QA_PIXEL") -> DataFrame:
    return where_mask(df, bits_clear(F.col(qa), FILL), bands)


def mask_qa9(df: DataFrame, bands: Sequence[str], qa: str = "QA_RADSAT") -> DataFrame:
    return where_mask(df, bits_clear(F.col(qa), RADSAT_9), bands)


def mask_negative_sr(df: DataFrame, bands: Sequence[str], of: Sequence[str] = SR_BANDS) -> DataFrame:
    """Keeps pixels whose smallest reflectance is not negative."""
    return where_mask(df, F.least(*of) >= 0, bands)


def mask_s2_clouds(df: DataFrame, bands: Sequence[str], qa: str = "QA60", scale: float = 10000.0) -> DataFrame:
    """Clouds and cirrus, then bands to reflectance."""
    clear = bits_clear(F.col(qa), S2_CLOUD | S2_CIRRUS)
    return df.withColumns({b: F.when(clear, F.col(b) / scale) for b in bands})


def mask_s2_snow(df: DataFrame, bands: Sequence[str], scl: str = "SCL") -> DataFrame:
    return where_mask(df, F.col(scl) != SCL_SNOW, bands)


def mask_s2_vegetation(df: DataFrame, bands: Sequence[str], scl: str = "SCL") -> DataFrame:
    return where_mask(df, F.col(scl) == SCL_VEGETATION, bands)


def mask_s2_water(df: DataFrame, bands: Sequence[str], scl: str = "SCL") -> DataFrame:
    return where_mask(df, F.col(scl) != SCL_WATER, bands)


def mask_by_aligned(df: DataFrame, raster: DataFrame, keep: Column, bands: Sequence[str]) -> DataFrame:
    """Masks by a predicate on an aligned raster, joined on the cell; cells it lacks are masked."""
    own = df.columns
    return where_mask(df.join(raster, CELL, "left"), keep, bands).select(*own)


def mask_by_forest_age(df: DataFrame, age: DataFrame, bands: Sequence[str], above: float = 60) -> DataFrame:
    return mask_by_aligned(df, age.select(*CELL, F.col("age").alias("_age")), F.col("_age") > above, bands)


def mask_by_landcover(df: DataFrame, landcover: DataFrame, bands: Sequence[str], year: int = 2019, cls: int = 210, band: str = "b1") -> DataFrame:
    chosen = landcover.where(F.col("year") == year).select(*CELL, F.col(band).alias("_cls"))
    return mask_by_aligned(df, chosen, F.col("_cls") == cls, bands)


def leading_class(probs: DataFrame, keys: Sequence[str], classes: Sequence[str] = CLASSES) -> DataFrame:
    """Mean of each class over the rows of a key, and the index of the largest mean."""
    means = probs.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in classes])
    return means.withColumn("label", argmax([F.col(c) for c in classes]))


def mask_dynamic_world(df: DataFrame, probs: DataFrame, bands: Sequence[str], months: tuple[int, int] = (6, 9), wanted: int = 1, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Keeps cells whose leading class over the season of the image's year is the wanted one.

    ``df`` has year, col, row; ``probs`` has time_start, col, row and a column per class. One aggregation over the
    season's rows, then a join on (year, col, row).
    """
    season = probs.where(F.month("time_start").between(*months)).withColumn("year", F.year("time_start"))
    label = leading_class(season, ["year", *CELL], classes).select("year", *CELL, F.col("label").alias("_label"))
    own = df.columns
    return where_mask(df.join(label, ["year", *CELL], "left"), F.col("_label") == wanted, bands).select(*own)
