"""Checks of finished rasters: statistics, histograms, stretches, lattice fit, pixels outside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.model import CELL, Grid
from rasterloom.operators.composite import quantile_of, sketches
from rasterloom.operators.zonal import clip, join_spans


def pixel_stats(df: DataFrame, value: str, key: str = "raster") -> DataFrame:
    """Counts, share missing, range, mean and sample standard deviation; rasters without a valid pixel are left out."""
    v = F.col(value)
    s = df.groupBy(key).agg(
        F.count("*").alias("n_total"), F.count_if(v.isNull()).alias("n_na"), F.count(v).alias("n_valid"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("sd"),
    )
    return s.where("n_valid > 0").withColumn("pct_na", F.col("n_na") * 100.0 / F.col("n_total"))


def histogram(df: DataFrame, value: str, bins: int = 50, key: str = "raster") -> DataFrame:
    """(key, bin, n): equal bins from the smallest to the largest value, 1 to ``bins``; a flat raster is all bin 1."""
    span = df.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    place = F.floor(F.try_divide((F.col(value) - F.col("_lo")) * F.lit(bins), F.col("_hi") - F.col("_lo")))
    at = F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int") + 1
    return df.where(F.col(value).isNotNull()).join(span, key).groupBy(key, at.alias("bin")).agg(F.count("*").alias("n"))


def peak_count(hist: DataFrame, key: str = "raster") -> DataFrame:
    return hist.groupBy(key).agg(F.max("n").alias("peak"))


def stretch(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98, key: str = "raster", approximate: bool = False) -> DataFrame:
    """Limits for display: two quantiles, or the whole range where they are equal."""
    q = (lambda p: F.percentile_approx(value, p, 10_000)) if approximate else (lambda p: F.percentile(value, p))
    s = df.groupBy(key).agg(q(low).alias("_a"), q(high).alias("_b"), F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    flat = F.col("_a") == F.col("_b")
    return s.select(key, F.when(flat, F.col("_lo")).otherwise(F.col("_a")).alias("low"), F.when(flat, F.col("_hi")).otherwise(F.col("_b")).alias("high"))


def stretch_of_sketches(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98, key: str = "raster") -> DataFrame:
    """``stretch`` for rasters of any size: quantiles of a sketch of bounded size, merged from partial ones."""
    s = sketches(df, [value], [key]).join(df.groupBy(key).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi")), key)
    s = s.select(key, "_lo", "_hi", quantile_of(value, low).alias("_a"), quantile_of(value, high).alias("_b"))
    flat = F.col("_a") == F.col("_b")
    return s.select(key, F.when(flat, F.col("_lo")).otherwise(F.col("_a")).alias("low"), F.when(flat, F.col("_hi")).otherwise(F.col("_b")).alias("high"))


def grid_fit(grids: DataFrame, template: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Per raster grid against a one-row template (crs, x0, y0, dx, dy, n_cols, n_rows): same projection, resolution,
    distances of its corner from the nearest grid lines (offset_x, offset_y), whether it is on the lattice, whether it
    has the template's whole extent, and whether it stacks with the template once that is cropped to it: the same
    projection, resolution and lattice, and an extent inside the template's. The tolerance is in units of the map."""
    t = template.select(*[F.col(c).alias(f"t_{c}") for c in ("crs", "x0", "y0", "dx", "dy", "n_cols", "n_rows")])
    j = grids.crossJoin(F.broadcast(t))

    def off(c: str, d: str):
        m = F.pmod(F.col(c) - F.col(f"t_{c}"), F.abs(f"t_{d}"))
        return F.least(m, F.abs(f"t_{d}") - m)

    def ends(p: str, c: str, d: str, n: str):
        a, b = F.col(p + c), F.col(p + c) + F.col(p + d) * F.col(p + n)
        return F.least(a, b), F.greatest(a, b)

    crs = F.col("crs") == F.col("t_crs")
    res = (F.abs(F.col("dx") - F.col("t_dx")) <= tolerance) & (F.abs(F.col("dy") - F.col("t_dy")) <= tolerance)
    j = j.withColumns({"crs_equal": crs, "res_equal": res, "offset_x": off("x0", "dx"), "offset_y": off("y0", "dy")})
    lattice = crs & (F.col("offset_x") <= tolerance) & (F.col("offset_y") <= tolerance)
    inside = same = F.lit(True)
    for c, d, n in (("x0", "dx", "n_cols"), ("y0", "dy", "n_rows")):
        (lo, hi), (t_lo, t_hi) = ends("", c, d, n), ends("t_", c, d, n)
        inside = inside & (lo >= t_lo - tolerance) & (hi <= t_hi + tolerance)
        same = same & (F.abs(lo - t_lo) <= tolerance) & (F.abs(hi - t_hi) <= tolerance)
    return j.withColumns({"aligned": lattice, "same_extent": same, "stackable": res & lattice & inside}).drop(*t.columns)


def count_outside(pixels: DataFrame, value: str, aoi: DataFrame) -> DataFrame:
    """One row: valid pixels outside the area; in_boundary is 0 if there is any."""
    out = join_spans(pixels, aoi, "left_anti").agg(F.count_if(F.col(value).isNotNull()).alias("n_outside"))
    return out.withColumn("in_boundary", (F.col("n_outside") == 0).cast("int"))


def na_mask(dense: DataFrame, value: str) -> DataFrame:
    return dense.withColumn("na", F.col(value).isNull().cast("int"))


def checkerboard(spark, grid: Grid, aoi: DataFrame) -> DataFrame:
    return clip(grid.cells(spark).withColumn("value", (F.col("col") + F.col("row")) % 2), aoi).select(*CELL, "value")
