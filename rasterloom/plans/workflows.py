"""Whole workflows composed of the operators; each is one lazy plan over all windows and images at once."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.functions import crs, masks, scaling
from rasterloom.functions.expr import at_least
from rasterloom.functions.indices import LANDSAT, SENTINEL2, add_indices
from rasterloom.model import CELL, Grid, densify
from rasterloom.operators import bands as b
from rasterloom.operators import focal as f
from rasterloom.operators import scenes as s
from rasterloom.operators.bands import suffixed
from rasterloom.operators.composite import composite, median_composite
from rasterloom.operators.resample import reduce_resolution
from rasterloom.operators.zonal import clip, dilated, reduce_by_sums, sample_regions


def landsat_series(scenes: DataFrame, pixels: DataFrame, windows: DataFrame, indices: Sequence[str], statistic: str = "mean", grid: Grid | None = None, fill_gaps: bool = True, aoi: DataFrame | None = None, intercept_scale: float = 10000.0) -> DataFrame:
    """start_date, col, row, reflectance bands, indices, year, month.

    Windows, sensor priority, cloud mask, harmonisation of the newer sensors, scaling, negative mask, indices,
    composite, gap fill (needs a grid), clip.
    """
    use = s.sensor_priority(s.join_windows(scenes, windows)).select("image_id", "start_date", "sensor")
    x = pixels.join(use, "image_id")
    own = masks.SR_BANDS
    x = masks.mask_cloud_snow(x, [*own, "SR_B6"])
    x = scaling.harmonize_where(x, F.col("sensor").isin(*s.NEW), intercept_scale=intercept_scale)
    x = scaling.scale_reflectance(x.select("start_date", *CELL, *own), own)
    x = add_indices(masks.mask_negative_sr(x, own), LANDSAT, indices)
    out = composite(x, [*own, *indices], statistic)
    if fill_gaps and grid is not None:
        out = f.gaussian_fill(densify(out, grid, ["start_date"]), [*own, *indices], ["start_date"])
    out = s.with_series_columns(out)
    return clip(out, aoi) if aoi is not None else out


def sentinel_series(scenes: DataFrame, pixels: DataFrame, windows: DataFrame, indices: Sequence[str], cloud_below: float = 20, aoi: DataFrame | None = None, earliest: date | None = date(2019, 6, 1)) -> DataFrame:
    """start_date, col, row, reflectance bands and indices (medians of the index, not indices of the median).

    Windows that begin before the archive is complete (``earliest``) are moved there.
    """
    windows = s.floor_windows(windows, earliest) if earliest else windows
    raw = [c for c in SENTINEL2.roles.values() if c in pixels.columns]
    use = s.join_windows(s.filter_property(scenes, F.col("cloud_pct") < cloud_below), windows).select("image_id", "start_date")
    x = masks.mask_s2_clouds(pixels.join(use, "image_id"), raw)
    x = add_indices(x, SENTINEL2, indices)
    out = s.with_series_columns(median_composite(x, [*raw, *[i for i in indices if i in x.columns]]))
    return clip(out, aoi) if aoi is not None else out


def polygon_summary(series: DataFrame, spans: DataFrame, bands: Sequence[str]) -> DataFrame:
    """Means of a series per polygon and window, from running sums along rows."""
    return suffixed(reduce_by_sums(series, spans, bands, "mean", ["start_date"]), "_mean", ["feature_id", "start_date"])


def annual_classes(rows: DataFrame, start: date, end: date, band: str, name: str, aoi: DataFrame | None = None) -> DataFrame:
    """Yearly class rasters of a period: the band renamed, with start and end of the year."""
    y = F.col("year")
    out = rows.where((F.make_date(y, F.lit(1), F.lit(1)) >= F.lit(start)) & (F.make_date(y, F.lit(1), F.lit(1)) < F.lit(end)))
    out = out.select("year", *CELL, F.col(band).alias(name), F.make_date(y, F.lit(1), F.lit(1)).alias("start_date"), F.make_date(y + 1, F.lit(1), F.lit(1)).alias("end_date"))
    return clip(out, aoi) if aoi is not None else out


def land_cover_series(rows: DataFrame, start: date, end: date, aoi: DataFrame | None = None) -> DataFrame:
    return annual_classes(rows, start, end, "b1", "forest_lc_class", aoi)


def species_series(rows: DataFrame, start: date, end: date, aoi: DataFrame | None = None) -> DataFrame:
    return annual_classes(rows, start, end, "species", "forest_species_class", aoi)


#: Whether a terrain index reads elevations beyond the area that it is wanted for.
PADDED = {"tpi": True, "dev": False, "tri": False}


def terrain_in_area(dem: DataFrame, kind: str, radii: Sequence[int], area: DataFrame, grid: Grid, z: str = "elevation", pad: bool | None = None, key: str = "feature_id") -> DataFrame:
    """tpi, dev or tri of the cells in an area (spans), at radii in cells (tri looks one cell around).

    Padded, the windows of cells at the border are whole: elevations within the largest radius of the area are read and
    the result is clipped. Without padding the elevations are clipped first and windows at the border are partial. By
    default tpi is padded and dev and tri are not.
    """
    reach = max(radii, default=1) if kind != "tri" else math.sqrt(2)
    wide = PADDED[kind] if pad is None else pad
    cells = clip(dem.select(*CELL, z), dilated(area, grid, reach * max(abs(grid.dx), abs(grid.dy)), key) if wide else area)
    made = f.tri(cells, z) if kind == "tri" else {"tpi": f.tpi, "dev": f.dev}[kind](cells, z, radii)
    return clip(made, area) if wide else made


def twi(dem: DataFrame, upslope: DataFrame, cell: float, z: str = "elevation", area: str = "upa") -> DataFrame:
    """Wetness: ln(upslope area in m2 / max(tan(slope), 0.001)); area comes in km2."""
    x = f.slope_aspect(dem, z, cell).join(upslope, CELL, "left")
    up = F.col(area) * 1e6
    tan = at_least(F.tan(F.radians("slope")), 0.001)
    return x.withColumn("twi", F.when(up > 0, F.ln(up / tan))).select(*CELL, "slope", "twi")


def hand(rows: DataFrame, band: str = "hnd", name: str = "hand", aoi: DataFrame | None = None) -> DataFrame:
    out = rows.select(*CELL, F.col(band).alias(name))
    return clip(out, aoi) if aoi is not None else out


def terrain_stack(dem: DataFrame, cell: float, z: str = "elevation", eastness: bool = False) -> DataFrame:
    x = f.slope_aspect(dem, z, cell).withColumn("northness", F.cos(F.radians("aspect")))
    x = x.withColumn("eastness", F.sin(F.radians("aspect"))) if eastness else x
    return x.select(*CELL, z, "slope", "northness", "aspect", *(["eastness"] if eastness else []))


def canopy_stack(height: DataFrame, sd: DataFrame) -> DataFrame:
    return b.add_bands(height, sd)


def tpi_to_coarse(dem: DataFrame, radius: int, fine: Grid, coarse: Grid, aoi: DataFrame | None = None, z: str = "elevation") -> DataFrame:
    """Topographic position on the fine grid (computed before the clip, so edges see their ring), averaged by area to
    the coarse one and rounded to whole numbers. A fine grid of another projection is first brought to the coarse one's,
    bilinearly and at its own cell size."""
    from rasterloom.operators.resample import aggregate_to_grid, snap_to_grid
    from rasterloom.sources.io import round_and_cast

    x = f.tpi(densify(dem, fine), z, [radius])
    x = clip(x, aoi) if aoi is not None else x
    if fine.crs != coarse.crs:
        at = lambda k: crs.transform_crs(F.lit(fine.x0 + (fine.n_cols / 2 + k) * fine.dx), F.lit(fine.y0 + fine.n_rows / 2 * fine.dy), fine.crs, coarse.crs)
        (x1, y1), (x2, y2) = at(0), at(1)
        step = dem.sparkSession.range(1).select(F.hypot(x2 - x1, y2 - y1)).first()[0]  # the cell's width in the coarse grid's units
        n = lambda k, d: round(k * abs(d) / step)
        warped = Grid(n(coarse.n_cols, coarse.dx), n(coarse.n_rows, coarse.dy), coarse.x0, coarse.y0, step, step if coarse.dy > 0 else -step, coarse.crs)
        x, fine = snap_to_grid(x, [f"tpi_{radius}"], fine, warped, "bilinear"), warped
    return round_and_cast(aggregate_to_grid(x, [f"tpi_{radius}"], fine, coarse), [f"tpi_{radius}"])


def soil_stack(soil: DataFrame, bands: Sequence[str], variables: Sequence[str], points: DataFrame | None = None, grid: Grid | None = None, keep: Sequence[str] = ("point_id",), factor: int = 4) -> dict[str, DataFrame]:
    """``points``: scaled values at points; ``coarse``: means on cells ``factor`` times as large."""
    x = scaling.scale_soil(b.select_requested(soil, bands, variables))
    out = {"coarse": reduce_resolution(x, list(bands), factor)}
    if points is not None:
        out["points"] = sample_regions(x, points, grid, keep)
    return out


def hydrosoil_image(rows: DataFrame, assets: Mapping[str, Sequence[str]], selected: Sequence[str] = (), chosen: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The images of the selected assets (all where none is) as bands of one, by asset and depth (``bands.asset_image``).

    ``assets`` names every asset's images; ``chosen`` those to keep of an asset.
    """
    wanted = [a for a in assets if not selected or a in selected]
    if not wanted:
        raise ValueError(f"none of {list(selected)} is an asset")
    parts = [b.asset_image(rows, a, assets[a], (chosen or {}).get(a)) for a in wanted]
    return parts[0] if len(parts) == 1 else b.combine_images(parts, prefix=False)


def hydrosoil_points(stack: DataFrame, points: DataFrame, grid: Grid, continuous: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Scaled values at the points of every batch, which is kept for ``io.write_batched``; not clipped."""
    return sample_regions(scaling.scale_hydrosoil(stack, continuous, categorical), points, grid, ["point_id", "batch"])


def hydrosoil_stack(stack: DataFrame, continuous: Sequence[str], categorical: Sequence[str], factor: int = 4) -> DataFrame:
    """Means of continuous and modes of categorical bands on coarser cells; either list may be empty."""
    x = scaling.scale_hydrosoil(stack, continuous, categorical)
    parts = [reduce_resolution(x, list(names), factor, how) for names, how in ((continuous, "mean"), (categorical, "mode")) if names]
    if not parts:
        raise ValueError("no bands")
    return parts[0] if len(parts) == 1 else b.add_bands(*parts)


def phenology_series(rows: DataFrame, bands: Sequence[str], radii: Mapping[str, int], grid: Grid, aoi: DataFrame | None = None) -> DataFrame:
    """Yearly phenology, scaled, with focal means per label (radius in cells; 0 only renames)."""
    x = scaling.scale_modis_phenology(rows)
    dense = densify(clip(x, aoi) if aoi is not None else x, grid, ["year"])
    out = None
    for label, r in radii.items():
        part = f.focal_stats(dense, list(bands), f.Kernel(r), label, ["year"], keep=())
        out = part if out is None else out.join(part, ["year", *CELL])
    return out
