"""Hand-made grids for what the tables don't show: holes, missing bands, flat and fully masked images, exact halves."""

import math

import pytest
from pyspark.sql import functions as F

from rasterloom.functions import crs, expr, masks, scaling
from rasterloom.functions import indices as ix
from rasterloom.model import Grid, densify
from rasterloom.operators import bands, composite, focal, interpolate, qa, resample, scenes, zonal
from rasterloom.plans import workflows
from rasterloom.sources import io


def grid_of(spark, values, name="z"):
    cells = [(c, r, v) for r, line in enumerate(values) for c, v in enumerate(line)]
    return spark.createDataFrame(cells, f"col int, row int, {name} double")


def as_grid(df, name, n_cols, n_rows):
    found = {(r.col, r.row): r[name] for r in df.select("col", "row", name).collect()}
    return [[found.get((c, r)) for c in range(n_cols)] for r in range(n_rows)]


def test_masked_in_masked_out(spark):
    df = spark.createDataFrame([(1, None, 8), (2, 5.0, 8), (3, 5.0, 0), (4, 5.0, None)], "id int, b double, QA_PIXEL int")
    assert [r.b for r in masks.mask_cloud(df, ["b"]).orderBy("id").collect()] == [None, None, 5.0, None]
    out = df.select(expr.clamp(F.col("b"), 0.0, 3.0).alias("x"), expr.at_least(F.col("b"), 7.0).alias("y")).collect()
    assert [(r.x, r.y) for r in out] == [(None, None), (3.0, 7.0), (3.0, 7.0), (3.0, 7.0)]


def test_index_of_a_missing_band_is_left_out_and_unknown_is_an_error(spark):
    df = spark.createDataFrame([(0.1, 0.2, 0.3)], "B4 double, B8 double, B7 double")
    assert ix.add_indices(df, ix.SENTINEL2, ["NDVI", "NDRE3"]).columns == ["B4", "B8", "B7", "NDVI"]
    with pytest.raises(ValueError, match="NDMI"):
        ix.add_indices(df, ix.SENTINEL2, ["NDMI"])


def test_zero_divisor_masks(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "SR_B4 double, SR_B3 double")
    assert ix.add_indices(df, ix.LANDSAT, ["NDVI"]).first().NDVI is None


def test_flat_forest_range_is_null(spark):
    df = spark.createDataFrame([(1, 2019, 0, 0, 0.4), (1, 2019, 1, 0, 0.4)], "image_id int, year int, col int, row int, DRS double")
    lc = spark.createDataFrame([(2019, 0, 0, 210), (2019, 1, 0, 210)], "year int, col int, row int, b1 int")
    assert [r.NDRS_coni for r in ix.add_ndrs(df, lc, [210]).collect()] == [None, None]


def test_polygon_with_hole(spark):
    f = io.features_from_rows(spark, [(1, [[(0, 0), (5, 0), (5, 5), (0, 5)], [(1, 1), (4, 1), (4, 4), (1, 4)]])])
    cells = {(r.col, r.row) for r in zonal.span_cells(zonal.polygon_spans(f, Grid(5, 5))).collect()}
    assert cells == {(c, r) for c in range(5) for r in range(5)} - {(c, r) for c in (1, 2, 3) for r in (1, 2, 3)}


def test_spans_longer_than_a_stretch(spark):
    f = io.features_from_rows(spark, [(1, [[(10, 0), (900, 0), (900, 1), (10, 1)]])])
    g = Grid(1000, 1)
    hit = zonal.clip(g.cells(spark).withColumn("z", F.col("col") * 1.0), zonal.polygon_spans(f, g)).agg(F.count("*"), F.min("col"), F.max("col")).first()
    assert tuple(hit) == (890, 10, 899)


@pytest.mark.parametrize("tiled", [False, True])
def test_focal_mean_of_a_constant_is_the_constant(spark, tiled):
    df = grid_of(spark, [[7.0] * 6] * 5)
    out = focal.focal(df, ["z"], focal.Kernel(2), ("mean", "stdDev", "count"), tiled=tiled)
    assert {(round(r.z_mean, 9), round(r.z_stdDev, 9)) for r in out.collect()} == {(7.0, 0.0)}


def test_wide_windows_across_tiles_agree_with_brute_force(spark, monkeypatch):
    monkeypatch.setattr(focal, "SIDE", 24)
    values = [[None if (c * 5 + r * 3) % 7 == 0 else float((c * 13 + r * 7) % 19) for c in range(70)] for r in range(60)]
    df = grid_of(spark, values).where("not (col = 30 and row = 30)")  # a missing row
    got = {(x.col, x.row): (x.z_sum, x.z_count) for x in focal.focal(df, ["z"], focal.Kernel(20), ("sum", "count")).collect()}
    assert len(got) == 70 * 60 - 1
    for c, r in [(0, 0), (24, 24), (23, 47), (69, 59), (35, 30), (48, 1)]:
        near = [values[j][i] for i in range(70) for j in range(60) if (i - c) ** 2 + (j - r) ** 2 <= 400 and (i, j) != (30, 30) and values[j][i] is not None]
        assert got[c, r][1] == len(near) and abs(got[c, r][0] - sum(near)) < 1e-6


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 7])
def test_focal_ways_agree_with_brute_force(spark, radius):
    values = [[None if (c * 5 + r * 3) % 7 == 0 else float((c * 13 + r * 7) % 19) for c in range(9)] for r in range(8)]
    df = grid_of(spark, values)
    for tiled in (False, True):
        got = {(x.col, x.row): (x.z_sum, x.z_count) for x in focal.focal(df, ["z"], focal.Kernel(radius), ("sum", "count"), tiled=tiled).collect()}
        for c in range(9):
            for r in range(8):
                near = [values[j][i] for i in range(9) for j in range(8) if (i - c) ** 2 + (j - r) ** 2 <= radius**2 and values[j][i] is not None]
                s, n = got[c, r]
                assert n == len(near) and (s is None if not near else math.isclose(s, sum(near), abs_tol=1e-9))


def test_all_masked_image(spark):
    df = grid_of(spark, [[None] * 3] * 3)
    out = focal.gaussian_fill(focal.focal(df, ["z"], focal.Kernel(1), ("mean",)), ["z"]).collect()
    assert all(r.z is None and r.z_mean is None for r in out)
    assert qa.pixel_stats(df.withColumn("raster", F.lit("a")), "z").count() == 0


def test_flat_terrain(spark):
    df = grid_of(spark, [[4.0] * 5] * 5, "elevation")
    assert {r.dev_2 for r in focal.dev(df, "elevation", [2]).collect()} == {0.0}
    assert {r.tri for r in focal.tri(df, "elevation").collect()} == {0.0}
    up = grid_of(spark, [[1.0] * 5] * 5, "upa")
    centre = workflows.twi(df, up, 30.0).where("col = 2 and row = 2").first()
    assert centre.slope == 0 and math.isclose(centre.twi, math.log(1e6 / 0.001))


def test_halves_round_to_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,), (40000.0,), (None,)], "v double")
    assert [r.v for r in io.round_and_cast(df, ["v"]).collect()] == [0, 2, 2, 0, 32767, None]


def test_area_mean_keeps_a_constant(spark):
    df = grid_of(spark, [[3.0] * 10] * 10)
    out = resample.aggregate_to_grid(df, ["z"], Grid(10, 10, 0, 0, 30, 30), Grid(3, 3, 0, 0, 100, 100)).collect()
    assert len(out) == 9 and all(math.isclose(r.z, 3.0) for r in out)


def test_mosaic_takes_the_last_valid_value(spark):
    df = spark.createDataFrame([(0, 0, 1, 5.0), (0, 0, 2, None), (0, 0, 0, 9.0)], "col int, row int, image_id int, z double")
    assert composite.mosaic(df, ["z"], order=["image_id"]).first().z == 5.0


def test_stacks_refuse_the_same_name(spark):
    a = grid_of(spark, [[1.0]])
    with pytest.raises(ValueError):
        bands.add_bands(a, a)
    with pytest.raises(ValueError):
        bands.combine_images([a, a], prefix=False)


def test_idw_without_samples_in_reach_is_the_mean(spark):
    df = densify(spark.createDataFrame([(0, 0, 2.0), (1, 0, 4.0)], "col int, row int, z double"), Grid(20, 1))
    got = {r.col: r.z for r in interpolate.idw(df, ["z"], 3, 2, 10).collect()}
    assert got[0] == 2.0 and got[1] == 4.0 and got[15] == 3.0


def test_samples_of_far_rows_are_drawn_by_the_same_order(spark):
    cells = [(c, r) for c in (0, 7, 49) for r in (0, 20505, 20506, 23999, 2_000_000_000)]
    df = spark.createDataFrame([(c, r, float(i)) for i, (c, r) in enumerate(cells)], "col int, row int, z double")
    for seed in (0, 9):
        place = lambda c, r: (c * 7919 + r * 104729 + seed * 611953) % 1_000_003  # noqa: B023, E731
        want = sorted(cells, key=lambda x: (place(*x), x))[:6]
        assert [(x.col, x.row) for x in composite.sample(df, 6, seed).collect()] == want
        assert sorted((x.col, x.row) for x in interpolate.band_samples(df, ["z"], 6, seed).collect()) == sorted(want)
    made = {(x.col, x.row): x.z for x in interpolate.idw(df, ["z"], 60_000, n=15).collect()}
    assert made == {x: float(i) for i, x in enumerate(cells)}


def test_projection_origin_and_known_shape(spark):
    row = spark.range(1).select(*[c.alias(n) for n, c in zip(("x", "y"), crs.transform_crs(F.lit(-115.0), F.lit(0.0), "EPSG:4326", "EPSG:3400"))]).first()
    assert math.isclose(row.x, 500000.0, abs_tol=1e-6) and math.isclose(row.y, 0.0, abs_tol=1e-6)
    row = spark.range(1).select(*[c.alias(n) for n, c in zip(("x", "y"), crs.transform_crs(F.lit(-95.0), F.lit(49.0), "EPSG:4326", "EPSG:3978"))]).first()
    assert math.isclose(row.x, 0.0, abs_tol=1e-6) and math.isclose(row.y, 0.0, abs_tol=1e-6)


def test_write_needs_a_grid_or_a_scale(spark, tmp_path):
    with pytest.raises(ValueError):
        io.write_on_grid(grid_of(spark, [[1.0]]), str(tmp_path / "x"), ["z"], Grid(1, 1), Grid(1, 1), 30.0)


def test_tiles_that_do_not_match_are_an_error(spark, tmp_path):
    grid_of(spark, [[1.0]]).write.parquet(str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        io.read_tiles(spark, str(tmp_path / "t"), "nothing")


def test_unnamed_images_are_returned(spark, tmp_path):
    bad = io.write_images(grid_of(spark, [[1.0, 2.0]]), str(tmp_path / "i"), F.when(F.col("col") == 0, F.lit("a")))
    assert [r.col for r in bad.collect()] == [1]


def test_harmonised_bands_keep_flags(spark):
    df = spark.createDataFrame([(1, 7, *range(10000, 10700, 100))], "image_id int, QA_PIXEL int, SR_B1 int, SR_B2 int, SR_B3 int, SR_B4 int, SR_B5 int, SR_B6 int, SR_B7 int")
    row = scaling.harmonize_oli_to_etm(df).first()
    assert row.QA_PIXEL == 7 and math.isclose(row.SR_B1, (10100 + 95) / 0.9785)


def test_streaming_composite_matches_batch(spark, tmp_path):
    from rasterloom.streaming.composites import streaming_composite

    rows = [(c, 0, f"2001-0{m}-0{d} 00:00:00", None if (m, c) == (2, 1) else float(m * d + c)) for m in (1, 2, 3, 4, 9) for d in (1, 5) for c in (0, 1)]
    df = spark.createDataFrame(rows, "col int, row int, t string, z double").selectExpr("col", "row", "to_timestamp(t) AS time_start", "z")
    df.where("month(time_start) < 9").coalesce(1).write.parquet(str(tmp_path / "in"))
    df.where("month(time_start) = 9").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = streaming_composite(stream, ["z"], length="60 days", late="1 day").writeStream.outputMode("append").format("memory").queryName("made").trigger(availableNow=True).start()
    q.awaitTermination(120)
    batch = df.withColumn("start_date", F.window("time_start", "60 days")["start"])
    want = composite.composite(batch.where("month(time_start) < 9"), ["z"], "mean")  # the last window is still open
    told = lambda x: sorted((str(r.start_date), r.col, r.row, r.z) for r in x.collect())
    assert told(spark.table("made")) == told(want) and want.count() >= 4


def test_transverse_mercator_against_a_series_of_another_kind(spark):
    f = 1 / 298.257222101
    n = f / (2 - f)
    e = math.sqrt(f * (2 - f))
    radius = 6378137 / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280]

    def kruger(lon, lat):
        phi, lam = math.radians(lat), math.radians(lon + 115)
        t = math.sinh(math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi)))
        xi, eta = math.atan2(t, math.cos(lam)), math.asinh(math.sin(lam) / math.hypot(t, math.cos(lam)))
        east = eta + sum(a * math.cos(2 * j * xi) * math.sinh(2 * j * eta) for j, a in enumerate(alpha, 1))
        north = xi + sum(a * math.sin(2 * j * xi) * math.cosh(2 * j * eta) for j, a in enumerate(alpha, 1))
        return 500000 + 0.9992 * radius * east, 0.9992 * radius * north

    points = [(-115.0, 54.0), (-120.0, 49.0), (-110.0, 60.0), (-112.5, 51.05), (-118.9, 56.2)]
    df = spark.createDataFrame(points, "lon double, lat double")
    x, y = crs.transform_crs(F.col("lon"), F.col("lat"), "EPSG:4326", "EPSG:3400")
    for r in df.select("lon", "lat", x.alias("x"), y.alias("y")).collect():
        a, b = kruger(r.lon, r.lat)
        assert abs(r.x - a) < 0.05 and abs(r.y - b) < 0.05  # metres


def test_template_of_another_projection(spark):
    fine = Grid(40, 40, -115.01, 54.0, 0.0005, -0.0005, "EPSG:4326")
    df = fine.cells(spark).withColumn("elevation", F.col("col") * 3.0 + F.col("row") * 3.0)  # a plane is flat everywhere
    lon, lat = crs.transform_crs(F.lit(-115.0), F.lit(53.99), "EPSG:4326", "EPSG:3400")
    mid = spark.range(1).select(lon.alias("x"), lat.alias("y")).first()
    coarse = Grid(4, 4, mid.x - 400, mid.y + 400, 200.0, -200.0, "EPSG:3400")
    out = workflows.tpi_to_coarse(df, 2, fine, coarse).collect()
    assert {(r.col, r.row) for r in out} == {(c, r) for c in range(4) for r in range(4)} and all(r.tpi_2 == 0 for r in out)


def test_dates_of_rounded_periods(spark):
    rows = [("1995-06-01", "2001-11-30"), ("1995-06-01", "2001-12-15")]
    for (a, b), last in zip(rows, ("2001-06-01", "2002-06-01")):
        got = scenes.dates_within(spark.sql(f"SELECT DATE '{a}' AS start, DATE '{b}' AS end"), 1, "year").agg(F.max("start_date")).first()[0]
        assert str(got) == last
