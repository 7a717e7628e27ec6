"""Operators meant for large inputs: results against brute force, and what their plans read, shuffle and open."""

import datetime
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import crs
from rasterloom.model import CELL, Grid
from rasterloom.operators import composite as cp
from rasterloom.operators import interpolate, qa, resample
from rasterloom.operators import scenes as sc
from rasterloom.operators import zonal as zo
from rasterloom.sources import aligned, io, tiles


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved(spark, points, source, target):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in points], "x double, y double")
    lon, lat = crs.transform_crs(F.col("x"), F.col("y"), source, "EPSG:4326")
    df = df.select(lon.alias("a"), lat.alias("b"))
    x, y = crs.transform_crs(F.col("a"), F.col("b"), "EPSG:4326", target)
    return [(r[0], r[1]) for r in df.select(x, y).collect()]


def off_segments(p, ring):
    """Distance of a point from a closed line."""
    best = math.inf
    for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
        d = (bx - ax) ** 2 + (by - ay) ** 2
        t = 0 if d == 0 else max(0, min(1, ((p[0] - ax) * (bx - ax) + (p[1] - ay) * (by - ay)) / d))
        best = min(best, math.hypot(p[0] - ax - t * (bx - ax), p[1] - ay - t * (by - ay)))
    return best


@pytest.mark.parametrize(("source", "target", "ring", "tolerance"), [
    ("EPSG:4326", "EPSG:3978", [(-120, 49), (-110, 49), (-110, 58), (-121, 60)], 25.0),
    ("EPSG:3978", "EPSG:3400", [(-1_900_000, 200_000), (-1_000_000, 100_000), (-1_200_000, 1_300_000)], 5.0),
    ("EPSG:3400", "EPSG:4326", [(200_000, 5_500_000), (800_000, 5_500_000), (500_000, 6_600_000)], 1e-4),
])
def test_reprojected_edges_keep_to_their_images(spark, source, target, ring, tolerance):
    f = io.features_from_rows(spark, [(1, [ring, [(x * 0.99 + ring[0][0] * 0.01, y * 0.99 + ring[0][1] * 0.01) for x, y in ring]]), (2, [])]).withColumn("_n", F.lit("kept"))
    got = {r.feature_id: r for r in zo.reprojected(f, source, target, tolerance).collect()}
    assert got[2].rings == [] and got[1]._n == "kept" and got[1].geom_type == "Polygon"
    made = [(p.x, p.y) for p in got[1].rings[0]]
    assert 8 < len(made) < 3000
    dense = [(a[0] + (b[0] - a[0]) * t / 97, a[1] + (b[1] - a[1]) * t / 97) for a, b in zip(ring, [*ring[1:], ring[0]]) for t in range(97)]
    far = [off_segments(p, made) for p in moved(spark, dense, source, target)]
    assert max(far) <= tolerance
    few = moved(spark, ring, source, target)
    assert max(off_segments(p, few) for p in made) > 20 * tolerance  # without cuts it would be far off


def test_same_projection_is_left_alone(spark):
    f = io.features_from_rows(spark, [(1, [[(0, 0), (1, 0), (1, 1)]])])
    assert zo.reprojected(f, "EPSG:3400", "EPSG:3400").collect() == f.collect()


def test_cells_of_reprojected_areas_are_those_inside_the_curved_edges(spark):
    boxes = [(-120, 49, -112.5, 53), (-117.75, 52, -114, 54.5)]
    f = io.features_from_rows(spark, [(i, [[(a, b), (c, b), (c, d), (a, d)]]) for i, (a, b, c, d) in enumerate(boxes)])
    grid = Grid(40, 12000, -1_900_000.0, 1_100_000.0, 30_000.0, -100.0, "EPSG:3978")
    lon, lat = crs.transform_crs(grid.x_of(F.col("col")), grid.y_of(F.col("row")), grid.crs, "EPSG:4326")
    cells = grid.cells(spark).select(*CELL, lon.alias("lon"), lat.alias("lat")).toArrow()
    lon, lat, col, row = (cells.column(c).to_numpy() for c in ("lon", "lat", *CELL))
    want = {(i, int(x), int(y)) for i, (a, b, c, d) in enumerate(boxes) for x, y in zip(*(v[(lon > a) & (lon < c) & (lat > b) & (lat < d)] for v in (col, row)))}
    drawn = lambda spans: {(r.feature_id, r.col, r.row) for r in zo.span_cells(spans).collect()}
    assert drawn(zo.reprojected_spans(f, "EPSG:4326", grid)) == want
    assert drawn(zo.polygon_spans(zo.reprojected(f, "EPSG:4326", grid.crs, 50.0), grid)) != want


@pytest.fixture(scope="module")
def tiled(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tiles"))
    cells = spark.range(60 * 40).select((F.col("id") % 60).cast("int").alias("col"), F.floor(F.col("id") / 60).cast("int").alias("row"), F.col("id").alias("b1"))
    cells.withColumn("t", F.floor(F.col("row") / 10) * 10 + F.floor(F.col("col") / 20)).repartition("t").write.partitionBy("t").parquet(path := path + "/t")
    index = tiles.index_tiles(spark, path).collect()
    assert len(index) == 12 and sum(r.cells for r in index) == 2400
    return path, index


def opened(path, index, *filters):
    reader = tiles.TileReader(path, None, 250)
    left = list(reader.pushFilters(list(filters)))
    return [n for p in reader.partitions() for n in p.value], left, len(reader.partitions())


def test_tiles_that_cannot_match_are_not_opened(spark, tiled):
    path, index = tiled
    everything, _, parts = opened(path, index)
    assert len(everything) == 12 and parts == 12
    names, left, _ = opened(path, index, tiles.GreaterThanOrEqual(("row",), 12), tiles.LessThan(("row",), 18), tiles.EqualTo(("col",), 5))
    assert len(names) == 1 and names[0].startswith("t=10/") and len(left) == 3
    names, left, _ = opened(path, index, tiles.StringStartsWith(("tile",), "t=2"), tiles.In(("col",), (1, 39)))
    assert {n.split("/")[0] for n in names} == {"t=20", "t=21"} and len(left) == 1
    assert opened(path, index, tiles.GreaterThan(("row",), 100))[0] == []
    df = tiles.open_tiles(spark, path)
    assert df.count() == 2400 and df.where("row between 12 and 17 and col = 5").count() == 6
    broken = [r.tile for r in index if r.tile.startswith("t=31/")]
    with open(f"{path}/{broken[0]}", "wb") as f:
        f.write(b"not a tile")
    assert df.where("row < 30").agg(F.sum("b1")).first()[0] == sum(range(1800))  # the broken tile is not opened
    assert df.where(~F.col("tile").startswith("t=31/")).where("col < 20").count() == 800
    with pytest.raises(Exception, match="tile|Parquet|magic"):
        df.where("row >= 30").count()


def test_aligned_tables_join_without_an_exchange(spark, tmp_path):
    cells = spark.range(3000).select((F.col("id") % 60).cast("int").alias("col"), F.floor(F.col("id") / 60).cast("int").alias("row"))
    for name, factor in (("a", 2), ("b", 3), ("c", 5)):
        aligned.write_aligned(cells.withColumn(name, F.col("col") * factor + F.col("row")), f"aligned_test_{name}", f"{tmp_path}/{name}", 4, 16, mode="overwrite")
    a, b, c = (aligned.read_aligned(spark, f"aligned_test_{n}") for n in "abc")
    joined = aligned.join_aligned(a, b, c)
    assert "Exchange" not in plan(joined) and plan(joined).count("SortMergeJoin") == 2
    assert joined.where("a = col * 2 + row and b = col * 3 + row and c = col * 5 + row").count() == 3000
    masked = aligned.mask_aligned(a, b.where("row > 3"), F.col("b") > 40, ["a"])
    assert "Exchange" not in plan(masked)
    assert masked.where("a is not null").count() == cells.where("row > 3 and col * 3 + row > 40").count() and masked.count() == 3000
    assert "Exchange" not in plan(aligned.join_aligned(a, b, how="left").groupBy("block").agg(F.sum("a")))
    assert aligned.read_aligned(spark, "aligned_test_a", (3, 9, 2, 4)).count() == 21
    for n in "abc":
        spark.sql(f"DROP TABLE aligned_test_{n}")


def overlapping(spark, n, side, extent, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x, y, s = rng.uniform(-5, extent - 5), rng.uniform(-5, extent - 5), rng.uniform(side / 2, side)
        rows.append((i, [[(x, y), (x + s, y + s / 3), (x + s / 2, y + s)]]))
    return io.features_from_rows(spark, rows)


def test_running_sums_against_joined_pixels(spark):
    grid = Grid(80, 60)
    pixels = grid.cells(spark).crossJoin(spark.range(3).select(F.col("id").alias("image_id"))).where("(col * 7 + row * 3 + image_id) % 11 <> 0 and row <> 17")
    pixels = pixels.withColumn("a", F.when((F.col("col") + F.col("row")) % 5 != 0, F.col("col") * 1.5 + F.col("row") + F.col("image_id"))).withColumn("b", F.lit(None).cast("double"))
    spans = zo.polygon_spans(overlapping(spark, 60, 40, 80), grid)
    for name in ("mean", "sum", "count"):
        want = zo.collection_to_features(pixels, pixels, spans, ["a", "b"], name).collect()
        got = {(r.feature_id, r.image_id): (r.a, r.b) for r in zo.reduce_by_sums(pixels, spans, ["a", "b"], name, ["image_id"]).collect()}
        assert len(got) == len(want) > 100
        for r in want:
            a, b = got[r.feature_id, r.image_id]
            assert a == pytest.approx(r[f"a_{name}"], rel=1e-12) and b == r[f"b_{name}"]
    with pytest.raises(ValueError):
        zo.reduce_by_sums(pixels, spans, ["a"], "median")


def test_a_hundred_times_the_polygons_cost_less_than_twice(spark):
    grid = Grid(2000, 1000)
    pixels = grid.cells(spark).withColumn("a", (F.col("col") * 31 + F.col("row")) % 97 * 1.0).cache()
    pixels.count()

    def took(n):
        spans = zo.polygon_spans(overlapping(spark, n, 200, 1000), grid).cache()
        spans.count()
        began = time.time()
        zo.reduce_by_sums(pixels, spans, ["a"]).write.format("noop").mode("overwrite").save()
        return time.time() - began

    took(10)
    few = min(took(10), took(10))
    assert min(took(1000), took(1000)) < 2 * few
    pixels.unpersist()


def test_sketch_rank_error_and_merging(spark):
    df = spark.range(300_000).select((F.col("id") % 3).alias("raster"), F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"), F.pmod(F.col("id"), F.lit(50)).alias("day"))
    parts = cp.sketches(df, ["v"], ["raster", "day"])
    merged = cp.merged_sketches(parts, ["v"], ["raster"])
    got = merged.select("raster", *[cp.quantile_of("v", q).alias(f"q{i}") for i, q in enumerate((0.02, 0.5, 0.98))]).collect()
    values = {r.raster: np.sort(np.array(r.v)) for r in df.groupBy("raster").agg(F.collect_list("v").alias("v")).collect()}
    for r in got:
        for i, q in enumerate((0.02, 0.5, 0.98)):
            assert abs(np.searchsorted(values[r.raster], r[f"q{i}"]) / 100_000 - q) < 0.0025
    s = qa.stretch_of_sketches(df, "v").collect()
    assert len(s) == 3 and all(15_000 < r.low < 25_000 and 975_000 < r.high < 985_000 for r in s)
    nothing = cp.sketches(df.withColumn("v", F.lit(None).cast("double")), ["v"], ["raster"]).select(cp.quantile_of("v", 0.5).alias("q")).collect()
    assert [r.q for r in nothing] == [None] * 3


def test_streaming_median_from_sketches(spark, tmp_path):
    schema = "start_date date, col int, row int, b double"
    day = datetime.date(2000, 6, 1)
    for k in range(3):
        spark.createDataFrame([(day, c, 0, float(c + 10 * k)) for c in range(4) for _ in range(k + 1)], schema).write.parquet(f"{tmp_path}/in/{k}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    made = cp.sketches(stream, ["b"], ["start_date", *CELL]).select("start_date", *CELL, cp.quantile_of("b", 0.5).alias("b"))
    q = made.writeStream.format("memory").queryName("medians").outputMode("complete").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.col: r.b for r in spark.table("medians").collect()}
    assert got == {c: c + 10.0 for c in range(4)}  # of c, c + 10 twice and c + 20 thrice the third


def test_distance_transform_against_all_cells(spark, monkeypatch):
    monkeypatch.setattr(zo, "TILE", 16)
    grid = Grid(70, 45, 0, 0, 10.0, -25.0)
    spans = spark.createDataFrame([("a", 3, 2, 5), ("a", 3, 4, 9), ("a", 44, 69, 69), ("b", 20, 0, 69), ("b", 21, 30, 31), ("c", 0, 0, 0)], "feature_id string, row int, col_lo int, col_hi int")
    radius = 180.0
    got = {(r.feature_id, r.col, r.row): r.distance for r in zo.distance_transform(spans, grid, radius).collect()}
    covered = {}
    for r in spans.collect():
        covered.setdefault(r.feature_id, []).extend((c, r.row) for c in range(r.col_lo, r.col_hi + 1))
    want = {}
    for f, cells in covered.items():
        at = np.array(cells)
        for c in range(70):
            for r in range(45):
                d = np.hypot((at[:, 0] - c) * 10.0, (at[:, 1] - r) * 25.0).min()
                if d <= radius:
                    want[f, c, r] = d
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())
    buffered = zo.dilated(spans, grid, radius)
    cells = [(r.feature_id, r.col, r.row) for r in zo.span_cells(buffered).collect()]
    assert len(cells) == len(set(cells)) and set(cells) == want.keys()
    assert zo.dilated(spans.limit(0), grid, radius).count() == 0


def scans(text):
    return text.count("FileScan") + text.count("BatchScan")


def test_interpolation_reads_the_raster_once(spark, tmp_path):
    Grid(40, 30).cells(spark).select(*CELL, F.when((F.col("col") + F.col("row")) % 3 != 0, F.col("col") * 1.0).alias("a"), F.when(F.col("col") % 4 != 0, F.col("row") * 2.0).alias("b")).write.parquet(f"{tmp_path}/r")
    df = spark.read.parquet(f"{tmp_path}/r")
    out = interpolate.idw(df, ["a", "b"], 5, n=50, statistics=True)
    text = plan(out)
    assert scans(text) == 1 and "Exchange hashpartitioning(col" not in text
    rows = out.collect()
    assert len(rows) == 1200 and len({(r.a_mean, r.a_stdDev, r.b_mean, r.b_stdDev) for r in rows}) == 1
    s = cp.sample(df.where("a is not null").select(*CELL, "a"), 50).agg(F.avg("a"), F.stddev_pop("a")).first()
    assert (rows[0].a_mean, rows[0].a_stdDev) == (pytest.approx(s[0]), pytest.approx(s[1]))


def shuffled(df):
    """Bytes that the finished plan wrote to shuffles."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        m = node.metrics()
        if name == "Exchange" and m.contains("shuffleBytesWritten"):
            total += m.apply("shuffleBytesWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_separable_resampling_shuffles_little(spark):
    source, target = Grid(300, 200, 0, 0, 1.0, 1.0), Grid(280, 190, 3.3, 2.7, 1.0, 1.0)
    df = source.cells(spark).withColumn("z", F.sqrt(F.col("col") * 7.0 + F.col("row")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for rasters that are too large for it
    try:
        nearest = shuffled(resample.snap_to_grid(df, ["z"], source, target))
        for method in ("bilinear", "bicubic"):
            assert 0 < shuffled(resample.snap_to_grid(df, ["z"], source, target, method)) < 3 * nearest
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("method", ["bilinear", "bicubic"])
@pytest.mark.parametrize("target", [Grid(9, 7, 1.25, 2.5, 1.5, 1.25), Grid(30, 25, 0, 0, 0.5, 0.5), Grid(12, 9, 3, 12, 1, -1)])
def test_separable_resampling_against_neighbours(spark, method, target):
    source = Grid(14, 12)
    df = source.cells(spark).where("not (col = 6 and row = 5)").withColumn("z", F.when((F.col("col") != 2) | (F.col("row") != 9), F.col("col") * F.col("col") * 0.7 + F.col("row") * 1.3))
    z = {(r.col, r.row): r.z for r in df.collect()}

    def weight(d):
        d = abs(d)
        if method == "bilinear":
            return max(0, 1 - d)
        return 1.5 * d**3 - 2.5 * d**2 + 1 if d <= 1 else -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2 if d < 2 else 0

    got = {(r.col, r.row): r.z for r in resample.snap_to_grid(df, ["z"], source, target, method).collect()}
    assert len(got) == target.n_cols * target.n_rows
    reach, some = {"bilinear": (0, 1), "bicubic": (-1, 0, 1, 2)}[method], 0
    for (c, r), v in got.items():
        u, w = target.x0 + (c + 0.5) * target.dx - 0.5, target.y0 + (r + 0.5) * target.dy - 0.5
        near = [(weight(u - math.floor(u) - i) * weight(w - math.floor(w) - j), z.get((math.floor(u) + i, math.floor(w) + j))) for i in reach for j in reach]
        near = [(k, x) for k, x in near if abs(k) > 1e-12]
        want = None if any(x is None for _, x in near) else sum(k * x for k, x in near) / sum(k for k, _ in near)
        some += want is not None
        assert v == (None if want is None else pytest.approx(want))
    assert some > 10


def test_many_windows_meet_scenes_by_stretches(spark):
    scenes = spark.range(500).select("id", F.timestamp_seconds(F.lit(900_000_000) + F.col("id") * 86_400 * 3 + F.col("id") * 977).alias("time_start"))
    starts = spark.range(2000).select(F.date_add(F.lit("1998-01-01").cast("date"), F.col("id").cast("int")).alias("start_date"))
    windows = sc.windows_from(starts, 16).union(sc.windows_from(starts.limit(3), 700)).union(sc.windows_from(starts.limit(2), 0))
    many, all_of = sc.join_windows(scenes, windows), sc.join_windows(scenes, windows, few=10**9)
    assert "NestedLoop" not in plan(many) and "NestedLoop" in plan(all_of)
    assert sorted(map(tuple, many.collect())) == sorted(map(tuple, all_of.collect())) and many.count() > 5000


def test_dates_in_text(spark):
    rows = [("LC08_19990704_T1", datetime.date(1999, 7, 4)), ("a/2001-02-28.tif", datetime.date(2001, 2, 28)), ("2001-02-30", None), ("none", None), (None, None), ("id 120010228 9", None), ("x 2003/01/09", datetime.date(2003, 1, 9))]
    df = spark.createDataFrame([(t,) for t, _ in rows], "t string")
    assert [r.d for r in sc.parsed_dates(df, "t", "d").collect()] == [d for _, d in rows]


def test_points_only_inside_the_area(spark):
    grid = Grid(10, 10)
    pixels = grid.cells(spark).withColumn("z", F.col("col") * 10.0 + F.col("row"))
    points = spark.createDataFrame([(1, 2.5, 2.5), (2, 7.5, 7.5), (3, -1.0, 2.0)], "point_id int, x double, y double")
    aoi = spark.createDataFrame([(0, 2, 0, 4)], "feature_id int, row int, col_lo int, col_hi int")
    assert [tuple(r) for r in zo.image_to_points(pixels, points, grid, ["z"], aoi=aoi).collect()] == [(1, 2.5, 2.5, 22.0)]


def test_range_of_a_region_only(spark):
    df = Grid(4, 1).cells(spark).withColumn("z", F.col("col") * 2.0)
    got = {r.col: r.z for r in cp.normalize_image(df, ["z"], df.where("col in (1, 2)")).collect()}
    assert got == {0: -1.0, 1: 0.0, 2: 1.0, 3: 2.0}


def test_approximate_quantiles_are_near(spark):
    df = spark.range(5000).select(F.lit(1).alias("raster"), F.lit(datetime.date(2000, 1, 1)).alias("start_date"), F.lit(0).alias("col"), F.lit(0).alias("row"), F.col("id").cast("double").alias("v"))
    assert abs(cp.median_composite(df, ["v"], approximate=True).first().v - 2499.5) <= 1
    s = qa.stretch(df, "v", approximate=True).first()
    assert abs(s.low - 100) <= 2 and abs(s.high - 4900) <= 2


def rows_by(df, *by):
    return [r["count"] for r in df.groupBy(*by).count().collect()]


def test_a_task_holds_few_rows_of_large_tables(spark, tmp_path, monkeypatch, sf_dir):
    """Buckets, folders of a collection and dense cells are dealt by rows, whatever their bytes and the input's splits."""
    from rasterloom import model
    from rasterloom.plans import queries
    from rasterloom.plans.fixtures import Fixture

    monkeypatch.setattr(aligned, "ROWS", 500)
    fx = Fixture(spark, sf_dir)
    pixels = queries._aligned(fx, pixels=fx.pixels_ls().select("image_id", *CELL), age=fx.forest_age())[0]
    held = rows_by(pixels, F.input_file_name())
    assert sum(held) == fx.pixels_ls().count() and len(held) > 4
    assert [aligned.buckets_for(n) for n in (0, 2000, 2001, 500_000)] == [4, 4, 5, 1000]

    monkeypatch.setattr(io, "ROWS", 500)
    monkeypatch.setattr(io, "STRIPE", 4)
    made = Grid(5, 200).cells(spark).coalesce(1).withColumn("year", F.explode(F.array(F.lit(1996), F.lit(1997)))).withColumn("collection", F.lit("x"))
    io.write_collection(made, f"{tmp_path}/c", 2000)
    back = io.read_collection(spark, f"{tmp_path}/c", "x", [1997])
    assert sorted(back.select(*CELL).collect()) == sorted(made.where("year = 1997").select(*CELL).collect())
    assert max(rows_by(spark.read.parquet(f"{tmp_path}/c"), F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1))) < 1200

    monkeypatch.setattr(model, "CELLS_A_TASK", 100)
    some = made.where("(col + row) % 3 = 0").select("year", *CELL, (F.col("col") * 2).alias("b"))
    dense = model.densify(some, Grid(5, 200), ["year"])
    assert max(rows_by(dense, F.spark_partition_id())) < 600
    assert sorted(dense.select("year", *CELL, "b").collect(), key=str) == sorted(made.select("year", *CELL, F.when((F.col("col") + F.col("row")) % 3 == 0, F.col("col") * 2).alias("b")).collect(), key=str)


def test_samples_are_drawn_without_sorting_the_raster(spark):
    cells = Grid(300, 200).cells(spark).repartition(3).select(*CELL, F.when(F.col("col") % 3 != 0, F.col("row") * 1.0).alias("a.b"), (F.col("col") + F.col("row")).alias("c"))
    drawn = interpolate.band_samples(cells, ["a.b", "c"], 25, 4)
    assert "WindowGroupLimit" not in plan(drawn).split("MapInArrow")[-1]
    got = {b: {(r.col, r.row, r.value) for r in drawn.collect() if r.band == b} for b in ("a.b", "c")}
    for b in got:
        assert got[b] == {(r[0], r[1], float(r[2])) for r in cp.sample(cells.where(f"`{b}` is not null").select(*CELL, f"`{b}`"), 25, 4).collect()}
    assert interpolate.band_samples(cells, ["c"], 0).count() == 0
