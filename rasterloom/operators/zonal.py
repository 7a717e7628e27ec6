"""Features on grids: covered cells as row spans, clips, zonal statistics and point extraction.

Spans are joined to pixels on (row, 256-cell stretch of columns), an equi-key, with a small range test behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.functions.crs import transform_crs
from rasterloom.functions.expr import ratio
from rasterloom.model import CELL, Grid
from rasterloom.operators.bands import suffixed
from rasterloom.operators.composite import reducer

STRETCH = 256


def polygon_spans(features: DataFrame, grid: Grid, key: str = "feature_id", rings: str = "rings") -> DataFrame:
    """(key, row, col_lo, col_hi) of the cells whose centre lies inside, by the even-odd rule: holes and parts work.

    Edges are cut at the row centres they cross (half-open, so a shared corner counts once); sorted crossings of a
    row pair up into spans. Cells off the grid are left out.
    """
    u = lambda p: (p["x"] - grid.x0) / grid.dx
    v = lambda p: (p["y"] - grid.y0) / grid.dy
    ring = F.explode(rings).alias("ring")
    pairs = F.transform("ring", lambda p, i: F.struct(u(p).alias("x1"), v(p).alias("y1"), u(F.element_at("ring", (i + 1) % F.size("ring") + 1)).alias("x2"), v(F.element_at("ring", (i + 1) % F.size("ring") + 1)).alias("y2")))
    e = features.select(key, ring).select(key, F.explode(pairs).alias("e")).select(key, "e.*").where("y1 <> y2")
    lo = F.greatest(F.ceil(F.least("y1", "y2") - 0.5), F.lit(0))
    hi = F.least(F.ceil(F.greatest("y1", "y2") - 0.5) - 1, F.lit(grid.n_rows - 1))
    e = e.withColumn("lo", lo).withColumn("hi", hi).where("lo <= hi").withColumn("row", F.explode(F.sequence(F.col("lo").cast("int"), F.col("hi").cast("int"))))
    xc = F.col("x1") + (F.col("row") + 0.5 - F.col("y1")) / (F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    rows = e.groupBy(key, "row").agg(F.array_sort(F.collect_list(xc)).alias("xs"))  # at most one per edge
    half = F.transform(F.sequence(F.lit(0), F.floor(F.size("xs") / 2).cast("int") - 1), lambda i: F.struct(F.element_at("xs", 2 * i + 1).alias("a"), F.element_at("xs", 2 * i + 2).alias("b")))
    s = rows.where(F.size("xs") >= 2).select(key, "row", F.explode(half).alias("p"))
    return _within(s.select(key, "row", F.ceil(F.col("p.a") - 0.5).cast("int").alias("col_lo"), (F.ceil(F.col("p.b") - 0.5) - 1).cast("int").alias("col_hi")), grid)


def circle_spans(points: DataFrame, grid: Grid, radius: float, key: str = "feature_id") -> DataFrame:
    """Cells whose centre lies within ``radius`` of the point (x, y); columns are half-chords by row."""
    u, v, r = (F.col("x") - grid.x0) / grid.dx, (F.col("y") - grid.y0) / grid.dy, abs(radius / grid.dx)
    ry = abs(radius / grid.dy)
    lo, hi = F.greatest(F.ceil(v - ry - 0.5), F.lit(0)), F.least(F.floor(v + ry - 0.5), F.lit(grid.n_rows - 1))
    p = points.select(key, u.alias("u"), v.alias("v"), lo.alias("lo"), hi.alias("hi")).where("lo <= hi").withColumn("row", F.explode(F.sequence(F.col("lo").cast("int"), F.col("hi").cast("int"))))
    chord = F.sqrt(F.greatest(F.lit(0.0), 1 - F.pow((F.col("row") + 0.5 - F.col("v")) / ry, F.lit(2)))) * r
    return _within(p.select(key, "row", F.ceil(F.col("u") - chord - 0.5).cast("int").alias("col_lo"), F.floor(F.col("u") + chord - 0.5).cast("int").alias("col_hi")), grid)


def rectangle(min_x: float, min_y: float, max_x: float, max_y: float) -> Column:
    corner = lambda x, y: F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y"))
    return F.array(F.array(corner(min_x, min_y), corner(max_x, min_y), corner(max_x, max_y), corner(min_x, max_y)))


def bounds(features: DataFrame, key: str = "feature_id", rings: str = "rings") -> DataFrame:
    flat = F.flatten(rings)
    xs, ys = F.transform(flat, lambda p: p["x"]), F.transform(flat, lambda p: p["y"])
    return features.select(key, F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = 6_371_008.8) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2))
    return 2 * radius * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _within(spans: DataFrame, grid: Grid) -> DataFrame:
    s = spans.withColumn("col_lo", F.greatest("col_lo", F.lit(0))).withColumn("col_hi", F.least("col_hi", F.lit(grid.n_cols - 1)))
    return s.where("col_lo <= col_hi")


#: Places of an edge where its image is held against the chord; pieces an edge is cut into at most, at either of two cuts.
PROBES, MOST_PIECES = (0.25, 0.5, 0.75), 1024


def reprojected(features: DataFrame, source: str, target: str, tolerance: float = 1.0, key: str = "feature_id", rings: str = "rings") -> DataFrame:
    """Features with their rings in another projection: no edge is farther than ``tolerance`` (map units of the target)
    from the image of the edge it stands for.

    A straight edge is a curve in the other projection, so it is cut before it is transformed. The distance of its image
    from the chord at three places says into how many pieces: it falls with the square of their number. Each piece is then
    measured and cut again in the same way, which mends edges whose curvature varies. Other columns stay; a feature without
    rings keeps none.
    """
    if source == target:
        return features
    e = features.select(key, F.posexplode(rings).alias("_ring", "_points")).select(key, "_ring", "_points", F.posexplode("_points").alias("_at", "_p"))
    after = F.element_at("_points", (F.col("_at") + 1) % F.size("_points") + 1)
    e = e.select(key, "_ring", F.col("_at").cast("double").alias("_at"), F.lit(1.0).alias("_len"), F.col("_p.x").alias("_x1"), F.col("_p.y").alias("_y1"), after["x"].alias("_x2"), after["y"].alias("_y2"))

    def between(t: Column) -> tuple[Column, Column]:
        return F.col("_x1") + (F.col("_x2") - F.col("_x1")) * t, F.col("_y1") + (F.col("_y2") - F.col("_y1")) * t

    def moved(df: DataFrame, points: dict[str, tuple[Column, Column]]) -> DataFrame:
        """Adds <name>u and <name>v, the images of the points; by way of geographic coordinates, a projection each."""
        kept = df.columns
        df = df.select(*kept, *[c.alias(n + x) for n, p in points.items() for c, x in zip(transform_crs(*p, source, "EPSG:4326"), "gh")])
        made = [c.alias(n + x) for n in points for c, x in zip(transform_crs(F.col(n + "g"), F.col(n + "h"), "EPSG:4326", target), "uv")]
        return df.select(*kept, *made)

    for _ in range(2):
        probed = moved(e, {"_a": between(F.lit(0.0)), "_b": between(F.lit(1.0)), **{f"_m{i}": between(F.lit(t)) for i, t in enumerate(PROBES)}})
        off = [F.hypot(F.col(f"_m{i}u") - F.col("_au") - (F.col("_bu") - F.col("_au")) * t, F.col(f"_m{i}v") - F.col("_av") - (F.col("_bv") - F.col("_av")) * t) for i, t in enumerate(PROBES)]
        pieces = F.least(F.ceil(F.sqrt(F.greatest(*off) * (2 / tolerance))), F.lit(MOST_PIECES))
        n = F.greatest(pieces, F.lit(1)).cast("int")
        cut = probed.select(*e.columns, n.alias("_n")).select(*e.columns, "_n", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_i"))
        (x1, y1), (x2, y2) = between(F.col("_i") / F.col("_n")), between((F.col("_i") + 1) / F.col("_n"))
        last = F.col("_i") + 1 == F.col("_n")
        e = cut.select(key, "_ring", (F.col("_at") + F.col("_len") * F.col("_i") / F.col("_n")).alias("_at"), (F.col("_len") / F.col("_n")).alias("_len"), x1.alias("_x1"), y1.alias("_y1"), F.when(last, F.col("_x2")).otherwise(x2).alias("_x2"), F.when(last, F.col("_y2")).otherwise(y2).alias("_y2"))
    points = moved(e, {"_a": between(F.lit(0.0))}).groupBy(key, "_ring").agg(F.sort_array(F.collect_list(F.struct("_at", F.col("_au").alias("x"), F.col("_av").alias("y")))).alias("_points"))
    ring = F.transform("_points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y")))
    made = points.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_ring", ring.alias("_r"))))["_r"].alias("_rings"))
    return features.join(made, key, "left").select(*[F.coalesce("_rings", F.array().cast(made.schema["_rings"].dataType)).alias(c) if c == rings else c for c in features.columns])


#: How far from an edge's image its chords may lie, as a share of the lesser side of a cell, when cells are chosen by them.
CLOSE = 1e-6


def reprojected_spans(features: DataFrame, source: str, grid: Grid, key: str = "feature_id", rings: str = "rings") -> DataFrame:
    """``polygon_spans`` of features in another projection than the grid's.

    A cell whose centre lies between an edge's image and its chords would be taken for inside or outside wrongly, and the
    smaller cells are, the more of them lie there. So chords are held to the cells: of a million cells along the edges
    about one can be mistaken. The number of pieces grows with the square root of that.
    """
    close = min(abs(grid.dx), abs(grid.dy)) * CLOSE
    return polygon_spans(reprojected(features, source, grid.crs, close, key, rings), grid, key, rings)


def split_spans(spans: DataFrame) -> DataFrame:
    """One row per 256-cell stretch a span touches, which gives joins an equi-key."""
    return spans.withColumn("stretch", F.explode(F.sequence(F.floor(F.col("col_lo") / STRETCH), F.floor(F.col("col_hi") / STRETCH))))


def span_cells(spans: DataFrame, key: str = "feature_id") -> DataFrame:
    return spans.select(key, "row", F.explode(F.sequence("col_lo", "col_hi")).alias("col"))


def join_spans(pixels: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """Pixels with the features that cover them (``left_semi``: covered pixels, ``left_anti``: the others)."""
    s = split_spans(spans).withColumnRenamed("row", "_row")
    on = (F.col("row") == F.col("_row")) & (F.floor(F.col("col") / STRETCH) == F.col("stretch")) & F.col("col").between(F.col("col_lo"), F.col("col_hi"))
    j = pixels.join(s, on, how)
    return j if how in ("left_semi", "left_anti") else j.drop("_row", "stretch", "col_lo", "col_hi")


def clip(pixels: DataFrame, spans: DataFrame) -> DataFrame:
    """Pixels inside the features; a pixel covered twice stays one row."""
    return join_spans(pixels, spans, "left_semi")


def filter_by_spans(features: DataFrame, own: DataFrame, aoi: DataFrame, key: str = "feature_id") -> DataFrame:
    """Features that share a cell with the area: the exact test behind a box test. Spans meet spans, not cells."""
    area = split_spans(aoi).select(F.col("row").alias("_row"), F.col("stretch").alias("_stretch"), F.col("col_lo").alias("_lo"), F.col("col_hi").alias("_hi"))
    on = (F.col("row") == F.col("_row")) & (F.col("stretch") == F.col("_stretch")) & (F.col("col_lo") <= F.col("_hi")) & (F.col("col_hi") >= F.col("_lo"))
    return features.join(split_spans(own).join(area, on, "left_semi").select(key).distinct(), key, "left_semi")


#: Side of the tiles of the distance transform, at least; wider reaches have tiles of their reach.
TILE = 256


def row_gaps(covered: np.ndarray, dx: float) -> np.ndarray:
    """Per cell the distance along its row to the nearest covered cell (infinite without one), by two running maxima."""
    n, at = covered.shape[1], np.arange(covered.shape[1])
    left = np.maximum.accumulate(np.where(covered, at, -(1 << 30)), axis=1)
    right = np.minimum.accumulate(np.where(covered, at, 1 << 30)[:, ::-1], axis=1)[:, ::-1]
    gap = np.minimum(at - left, right - at)
    return np.where(gap <= n, gap * dx, np.inf)


def lower_envelope(gaps: np.ndarray, dy: float, reach: int) -> np.ndarray:
    """Per cell the least squared distance: the lower envelope along its column of the parabolas gap^2 + (rows * dy)^2.

    Rows up to ``reach`` above and below are looked at, all columns at once, nearest rows first; it ends where a row's
    own distance can lower no value any more.
    """
    squares = gaps * gaps
    out = squares.copy()
    for k in range(1, min(reach, len(gaps) - 1) + 1):
        step = (k * dy) ** 2
        if step >= out.max():
            break
        np.minimum(out[k:], squares[:-k] + step, out=out[k:])
        np.minimum(out[:-k], squares[k:] + step, out=out[:-k])
    return out


def _distances(spans: DataFrame, grid: Grid, radius: float, key: str, schema: str, make) -> DataFrame:
    """What ``make`` draws from each (feature, tile): (key, row of the tile, col of the tile, squared distances)."""
    dx, dy = abs(grid.dx), abs(grid.dy)
    across, down = int(radius / dx), int(radius / dy)
    side = max(TILE, across, down)
    over = lambda lo, hi, far: F.explode(F.sequence(F.floor((F.col(lo) - far) / side), F.floor((F.col(hi) + far) / side)))
    dealt = spans.select(key, "row", "col_lo", "col_hi").withColumn("_tr", over("row", "row", down)).withColumn("_tc", over("col_lo", "col_hi", across))
    last_row, last_col = (grid.n_rows - 1) // side, (grid.n_cols - 1) // side
    dealt = dealt.where(F.col("_tr").between(0, last_row) & F.col("_tc").between(0, last_col))
    n_rows, n_cols = grid.n_rows, grid.n_cols

    def run(keys: tuple, table: pa.Table) -> pa.Table:
        r0, c0 = keys[1].as_py() * side, keys[2].as_py() * side
        rows, lo, hi = (table.column(c).to_numpy().astype(np.int64) for c in ("row", "col_lo", "col_hi"))
        marks = np.zeros((side + 2 * down, side + 2 * across + 1), np.int32)
        np.add.at(marks, (rows - r0 + down, np.clip(lo - c0 + across, 0, marks.shape[1] - 1)), 1)
        np.add.at(marks, (rows - r0 + down, np.clip(hi + 1 - c0 + across, 0, marks.shape[1] - 1)), -1)
        covered = np.cumsum(marks, axis=1)[:, :-1] > 0
        far = lower_envelope(row_gaps(covered, dx), dy, down)[down : down + min(side, n_rows - r0), across : across + min(side, n_cols - c0)]
        return make(keys[0].as_py(), r0, c0, far, far <= radius * radius)

    return dealt.groupBy(key, "_tr", "_tc").applyInArrow(run, schema)


def distance_transform(spans: DataFrame, grid: Grid, radius: float, key: str = "feature_id") -> DataFrame:
    """(key, col, row, distance): every cell whose centre is within ``radius`` of a covered cell's, with the distance.

    Exact: gaps along rows, then lower envelopes along columns, in tiles that see ``radius`` beyond their border. A span
    is sent to the tiles it can reach, not to every row.
    """
    kind = dict(spans.dtypes)[key]
    arrow = spans.select(key).limit(0).toArrow().schema.field(key).type

    def make(k, r0, c0, far, near):
        r, c = np.nonzero(near)
        return pa.table({key: pa.array([k] * len(r), arrow), "col": pa.array((c + c0).astype(np.int32)), "row": pa.array((r + r0).astype(np.int32)), "distance": pa.array(np.sqrt(far[near]))})

    return _distances(spans, grid, radius, key, f"`{key}` {kind}, col int, row int, distance double", make)


def dilated(spans: DataFrame, grid: Grid, radius: float, key: str = "feature_id") -> DataFrame:
    """A buffer around features: cells whose centre is within ``radius`` of a covered cell's centre, as spans.

    Read off the distance transform tile by tile; spans that touch at a tile's border are joined.
    """
    kind = dict(spans.dtypes)[key]
    arrow = spans.select(key).limit(0).toArrow().schema.field(key).type

    def make(k, r0, c0, far, near):
        edges = np.diff(np.pad(near, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (r, lo), (_, hi) = np.nonzero(edges == 1), np.nonzero(edges == -1)
        return pa.table({key: pa.array([k] * len(r), arrow), "row": pa.array((r + r0).astype(np.int32)), "col_lo": pa.array((lo + c0).astype(np.int32)), "col_hi": pa.array((hi - 1 + c0).astype(np.int32))})

    return merged(_distances(spans, grid, radius, key, f"`{key}` {kind}, row int, col_lo int, col_hi int", make), key)


def merged(spans: DataFrame, key: str = "feature_id") -> DataFrame:
    """Overlapping and touching spans of a row as one."""
    w = Window.partitionBy(key, "row").orderBy("col_lo", "col_hi")
    before = F.max("col_hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    s = spans.withColumn("_new", (F.col("col_lo") > F.coalesce(before, F.lit(-(1 << 30))) + 1).cast("int"))
    s = s.withColumn("_run", F.sum("_new").over(w))
    return s.groupBy(key, "row", "_run").agg(F.min("col_lo").alias("col_lo"), F.max("col_hi").alias("col_hi")).drop("_run")


def reduce_regions(pixels: DataFrame, spans: DataFrame, features: DataFrame, bands: Sequence[str], name: str = "mean", keys: Sequence[str] = (), key: str = "feature_id") -> DataFrame:
    """Per feature (and image keys) a reduced value a band; features that meet no pixel give one row of nulls."""
    fn = reducer(name)
    made = join_spans(pixels, spans).groupBy(key, *keys).agg(*[fn(F.col(f"`{b}`")).alias(b) for b in bands])
    return features.select(key).join(made, key, "left")


def span_sums(pixels: DataFrame, spans: DataFrame, bands: Sequence[str], keys: Sequence[str] = (), key: str = "feature_id") -> DataFrame:
    """(key, keys, _pixels, _s0, _n0, _s1, ...): per feature and image the rows, sum and number of valid values a band.

    Each row of an image is summed once, from left to right; a span takes two places of that sum, before its first and
    after its last cell, whatever its width and however many other spans cover it. No pixel meets a feature in a join. A
    running sum over a row costs some digits: 16 of the row's sum, not of the span's.
    """
    row = [*keys, "row"]
    values = [F.col(f"`{b}`").cast("double") for b in bands]
    cells = pixels.select(*row, F.col("col").alias("_at"), F.lit(0).alias("_end"), F.lit(None).cast(dict(spans.dtypes)[key]).alias("_f"), *[v.alias(f"_v{i}") for i, v in enumerate(values)])
    ends = F.explode(F.array(F.struct(F.col("col_lo").alias("_at"), F.lit(-1).alias("_end")), F.struct(F.col("col_hi").alias("_at"), F.lit(1).alias("_end"))))
    asked = spans.select(F.col(key).alias("_f"), F.col("row").alias("_row"), ends.alias("_e")).join(pixels.select(*row).distinct(), F.col("_row") == F.col("row"))
    asked = asked.select(*row, "_e._at", "_e._end", "_f", *[F.lit(None).cast("double").alias(f"_v{i}") for i in range(len(bands))])
    w = Window.partitionBy(*row).orderBy("_at", "_end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"_pixels": F.sum((F.col("_end") == 0).cast("long")).over(w)}
    for i in range(len(bands)):
        sums |= {f"_s{i}": F.coalesce(F.sum(f"_v{i}").over(w), F.lit(0.0)), f"_n{i}": F.count(f"_v{i}").over(w)}
    read = cells.union(asked).select(*keys, "_f", "_end", *[c.alias(n) for n, c in sums.items()]).where("_end <> 0")
    return read.groupBy(F.col("_f").alias(key), *keys).agg(*[F.sum(F.col("_end") * F.col(n)).alias(n) for n in sums])


def reduce_by_sums(pixels: DataFrame, spans: DataFrame, bands: Sequence[str], name: str = "mean", keys: Sequence[str] = (), key: str = "feature_id") -> DataFrame:
    """What ``reduce_regions`` gives for mean, sum and count, from running sums; a row per feature and image that meet."""
    if name not in ("mean", "sum", "count"):
        raise ValueError(f"running sums give mean, sum and count, not {name}")
    made = span_sums(pixels, spans, bands, keys, key).where("_pixels > 0")
    of = {"mean": lambda i: ratio(F.col(f"_s{i}"), F.col(f"_n{i}")), "sum": lambda i: F.when(F.col(f"_n{i}") > 0, F.col(f"_s{i}")), "count": lambda i: F.col(f"_n{i}")}[name]
    return made.select(key, *keys, *[of(i).alias(b) for i, b in enumerate(bands)])


def point_cells(points: DataFrame, grid: Grid) -> DataFrame:
    """Points with the cell they lie in; null off the grid."""
    c, r = grid.col_of(F.col("x")), grid.row_of(F.col("y"))
    there = grid.inside(c, r)
    return points.withColumn("col", F.when(there, c)).withColumn("row", F.when(there, r))


def sample_regions(pixels: DataFrame, points: DataFrame, grid: Grid, keep: Sequence[str]) -> DataFrame:
    """Every band at each point; points off the raster disappear. A shuffled equi-join on the cell: points may be many."""
    at = point_cells(points, grid).select(*keep, *CELL).where("col is not null")
    return at.join(pixels, CELL).drop(*CELL)


def image_to_points(pixels: DataFrame, points: DataFrame, grid: Grid, bands: Sequence[str], name: str = "mean", buffer: float = 0, aoi: DataFrame | None = None, key: str = "point_id") -> DataFrame:
    """Bands reduced around each point, named <band>_<reducer>_<buffer>; without a buffer the cell the point lies in.

    With an area only points in its cells are used. Point columns come first.
    """
    if aoi is not None:
        inside = point_cells(points, grid).where("col is not null")
        points = join_spans(inside, aoi, "left_semi").drop(*CELL)
    if buffer > 0:
        spans = circle_spans(points, grid, buffer, key)
        out = reduce_regions(pixels, spans, points, bands, name, key=key)
    else:
        at = point_cells(points, grid).select(key, *CELL)
        out = at.join(pixels.select(*CELL, *bands), CELL, "left").drop(*CELL)
    return points.join(suffixed(out, f"_{name}_{buffer:g}", [key]), key)


def collection_to_points(pixels: DataFrame, scenes: DataFrame, points: DataFrame, grid: Grid, bands: Sequence[str], name: str = "mean", buffer: float = 0, key: str = "point_id", properties: Sequence[str] = ()) -> DataFrame:
    """The same for every image: a row per point and image that has pixels there, with the image's properties."""
    if buffer > 0:
        made = join_spans(pixels, circle_spans(points, grid, buffer, key)).groupBy(key, "image_id").agg(*[reducer(name)(F.col(b)).alias(b) for b in bands])
    else:
        made = sample_regions(pixels.select("image_id", *CELL, *bands), points, grid, [key])
    made = suffixed(made, f"_{name}_{buffer:g}", [key, "image_id"])
    return made.join(scenes.select("image_id", *properties), "image_id").join(points, key)


def collection_to_features(pixels: DataFrame, scenes: DataFrame, spans: DataFrame, bands: Sequence[str], name: str = "mean", image: str = "image_id", key: str = "feature_id", properties: Sequence[str] = ()) -> DataFrame:
    """A row per polygon and image that meet, bands named <band>_<reducer>, with the image's properties."""
    fn = reducer(name)
    made = join_spans(pixels, spans).groupBy(key, image).agg(*[fn(F.col(b)).alias(f"{b}_{name}") for b in bands])
    return made.join(scenes.select(image, *properties), image) if properties else made
