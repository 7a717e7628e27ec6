"""Changing grids: coarser cells, other lattices, other projections, tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rasterloom.functions.crs import transform_crs
from rasterloom.functions.expr import ratio
from rasterloom.model import CELL, Grid
from rasterloom.operators.composite import reducer


def reduce_resolution(df: DataFrame, bands: Sequence[str], factor: int, name: str = "mean", keys: Sequence[str] = ()) -> DataFrame:
    """Cells of factor x factor as one; ``mode`` for codes (the smallest of equals)."""
    fn = reducer(name)
    coarse = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in CELL]
    return df.groupBy(*keys, *coarse).agg(*[fn(F.col(b)).alias(b) for b in bands])


def aggregate_to_grid(df: DataFrame, bands: Sequence[str], fine: Grid, coarse: Grid, keys: Sequence[str] = ()) -> DataFrame:
    """Area-weighted means on a lattice of any ratio; masked cells have no weight.

    A fine cell is handed to the coarse cells it overlaps (four at most when they are larger) with its share of area,
    then one hash aggregation by coarse cell.
    """

    def overlap(axis: str, f0: float, fd: float, c0: float, cd: float):
        a = (F.lit(f0) + F.col(axis) * fd - c0) / cd
        b = (F.lit(f0) + (F.col(axis) + 1) * fd - c0) / cd
        return F.least(a, b), F.greatest(a, b)

    def cells(lo, hi):
        first, last = F.floor(lo), F.greatest(F.ceil(hi) - 1, F.floor(lo))
        return F.transform(F.sequence(first, last), lambda k: F.struct(k.cast("int").alias("k"), (F.least(hi, k + 1.0) - F.greatest(lo, k.cast("double"))).alias("w")))

    x, y = overlap("col", fine.x0, fine.dx, coarse.x0, coarse.dx), overlap("row", fine.y0, fine.dy, coarse.y0, coarse.dy)
    parts = df.withColumn("_x", F.explode(cells(*x))).withColumn("_y", F.explode(cells(*y)))
    parts = parts.select(*keys, F.col("_x.k").alias("col"), F.col("_y.k").alias("row"), (F.col("_x.w") * F.col("_y.w")).alias("_w"), *bands).where("_w > 1e-12")
    parts = parts.where(coarse.inside(F.col("col"), F.col("row")))
    weight = lambda b: F.when(F.col(b).isNotNull(), F.col("_w"))
    return parts.groupBy(*keys, *CELL).agg(*[ratio(F.sum(F.col("_w") * F.col(b)), F.sum(weight(b))).alias(b) for b in bands])


def tiles_of(boxes: DataFrame, size: float, keys: Sequence[str] = ()) -> DataFrame:
    """Squares of a metric size that cover each box (min_x, min_y, max_x, max_y), from its lower left corner."""
    step = F.lit(float(size))
    count = lambda lo, hi: F.greatest(F.ceil((F.col(hi) - F.col(lo)) / step), F.lit(1)).cast("int")
    t = boxes.withColumn("tile_y", F.explode(F.sequence(F.lit(0), count("min_y", "max_y") - 1))).withColumn("tile_x", F.explode(F.sequence(F.lit(0), count("min_x", "max_x") - 1)))
    x, y = F.col("min_x") + F.col("tile_x") * step, F.col("min_y") + F.col("tile_y") * step
    return t.select(*keys, "tile_x", "tile_y", x.alias("min_x"), y.alias("min_y"), (x + step).alias("max_x"), (y + step).alias("max_y"))


def split_into_tiles(spark: SparkSession, min_x: float, min_y: float, max_x: float, max_y: float, size: float) -> DataFrame:
    """``tiles_of`` one given box."""
    ends = {"min_x": min_x, "min_y": min_y, "max_x": max_x, "max_y": max_y}
    return tiles_of(spark.range(1).select(*[F.lit(float(v)).alias(k) for k, v in ends.items()]), size)


#: Source cells that a mixed value is made of along an axis, as offsets from the one at or before the place.
REACH = {"bilinear": (0, 1), "bicubic": (-1, 0, 1, 2)}
#: Weights below this count as none: a place on a cell's centre needs no neighbours.
LEAST = 1e-12
#: Places along an axis up to which their table is broadcast (60 bytes each).
AXIS = 1_000_000


def _weight(method: str, d: Column) -> Column:
    d = F.abs(d)
    if method == "bilinear":
        return F.greatest(1 - d, F.lit(0.0))
    near, far = 1.5 * d * d * d - 2.5 * d * d + 1, -0.5 * d * d * d + 2.5 * d * d - 4 * d + 2
    return F.when(d <= 1, near).when(d < 2, far).otherwise(0.0)


def _along(df: DataFrame, bands: Sequence[str], axis: str, other: str, places: DataFrame, reach: Sequence[int]) -> DataFrame:
    """One pass: per line of cells (``other``) the mix of neighbours along ``axis`` at each place (_to, _base, _w0, ...).

    Neighbours come from window frames of one cell, so each cell is shuffled once, whatever the number of neighbours.
    """
    line = Window.partitionBy(other).orderBy(axis)
    beside = {f"_{i}_{k}": F.max(F.col(f"`{b}`")).over(line.rangeBetween(k, k)) for i, b in enumerate(bands) for k in reach if k}
    j = df.select(*CELL, *bands).withColumns(beside).join(places, F.col(axis) == F.col("_base"))

    def mixed(i: int, b: str) -> Column:
        total = weights = F.lit(0.0)
        whole = F.lit(True)
        for n, k in enumerate(reach):
            v, w = F.col(f"_{i}_{k}") if k else F.col(f"`{b}`"), F.col(f"_w{n}")
            used = F.abs(w) > LEAST
            whole = whole & (~used | v.isNotNull())
            total, weights = total + F.when(used, w * v).otherwise(0.0), weights + F.when(used, w).otherwise(0.0)
        return F.when(whole, total / weights).alias(b)

    return j.select(F.col("_to").alias(axis), F.col(other), *[mixed(i, b) for i, b in enumerate(bands)])


def _separable(df: DataFrame, bands: Sequence[str], source: Grid, target: Grid, method: str) -> DataFrame:
    """Mixed values on a grid of the same projection: along rows to the target's columns, then along columns."""
    reach = REACH[method]

    def places(n: int, at: Column, first: float, step: float) -> DataFrame:
        u = (at - first) / step - 0.5
        t = df.sparkSession.range(n).select(F.col("id").cast("int").alias("_to"), u.alias("_u")).withColumn("_base", F.floor("_u").cast("int"))
        t = t.select("_to", "_base", *[_weight(method, F.col("_u") - F.col("_base") - k).alias(f"_w{i}") for i, k in enumerate(reach)])
        return F.broadcast(t) if n <= AXIS else t

    half = _along(df, bands, "col", "row", places(target.n_cols, target.x_of(F.col("id")), source.x0, source.dx), reach)
    made = _along(half, bands, "row", "col", places(target.n_rows, target.y_of(F.col("id")), source.y0, source.dy), reach)
    return target.cells(df.sparkSession).join(made, CELL, "left").select(*CELL, *bands)


def snap_to_grid(df: DataFrame, bands: Sequence[str], source: Grid, target: Grid, method: str = "nearest") -> DataFrame:
    """Values at the target's cell centres: the source cell there, or a bilinear or bicubic mix of 4 or 16 of them.

    Masked or missing neighbours mask a mixed value. On a grid of the same projection a mix is made in two passes, along
    rows and then along columns, and each cell is shuffled once a pass. Grids may be of different projections; then
    centres are transformed to the source's and look up its cells by an equi-join.
    """
    if method != "nearest" and source.crs == target.crs:
        return _separable(df, bands, source, target, method)
    spark = df.sparkSession
    x, y = transform_crs(target.x_of(F.col("col")), target.y_of(F.col("row")), target.crs, source.crs)
    u, v = (x - source.x0) / source.dx - 0.5, (y - source.y0) / source.dy - 0.5
    t = target.cells(spark).withColumn("_u", u).withColumn("_v", v)
    if method == "nearest":
        t = t.select(F.col("col").alias("_c"), F.col("row").alias("_r"), F.floor(F.col("_u") + 0.5).cast("int").alias("col"), F.floor(F.col("_v") + 0.5).cast("int").alias("row"))
        return t.join(df.select(*CELL, *bands), CELL, "left").select(F.col("_c").alias("col"), F.col("_r").alias("row"), *bands)
    reach = REACH[method]
    offsets = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in reach for j in reach])
    e = t.withColumn("_o", F.explode(offsets))
    c, r = F.floor("_u") + F.col("_o.i"), F.floor("_v") + F.col("_o.j")
    e = e.select(F.col("col").alias("_c"), F.col("row").alias("_r"), c.cast("int").alias("col"), r.cast("int").alias("row"), (_weight(method, F.col("_u") - c) * _weight(method, F.col("_v") - r)).alias("_w"))
    e = e.where(F.abs("_w") > LEAST)
    j = e.join(df.select(*CELL, *bands), CELL, "left")
    total = lambda b: F.when(F.count(b) == F.count("*"), F.sum(F.col("_w") * F.col(b)) / F.sum("_w"))
    return j.groupBy("_c", "_r").agg(*[total(b).alias(b) for b in bands]).select(F.col("_c").alias("col"), F.col("_r").alias("row"), *bands)


def reference_template(features: DataFrame, cell_key: str = "feature_id") -> DataFrame:
    """One row (x0, y0, dx, dy, n_cols, n_rows): the lattice of the largest cell, grown outwards to all of them.

    ``features`` has min_x, min_y, max_x, max_y of each cell; cells cut by a border are smaller, so the largest is whole.
    A raster's own lattice (those six columns) is the template as it is.
    """
    lattice = ["x0", "y0", "dx", "dy", "n_cols", "n_rows"]
    if set(lattice) <= set(features.columns):
        return features.select(*lattice)
    area = (F.col("max_x") - F.col("min_x")) * (F.col("max_y") - F.col("min_y"))
    s = features.agg(F.max_by(F.struct("min_x", "min_y", "max_x", "max_y"), F.struct(area, (-F.col(cell_key)).alias("k"))).alias("b"), F.min("min_x").alias("x1"), F.min("min_y").alias("y1"), F.max("max_x").alias("x2"), F.max("max_y").alias("y2"))
    s = s.select("b.*", "x1", "y1", "x2", "y2").withColumn("dx", F.col("max_x") - F.col("min_x")).withColumn("dy", F.col("max_y") - F.col("min_y"))
    left = F.col("min_x") + F.floor(F.round((F.col("x1") - F.col("min_x")) / F.col("dx"), 9)) * F.col("dx")
    right = F.col("min_x") + F.ceil(F.round((F.col("x2") - F.col("min_x")) / F.col("dx"), 9)) * F.col("dx")
    low = F.col("min_y") + F.floor(F.round((F.col("y1") - F.col("min_y")) / F.col("dy"), 9)) * F.col("dy")
    high = F.col("min_y") + F.ceil(F.round((F.col("y2") - F.col("min_y")) / F.col("dy"), 9)) * F.col("dy")
    return s.select(left.alias("x0"), low.alias("y0"), "dx", "dy", F.round((right - left) / F.col("dx")).cast("int").alias("n_cols"), F.round((high - low) / F.col("dy")).cast("int").alias("n_rows"))
