"""Moving windows over cells without self-joins: two passes of window functions, one along rows, one along columns, or,
for wide windows and many classes, square tiles with a margin, each summed as an array in a task."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rasterloom.functions.expr import at_least, ratio
from rasterloom.model import CELL

#: Half-width in cells from which tiles replace sliding frames, whose cost grows with their width.
TILED_FROM = 6
#: Side of a tile in cells, at least; a wider window has tiles of its half-width, so a cell is sent to 9 tiles at most.
SIDE = 256


@dataclass(frozen=True)
class Kernel:
    """A circle or square of a radius in cells."""

    radius: int
    shape: str = "circle"

    @classmethod
    def metres(cls, radius: float, cell: float, shape: str = "circle") -> Kernel:
        return cls(round(radius / cell), shape)

    def bands(self) -> list[tuple[int, int, int]]:
        """(first, last, half-width): row offsets 0 and up, grouped by equal half-width."""
        if self.shape == "square":
            return [(0, self.radius, self.radius)]
        widths = [math.isqrt(self.radius**2 - d * d) for d in range(self.radius + 1)]
        out, start = [], 0
        for d in range(1, self.radius + 2):
            if d > self.radius or widths[d] != widths[start]:
                out.append((start, d - 1, widths[start]))
                start = d
        return out

    def widths(self) -> list[tuple[int, int]]:
        """(row offset, half-width) of every row of the window."""
        return [(d, w) for a, b, w in self.bands() for k in range(a, b + 1) for d in {k, -k}]


def _sliding(value: str, keys: Sequence[str], order: str, lo: int, hi: int) -> Column:
    return F.coalesce(F.sum(value).over(Window.partitionBy(*keys).orderBy(order).rangeBetween(lo, hi)), F.lit(0.0))


def _by_tile(df: DataFrame, names: Sequence[str], reach: int, group: Sequence[str], compute: Callable[[pa.Table, Callable], list[np.ndarray]]) -> DataFrame:
    """Adds double columns ``names`` to all rows of ``df``, computed tile by tile from the rows up to ``reach`` cells around.

    Each cell is sent to the tiles whose margin it lies in, in one shuffle; a task holds one tile and its margin.
    ``compute`` gets a tile's rows and a function that sums an array over them (one number a row) over the window of
    each own cell, in the order of the rows that are the tile's own.
    """
    side = max(SIDE, reach)
    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side)))
    spread = df.withColumn("_tc", span("col")).withColumn("_tr", span("row"))
    columns = list(df.columns)
    schema = T.StructType([*df.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(table: pa.Table) -> pa.Table:
        x0, y0 = table.column("_tc")[0].as_py() * side, table.column("_tr")[0].as_py() * side
        x, y = (table.column(c).to_numpy().astype(np.int64) - o for c, o in (("col", x0), ("row", y0)))
        own = (x >= 0) & (x < side) & (y >= 0) & (y < side)
        n = side + 2 * reach

        def summed(values: np.ndarray, widths: Sequence[tuple[int, int]]) -> np.ndarray:
            grid = np.zeros((n, n))
            np.add.at(grid, (y + reach, x + reach), values)
            running = np.concatenate([np.zeros((n, 1)), np.cumsum(grid, axis=1)], axis=1)
            out = np.zeros((side, side))
            for dy, w in widths:
                rows = running[reach + dy : reach + dy + side]
                out += rows[:, reach + w + 1 : reach + w + 1 + side] - rows[:, reach - w : reach - w + side]
            return out[y[own], x[own]]

        made = compute(table, summed)
        kept = table.select(columns).filter(pa.array(own))
        for name, values in zip(names, made):
            kept = kept.append_column(name, pa.array(values, pa.float64()))
        return kept

    return spread.groupBy(*group, "_tc", "_tr").applyInArrow(run, schema)


def focal_sums(df: DataFrame, values: Sequence[str], kernel: Kernel, group: Sequence[str] = (), tiled: bool | None = None) -> DataFrame:
    """Adds <value>__sum over the kernel around every row's cell; missing rows and nulls add nothing.

    Narrow windows: pass one sums along the row for each distinct half-width, pass two adds those along the column, in
    two shuffles by (group, row) and (group, col). From a half-width of TILED_FROM: tiles (``_by_tile``), in one.
    """
    tiled = kernel.radius >= TILED_FROM if tiled is None else tiled
    own = df.columns
    if tiled:
        widths = kernel.widths()

        def sums(table: pa.Table, summed: Callable) -> list[np.ndarray]:
            return [summed(np.nan_to_num(table.column(v).to_numpy().astype(float)), widths) for v in values]

        return _by_tile(df, [f"{v}__sum" for v in values], kernel.radius, group, sums).select(*own, *[f"{v}__sum" for v in values])
    bands = kernel.bands()
    first, second = [*group, "row"], [*group, "col"]
    part = lambda v, i: f"_{v}_{i}"
    df = df.withColumns({part(v, i): _sliding(v, first, "col", -w, w) for v in values for i, (_, _, w) in enumerate(bands)})
    made = {}
    for v in values:
        total = None
        for i, (a, b, _) in enumerate(bands):
            n = part(v, i)
            x = _sliding(n, second, "row", -b, b) if a == 0 else _sliding(n, second, "row", a, b) + _sliding(n, second, "row", -b, -a)
            total = x if total is None else total + x
        made[f"{v}__sum"] = total
    return df.withColumns(made).select(*own, *made)


def focal(df: DataFrame, bands: Sequence[str], kernel: Kernel, stats: Sequence[str] = ("mean",), group: Sequence[str] = (), mask_center: bool = False, tiled: bool | None = None) -> DataFrame:
    """Adds <band>_<stat> (mean, sum, count, stdDev) over the valid cells of the kernel; null where there are none.

    Masked centres get a value too unless ``mask_center``. Input must have a row for every cell that is to have one
    (``densify``). The standard deviation is the population's, of values shifted by the band's mean in the group, one
    row joined back, which keeps large numbers from cancelling.
    """
    own = df.columns
    spread = "stdDev" in stats
    if spread:
        means = df.groupBy(*group).agg(*[F.avg(b).alias(f"_m_{b}") for b in bands]) if group else df.agg(*[F.avg(b).alias(f"_m_{b}") for b in bands])
        df = df.join(means, list(group)) if group else df.crossJoin(F.broadcast(means))
    shift = lambda b: F.col(b).cast("double") - F.coalesce(F.col(f"_m_{b}"), F.lit(0.0)) if spread else F.col(b).cast("double")
    cols = {}
    for b in bands:
        cols |= {f"v_{b}": shift(b), f"n_{b}": F.when(F.col(b).isNotNull(), 1.0).otherwise(0.0)}
        if spread:
            cols[f"s_{b}"] = shift(b) * shift(b)
    summed = focal_sums(df.withColumns(cols), list(cols), kernel, group, tiled)
    out = {}
    for b in bands:
        n = F.round(F.col(f"n_{b}__sum"))
        mean = ratio(F.col(f"v_{b}__sum"), n)
        back = F.coalesce(F.col(f"_m_{b}"), F.lit(0.0)) if spread else F.lit(0.0)
        made = {"mean": mean + back, "count": n.cast("long"), "sum": F.when(n > 0, F.col(f"v_{b}__sum") + back * n)}
        if spread:
            made["stdDev"] = F.sqrt(at_least(ratio(F.col(f"s_{b}__sum"), n) - mean * mean, 0.0))
        for s in stats:
            out[f"{b}_{s}"] = F.when(F.col(b).isNotNull(), made[s]) if mask_center else made[s]
    return summed.withColumns(out).select(*own, *out)


def focal_stats(df: DataFrame, bands: Sequence[str], kernel: Kernel, label: str, group: Sequence[str] = (), keep: Sequence[str] = ("time_start",)) -> DataFrame:
    """Focal means named <band>_<label>, with the group, the cell and the copied properties."""
    if kernel.radius == 0:
        out = df.withColumns({f"{b}_mean": F.col(b) for b in bands})
    else:
        out = focal(df, bands, kernel, ("mean",), group)
    kept = [k for k in keep if k in df.columns]
    return out.select(*dict.fromkeys([*group, *CELL, *kept]), *[F.col(f"{b}_mean").alias(f"{b}_{label}") for b in bands])


def gaussian_fill(df: DataFrame, bands: Sequence[str], group: Sequence[str] = (), radius: int = 3, sigma: float = 1.0) -> DataFrame:
    """Masked cells get the gaussian-weighted mean of the valid cells in the (2 radius + 1) square; others are unchanged.

    Weighted sums by shift: along the row, then along the column, with the separable kernel. Needs dense rows.
    """
    own = df.columns
    weight = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(radius + 1)]

    def blur(df: DataFrame, names: Sequence[str], w) -> DataFrame:
        at = lambda n, k: F.col(n) if k == 0 else F.coalesce((F.lead if k > 0 else F.lag)(n, abs(k)).over(w), F.lit(0.0))
        made = {}
        for n in names:
            total = F.col(n) * weight[0]
            for k in range(1, radius + 1):
                total = total + (at(n, k) + at(n, -k)) * weight[k]
            made[n] = total
        return df.withColumns(made)

    names = [f"_{p}_{b}" for b in bands for p in "vn"]
    df = df.withColumns({f"_v_{b}": F.coalesce(F.col(b).cast("double"), F.lit(0.0)) for b in bands} | {f"_n_{b}": F.when(F.col(b).isNotNull(), 1.0).otherwise(0.0) for b in bands})
    df = blur(df, names, Window.partitionBy(*group, "row").orderBy("col"))
    df = blur(df, names, Window.partitionBy(*group, "col").orderBy("row"))
    return df.withColumns({b: F.coalesce(F.col(b), F.when(F.col(f"_n_{b}") > 1e-12, F.col(f"_v_{b}") / F.col(f"_n_{b}"))) for b in bands}).select(*own)


def tpi(df: DataFrame, z: str, radii: Sequence[int], group: Sequence[str] = ()) -> DataFrame:
    """Height above the mean of a circle, one column a radius (in cells): tpi_<radius>. Clip afterwards."""
    for r in radii:
        df = focal(df, [z], Kernel(r), ("mean",), group).withColumn(f"tpi_{r}", F.col(z) - F.col(f"{z}_mean")).drop(f"{z}_mean")
    return df


def dev(df: DataFrame, z: str, radii: Sequence[int], group: Sequence[str] = (), least_sd: float = 0.001) -> DataFrame:
    """(z - mean) / max(sd, least): dev_<radius>; mean and sd share one pair of passes."""
    for r in radii:
        df = focal(df, [z], Kernel(r), ("mean", "stdDev"), group)
        df = df.withColumn(f"dev_{r}", ratio(F.col(z) - F.col(f"{z}_mean"), at_least(F.col(f"{z}_stdDev"), least_sd))).drop(f"{z}_mean", f"{z}_stdDev")
    return df


def tri(df: DataFrame, z: str, group: Sequence[str] = ()) -> DataFrame:
    """Ruggedness: root of the summed squared differences to the 3x3 neighbours, from three sums."""
    df = df.withColumn("_z", F.col(z).cast("double")).withColumn("_zz", F.col("_z") * F.col("_z")).withColumn("_n", F.when(F.col(z).isNotNull(), 1.0).otherwise(0.0))
    df = focal_sums(df, ["_z", "_zz", "_n"], Kernel(1, "square"), group)
    inside = F.col("_zz__sum") - 2 * F.col("_z") * F.col("_z__sum") + F.col("_n__sum") * F.col("_z") * F.col("_z")
    return df.withColumn("tri", F.sqrt(at_least(inside, 0.0))).drop("_z", "_zz", "_n", "_z__sum", "_zz__sum", "_n__sum")


def slope_aspect(df: DataFrame, z: str, cell: float, group: Sequence[str] = ()) -> DataFrame:
    """Slope and aspect in degrees by central differences of the four neighbours; null where one is missing.

    Rows go south. Aspect is the compass direction of steepest descent.
    """
    ew, ns = Window.partitionBy(*group, "row").orderBy("col"), Window.partitionBy(*group, "col").orderBy("row")
    df = df.withColumn("_gx", (F.lead(z).over(ew) - F.lag(z).over(ew)) / F.lit(2.0 * cell))
    df = df.withColumn("_gy", (F.lag(z).over(ns) - F.lead(z).over(ns)) / F.lit(2.0 * cell))  # towards north
    valid = F.col(z).isNotNull()
    slope = F.degrees(F.atan(F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy"))))
    aspect = F.pmod(F.degrees(F.atan2(-F.col("_gx"), -F.col("_gy"))) + 360.0, F.lit(360.0))
    return df.withColumn("slope", F.when(valid, slope)).withColumn("aspect", F.when(valid, aspect)).drop("_gx", "_gy")


def class_proportions(df: DataFrame, cls: str, classes: Sequence[int], radius: int, group: Sequence[str] = (), prefix: str = "class_") -> DataFrame:
    """Share of each class among the valid cells of a circle, 0 where there are none: <prefix><class>_<radius>.

    All classes are counted from one column of codes, tile by tile: one shuffle however many they are.
    """
    widths, names = Kernel(radius).widths(), [f"{prefix}{k}_{radius}" for k in classes]

    def shares(table: pa.Table, summed: Callable) -> list[np.ndarray]:
        code = table.column(cls).to_numpy().astype(float)  # null: nan
        n = summed((~np.isnan(code)).astype(float), widths)
        return [np.divide(summed((code == k).astype(float), widths), n, out=np.zeros_like(n), where=n > 0) for k in classes]

    return _by_tile(df.select(*group, *CELL, cls), names, radius, group, shares).select(*group, *CELL, *names)
