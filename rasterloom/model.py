"""The data model: pixel tables on grids.

pixels: one row per image and cell, a nullable DOUBLE column per band (null: masked; no row: all bands masked).
scenes: one row per image. features: polygons, points or circles. spans: the cells a feature covers, by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELL = ["col", "row"]


@dataclass(frozen=True)
class Grid:
    """A lattice without shear: the outer corner (x0, y0) of cell (0, 0), cell steps (dy is negative for rows going
    south) and numbers of cells."""

    n_cols: int
    n_rows: int
    x0: float = 0.0
    y0: float = 0.0
    dx: float = 1.0
    dy: float = 1.0
    crs: str = "local"

    def cells(self, spark: SparkSession) -> DataFrame:
        """Every cell once; made in parallel, never on the driver."""
        i = F.col("id")
        return spark.range(self.n_cols * self.n_rows).select((i % self.n_cols).cast("int").alias("col"), F.floor(i / self.n_cols).cast("int").alias("row"))

    def col_of(self, x: Column) -> Column:
        return F.floor((x - self.x0) / self.dx).cast("int")

    def row_of(self, y: Column) -> Column:
        return F.floor((y - self.y0) / self.dy).cast("int")

    def x_of(self, col: Column) -> Column:
        return F.lit(self.x0) + (col + 0.5) * self.dx

    def y_of(self, row: Column) -> Column:
        return F.lit(self.y0) + (row + 0.5) * self.dy

    def inside(self, col: Column, row: Column) -> Column:
        return col.between(0, self.n_cols - 1) & row.between(0, self.n_rows - 1)

    def transform(self) -> list[float]:
        """The affine transform as six numbers."""
        return [self.dx, 0.0, self.x0, 0.0, self.dy, self.y0]


def bands_of(df: DataFrame, keys: tuple[str, ...] = ("image_id", "col", "row")) -> list[str]:
    """The numeric columns that aren't keys."""
    numeric = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if c not in keys and (t in numeric or t.startswith("decimal"))]


#: Cells of a grid for which a task of ``densify`` holds the rows, about, of every combination of keys.
CELLS_A_TASK = 100_000


def densify(df: DataFrame, grid: Grid, keys: list[str] | None = None) -> DataFrame:
    """One row per cell of the grid, and per combination of ``keys`` found; bands are null where there was no row.

    The output is by its nature keys times cells; each key row grows its cells by ``explode``, row by row of the grid.
    Cells of large grids are dealt by number, not by bytes, of which regular rows take few, and what comes out is dealt by
    rows of the grid, as windows along them need it: a task sorts the rows of CELLS_A_TASK cells or so, or of one grid row.
    """
    keys = list(keys or [])
    parts = -(-grid.n_cols * grid.n_rows // CELLS_A_TASK)
    deal = lambda x, *by: x.repartition(parts, *by) if parts > 1 else x
    if keys:
        rows = df.select(*keys).distinct().withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(grid.n_rows - 1))))
        cells = deal(rows, *keys, "row").withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(grid.n_cols - 1))))
    else:
        cells = grid.cells(df.sparkSession)
    whole = deal(cells, *keys, *CELL).join(deal(df, *keys, *CELL), [*keys, *CELL], "left")
    return deal(whole, *keys, "row")
