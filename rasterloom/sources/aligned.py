"""Aligned rasters laid out for joins without a shuffle: tables bucketed by square blocks of cells.

Rasters of one lattice that are written with the same number of buckets have a block's cells in the bucket of the same
number, so their joins read bucket against bucket: the exchange is paid once, when a raster is written, and never by
the masks, stacks and forest ranges that read it afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.expr import where_mask
from rasterloom.model import CELL

#: Side of a block in cells; its files are sorted by it, so a box of cells reads few of their row groups.
BLOCK = 64
KEYS = ["block", *CELL]
#: Rows of a bucket, about: a task sorts one when it is written and again when it is joined.
ROWS = 500_000


def buckets_for(rows: int, least: int = 4) -> int:
    """Buckets for rasters of which the largest has so many rows: their number grows with the rows, not what a task holds."""
    return max(least, -(-rows // ROWS))


def block_of(side: int = BLOCK) -> Column:
    """One number per block."""
    return F.shiftleft(F.floor(F.col("row") / side), 32) + F.floor(F.col("col") / side)


def write_aligned(df: DataFrame, table: str, path: str, buckets: int, side: int = BLOCK, mode: str = "errorifexists") -> None:
    """A raster (or a collection) as a table with ``buckets`` files, one a bucket; all that are to be joined need the same
    number and side. Rows without a cell are an error of the writer's: they would meet nothing."""
    laid = df.withColumn("block", block_of(side)).repartition(buckets, "block")
    laid.write.mode(mode).format("parquet").option("path", path).bucketBy(buckets, "block").sortBy("block", "row", "col").saveAsTable(table)


def read_aligned(spark: SparkSession, table: str, box: tuple[int, int, int, int] | None = None) -> DataFrame:
    """The table's rows, of a box of cells (first and last column, first and last row) if one is given."""
    df = spark.table(table)
    return df if box is None else df.where(F.col("col").between(box[0], box[1]) & F.col("row").between(box[2], box[3]))


def join_aligned(first: DataFrame, *others: DataFrame, how: str = "inner") -> DataFrame:
    """Rasters read by ``read_aligned`` joined cell by cell, bucket against bucket."""
    first.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")  # the block alone deals the rows
    out = first
    for other in others:
        out = out.hint("merge").join(other.hint("merge"), KEYS, how)
    return out


def mask_aligned(df: DataFrame, other: DataFrame, keep: Column, bands: Sequence[str]) -> DataFrame:
    """Bands of ``df`` where ``keep``, a condition on the other raster's bands, holds; without its cell they are masked."""
    return where_mask(join_aligned(df, other, how="left"), keep, bands).select(*df.columns)
