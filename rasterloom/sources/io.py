"""Reading and writing pixel, scene and feature tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.functions.expr import padded, rounded
from rasterloom.model import CELL, Grid
from rasterloom.operators.bands import unpivoted
from rasterloom.operators.composite import mosaic
from rasterloom.operators.resample import snap_to_grid

FEATURE_SCHEMA = "feature_id bigint, geom_type string, rings array<array<struct<x: double, y: double>>>"


def read_collection(spark: SparkSession, path: str, collection: str | None = None, years: Sequence[int] | None = None) -> DataFrame:
    """A collection's rows; both conditions prune partitions of a table laid out by collection and year."""
    df = spark.read.parquet(path)
    if collection is not None:
        df = df.where(F.col("collection") == collection)
    return df.where(F.col("year").isin(list(years))) if years is not None else df


#: Rows that one task writes of a collection, about; side of the stretches of rows by which they are dealt.
ROWS, STRIPE = 500_000, 512


def write_collection(df: DataFrame, path: str, rows: int, mode: str = "errorifexists") -> None:
    """A collection laid out by collection and year, as ``read_collection`` prunes it; ``rows`` is its number of rows.

    A writer sorts a task's rows by folder. Years and stripes of cells are dealt over as many tasks as the rows need, so
    that a task holds ROWS of them or so whatever the splits of the input are: a small file can make many rows.
    """
    stripe = F.floor(F.col("row") / STRIPE)
    dealt = df.repartition(max(1, -(-rows // ROWS)), "collection", "year", stripe)
    dealt.write.mode(mode).partitionBy("collection", "year").parquet(path)


def read_image(spark: SparkSession, path: str, bands: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*CELL, *bands) if bands else df


def read_features(spark: SparkSession, path: str, kind: str = "parquet", schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return {"parquet": reader.parquet, "csv": lambda p: reader.csv(p, header=True), "json": reader.json}[kind](path)


def features_from_rows(spark: SparkSession, rows: Sequence[tuple[int, Sequence[Sequence[tuple[float, float]]]]]) -> DataFrame:
    """Polygons written in place: (id, rings of (x, y))."""
    made = [(i, "Polygon", [[(float(x), float(y)) for x, y in ring] for ring in rings]) for i, rings in rows]
    return spark.createDataFrame(made, FEATURE_SCHEMA)


def read_tiles(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Rows of one file, or of the files below ``path`` whose path below it matches a regular expression, with that path
    in ``tile``; an error when no file matches. Names are listed and chosen first, so other files are never opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect()  # names alone
    below = lambda p: p.split(path.removeprefix("file://").rstrip("/") + "/", 1)[-1]
    chosen = {r.path: below(r.path) for r in listed if r.path.endswith(".parquet") and (pattern is None or re.search(pattern, below(r.path)))}
    if not chosen:
        raise FileNotFoundError(f"no tile in {path} matches {pattern or 'anything'}")
    at = F.input_file_name()
    return spark.read.parquet(*chosen).withColumn("tile", F.element_at(F.split(at, F.lit(re.escape(path.removeprefix("file://").rstrip("/")) + "/"), 2), -1))


def mosaic_tiles(tiles: DataFrame, band: str, order: Sequence[str] = ("tile",)) -> DataFrame:
    """One raster of the first band; where tiles overlap the last valid one in order is on top."""
    return mosaic(tiles, [band], CELL, order)


def read_named_layers(spark: SparkSession, layers: dict[str, str], band: str = "b1", clip_to: DataFrame | None = None) -> DataFrame:
    """Layers by name as bands of one image: one union with the layer's name, then one pivot with known values."""
    parts = [spark.read.parquet(p).select(*CELL, F.col(band).alias("value")).withColumn("layer", F.lit(n)) for n, p in layers.items()]
    return stack_layers(reduce(DataFrame.unionByName, parts), list(layers), clip_to)


def stack_layers(rows: DataFrame, names: Sequence[str], clip_to: DataFrame | None = None) -> DataFrame:
    """(layer, col, row, value) rows as one image with a band per name."""
    if clip_to is not None:
        from rasterloom.operators.zonal import clip

        rows = clip(rows, clip_to)
    return rows.groupBy(*CELL).pivot("layer", list(names)).agg(F.max("value"))


def write_table_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(path, header=True)


write_stats_csv = write_table_csv


def with_file_key(df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable file name, and those without (null, empty or with a separator), which are reported."""
    named = df.withColumn("file_key", key)
    good = F.coalesce(F.length("file_key") > 0, F.lit(False)) & ~F.coalesce(F.col("file_key").contains("/"), F.lit(False))
    return named.where(good), named.where(~good)


#: Side of the block of cells that one task writes of an image; files of a batch.
BLOCK, PARTS = 4096, 8


def blocks(df: DataFrame) -> list[Column]:
    """What deals an image's cells over tasks: blocks of BLOCK x BLOCK cells, where there are cells."""
    return [F.floor(F.col(c) / BLOCK) for c in CELL] if set(CELL) <= set(df.columns) else []


def write_images(df: DataFrame, path: str, key: Column, mode: str = "errorifexists") -> DataFrame:
    """One folder per image, named by the key; returns the rows that could not be named."""
    good, bad = with_file_key(df, key)
    good.repartition("file_key", *blocks(good)).write.mode(mode).partitionBy("file_key").parquet(path)
    return bad


def write_bands(df: DataFrame, path: str, key: Column, bands: Sequence[str], mode: str = "errorifexists") -> DataFrame:
    """One folder per image and band."""
    good, bad = with_file_key(df, key)
    unpivoted(good, bands).repartition("file_key", "band", *blocks(good)).write.mode(mode).partitionBy("file_key", "band").parquet(path)
    return bad


def write_on_grid(df: DataFrame, path: str, bands: Sequence[str], source: Grid, grid: Grid | None = None, scale: float | None = None, mode: str = "errorifexists") -> None:
    """Written at a scale or pinned to a lattice; not both."""
    if (grid is None) == (scale is None):
        raise ValueError("give a grid or a scale, not both")
    if grid is None:
        n = lambda k, step: max(1, round(k * abs(step) / scale))
        grid = Grid(n(source.n_cols, source.dx), n(source.n_rows, source.dy), source.x0, source.y0, scale, scale if source.dy > 0 else -scale, source.crs)
    (df if grid == source else snap_to_grid(df, bands, source, grid)).write.mode(mode).parquet(path)


def with_batch_name(df: DataFrame, batch: str = "batch", stem: str = "points") -> DataFrame:
    return df.withColumn("file_key", F.concat(F.lit(f"{stem}_batch"), padded(F.col(batch))))


def write_batched(df: DataFrame, path: str, batch: str = "batch", stem: str = "points", mode: str = "errorifexists") -> None:
    """All batches in one job, a folder of CSV each; a batch is dealt over up to PARTS files."""
    parts = F.pmod(F.xxhash64(*df.columns), F.lit(PARTS))
    with_batch_name(df, batch, stem).repartition("file_key", parts).write.mode(mode).partitionBy("file_key").csv(path, header=True)


def round_and_cast(df: DataFrame, bands: Sequence[str], dtype: str = "smallint") -> DataFrame:
    return df.withColumns({b: rounded(F.col(b), dtype) for b in bands})
