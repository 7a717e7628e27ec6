"""A folder of raster tiles as a data source that opens only the tiles a query can need.

``index_tiles`` makes one row per tile: its name, the box of its cells and their number. The source keeps that index and
no other list; filters on the tile's name and on ``col`` and ``row`` are pushed to it, tiles whose box or name can't
match are not opened, and what is left is planned in partitions of about equal size, each read as Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith
from pyspark.sql.pandas.types import from_arrow_schema

INDEX = "_tile_index"
#: Cells that a partition reads, as far as tiles allow.
CELLS = 4_000_000
BOX = ("col_lo", "col_hi", "row_lo", "row_hi")


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return pafs.LocalFileSystem(), path


def index_tiles(spark: SparkSession, path: str) -> DataFrame:
    """Writes the index of the Parquet tiles below ``path`` beside them: tile (its path below it), box and cells."""
    below = F.element_at(F.split(F.col("_metadata.file_path"), path.removeprefix("file://").rstrip("/") + "/", 2), -1)
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path).select(F.url_decode(below).alias("tile"), "col", "row")
    boxes = rows.groupBy("tile").agg(F.min("col").alias("col_lo"), F.max("col").alias("col_hi"), F.min("row").alias("row_lo"), F.max("row").alias("row_hi"), F.count("*").alias("cells"))
    boxes.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{INDEX}")
    return spark.read.parquet(f"{path.rstrip('/')}/{INDEX}")


@dataclass
class Wanted:
    """What pushed filters leave: a box of cells and conditions on the tile's name."""

    box: dict[str, int] = field(default_factory=dict)
    names: list[tuple[str, object]] = field(default_factory=list)

    def take(self, f: Filter) -> bool:
        """Notes the filter; whether it is of use here."""
        column = ".".join(f.attribute) if hasattr(f, "attribute") else ""
        if column in ("col", "row"):
            if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)) and f.value is not None:
                lo = f.value + isinstance(f, GreaterThan)  # cells are whole numbers
                self.box[f"{column}_lo"] = max(lo, self.box.get(f"{column}_lo", lo))
            if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)) and f.value is not None:
                hi = f.value - isinstance(f, LessThan)
                self.box[f"{column}_hi"] = min(hi, self.box.get(f"{column}_hi", hi))
            if isinstance(f, In) and f.value and None not in f.value:
                self.take(GreaterThanOrEqual(f.attribute, min(f.value)))
                self.take(LessThanOrEqual(f.attribute, max(f.value)))
            return False  # rows inside a tile are still to be tested
        if column != "tile":
            return False
        for kind, name in ((EqualTo, "is"), (In, "in"), (StringStartsWith, "starts"), (StringEndsWith, "ends"), (StringContains, "contains")):
            if isinstance(f, kind):
                self.names.append((name, f.value))
                return True
        return False

    def condition(self) -> ds.Expression | None:
        """On the index: boxes that meet, names that match."""
        tests = []
        for axis in ("col", "row"):
            if (lo := self.box.get(f"{axis}_lo")) is not None:
                tests.append(ds.field(f"{axis}_hi") >= lo)
            if (hi := self.box.get(f"{axis}_hi")) is not None:
                tests.append(ds.field(f"{axis}_lo") <= hi)
        import pyarrow.compute as pc

        tile = ds.field("tile")
        for how, value in self.names:
            tests.append({
                "is": lambda v: tile == v, "in": lambda v: tile.isin(list(v)), "starts": lambda v: pc.starts_with(tile, v),
                "ends": lambda v: pc.ends_with(tile, v), "contains": lambda v: pc.match_substring(tile, v),
            }[how](value))
        out = None
        for t in tests:
            out = t if out is None else out & t
        return out


class Tiles(InputPartition):
    def __init__(self, names: list[str]):
        super().__init__(names)


def read_tile(path: str, tile: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The batches of one tile, with its name; columns that it lacks are null."""
    fs, inner = _store(f"{path.rstrip('/')}/{tile}")
    with fs.open_input_file(inner) as f:
        file = pq.ParquetFile(f)
        there = [n for n in schema.names if n in file.schema_arrow.names]
        for batch in file.iter_batches(columns=there):
            made = {"tile": pa.array([tile] * batch.num_rows, pa.string())} | {n: batch.column(n).cast(schema.field(n).type) for n in there}
            yield pa.RecordBatch.from_arrays([made.get(n, pa.nulls(batch.num_rows, schema.field(n).type)) for n in schema.names], schema=schema)


class TileReader(DataSourceReader):
    def __init__(self, path: str, schema: pa.Schema, cells: int):
        self.path, self.schema, self.cells, self.wanted = path, schema, cells, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def partitions(self) -> list[Tiles]:
        fs, inner = _store(f"{self.path.rstrip('/')}/{INDEX}")
        out, held, size = [], [], 0
        scan = ds.dataset(inner, filesystem=fs, format="parquet").scanner(columns=["tile", "cells"], filter=self.wanted.condition())
        for batch in scan.to_batches():
            for tile, n in zip(batch.column("tile").to_pylist(), batch.column("cells").to_pylist()):
                if held and size + n > self.cells:
                    out.append(Tiles(held))
                    held, size = [], 0
                held.append(tile)
                size += n
        return [*out, Tiles(held)]

    def read(self, partition: Tiles) -> Iterator[pa.RecordBatch]:
        for tile in partition.value:
            yield from read_tile(self.path, tile, self.schema)


class TileSource(DataSource):
    """Options: path, and cells, the number that a partition reads."""

    @classmethod
    def name(cls) -> str:
        return "rasterloom_tiles"

    def _arrow(self) -> pa.Schema:
        path = self.options["path"].rstrip("/")
        fs, inner = _store(f"{path}/{INDEX}")
        first = ds.dataset(inner, filesystem=fs, format="parquet").head(1, columns=["tile"]).column("tile").to_pylist()
        if not first:
            raise FileNotFoundError(f"no tile in {path}")
        fs, inner = _store(f"{path}/{first[0]}")
        return pq.read_schema(inner, filesystem=fs).remove_metadata().append(pa.field("tile", pa.string()))

    def schema(self):
        return from_arrow_schema(self._arrow())

    def reader(self, schema) -> TileReader:
        from pyspark.sql.pandas.types import to_arrow_schema

        return TileReader(self.options["path"], to_arrow_schema(schema), int(self.options.get("cells", CELLS)))


def open_tiles(spark: SparkSession, path: str, cells: int = CELLS) -> DataFrame:
    """The cells of the indexed tiles below ``path``, with their tile's name in ``tile``; a table of the first tile's columns.

    Comparisons of ``col`` and ``row`` with numbers and of ``tile`` with names, their beginnings, ends or parts are pushed to
    the index. An index without tiles is an error.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TileSource)
    return spark.read.format("rasterloom_tiles").option("cells", cells).load(path)
