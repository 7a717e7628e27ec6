"""Inverse-distance interpolation of scattered samples."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.functions.expr import ratio
from rasterloom.model import CELL
from rasterloom.operators.composite import sample_order


def band_samples(df: DataFrame, bands: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """(band, col, row, value): n valid pixels of each band, chosen as ``sample`` does, in one pass for all bands.

    Every task keeps its own first n of a band, batch by batch, so it holds and shuffles little more than that.
    """
    order = ["_place", *CELL]
    placed = df.select(sample_order(seed).alias("_place"), *[F.col(c).cast("int").alias(c) for c in CELL], *[F.col(f"`{b}`").cast("double").alias(f"_v{i}") for i, b in enumerate(bands)])

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, pa.Table] = {}
        for batch in batches:
            for i in range(len(bands)):
                found = pa.table([batch.column(c) for c in order] + [batch.column(f"_v{i}")], names=[*order, "value"])
                found = found.filter(pc.is_valid(found["value"]))
                if i in kept:
                    if 0 < n == len(kept[i]):
                        found = found.filter(pc.less_equal(found["_place"], kept[i]["_place"][-1]))
                    found = pa.concat_tables([kept[i], found])
                kept[i] = found.sort_by([(c, "ascending") for c in order]).slice(0, n).combine_chunks()
        for i, found in kept.items():
            yield from found.append_column("band", pa.array([bands[i]] * len(found), pa.string())).to_batches()

    valid = placed.mapInArrow(least, "_place long, col int, row int, value double, band string")
    first = Window.partitionBy("band").orderBy(*order)
    return valid.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= n).select("band", *CELL, "value")


def idw(df: DataFrame, bands: Sequence[str], reach: float, gamma: float = 2.0, n: int = 1000, seed: int = 0, gaps_only: bool = False, statistics: bool = False) -> DataFrame:
    """Every cell's value from up to n sample pixels a band within ``reach`` cells, weighted by 1 / distance^gamma.

    A sample at the cell is its value; without samples in reach the samples' mean is. ``gaps_only`` keeps valid cells;
    ``statistics`` adds <band>_mean and <band>_stdDev (population) of the samples. The samples, n a band, are drawn first
    and put into bins of side ``reach``; each bin lists those of the 3x3 bins around it. That index is broadcast and the
    raster is read once for all bands, without a shuffle.
    """
    side = max(1, math.ceil(reach))
    spark = df.sparkSession
    drawn = spark.createDataFrame(band_samples(df, bands, n, seed).toArrow())  # n rows a band: a parameter bounds them
    bin_of = lambda c: F.floor(F.col(c) / side).cast("int")
    around = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    near = drawn.withColumn("_o", around).select((bin_of("col") + F.col("_o.i")).alias("_bc"), (bin_of("row") + F.col("_o.j")).alias("_br"), "band", F.struct("col", "row", "value").alias("s"))
    listed = [F.sort_array(F.collect_list(F.when(F.col("band") == b, F.col("s")))).alias(f"_near{i}") for i, b in enumerate(bands)]
    index = near.groupBy("_bc", "_br").agg(*listed)
    stats = drawn.agg(*[f(F.when(F.col("band") == b, F.col("value"))).alias(f"_{m}{i}") for i, b in enumerate(bands) for m, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    cells = df.withColumn("_bc", bin_of("col")).withColumn("_br", bin_of("row")).join(F.broadcast(index), ["_bc", "_br"], "left").crossJoin(F.broadcast(stats))

    def mixed(near: str) -> Column:
        off = lambda s, c: (s[c] - F.col(c)).cast("bigint")
        d2 = lambda s: off(s, "col") * off(s, "col") + off(s, "row") * off(s, "row")
        here = F.filter(near, lambda s: d2(s) <= reach * reach)
        nothing = F.struct(F.lit(None).cast("double").alias("at"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("w"))
        weight = lambda s: F.pow(d2(s).cast("double"), F.lit(-gamma / 2))

        def add(t: Column, s: Column) -> Column:
            zero = d2(s) == 0
            return F.struct(
                F.when(zero, F.greatest(t["at"], s["value"])).otherwise(t["at"]).alias("at"), F.when(zero, t["sum"]).otherwise(t["sum"] + s["value"] * weight(s)).alias("sum"), F.when(zero, t["w"]).otherwise(t["w"] + weight(s)).alias("w"),
            )

        return F.aggregate(here, nothing, add, lambda t: F.coalesce(t["at"], ratio(t["sum"], t["w"])))

    made = []
    for i, b in enumerate(bands):
        value = F.coalesce(mixed(f"_near{i}"), F.col(f"_mean{i}"))
        made.append((F.coalesce(F.col(f"`{b}`"), value) if gaps_only else value).alias(b))
        if statistics:
            made += [F.col(f"_mean{i}").alias(f"{b}_mean"), F.col(f"_sd{i}").alias(f"{b}_stdDev")]
    return cells.select(*CELL, *made)
