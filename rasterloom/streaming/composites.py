"""Composites kept up to date from a stream of pixels.

Pixels carry their scene's time; windows of fixed length tumble over it. Partial aggregates are the state, and late
pixels are taken until the watermark passes. The batch form is operators.composite.composite.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.model import CELL
from rasterloom.operators.composite import reducer


def streaming_composite(pixels: DataFrame, bands: Sequence[str], statistic: str = "mean", length: str = "120 days", late: str = "30 days", time: str = "time_start") -> DataFrame:
    """(start_date, col, row, bands): one row per window and cell, final when the watermark has passed the window."""
    fn = reducer(statistic)
    made = pixels.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), *CELL).agg(*[fn(F.col(b)).alias(b) for b in bands])
    return made.select(F.col("w.start").alias("start_date"), *CELL, *bands)
