"""Scene tables: metadata filters, time windows, sensor priority. Pixels are read only for the scenes that remain."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.model import CELL


def filter_date(df: DataFrame, start, end, time: str = "time_start") -> DataFrame:
    """start <= time < end."""
    return df.where((F.col(time) >= F.lit(start).cast("timestamp")) & (F.col(time) < F.lit(end).cast("timestamp")))


def filter_bounds(df: DataFrame, min_x: float, min_y: float, max_x: float, max_y: float) -> DataFrame:
    """Scenes whose box meets the given one."""
    return df.where((F.col("min_x") <= max_x) & (F.col("max_x") >= min_x) & (F.col("min_y") <= max_y) & (F.col("max_y") >= min_y))


def filter_calendar(df: DataFrame, lo: int, hi: int, unit: str = "month", time: str = "time_start") -> DataFrame:
    part = {"month": F.month, "year": F.year, "day_of_year": F.dayofyear}[unit]
    return df.where(part(time).between(lo, hi))


def filter_property(df: DataFrame, *predicates: Column, any_of: bool = False) -> DataFrame:
    """All of the predicates, or any of them."""
    keep = predicates[0]
    for p in predicates[1:]:
        keep = keep | p if any_of else keep & p
    return df.where(keep)


def filter_has_bands(df: DataFrame, required: Sequence[str], bands: str = "bands") -> DataFrame:
    return df.where(F.size(F.array_except(F.array(*[F.lit(b) for b in required]), F.col(bands))) == 0)


def first_scene(df: DataFrame, image: str = "image_id", time: str = "time_start") -> DataFrame:
    """The earliest scene (lowest id of equals): the first row in order, found without a sort of the table."""
    return df.orderBy(time, image).limit(1)


def first_rows(df: DataFrame, n: int, key: str = "feature_id") -> DataFrame:
    return df.orderBy(key).limit(n)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def dates_within(periods: DataFrame, step: int = 1, unit: str = "year") -> DataFrame:
    """start_date: of each period (start, end) every ``step`` units from the start while within the rounded number of
    units to the end."""
    months = {"year": 12, "month": 1}.get(unit)
    a, b = F.col("start").cast("date"), F.col("end").cast("date")
    if months:
        n = F.round(F.months_between(b, a) / months).cast("int")
        at = F.add_months(a, F.col("i") * months)
    else:
        days = {"day": 1, "week": 7}[unit]
        n = F.round(F.datediff(b, a) / days).cast("int")
        at = F.date_add(a, F.col("i") * days)
    return periods.select("start", F.explode(F.sequence(F.lit(0), n, F.lit(step))).alias("i")).select(at.alias("start_date"))


def date_list(spark: SparkSession, start: date, end: date, step: int = 1, unit: str = "year") -> DataFrame:
    """``dates_within`` one given period."""
    return dates_within(spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end")), step, unit)


def windows_from(starts: DataFrame, days: int) -> DataFrame:
    """[start_date, end_date) windows; they may overlap or leave gaps."""
    return starts.select("start_date", F.date_add("start_date", days).alias("end_date"))


#: Windows up to which they are broadcast and each scene is tested against all; more meet scenes by stretches of time.
FEW_WINDOWS = 256


def join_windows(scenes: DataFrame, windows: DataFrame, time: str = "time_start", few: int = FEW_WINDOWS) -> DataFrame:
    """Each scene with every window its time lies in.

    Windows are counted. Few of them (one per composite) are broadcast. More are joined by stretches of time as long as
    the mean window: a window is listed in each stretch that it meets, two or so, a scene in its own, and those that
    share one are tested; no scene is held against all windows. Pixels follow by an equi-join on the image.
    """
    t = F.col(time)
    inside = (t >= F.col("start_date")) & (t < F.col("end_date"))
    n, days = windows.agg(F.count("*"), F.avg(F.greatest(F.datediff("end_date", "start_date"), F.lit(1)))).first()
    if n <= few:
        return scenes.join(F.broadcast(windows), inside)
    length = max(1, round(days))
    stretch = lambda c: F.floor(F.datediff(c, F.lit("1970-01-01").cast("date")) / length)
    listed = windows.where("start_date < end_date").withColumn("_stretch", F.explode(F.sequence(stretch("start_date"), stretch("end_date"))))
    return scenes.withColumn("_stretch", stretch(t)).join(listed, "_stretch").where(inside).drop("_stretch")


#: Sensors of the merge.
OLD, NEW, LAST_RESORT = "LT05", ("LC08", "LC09"), "LE07"


def sensor_priority(scenes: DataFrame, window: str = "start_date", sensor: str = "sensor") -> DataFrame:
    """Scenes of the sensors a window uses: the old one and the new ones where there, else the last resort.

    What is there is counted per window in scenes, one row per window, and joined back.
    """
    has = scenes.groupBy(window).agg(F.max((F.col(sensor) == OLD).cast("int")).alias("_old"), F.max(F.col(sensor).isin(*NEW).cast("int")).alias("_new"))
    s = F.col(sensor)
    use = ((s == OLD) & (F.col("_old") == 1)) | (s.isin(*NEW) & (F.col("_new") == 1)) | ((s == LAST_RESORT) & (F.col("_old") + F.col("_new") == 0))
    return scenes.join(has, window).where(use).drop("_old", "_new")


def floor_windows(windows: DataFrame, earliest: date) -> DataFrame:
    """Windows moved to begin no earlier than the archive does, of unchanged length; those that become one are one."""
    start = F.greatest(F.col("start_date"), F.lit(earliest))
    return windows.select(start.alias("start_date"), F.date_add(start, F.datediff("end_date", "start_date")).alias("end_date")).distinct()


def with_empty_windows(series: DataFrame, windows: DataFrame, cells: DataFrame, window: str = "start_date") -> DataFrame:
    """A series with every cell of the windows that have no scene at all, all bands masked there."""
    left = windows.select(window).join(series.select(window).distinct(), window, "left_anti")
    empty = cells.select(*CELL).crossJoin(F.broadcast(left))  # windows are few; these rows are the result
    return series.unionByName(empty, allowMissingColumns=True)


def parsed_dates(df: DataFrame, text: str, out: str, formats: Sequence[str] = ("yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "yyyy_MM_dd")) -> DataFrame:
    """Adds the date that a text holds, whole or as a part (a file name, an image id), by the first format that fits; null
    where none does or the day does not exist."""
    found = []
    for f in formats:
        pattern = re.escape(f).replace("yyyy", r"\d{4}").replace("MM", r"\d{2}").replace("dd", r"\d{2}")
        part = F.regexp_extract(F.col(text), rf"(?<!\d)({pattern})(?!\d)", 1)
        found.append(F.try_to_date(F.nullif(part, F.lit("")), f))
    return df.withColumn(out, F.coalesce(*found))


def with_series_columns(df: DataFrame, start: str = "start_date") -> DataFrame:
    return df.withColumn("month", F.month(start)).withColumn("year", F.year(start))
