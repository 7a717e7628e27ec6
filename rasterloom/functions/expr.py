"""Null-safe scalar building blocks: a masked input gives a masked output."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double; null where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def normalized_difference(a: Column, b: Column) -> Column:
    return ratio(a - b, a + b)


def clamp(c: Column, lo: float, hi: float) -> Column:
    """Bounded to [lo, hi]; null stays null (``greatest`` alone would turn it into a bound)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def at_least(c: Column, lo: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def where_mask(df: DataFrame, keep: Column, bands: Sequence[str]) -> DataFrame:
    """Masks the bands where ``keep`` is false or itself masked; other columns stay."""
    return df.withColumns({b: F.when(keep, F.col(b)) for b in bands})


def unmask(c: Column, value: float | Column = 0.0) -> Column:
    return F.coalesce(c, value if isinstance(value, Column) else F.lit(value))


def is_masked(c: Column) -> Column:
    """1 where the pixel is missing, else 0."""
    return c.isNull().cast("int")


def remap(c: Column, old: Sequence[int], new: Sequence[int], default: int | None = None) -> Column:
    """A code table; unknown codes become null, or ``default`` (null input included) where one is given."""
    table = F.create_map(*[F.lit(x) for pair in zip(old, new) for x in pair])
    out = F.try_element_at(table, c.cast("int"))
    return out if default is None else F.coalesce(out, F.lit(default))


def argmax(columns: Sequence[Column]) -> Column:
    """Index of the largest value, the first of equals; null if any value is null."""
    values = F.array(*columns)
    some_null = F.exists(values, lambda x: x.isNull())
    return F.when(~some_null, F.array_position(values, F.array_max(values)).cast("int") - 1)


def expression(text: str, variables: Mapping[str, str]) -> Column:
    """A formula over aliases of columns, e.g. ("(n - r) / (n + r)", {"n": "B8", "r": "B4"}); division is null-safe
    only if written with try_divide."""
    names = "|".join(sorted(map(re.escape, variables), key=len, reverse=True))
    return F.expr(re.sub(rf"\b({names})\b", lambda m: f"`{variables[m[1]]}`", text))


def to_int16(c: Column) -> Column:
    """Clamped to the range first: a cast beyond it would fail."""
    return clamp(c, -32768, 32767).cast("smallint")


def rounded(c: Column, dtype: str) -> Column:
    """Half-even rounding for whole-number types, then the cast."""
    whole = dtype in ("smallint", "int", "bigint", "tinyint")
    return to_int16(F.bround(c, 0)) if dtype == "smallint" else (F.bround(c, 0) if whole else c).cast(dtype)


def padded(c: Column, width: int = 2) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def renamed_by(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """Columns renamed by a regular expression, as names of bands after a reducer."""
    return df.withColumnsRenamed({c: re.sub(pattern, replacement, c) for c in df.columns if re.search(pattern, c)})
