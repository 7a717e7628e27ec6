"""Band stacks: selecting, joining and naming bands."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rasterloom.model import CELL, bands_of


def select_bands(df: DataFrame, names: Sequence[str] | str, rename: Sequence[str] | None = None, keys: Sequence[str] = ("image_id", "col", "row")) -> DataFrame:
    """Bands by name, or by a regular expression over whole names, renamed in order if asked."""
    keys = [k for k in keys if k in df.columns]
    picked = [c for c in df.columns if c not in keys and re.fullmatch(names, c)] if isinstance(names, str) else list(names)
    new = list(rename or picked)
    if len(new) != len(picked):
        raise ValueError("as many new names as bands are needed")
    return df.select(*keys, *[F.col(f"`{a}`").alias(b) for a, b in zip(picked, new)])


def select_requested(df: DataFrame, bands: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """The wanted bands of the variables that any of them needs: names decide, so only those columns are read."""
    needed = {v for v in variables if any(b.split("_")[0] == v for b in bands)}
    there = [b for b in bands if b in df.columns and b.split("_")[0] in needed]
    return df.select(*[k for k in ("image_id", *CELL) if k in df.columns], *there)


def add_bands(a: DataFrame, b: DataFrame, overwrite: bool = False, keys: Sequence[str] = CELL) -> DataFrame:
    """Bands of two aligned images on all cells of either; same-named bands need ``overwrite``, which takes b's."""
    keys = list(keys)
    mine, theirs = [c for c in a.columns if c not in keys], [c for c in b.columns if c not in keys]
    if (both := set(mine) & set(theirs)) and not overwrite:
        raise ValueError(f"bands in both: {sorted(both)}")
    return a.drop(*both).join(b, keys, "full_outer").select(*keys, *[c for c in mine if c not in both], *theirs)


def combine_images(images: Sequence[DataFrame], prefix: bool = True, keys: Sequence[str] = CELL) -> DataFrame:
    """All images' bands in one, prefixed by the image's place in the list; without a prefix duplicates are an error.

    One union and one aggregation by cell, whatever the number of images.
    """
    keys = list(keys)
    named = [[(c, f"{i}_{c}" if prefix else c) for c in df.columns if c not in keys] for i, df in enumerate(images)]
    names = [n for x in named for _, n in x]
    if len(set(names)) != len(names):
        raise ValueError("bands of the same name; use prefix")
    parts = [df.select(*keys, *[F.col(f"`{c}`").alias(n) for c, n in x]) for df, x in zip(images, named)]
    union = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return union.groupBy(*keys).agg(*[F.max(F.col(f"`{n}`")).alias(n) for n in names])


def to_bands(df: DataFrame, images: Mapping | Sequence, bands: Sequence[str], image: str = "image_id") -> DataFrame:
    """A collection as one image, bands <name>_<band>; ``images`` maps the known ids to names (or lists the ids)."""
    names = dict(images) if isinstance(images, Mapping) else {k: str(k) for k in images}
    made = [F.max(F.when(F.col(image) == F.lit(k), F.col(f"`{b}`"))).alias(f"{n}_{b}") for k, n in names.items() for b in bands]
    return df.where(F.col(image).isin(list(names))).groupBy(*CELL).agg(*made)


def asset_image(rows: DataFrame, asset: str, images: Sequence[str], chosen: Sequence[str] | None = None, band: str = "b1") -> DataFrame:
    """An asset's images (asset, image_id, col, row, band) as one, without the trailing _<band> in the names.

    Chosen images go by their own names; all of them, where none are chosen, by <asset>_<image>.
    """
    stacked = to_bands(rows.where(F.col("asset") == asset), [i for i in images if chosen is None or i in chosen], [band])
    name = lambda c: ("" if chosen else f"{asset}_") + re.sub(f"_{band}$", "", c)
    return stacked.withColumnsRenamed({c: name(c) for c in stacked.columns if c not in CELL})


def suffixed(df: DataFrame, suffix: str, but: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c not in but})


def copy_properties(df: DataFrame, scenes: DataFrame, names: Sequence[str], image: str = "image_id") -> DataFrame:
    return df.join(scenes.select(image, *names), image, "left")


def unpivoted(df: DataFrame, bands: Sequence[str] | None = None) -> DataFrame:
    """One row per image, cell and band."""
    bands = list(bands or bands_of(df))
    rest = [c for c in df.columns if c not in bands]
    return df.unpivot(rest, [F.col(b).cast("double").alias(b) for b in bands], "band", "value")
