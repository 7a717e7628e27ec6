"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a demand in words (its target) and a schedule: how its weight changes over training, piecewise linear
in time from 0 to 1. The integral of the schedule is the share of the demand that is met by a time; its inverse turns
a document's place in the running demand of its source into a training position, by which documents are range-sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.shared import numbered, packed, with_running_total, written

WORD = r"[^\x20\x09-\x0D]+"
#: Weight over time of the 1st, 2nd and 3rd source, repeating: knots (time, weight).
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.5), (1.0, 2.0)))


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size), one row each.

    The sources in the order of their code points, null last, take the weights in turn. ``share`` times all words are
    dealt out by weight; no source gets over ``most`` times its size, and what is cut off is dealt again to the others
    until none is above. Equivalently target = min(most * size, level * weight) for one level, which is found from the
    sources sorted by size / weight: one pass over one row per source, never over documents.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (turn + 1).cast("int"))
    s = sizes.withColumn("turn", turn.cast("int")).withColumn("weight", w)
    cap = F.col("source_size") * F.lit(float(most))
    s = s.withColumn("cap", cap).withColumn("at", cap / F.col("weight"))
    full = Window.orderBy("at", F.col("source").isNull(), F.col("source").cast("binary"))
    everyone = Window.partitionBy()
    s = (
        s.withColumn("demand", F.sum("source_size").over(everyone) * F.lit(float(share)))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weight_from", F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level_here", (F.col("demand") - F.col("cap_before")) / F.col("weight_from"))
    )
    first = F.when(F.col("level_here") < F.col("at"), F.row_number().over(full))
    s = s.withColumn("first", first).withColumn("level", F.min_by("level_here", "first").over(everyone))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("level") * F.col("weight")))
    return s.select("source", "source_size", "turn", target.alias("target"))


def inverse_of(schedule: Sequence[tuple[float, float]], share: Column) -> Column:
    """The time at which the integral of the schedule, scaled to 1 in all, reaches ``share``.

    The integral is a parabola between two knots, so its inverse has a closed form in each piece.
    """
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        if not t1 > t0 or min(w0, w1) < 0:
            raise ValueError("times must rise and weights not be negative")
        pieces.append((t0, w0, t1, w1, total))
        total += (t1 - t0) * (w0 + w1) / 2
    if not total > 0:
        raise ValueError("a schedule needs a positive weight somewhere")
    y = share * F.lit(total)
    out = F.lit(float(schedule[-1][0]))
    for t0, w0, t1, w1, before in reversed(pieces):
        if w0 + w1 == 0:
            continue
        z = F.greatest(y - F.lit(before), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2 * slope) * z, F.lit(0.0)))
        dt = F.try_divide(F.lit(2.0) * z, F.lit(w0) + root)  # the stable root; also right for a slope of 0
        end = before + (t1 - t0) * (w0 + w1) / 2
        out = F.when(y <= F.lit(end), F.lit(t0) + F.coalesce(dt, F.lit(0.0))).otherwise(out)
    return F.least(F.greatest(out, F.lit(float(schedule[0][0]))), F.lit(float(schedule[-1][0])))


def curriculum(df: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, schedules=SCHEDULES, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, taken and positions (one training position per copy) of every row.

    A source's words are laid out again and again in the order of a hash of the document until the demand is reached:
    a copy is taken if it begins within the demand and its middle does not lie beyond it, so the words taken miss the
    target by half a document at most, and a document is taken whole or not at all, at most ceil(most) times.
    Null texts and texts without words have size 0 and are never taken (they meet no demand). Null sources are one
    source, the last. Rows that are alike in everything differ at most in which of them is taken. An empty table gives
    an empty one. Only doc_id, source, size and hash are shuffled, never texts.
    """
    slim = df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"), F.xxhash64(F.col(doc_id), F.col(text)).alias("h"))
    return _assign(written(slim, "mix"), weights, share, most, schedules)


def _assign(slim: DataFrame, weights, share, most, schedules) -> DataFrame:
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "t_source")
    placed = with_running_total(slim, ["source"], "h", ["doc_id", "size"], "size", "begin")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    copies = int(-(-most // 1))
    n = len(weights)
    middle = lambda k: F.col("begin") + F.lit(k) * F.col("source_size") + F.col("size") / F.lit(2.0)
    slots = []
    for k in range(copies):
        share_here = F.try_divide(middle(k), F.col("target"))
        at = inverse_of(schedules[-1 % len(schedules)], share_here)
        for turn in range(n):
            at = F.when(F.col("turn") == turn, inverse_of(schedules[turn % len(schedules)], share_here)).otherwise(at)
        slots.append(F.when((F.col("size") > 0) & (middle(k) <= F.col("target")), at))
    return joined.select("doc_id", "source", "size", "source_size", "target", "h", F.array_compact(F.array(*slots)).alias("positions")).withColumn(
        "taken", F.col("size") * F.size("positions")
    )


def in_training_order(df: DataFrame, position: str = "position") -> DataFrame:
    """Range-sorts rows by position: each partition holds one stretch of the training, in order. Rows without a position come
    last, equal positions by hash; no rows give none."""
    return df.repartitionByRange(F.col(position).asc_nulls_last(), F.col("h")).sortWithinPartitions(F.col(position).asc_nulls_last(), "h")


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df``, each as often as it is taken, in training order, with the columns of ``df`` alone.

    A row finds its assignment by the hash of doc_id and text and, among rows alike in both, by its number. Whole rows
    are shuffled twice: to meet their assignment, and into training order. Texts without words, null ones too, are never
    taken; null ids and sources are values like others; no rows give none.
    """
    keyed = packed(df).withColumn("h", F.xxhash64(F.col("_row.doc_id"), F.col("_row.text")))
    took = written(curriculum(df, **options).select(F.col("h").alias("th"), "positions"), "taken")
    took = numbered(took, "th", "tn", "positions")
    rows = numbered(keyed, "h", "n")
    placed = rows.join(took, (F.col("h") == F.col("th")) & (F.col("n") == F.col("tn")))
    placed = placed.select("_row", "h", F.explode("positions").alias("position"))
    return in_training_order(placed).select("_row.*")
