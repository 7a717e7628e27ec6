"""Substring deduplication by content-defined chunking.

A gear hash rolls over a text's words and a chunk ends where its low bits are small, so cuts depend on the last few
words only and a passage is cut alike wherever it stands. What is compared, by a 128-bit digest of the words, is a chunk
with those after it that make one word less than the least span: such units overlap by so much that every least span
inside successive repeated units lies in one of them and is itself repeated. The first occurrence in the corpus, by
(doc_id, place), is kept. Successive repeated units are reported as spans of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.shared import BROADCAST_ROWS, DEALT, met, written

#: The cut looks at the low 5 bits of the gear hash, so at 5 words; a chunk ends at 10 of the 32 values, but not where
#: one of the two places before would end one too, so a chunk has 3 words or more and 7 on average.
BITS, CUTS, APART = 5, 10, 2
#: Farther than ALONE words from any such cut, and there only, a chunk also ends where the hash is the smallest of the
#: LOW words on either side; equal hashes are equal words and end one each, but CLOSE words or more apart.
ALONE, LOW, CLOSE = 4, 3, 3
CACHE = 400_000
#: Values in a batch that a task sends.
BATCH = 100_000

_UNITS = "key long, doc_id long, at int, words int, d0 long, d1 long"


class _Gear(dict):
    """A random number per word: the table of the gear hash, over words in place of bytes."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = g = xxhash.xxh3_64_intdigest(word.encode(), seed=77)
        return g


def cut(words: list[str], gear: dict) -> list[int]:
    """Ends of the chunks. Each depends on the words around it alone.

    In a phrase said over and over the fallback cuts come once a period, or once in so many periods as make CLOSE words,
    so its chunks are alike wherever the repetition begins.
    """
    n = len(words)
    if not n:
        return []
    g = np.array([gear[w] for w in words], np.uint64)
    h = g.copy()
    for j in range(1, min(BITS, n)):
        h[j:] += g[: n - j] << np.uint64(j)
    low = (h & np.uint64((1 << BITS) - 1)) < CUTS
    here = low.copy()
    for j in range(1, min(APART + 1, n)):
        here[j:] &= ~low[:-j]
    near, least = here.copy(), h.copy()
    for j in range(1, min(ALONE + 1, n)):
        near[j:] |= here[:-j]
        near[:-j] |= here[j:]
    for j in range(1, min(LOW + 1, n)):
        np.minimum(least[j:], h[:-j], out=least[j:])
        np.minimum(least[:-j], h[j:], out=least[:-j])
    last, more = -CLOSE, []
    for i in np.flatnonzero((h == least) & ~near).tolist():
        if i - last >= CLOSE:
            more.append(i)
            last = i
    here[more] = True
    ends = (np.flatnonzero(here) + 1).tolist()
    if not ends or ends[-1] != n:
        ends.append(n)
    return ends


def units(ends: list[int], least: int) -> list[tuple[int, int]]:
    """(start, end) of the units over the chunks with those ends: a chunk and ``least`` - 1 words or more after it.

    The last chunk that has so many after it also makes a unit up to the end of the text; a text of ``least`` words or
    more in which no chunk has them is one unit.
    """
    out, j = [], 0
    for i, a in enumerate([0, *ends[:-1]]):
        while j < len(ends) and ends[j] < ends[i] + least - 1:
            j += 1
        if j == len(ends):
            break
        out.append((a, ends[j]))
    if not ends:
        return []
    whole = (out[-1][0] if out else 0, ends[-1])
    return out if out and out[-1] == whole or ends[-1] < least else [*out, whole]


def _units(rows: DataFrame, least: int) -> DataFrame:
    """The units of every row (key, doc_id, text), and one row with at = -1 and its number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = _Gear()
        for batch in batches:
            got: list[list] = [[], [], [], []]
            digests: list[bytes] = []

            def full() -> pa.RecordBatch:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [pa.array(x, k) for x, k in zip(got, kinds)] + [pa.array(np.ascontiguousarray(d[:, i])) for i in (0, 1)]
                return pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "at", "words", "d0", "d1"])

            for key, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = (text or "").split()
                spans = units(cut(words, gear), least)
                got[0] += [key] * (len(spans) + 1)
                got[1] += [doc] * (len(spans) + 1)
                got[2] += [-1, *(a for a, _ in spans)]
                got[3] += [len(words), *(e - a for a, e in spans)]
                digests += [bytes(16), *(xxhash.xxh3_128_digest(" ".join(words[a:e]).encode()) for a, e in spans)]
                if len(digests) > BATCH:
                    yield full()
                    got, digests = [[], [], [], []], []
            if digests:
                yield full()

    return rows.mapInArrow(run, _UNITS)


def _runs(places: DataFrame, name: str) -> DataFrame:
    """Per key the [start, end) ranges that overlapping or adjacent units cover, and their sum."""
    order = Window.partitionBy("key").orderBy("at", "words")
    end = F.col("at") + F.col("words")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("at") > reached, F.lit(True)).cast("int")
    runs = places.withColumn("run", F.sum(fresh).over(order)).groupBy("key", "run").agg(F.min("at").alias("start"), F.max(end).alias("end"))
    return runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(name), F.sum(F.col("end") - F.col("start")).alias(f"{name}_words"))


def _spans(places: DataFrame, least: int) -> DataFrame:
    """Per key the [start, end) ranges of repeated units, and their sum.

    Units that overlap by ``least`` - 1 words make one range. Where they overlap by less, what they cover together may
    stand nowhere else: the second range then begins where the first ends.
    """
    order = Window.partitionBy("key").orderBy("at", "words")
    end = F.col("at") + F.col("words")
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.coalesce(F.col("at") + least - 1 > reached, F.lit(True)).cast("int")
    begin = F.greatest(F.col("at"), F.coalesce(reached, F.lit(0)))
    cut = places.withColumn("run", F.sum(fresh).over(order)).withColumn("begin", F.when(fresh == 1, begin))
    runs = cut.groupBy("key", "run").agg(F.min("begin").alias("start"), F.max(end).alias("end")).where("end > start")
    return runs.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"), F.sum(F.col("end") - F.col("start")).alias("spans_words"))


def _copies(rows: DataFrame) -> DataFrame:
    """One row (key, doc_id, n_words, first) per row of the corpus: of rows alike one is first. Those repeated often are
    dealt over tasks before they are listed again."""
    each = rows.groupBy("key", "doc_id", "n_words").agg(F.count("*").alias("times"))
    dealt = each.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("times") - 1) / DEALT).cast("int"))))
    dealt = dealt.repartition("key", "_part")
    here = F.least(F.lit(DEALT), F.col("times") - F.col("_part") * DEALT).cast("int")
    listed = dealt.withColumn("_i", F.explode(F.sequence(F.lit(1), here)))
    return listed.select("key", "doc_id", "n_words", ((F.col("_part") == 0) & (F.col("_i") == 1)).alias("first"))


def repeated_spans(df: DataFrame, min_words: int = 16, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, repeat_words, removed_words, spans, removed and repeated of every row.

    Words are cut at white space. A unit (``units``) is repeated if another place of the corpus holds the same words.
    spans: the [start, end) word ranges of successive repeated units; all ``min_words`` successive words in one of them
    occur at another place too; repeat_words is their sum. removed: the ranges of units that are not the first of their
    kind, by (doc_id, hash of the row, place), so that cutting them out leaves every passage once, if not always in one
    piece; removed_words is their sum. A passage of over 50 words has 38 or so between its own first and last cuts, so it
    is found whatever stands around it (of 6,000 of 51 random words 2 were missed). Null and empty texts have no words and
    are never repeated; copies of whole texts of ``min_words`` or more repeat from end to end. Rows of one doc_id with
    different texts are different documents; null doc_ids come last. Of rows alike in doc_id and text one is the first,
    and all of the others is removed. doc_id is cast to long. An empty table gives an empty one; other columns are
    ignored.
    """
    rows = df.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("key"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = written(_units(rows, min_words), "units")
    texts = found.where("at = -1").select("key", "doc_id", F.col("words").cast("long").alias("n_words"))
    chunks = found.where("at >= 0").withColumn("doc_id", F.coalesce("doc_id", F.lit(2**63 - 1)))
    digest = ["d0", "d1"]
    kinds = chunks.groupBy(*digest).agg(F.min("doc_id").alias("holder"), F.count("*").alias("times")).where("times > 1")
    kinds = written(kinds, "kinds")
    many = kinds.where(F.col("times") > DEALT).select(*digest, F.ceil(F.col("times") / DEALT).cast("int").alias("parts"))
    n = many.count()
    many = None if n == 0 else F.broadcast(many) if n <= BROADCAST_ROWS else many
    repeats = met(chunks, kinds.drop("times"), digest, ["key", "at"], many)
    repeats = repeats.groupBy("key", "at", "words", *digest).agg(F.max(F.col("doc_id") == F.col("holder")).alias("held"))  # rows alike count once
    repeats = written(repeats, "repeats")
    shared = texts.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b")
    if not shared.isEmpty():  # documents of one doc_id, among which the least key holds what both have
        least = repeats.where("held").groupBy(*digest).agg(F.min("key").alias("least"))
        repeats = met(repeats, least, digest, ["key", "at"], many).withColumn("held", F.col("held") & (F.col("key") == F.col("least"))).drop("least")
    again = F.row_number().over(Window.partitionBy("key", *digest).orderBy("at")) > 1
    repeats = repeats.repartition("key").select("key", "at", "words", (~F.col("held") | again).alias("later"))
    per = _spans(repeats, min_words).join(_runs(repeats.where("later"), "removed"), "key", "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    out = _copies(texts).join(per, "key", "left")
    whole = ~F.col("first") & (F.col("n_words") >= min_words)
    every = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    removed = F.when(whole, every).otherwise(F.coalesce("removed", none))
    sum_of = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return out.select(
        "doc_id", "n_words", sum_of("spans_words").alias("repeat_words"), F.when(whole, F.col("n_words")).otherwise(sum_of("removed_words")).alias("removed_words"),
        F.coalesce("spans", none).alias("spans"), removed.alias("removed"), F.col("spans").isNotNull().alias("repeated"),
    )
