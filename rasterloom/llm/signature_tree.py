"""Exact Jaccard join of texts' word shingles by signature trees.

A leaf of the tree is a set of shingles: a bitmap with the bit of each shingle set (two bits a shingle or more, so that
unlike sets of any size differ), its size, and its excess, the shingles that found their bit set already. A node above
holds the OR of its members' bitmaps, all folded to 1024 bits, the range of their sizes and their greatest excess. Two members of nodes A and B have at most |A and B| + min(excess) shingles in common, and need
percent / (100 + percent) of their sizes' sum; a pair of nodes that can't reach that is not descended into.

At the top a bitmap of 2^64 bits is kept as the list of its bits, for those shingles alone of which similar sets must
share one: in one order of all shingles, the first n - ceil(n * percent / 100) + 1 of a set of n. Nodes that have a bit in
common meet by a join on it. In that order frequent shingles come last, so that passages which many texts share bring
nobody together, and the others go by counts of all shingles in CELLS cells: those that many texts have by chance, the more
the larger a table is, stay out of the lists. It is the same for all sets, hence nothing is lost whatever the counts are
taken to be. Below a bit
with many sets nodes are ranges of sizes, each as wide as a link allows: a set belongs to its own and the next. Bits that
the same sets have (by a 128-bit sum of their ids' hashes) are one.

As in ``neardup``, each member is first compared with two of its bucket, links are joined into components, and members of
one component never meet again. What is left goes down the tree: small buckets are one node, their leaves tested in the
join; larger ones have nodes of bounded weight (tiles), pairs of which are pruned, and each pair that stays is descended
in one task, over nodes of NODE leaves. Only then are sets sent, of the leaves that it came to. Links count after both
full sets are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.neardup import Shingles, _common, _forest, _linked, _sets, _tiles, components
from rasterloom.llm.shared import BROADCAST_ROWS, DEALT, dropped, met, often, written

BITS, LONGS, NODE = 1024, 16, 16
#: A shingle is frequent if tasks that saw it LOCAL times or more, in at most WINDOW shingles each, saw it FREQUENT times
#: in all; the MOST most frequent are put last. None of these changes a result.
LOCAL, WINDOW, FREQUENT, MOST = 3, 2_000_000, 32, 200_000
#: The others go by the number of shingles whose hashes have the same leading CELL_BITS, which is no less than their own.
CELL_BITS, PARTS = 21, 128
CELLS = 1 << CELL_BITS

#: Members up to which the pairs of a bucket are tested in the join.
PAIRED = 8

_SIG = [f"s{i}" for i in range(LONGS)]
_LEAVES = "doc_id long, place long, n long, excess long, narrow long, h0 long, h1 long, bits array<long>, prefix array<long>"


def frequent(docs: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The most frequent shingles in ascending order and how often they were seen, at most MOST; and the ``cells``: how many
    shingles were seen by the leading bits of their hashes, in steps that fit 16 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, held, size, cells, seen_in_all = Shingles(k), [], 0, np.zeros(CELLS, np.uint32), 0

        def rows(token: np.ndarray, times: np.ndarray, part: np.ndarray, found: list[bytes]) -> pa.RecordBatch:
            none = len(token) + len(part)
            fill = lambda x, before: pa.array(np.concatenate([np.zeros(before, np.int64), x, np.zeros(none - before - len(x), np.int64)]))
            columns = [fill(token, 0), fill(times, 0), fill(part, len(token)), pa.array([None] * len(token) + found, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["token", "times", "part", "cells"])

        def counted() -> pa.RecordBatch:
            seen = np.concatenate([np.zeros(0, np.uint64), *held])
            held.clear()
            seen.sort()
            np.add(cells, np.bincount(seen >> np.uint64(64 - CELL_BITS), minlength=CELLS).astype(np.uint32), out=cells)
            at = np.flatnonzero(np.concatenate([np.ones(min(1, len(seen)), bool), seen[1:] != seen[:-1]]))
            times = np.diff(np.append(at, len(seen)))
            keep = times >= LOCAL
            return rows(seen[at[keep]].view(np.int64), times[keep], np.zeros(0, np.int64), [])

        def summed() -> pa.RecordBatch:
            found = np.minimum(cells, 255).astype(np.uint8).reshape(-1, CELLS // PARTS)
            cells[:] = 0
            return rows(np.zeros(0, np.int64), np.zeros(0, np.int64), np.arange(PARTS), [x.tobytes() for x in found])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(cut.of(t))
                size += len(held[-1])
                if size > WINDOW:
                    yield counted()
                    seen_in_all, size = seen_in_all + size, 0
                    if seen_in_all > 16 * CELLS:  # before bytes are too small
                        yield summed()
                        seen_in_all = 0
        yield counted()
        if seen_in_all + size:
            yield summed()

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(CELLS // PARTS, np.uint32)
        for x in table.column("cells"):
            sums += np.frombuffer(x.as_buffer(), np.uint8)
        return pa.table({"part": table.column("part")[:1], "cells": pa.array([sums.tobytes()], pa.binary())})

    told = written(docs.select("text").mapInArrow(run, "token long, times long, part long, cells binary"), "seen")
    seen = told.where("cells is null").groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= FREQUENT)
    top = written(seen.orderBy(F.desc("times"), "token").limit(MOST), "frequent").toArrow()
    sums = written(told.where("cells is not null").select("part", "cells").groupBy("part").applyInArrow(total, "part long, cells binary"), "cells").toArrow()
    dropped(told)
    cells = np.zeros((PARTS, CELLS // PARTS), np.uint32)
    for part, found in zip(sums.column("part").to_pylist(), sums.column("cells").to_pylist()):
        cells[part] = np.frombuffer(found, np.uint32)
    cells = np.maximum(cells.reshape(-1), PAIRED)  # buckets of so few are paired in the join anyway
    cells = np.minimum(cells >> max(0, int(np.median(cells)).bit_length() - 14), 2**16 - 1).astype(np.uint16)
    token = top.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], top.column("times").to_numpy()[order], cells


def prefix(shingles: np.ndarray, percent: int, last: np.ndarray, times: np.ndarray, cells: np.ndarray | None = None) -> np.ndarray:
    """Of sorted shingles those of which any set that is similar enough has one: those of the least ``cells`` first, the
    frequent ones (``last``) after all others."""
    n = len(shingles)
    size = n + -n * percent // 100 + 1 if n else 0
    often = np.zeros(n, bool)
    if len(last):
        at = np.minimum(np.searchsorted(last, shingles), len(last) - 1)
        often = last[at] == shingles
    rare = shingles[~often]
    if cells is not None:
        rare = rare[np.argsort(cells[rare >> np.uint64(64 - CELL_BITS)], kind="stable")]  # of equal cells the least hash
    if len(rare) >= size:
        return rare[:size]
    rest, seen = shingles[often], times[at[often]]
    return np.concatenate([rare, rest[np.lexsort((rest, seen))][: size - len(rare)]])


def bitmap(shingles: np.ndarray, bits: int = BITS) -> np.ndarray:
    """``bits`` bits, a power of two; halves ORed are the bitmap of half the width."""
    out = np.zeros(bits, np.uint8)
    out[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(out).view(np.uint64)


def width(n: int) -> int:
    """Bits for a set of n: the power of two with two a shingle or more, at least BITS."""
    return max(BITS, 1 << (2 * n - 1).bit_length()) if n else BITS


def excess(n: int, bits: np.ndarray) -> int:
    return n - int(np.bitwise_count(bits).sum())


def _leaves(docs: DataFrame, k: int, percent: int, last: np.ndarray, times: np.ndarray, cells: np.ndarray) -> DataFrame:
    """Per row its set's size, digest, prefix and bitmap ``bits``, as wide as it needs, with its ``excess`` and that of the
    bitmap folded to BITS (``narrow``)."""

    def lists(values: list[np.ndarray]) -> pa.ListArray:
        ends = np.cumsum([0, *map(len, values)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingles(k)
        for batch in batches:
            sizes, whole, wide, heads = [], [], [], []
            for t in batch.column(2).to_pylist():
                s = cut.of(t)
                bits = bitmap(s, width(len(s)))
                sizes.append((len(s), excess(len(s), bits), excess(len(s), np.bitwise_or.reduce(bits.reshape(-1, LONGS), axis=0))))
                wide.append(bits.view(np.int64))
                whole.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                heads.append(prefix(s, percent, last, times, cells).view(np.int64))
            n, w = np.array(sizes, np.int64).reshape(-1, 3), np.array(whole, np.int64).reshape(-1, 2)
            column = lambda m, i: pa.array(np.ascontiguousarray(m[:, i]))
            columns = [batch.column(0), batch.column(1), *[column(n, i) for i in range(3)], *[column(w, i) for i in range(2)], lists(wide), lists(heads)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "n", "excess", "narrow", "h0", "h1", "bits", "prefix"])

    return docs.select("doc_id", "place", "text").mapInArrow(run, _LEAVES)


def _folded(bits: Column, longs: Column) -> Column:
    """A bitmap folded to so many longs, a power of two."""
    steps = F.sequence(F.lit(0), (F.size(bits) / longs).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), longs - 1), lambda i: F.aggregate(steps, F.lit(0).cast("long"), lambda t, j: t.bitwiseOR(F.get(bits, i + j * longs))))


def _thin(classes: DataFrame) -> DataFrame:
    """(id, n, excess, bits) with bitmaps of a bit a shingle or more, for the pairs that are tested in a join: unlike sets
    differ there too, and what is sent with each pair is half as much or less."""
    longs = F.call_function("shiftleft", F.lit(1), F.greatest(F.lit(0), F.length(F.bin(F.col("n") - 1)) - 6))
    thin = classes.select("id", "n", _folded(F.col("bits"), longs).alias("bits"))
    return thin.withColumn("excess", F.col("n") - F.aggregate("bits", F.lit(0), lambda t, c: t + F.bit_count(c)))


def _sizes_allow(a: str, b: str, percent: int, low: str = "n", high: str = "n") -> Column:
    return (100 * F.col(a + high) >= percent * F.col(b + low)) & (100 * F.col(b + high) >= percent * F.col(a + low))


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether two leaves (columns with those prefixes) can be similar enough, by sizes and possible overlap. Of two widths
    the greater, twice the other where sizes allow a link, is folded; its excess grows by that, so the other's is taken."""
    x, y = F.col(f"{a}bits"), F.col(f"{b}bits")
    n = F.least(F.size(x), F.size(y))

    def narrowed(z: Column) -> Column:
        return F.when(F.size(z) == n, z).otherwise(F.zip_with(F.slice(z, F.lit(1), n), F.slice(z, n + 1, n), lambda p, q: p.bitwiseOR(q)))

    both = F.aggregate(F.zip_with(narrowed(x), narrowed(y), lambda p, q: F.bit_count(p.bitwiseAND(q))), F.lit(0), lambda t, c: t + c)
    more = F.when(F.size(x) == F.size(y), F.least(a + "excess", b + "excess")).when(F.size(x) == n, F.col(a + "excess")).otherwise(F.col(b + "excess"))
    return F.when(_sizes_allow(a, b, percent), (100 + percent) * (both + more) >= percent * (F.col(a + "n") + F.col(b + "n"))).otherwise(F.lit(False))


def _nodes_may_link(a: str, b: str, percent: int) -> Column:
    """The same for nodes: ranges of sizes, greatest excess, bitmaps of BITS."""
    shared = F.least(a + "narrow", b + "narrow")
    for s in _SIG:
        shared = shared + F.bit_count(F.col(a + s).bitwiseAND(F.col(b + s)))
    return _sizes_allow(a, b, percent, "low", "high") & ((100 + percent) * shared >= percent * (F.col(a + "low") + F.col(b + "low")))


class _Nodes:
    """Leaves of one tile in the order of their sizes, and above them nodes of NODE leaves each."""

    def __init__(self, n: np.ndarray, excess: np.ndarray, sigs: np.ndarray, part: np.ndarray):
        self.order = np.lexsort((sigs[:, 0], n))
        self.n, self.excess, self.sigs, self.part = n[self.order], excess[self.order], sigs[self.order], part[self.order]
        self.at = np.arange(0, len(n), NODE)
        self.low, self.high, self.most = (f.reduceat(x, self.at) for f, x in ((np.minimum, self.n), (np.maximum, self.n), (np.maximum, self.excess)))
        self.all = np.bitwise_or.reduceat(self.sigs, self.at, axis=0)
        self.first, self.last = np.minimum.reduceat(self.part, self.at), np.maximum.reduceat(self.part, self.at)


def _can(percent: int, low_a, high_a, most_a, sig_a, low_b, high_b, most_b, sig_b) -> np.ndarray:
    overlap = np.bitwise_count(sig_a & sig_b).sum(axis=-1, dtype=np.int64) + np.minimum(most_a, most_b)
    return (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a) & ((100 + percent) * overlap >= percent * (low_a + low_b))


def traversed(a: _Nodes, b: _Nodes, percent: int) -> np.ndarray:
    """The matrix (in the leaves' own order) of pairs that the descent from both nodes comes to; none of one component."""
    out = np.zeros((len(a.n), len(b.n)), bool)
    for i in range(len(a.at)):
        several = (a.first[i] != a.last[i]) | (b.first != b.last) | (a.first[i] != b.first)
        stay = several & _can(percent, a.low[i], a.high[i], a.most[i], a.all[i], b.low, b.high, b.most, b.all)
        x = np.arange(a.at[i], min(a.at[i] + NODE, len(a.n)))
        y = np.flatnonzero(np.repeat(stay, np.diff(np.append(b.at, len(b.n)))))
        if len(y):
            near = _can(percent, a.n[x, None], a.n[x, None], a.excess[x, None], a.sigs[x, None], b.n[None, y], b.n[None, y], b.excess[None, y], b.sigs[None, y])
            out[np.ix_(x, y)] = near & (a.part[x, None] != b.part[None, y])
    back = np.zeros_like(out)
    back[np.ix_(a.order, b.order)] = out
    return back


def wide_overlap(near: np.ndarray, x: list[np.ndarray], y: list[np.ndarray], ex: np.ndarray, ey: np.ndarray) -> np.ndarray:
    """Greatest possible overlap of the pairs in the matrix ``near`` by their full bitmaps; 0 elsewhere.

    A pair's narrower width counts. A folded bitmap has a greater excess, so the narrower set's is taken, which both of
    its bounds allow.
    """
    out = np.zeros(near.shape, np.int64)
    for i in np.flatnonzero(near.any(1)):
        for size in {len(y[j]) for j in np.flatnonzero(near[i])}:
            at = np.array([j for j in np.flatnonzero(near[i]) if len(y[j]) == size])
            n = min(size, len(x[i]))
            fold = lambda z: np.bitwise_or.reduce(z.reshape(*z.shape[:-1], -1, n), axis=-2)
            rows = fold(np.stack([y[j] for j in at]))
            more = np.minimum(ex[i], ey[at]) if size == len(x[i]) else np.full(len(at), ex[i]) if n == len(x[i]) else ey[at]
            out[i, at] = np.bitwise_count(rows & fold(x[i])).sum(axis=1, dtype=np.int64) + more
    return out


def _descended(members: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(ta, tb, side, id) of the leaves that the descent from the pairs (ta, tb) of tiles comes to; no sets are needed."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number = lambda c: table.column(c).to_numpy()
        side, ids, part, n, more, narrow = (number(c) for c in ("side", "id", "component", "n", "excess", "narrow"))
        rows = table.column("bits").combine_chunks()
        bits = np.split(rows.flatten().to_numpy().view(np.uint64), np.cumsum(rows.value_lengths().to_numpy())[:-1])
        sigs = np.stack([np.bitwise_or.reduce(b.reshape(-1, LONGS), axis=0) for b in bits])
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        y = y if len(y) else x  # a tile with itself
        near = traversed(_Nodes(n[x], narrow[x], sigs[x], part[x]), _Nodes(n[y], narrow[y], sigs[y], part[y]), percent)
        overlap = wide_overlap(near, [bits[i] for i in x], [bits[i] for i in y], more[x], more[y])
        near &= (100 + percent) * overlap >= percent * (n[x][:, None] + n[y][None])
        a, b = ids[x[near.any(1)]], ids[y[near.any(0)]]
        found, sides = np.concatenate([a, b]), np.repeat(np.array([0, 1], np.int32), [len(a), len(b)])
        return pa.table({"ta": pa.array([key[0].as_py()] * len(found), pa.int64()), "tb": pa.array([key[1].as_py()] * len(found), pa.int64()), "side": pa.array(sides), "id": pa.array(found, pa.int64())})

    of = lambda p, k: p.join(members, F.col("ta" if k == 0 else "tb") == F.col("tile")).drop("tile").withColumn("side", F.lit(k))
    both = of(pairs, 0).unionByName(of(pairs.where("ta <> tb"), 1))
    return written(both.groupBy("ta", "tb").applyInArrow(run, "ta long, tb long, side int, id long"), "reached")


def _compared(rows: DataFrame, percent: int) -> DataFrame:
    """Links between the leaves (ta, tb, side, id, component, n, set) that the descent came to, pair by pair of tiles."""

    def compare(table: pa.Table) -> pa.Table:
        number = lambda c: table.column(c).to_numpy()
        side, ids, part, n = (number(c) for c in ("side", "id", "component", "n"))
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a = b = np.zeros(0, np.int64)
        if len(x) and len(y):
            sets = table.column("set").combine_chunks()
            cut = lambda rows: [np.frombuffer(sets[i].as_buffer(), np.uint64) for i in rows.tolist()]
            common = _common(cut(x), cut(y))
            linked = (100 * common >= percent * (n[x][:, None] + n[y][None] - common)) & (part[x][:, None] != part[y][None])
            a, b = _forest(linked, ids[x], ids[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return written(rows.groupBy("ta", "tb").applyInArrow(compare, "a long, b long"), "links")


def _pruned(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """The pairs (ta, tb) of tiles whose members (tile, n, narrow, signature) can be similar enough."""
    tiles = members.groupBy("tile").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("narrow").alias("narrow"), *[F.bit_or(s).alias(s) for s in _SIG])
    tiles = written(tiles, "tile-nodes")
    side = lambda t, p: tiles.select(F.col("tile").alias(t), *[F.col(c).alias(p + c) for c in ("low", "high", "narrow", *_SIG)])
    return pairs.join(side("ta", "a"), "ta").join(side("tb", "b"), "tb").where(_nodes_may_link("a", "b", percent)).select("ta", "tb")


def _ranged(large: DataFrame, percent: int) -> DataFrame:
    """Members (key, id, component, size) of large buckets by ranges of sizes: (key, id, component, size, n), with new
    keys and the numbers of members there. Similar sets share a range; those of one component alone are left out."""
    own = F.col("size") if percent == 100 else F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent) - 1e-9)
    spread = large.select("key", "id", "component", "size", F.explode(F.array(own, own + 1)).alias("range")).withColumn("key", F.xxhash64("key", "range"))
    counts = spread.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").drop("lo", "hi")
    return written(met(spread.drop("range"), counts, ["key"], ["id"], often(spread, ["key"])), "ranges")


def similar_texts(df: DataFrame, shingle_words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Texts are lower-cased in A-Z and cut at ASCII white space; a text of fewer words than a shingle is one shingle; a null,
    empty or blank text has none and is linked with nothing. Texts are linked if 100 * common >= percent * union of their
    sets (of 64-bit hashes of shingles); component_id is the smallest doc_id reachable, the row's own if there is no other. Equal
    sets are one class from the start. Rows are judged by their own texts, whatever others share their doc_id; a null
    doc_id is never the smallest. doc_id is cast to long. Other columns are ignored; an empty table gives an empty one.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    each = written(_leaves(docs, shingle_words, percent, *frequent(docs, shingle_words)), "leaves")
    classes = each.where("n > 0").groupBy("h0", "h1").agg(F.min("place").alias("id"), F.min("doc_id").alias("least_doc"), *[F.first(c).alias(c) for c in ("n", "excess", "narrow", "bits", "prefix")])
    classes = written(classes, "classes")
    rows = written(each.select("doc_id", "n", "h0", "h1", "place"), "rows")
    dropped(each)  # bitmaps and prefixes are those of the classes from here on

    index = classes.select("id", F.explode("prefix").alias("key"))
    sums = [F.bit_xor(F.xxhash64("id", F.lit(i))).alias(f"x{i}") for i in range(2)]
    # Most keys occur once: sent as (id, key), which takes less than their aggregates do, and aggregated where they meet.
    filled = index.repartition("key").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.max("id").alias("most"), *sums).where("n > 1")
    filled = written(filled.groupBy("n", "least", "most", "x0", "x1").agg(F.min("key").alias("key")).drop("x0", "x1"), "filled")
    two = filled.where("n = 2").select("key", F.explode(F.array("least", "most")).alias("id"), "n", "least")
    more = filled.where("n > 2").drop("most")
    if more.count() <= BROADCAST_ROWS:
        more = index.join(F.broadcast(more), "key")
    else:
        hot = more.where(F.col("n") > DEALT).select("key", F.ceil(F.col("n") / DEALT).cast("int").alias("parts"))
        more = met(index, more, ["key"], ["id"], None if (few := hot.count()) == 0 else F.broadcast(hot) if few <= BROADCAST_ROWS else hot)
    shared = written(two.unionByName(more), "buckets")

    def signed(p: str) -> DataFrame:
        return _thin(classes).select(F.col("id").alias(p), *[F.col(c).alias(p + c) for c in ("n", "excess", "bits")])

    weighted = shared.join(shared.groupBy("id").agg(F.sum("n").alias("weight")), "id")
    centres = weighted.groupBy("key").agg((-F.max(F.struct("weight", (-F.col("id")).alias("id")))["id"]).alias("centre"))
    stars = met(shared, centres, ["key"], ["id"], often(shared, ["key"])).select(F.col("id").alias("a"), F.explode(F.array_distinct(F.array("centre", "least"))).alias("b"))
    starred = stars = written(stars.where("a <> b").distinct(), "stars")
    size = lambda p: classes.select(F.col("id").alias(p), F.col("n").alias(f"{p}n"))
    sized = met(stars.join(size("a"), "a"), size("b"), ["b"], ["a"], often(stars, ["b"])).where(_sizes_allow("a", "b", percent))
    sized = written(sized.select("a", "b"), "sized")  # bitmaps are sent for these alone
    near = met(sized.join(signed("a"), "a"), signed("b"), ["b"], ["a"], often(sized, ["b"])).where(_may_link("a", "b", percent))
    stars = written(near.select("a", "b"), "pairs")
    full = _sets(stars.select(F.col("a").alias("id")).union(stars.select("b")), docs, shingle_words)
    links = _linked(stars, full, percent)
    found = written(components(links), "components")
    dropped(starred, sized, full, links, filled)

    part = written(shared.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("component")), "parts")
    several = part.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    several = written(met(part, several, ["key"], ["id"], often(part, ["key"])), "left")
    dropped(shared, part)

    sizes = classes.select("id", F.col("n").alias("size"))
    few = several.where(F.col("n") <= PAIRED).join(sizes, "id").select("key", "id", "component", "size")
    ranged = _ranged(several.where(F.col("n") > PAIRED).join(sizes, "id"), percent)
    few = few.unionByName(ranged.where(F.col("n") <= PAIRED).drop("n"))
    side = lambda p: few.select("key", F.col("id").alias(p), F.col("component").alias(f"{p}c"), F.col("size").alias(f"{p}n"))
    rest = side("a").join(side("b"), "key").where((F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc")) & _sizes_allow("a", "b", percent)).select("a", "b").distinct()
    rest = rest.join(stars, ["a", "b"], "left_anti").join(stars.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti")
    rest = written(rest.join(signed("a"), "a").join(signed("b"), "b").where(_may_link("a", "b", percent)).select("a", "b"), "pairs")
    large = ranged.where(F.col("n") > PAIRED).drop("size")
    ids = rest.select(F.col("a").alias("id")).union(rest.select("b"))
    if not (none := large.isEmpty()):
        placed, tiles = _tiles(large, classes.select("id", "n"))
        members = placed.drop("own")
        members = members.join(classes.select("id", "n", "excess", "narrow", "bits"), "id")
        nodes = members.withColumn("sig", _folded(F.col("bits"), F.lit(LONGS))).select("tile", "n", "narrow", *[F.get("sig", F.lit(i)).alias(c) for i, c in enumerate(_SIG)])
        reached = _descended(members, _pruned(tiles, nodes, percent), percent)
        ids = ids.union(reached.select("id"))
    full = _sets(ids, docs, shingle_words)
    links = found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(_linked(rest, full, percent))
    if not none:
        links = links.union(_compared(reached.join(placed.select("id", "component"), "id").join(classes.select("id", "n"), "id").join(full, "id"), percent))
    found = written(components(links), "components")
    dropped(rest, stars, several, ranged, full)

    own = classes.select("h0", "h1", "id", "least_doc").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = own.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    own = met(own, least, ["component"], ["id"], often(own, ["component"])).select("h0", "h1", "component_id")
    out = met(rows.where("n > 0"), own, ["h0", "h1"], ["doc_id", "place"], often(rows.where("n > 0"), ["h0", "h1"])).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.union(rows.where("n = 0").select("doc_id", "n", "doc_id"))
