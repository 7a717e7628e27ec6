"""Near duplicates by MinHash signatures under a Hamming join over several indexes.

A text's set of word shingles gets a signature of 64 MinHash symbols of 16 bits. Texts of the wanted similarity differ
in few symbols; the radius is set five standard deviations above the mean number. The signature is split into m chunks
with radius <= 2m - 1, so by the pigeonhole principle some chunk of any such pair differs in one symbol at most. Every
chunk is therefore indexed once per symbol left out: all pairs within the radius meet in a bucket.

Buckets are not expanded into pairs. First every member is compared with two of its bucket, the one whose buckets are
the fullest (the likely original of a group of copies) and the smallest, and links are joined into components. What is
left are buckets that still hold several components. In those of up to PAIRED members signatures are compared in the
join. Members of larger ones are put into tiles of bounded size, a large component into tiles of its own, and each two
tiles that meet in a bucket are compared in one go, but never tiles of one component; there too a pair must lie within
the radius. Links count after both full sets are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.shared import dropped, met, often, packed, written

SYMBOLS, LONGS = 64, 16
#: Members up to which the pairs of a bucket of several components are compared in the join; those of larger ones go by tiles.
PAIRED = 32
#: Weight of a tile: each member weighs 1, and 1 more per 1,000 shingles.
TILE = 256
#: Documents whose texts are compared, up to which their ids are broadcast (16 bytes each); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Distinct words that a worker remembers before it starts anew.
CACHE = 400_000

_draw = np.random.default_rng(20_240_501)
_A = _draw.integers(1, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
_P = _draw.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_S = _draw.integers(1, 2**63, 4 * SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class Shingles:
    """Distinct shingles of a text as sorted 64-bit hashes."""

    def __init__(self, k: int):
        self.k, self.words = k, _Words()

    def of(self, text: str | None) -> np.ndarray:
        known = self.words
        h = np.array([known[w] for w in (text or "").encode().lower().split()], np.uint64)  # bytes: A-Z, ASCII space
        if not len(h):
            return h
        k = min(self.k, len(h))
        n = len(h) - k + 1
        s = h[:n] * _P[0]
        for j in range(1, k):
            s += _mix(h[j : j + n] + _P[j]) * _P[j]
        return np.unique(_mix(s + np.uint64(k)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """64 symbols of 16 bits: of each permutation's smallest hash the lowest bits."""
    low = np.full(SYMBOLS, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048, None] * _A + _B
        part ^= part >> np.uint64(33)
        np.minimum(low, part.min(axis=0), out=low)
    return (_mix(low) & np.uint64(0xFFFF)).astype(np.uint16)


def radius_and_chunks(similarity: float) -> tuple[int, int]:
    p = 1 - similarity
    m = math.ceil((SYMBOLS * p + 5 * math.sqrt(SYMBOLS * p * similarity) + 1) / 2)
    m = min(m, SYMBOLS // 2)
    return 2 * m - 1, m


def bucket_keys(symbols: np.ndarray, m: int) -> np.ndarray:
    """Per row of symbols, the key of each chunk with each of its symbols left out."""
    per = _mix(symbols.astype(np.uint64) * _S[:SYMBOLS] + _S[SYMBOLS : 2 * SYMBOLS])
    keys = np.empty_like(per)
    for c in np.array_split(np.arange(SYMBOLS), m):
        keys[:, c] = per[:, c].sum(axis=1, dtype=np.uint64)[:, None] - per[:, c]
    return _mix(keys + _S[2 * SYMBOLS : 3 * SYMBOLS])


_SIG = [f"s{i}" for i in range(LONGS)]
_FEATURES = "doc_id long, place long, n_shingles long, h0 long, h1 long, " + ", ".join(f"{s} long" for s in _SIG)


def _features(df: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingles(k)
        for batch in batches:
            n, whole, sigs = [], [], []
            for t in batch.column(2).to_pylist():
                s = cut.of(t)
                n.append(len(s))
                whole.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64))
                sigs.append(signature(s).view(np.int64) if len(s) else np.zeros(LONGS, np.int64))
            w, s = np.array(whole, np.int64).reshape(-1, 2), np.array(sigs, np.int64).reshape(-1, LONGS)
            columns = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *[pa.array(w[:, i]) for i in (0, 1)], *[pa.array(np.ascontiguousarray(s[:, i])) for i in range(LONGS)]]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "place", "n_shingles", "h0", "h1", *_SIG])

    return df.mapInArrow(run, _FEATURES)


def _keys(classes: DataFrame, m: int) -> DataFrame:
    """(id, key) for each class and index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.stack([batch.column(i + 1).to_numpy(zero_copy_only=False) for i in range(LONGS)], axis=1)
            keys = bucket_keys(np.ascontiguousarray(sig).view(np.uint16).reshape(len(sig), SYMBOLS), m).view(np.int64)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), SYMBOLS)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys.reshape(-1))], names=["id", "key"])

    return classes.select("id", *_SIG).mapInArrow(run, "id long, key long")


def _differing(a: str, b: str) -> Column:
    """Symbols in which two signatures (columns with those prefixes) differ."""
    lanes = []
    for s in _SIG:
        z = F.col(a + s).bitwiseXOR(F.col(b + s))
        for shift in (8, 4, 2, 1):
            z = z.bitwiseOR(F.shiftrightunsigned(z, shift))
        lanes.append(F.bit_count(z.bitwiseAND(F.lit(0x0001000100010001))))
    total = lanes[0]
    for x in lanes[1:]:
        total = total + x
    return total


def _sets(ids: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(id, set) of the given ids of classes: the shingles of the texts of those hashes, cut again."""
    own = written(ids.distinct(), "compared")
    ids = F.broadcast(own) if own.count() <= BROADCAST_IDS else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = Shingles(k)
        for batch in batches:
            found = [cut.of(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "set"])

    texts = docs.join(ids, docs["place"] == ids["id"], "left_semi").select("place", "text")
    sets = written(texts.mapInArrow(run, "id long, set binary").groupBy("id").agg(F.min("set").alias("set")), "sets")
    dropped(own)
    return sets


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def _linked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) of ids, of which b may be anything often, those whose full sets are similar enough."""
    side = lambda p, x: full.select(F.col("id").alias(p), F.col("set").alias(x))
    both = met(pairs.join(side("a", "x"), "a"), side("b", "y"), ["b"], ["a"], often(pairs, ["b"]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ((np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) for x, y in zip(batch.column(2), batch.column(3)))
            keep = pa.array([_similar(x, y, percent) for x, y in sets], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(keep)

    return written(both.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long"), "links")


def _tiles(large: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, component, tile, own) of the members of large buckets (key, id, n, component), and the tiles (ta, tb) to compare.

    A member belongs to its fullest bucket; a component with enough members there has tiles of its own (``own``), others
    share some. Two tiles are compared if they meet in a bucket and are not one component's. In each bucket the component
    with the most tiles is joined to the others only, so at most as many pairs are looked at in vain as are compared.
    """
    member = large.groupBy("id").agg(F.max(F.struct("n", "key"))["key"].alias("home"), F.first("component").alias("component"))
    member = written(member.join(sizes, "id").withColumn("weight", 1 + F.col("n") / 1000), "members")
    parts = lambda w: F.ceil(F.col(w) / TILE)
    each = member.groupBy("home", "component").agg(F.sum("weight").alias("w"))
    shared = each.where(F.col("w") < TILE).groupBy("home").agg(F.sum("w").alias("shared"))
    placed = member.join(each.join(shared, "home", "left"), ["home", "component"])
    own = F.when(F.col("w") >= TILE, F.col("component"))
    tile = F.when(own.isNotNull(), F.xxhash64("home", "component", F.pmod(F.xxhash64("id"), parts("w")))).otherwise(F.xxhash64("home", F.pmod(F.xxhash64("component"), parts("shared"))))
    placed = written(placed.select("id", "component", tile.alias("tile"), own.alias("own")), "tiles")

    spread = written(large.join(placed.select("id", "tile", "own"), "id").groupBy("key", "tile").agg(F.first("own").alias("own")), "spread")
    most = spread.where("own is not null").groupBy("key", "own").agg(F.count("*").alias("tiles")).groupBy("key").agg(F.max_by("own", F.struct("tiles", "own")).alias("most"))
    spread = spread.join(most, "key", "left")
    main = F.coalesce(F.col("own") == F.col("most"), F.lit(False))
    others = spread.where(~main).select("key", F.col("tile").alias("tb"), F.col("own").alias("ob"))
    ordered = lambda df: df.select(F.least("ta", "tb").alias("ta"), F.greatest("ta", "tb").alias("tb"))
    first = ordered(spread.where(main).select("key", F.col("tile").alias("ta")).join(others, "key"))
    left = others.select("key", F.col("tb").alias("ta"), F.col("ob").alias("oa"))
    second = ordered(left.join(others, "key").where("ta <= tb and not coalesce(oa = ob, false)"))
    return placed, written(first.union(second).distinct(), "tile-pairs")


def _common(x: list[np.ndarray], y: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Sizes of the intersections of each of the sets x with each of y."""
    of = lambda sets: (np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets))
    (i, a), (j, b) = of(x), of(y)
    words = np.intersect1d(a, b)
    out = np.zeros((len(x), len(y)), np.int64)

    def columns(rows: int, i: np.ndarray, a: np.ndarray, part: np.ndarray) -> np.ndarray:
        at = np.searchsorted(part, a)
        there = part[np.minimum(at, len(part) - 1)] == a
        grid = np.zeros((rows, len(part)), np.float32)
        grid[i[there], at[there]] = 1
        return grid

    for k in range(0, len(words), step):
        part = words[k : k + step]
        out += (columns(len(x), i, a, part) @ columns(len(y), j, b, part).T).astype(np.int64)
    return out


def _forest(linked: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids that join what the matrix of links between x and y joins; fewer than x and y together."""
    none = len(x)
    own, other = np.where(linked.any(1), np.arange(len(x)), none), np.full(len(y), none)
    while True:
        after = np.where(linked, own[:, None], none).min(0, initial=none)
        own_after = np.minimum(own, np.where(linked, after[None], none).min(1, initial=none))
        if (own_after == own).all() and (after == other).all():
            break
        own, other = own_after, after
    ids, root = np.concatenate([x, y]), np.concatenate([own, other])
    ids, root = ids[root < none], root[root < none]
    keep = ids != x[root]
    return ids[keep], x[root[keep]]


def _compared_tiles(rows: DataFrame, pairs: DataFrame, radius: int, percent: int) -> DataFrame:
    """Links between members (tile, id, component, n, signature, set) of the tiles (ta, tb)."""

    def compare(table: pa.Table) -> pa.Table:
        number = lambda c: table.column(c).to_numpy()
        side, ids, part, n = number("side"), number("id"), number("component"), number("n")
        symbols = np.ascontiguousarray(np.stack([number(s) for s in _SIG], axis=1)).view(np.uint16).reshape(len(ids), SYMBOLS)
        x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(y)  # a tile with itself
        y = x if same else y
        apart = np.zeros((len(x), len(y)), np.uint8)
        for s in range(SYMBOLS):
            apart += symbols[x, s][:, None] != symbols[y, s][None]
        near = (apart <= radius) & (part[x][:, None] != part[y][None])
        near &= 100 * np.minimum(n[x][:, None], n[y][None]) >= percent * np.maximum(n[x][:, None], n[y][None])
        x, y, near = x[near.any(1)], y[near.any(0)], near[near.any(1)][:, near.any(0)]
        a = b = np.zeros(0, np.int64)
        if len(x):
            sets = table.column("set").combine_chunks()
            cut = lambda rows: [np.frombuffer(sets[i].as_buffer(), np.uint64) for i in rows.tolist()]
            common = _common(cut(x), cut(y))
            a, b = _forest(near & (100 * common >= percent * (n[x][:, None] + n[y][None] - common)), ids[x], ids[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    of = lambda p, k: p.join(rows, F.col("ta" if k == 0 else "tb") == F.col("tile")).drop("tile").withColumn("side", F.lit(k))
    both = of(pairs, 0).unionByName(of(pairs.where("ta <> tb"), 1))
    return written(both.groupBy("ta", "tb").applyInArrow(compare, "a long, b long"), "links")


def components(links: DataFrame) -> DataFrame:
    """(id, component) for each id in the links (a, b): the smallest id reachable.

    Alternates two steps that keep components: each id hands its larger neighbours to the smallest one, then its
    smaller ones; it ends when every id hangs at its component's smallest. Each round is a written table.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    mark = lambda: tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())
    before = mark()
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        last, edges = edges, written(small.where("u <> v").distinct(), "edges")
        dropped(last)
        after, before = before, mark()
        if after == before:
            break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def near_duplicates(df: DataFrame, shingle_words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Texts are lower-cased in A-Z and cut at ASCII white space; a text of fewer words than a shingle is one shingle; a
    text without words has none and is linked with nothing. Texts are linked if 100 * common >= percent * union of
    their sets; component_id is the smallest doc_id reachable and kept says that the row's doc_id is that. Equal sets
    are one class from the start. Each row is judged by its own text, whatever others share its doc_id; a null doc_id is
    never the smallest, and a row of one is kept if its component has no other. Other columns are ignored; an empty
    table gives an empty one.
    """
    return _grouped(df, shingle_words, percent, doc_id, text).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def _grouped(df: DataFrame, shingle_words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, place (the text's hash), n_shingles, component (null without shingles) and component_id of every row.

    A class goes by the smallest hash of its texts, and so does a component; ids of documents play no part in it.
    """
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    each = written(_features(docs, shingle_words), "features")
    radius, m = radius_and_chunks(percent / 100)
    classes = each.where("n_shingles > 0").groupBy("h0", "h1").agg(F.min("place").alias("id"), F.min("doc_id").alias("least_doc"), F.first("n_shingles").alias("n"), *[F.first(s).alias(s) for s in _SIG])
    classes = written(classes, "classes")

    index = _keys(classes, m)
    filled = index.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1")
    shared = written(index.join(filled, "key"), "buckets")

    def within(a: str, b: str) -> Column:
        sizes = 100 * F.least(f"{a}n", f"{b}n") >= percent * F.greatest(f"{a}n", f"{b}n")
        return sizes & (_differing(a, b) <= radius)

    def signed(p: str) -> DataFrame:
        return classes.select(F.col("id").alias(p), F.col("n").alias(f"{p}n"), *[F.col(s).alias(f"{p}{s}") for s in _SIG])

    weighted = shared.join(shared.groupBy("id").agg(F.sum("n").alias("weight")), "id")
    centres = weighted.groupBy("key").agg((-F.max(F.struct("weight", (-F.col("id")).alias("id")))["id"]).alias("centre"))
    stars = shared.join(centres, "key").select(F.col("id").alias("a"), F.explode(F.array_distinct(F.array("centre", "least"))).alias("b"))
    starred = stars = written(stars.where("a <> b").distinct(), "stars")
    near = met(stars.join(signed("a"), "a"), signed("b"), ["b"], ["a"], often(stars, ["b"])).where(within("a", "b"))
    stars = written(near.select("a", "b"), "pairs")
    full = _sets(stars.select(F.col("a").alias("id")).union(stars.select("b")), docs, shingle_words)
    links = _linked(stars, full, percent)
    found = written(components(links), "components")
    dropped(starred, full, links)

    part = written(shared.join(found, "id", "left").select("key", "id", "n", F.coalesce("component", "id").alias("component")), "parts")
    several = part.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    several = written(part.join(several, "key"), "left")
    dropped(shared, part)

    few = several.where(F.col("n") <= PAIRED)
    side = lambda p: few.select("key", F.col("id").alias(p), F.col("component").alias(f"{p}c")).join(signed(p), p)
    rest = side("a").join(side("b"), "key").where((F.col("a") < F.col("b")) & (F.col("ac") != F.col("bc")) & within("a", "b")).select("a", "b").distinct()
    rest = written(rest.join(stars, ["a", "b"], "left_anti").join(stars.select(F.col("a").alias("b"), F.col("b").alias("a")), ["a", "b"], "left_anti"), "pairs")
    large = several.where(F.col("n") > PAIRED)
    ids = rest.select(F.col("a").alias("id")).union(rest.select("b"))
    if not (none := large.isEmpty()):
        placed, tiles = _tiles(large, classes.select("id", "n"))
        ids = ids.union(placed.select("id"))
    full = _sets(ids, docs, shingle_words)
    links = found.select(F.col("id").alias("a"), F.col("component").alias("b")).union(_linked(rest, full, percent))
    if not none:
        rows = placed.drop("own").join(classes.select("id", "n", *_SIG), "id").join(full, "id")
        links = links.union(_compared_tiles(rows, tiles, radius, percent))
    found = written(components(links), "components")
    dropped(rest, stars, several, full)

    own = classes.select("h0", "h1", "id", "least_doc").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = own.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    own = met(own, least, ["component"], ["id"], often(own, ["component"])).select("h0", "h1", "component", "component_id")
    out = each.select("doc_id", "place", "n_shingles", "h0", "h1").join(own, ["h0", "h1"], "left")
    alone = F.col("n_shingles") == 0
    return out.select("doc_id", "place", "n_shingles", F.when(~alone, F.col("component")).alias("component"), F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``df`` with one row of each component, that of the smallest (doc_id, text hash), nulls last, with its columns.

    Of rows alike in both any one stays. Rows without words are linked with nothing and all stay.
    """
    rows = written(_grouped(df, doc_id=doc_id, text=text, **options).where("component is not null").groupBy("component", "doc_id", "place").agg(F.count("*").alias("times")), "rows")
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("first"))
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place") == F.col("first.place"))
    told = met(rows, first, ["component"], ["doc_id", "place"], often(rows, ["component"])).select(F.col("doc_id").alias("_doc"), F.col("place").alias("_place"), same.alias("_first"), "times")
    told = written(told.where("not _first or times > 1"), "copies")
    told = F.broadcast(told) if told.count() <= BROADCAST_IDS else told
    keyed, own = packed(df), F.col("_row")
    on = own[doc_id].cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64(own[text]) == F.col("_place"))
    copies = keyed.join(told.where("_first"), on).select("_row", "_doc", "_place").dropDuplicates(["_doc", "_place"])
    return keyed.join(told, on, "left_anti").unionByName(copies.select("_row")).select("_row.*")
