"""Sharding by a k-d tree: nodes are cut at distributed weighted medians along their widest metadata dimension.

All nodes of a level are cut in the same few jobs over a slim table (ids, sizes, places). A cut is found digit by digit
of a 30-bit sort key from sums of bytes per digit; a job sends the driver SUMS of them at most, whatever the data. The
tree is an expression over a row's places, so no level depends on a join above it. At the end small texts move from
shards above the mean to those below it, as cuts fall between whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.shared import numbered, packed, with_running_total, written

#: Bits of a sort key: place along the dimension, then the text's hash, of which a group too large for one side gives
#: the last SPREAD to its documents' own.
PLACE, GROUP, SPREAD = 10, 10, 10
KEY = PLACE + GROUP + SPREAD
#: Sums that one job sends to the driver at most, as a power of 2.
SUMS = 17
#: Rows of groups, or of moved texts, up to which they are broadcast (about 100 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 300_000


def _slim(df: DataFrame, doc_id: str, text: str, dimensions: Sequence[str], categories: Sequence[str]) -> DataFrame:
    t = F.col(text)
    n_bytes, chars = F.coalesce(F.octet_length(t), F.lit(0)), F.coalesce(F.length(t), F.lit(0))
    spaces = chars - F.coalesce(F.length(F.replace(t, F.lit(" "), F.lit(""))), F.lit(0))
    share = lambda part, whole: F.coalesce(F.try_divide(part.cast("double"), whole), F.lit(0.0))
    named = [F.coalesce(F.col(d).cast("double"), F.lit(0.0)) for d in dimensions]
    hashed = [F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")).cast("double"), F.lit(0.0)) for c in categories]
    return df.select(
        F.col(doc_id).alias("doc_id"), (n_bytes + 16).cast("long").alias("size"), F.crc32(F.coalesce(t, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        F.xxhash64(t).alias("th"), F.xxhash64(F.col(doc_id), t).alias("h"),
        F.array(share(n_bytes - chars, n_bytes), share(spaces, chars), *[F.signum(x) * F.log1p(F.abs(x)) for x in named], *hashed).alias("raw"),
    )


def _low(c: Column, bits: int) -> Column:
    return c.bitwiseAND(F.lit((1 << bits) - 1))


def _of(values: dict[int, int], node: Column, n: int) -> Column:
    """The value of a node below ``n``, null where it has none."""
    return F.get(F.array(*[F.lit(values.get(i)).cast("long") for i in range(n)]), node)


class _Tree:
    """cuts: node to (axis, last key of its first part). A node's parts are 2 node + 1 and 2 node + 2."""

    def __init__(self):
        self.cuts: dict[int, tuple[int, int]] = {}

    def node(self) -> Column:
        """The node that a row (place, group) has come to."""
        if not self.cuts:
            return F.lit(0)
        n = max(self.cuts) + 1
        axis, at = ({k: v[i] for k, v in self.cuts.items()} for i in (0, 1))
        levels = F.sequence(F.lit(1), F.lit(n.bit_length()))
        below = lambda x: 2 * x + F.when(_key(_of(axis, x, n)) <= _of(at, x, n), F.lit(1)).otherwise(F.lit(2))
        return F.aggregate(levels, F.lit(0), lambda x, _: F.when((x < n) & _of(at, x, n).isNotNull(), below(x)).otherwise(x))


def _key(axis: Column) -> Column:
    """The sort key along an axis."""
    return F.shiftleft(F.get("place", axis.cast("int")), GROUP + SPREAD) + F.col("group")


def _level(rows: DataFrame, tree: _Tree, open_: dict[int, tuple[int, int]], axes: int) -> None:
    """Cuts the open nodes (node to first shard and number of shards) that have rows."""
    bits = lambda cells: max(1, min(PLACE, SUMS - math.ceil(math.log2(cells))))
    n = max(open_) + 1
    at = rows.withColumn("node", tree.node()).where(F.col("node").isin(list(open_)) if len(open_) <= 64 else _of(dict.fromkeys(open_, 1), F.col("node"), n).isNotNull())
    done = bits(len(open_) * axes)
    places = F.posexplode(F.transform("place", lambda p: F.shiftright(p, PLACE - done))).alias("axis", "bin")
    sums = at.select("node", "size", places).groupBy("node", "axis", "bin").agg(F.sum("size").alias("s")).toArrow().to_pandas()
    axis, found = {}, {}
    for node, part in sums.groupby("node"):
        widths = part.groupby("axis")["bin"].agg(lambda b: b.max() - b.min())
        axis[node] = int(widths.idxmax())  # the first of equal ones
        own = part[part["axis"] == axis[node]].sort_values("bin")
        first, k = open_[node]
        found[node] = _crossed(own["bin"].to_numpy(), own["s"].to_numpy(), 0, own["s"].sum() * (k // 2) / k)
    while found and done < KEY:
        more = min(bits(len(found)), KEY - done)
        key = _key(_of(axis, F.col("node"), n))
        inside = at.withColumn("key", key).where(F.shiftright("key", KEY - done) == _of({k: v[0] for k, v in found.items()}, F.col("node"), n))
        digit = _low(F.shiftright("key", KEY - done - more), more).alias("bin")
        sums = inside.select("node", "size", digit).groupBy("node", "bin").agg(F.sum("size").alias("s")).toArrow().to_pandas()
        for node, part in sums.groupby("node"):
            part, (above, before, want) = part.sort_values("bin"), found[node]
            b, start, _ = _crossed(part["bin"].to_numpy(), part["s"].to_numpy(), before, want, nearest=done + more == KEY)
            found[node] = ((above << more) + b, start, want)
        done += more
    tree.cuts |= {node: (axis[node], key) for node, (key, _, _) in found.items()}


def _crossed(bins: np.ndarray, sizes: np.ndarray, before: float, want: float, nearest: bool = False) -> tuple[int, float, float]:
    """The bin in which the running bytes (from what came before) reach the wanted ones, the bytes before it, and want.

    ``nearest``: the bin whose end lies nearest to what is wanted, which may be the one before (-1: none at all).
    """
    ends = before + np.cumsum(sizes, dtype=float)
    i = min(int(np.searchsorted(ends, want)), len(bins) - 1)
    start = ends[i] - sizes[i]
    if nearest and want - start < ends[i] - want:
        return (int(bins[i]) - 1, start, want)
    return (int(bins[i]), start, want)


def kd_shards(
    df: DataFrame, shards: int = 40, law: str = "bytes", doc_id: str = "doc_id", text: str = "text", dimensions: Sequence[str] = (), categories: Sequence[str] = (), group_share: float = 0.02
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row; h is the hash of id and text.

    Dimensions are the text's share of multi-byte characters, its share of spaces, the logarithm of any numeric columns
    named in ``dimensions`` (null counts as 0) and the hash of any columns in ``categories`` (null: 0). A node that is to
    become s shards is cut along the dimension with the widest range (in units of the whole table's) so that its first
    part holds floor(s / 2) / s of its bytes. Equal texts take the smallest places of their group and stay together
    unless the group is over ``group_share`` of a shard; such a group may be cut between any of its documents, so no
    shard depends on a hot text. At last shards above the mean hand their smaller texts, by hash, to those below it (``_evened``). Size:
    bytes of the text (null: none) plus 16. Slots count from 0 in each shard, ordered by hash; rows alike in id and text
    are told apart by their order alone. An empty table gives an empty one; with fewer texts than shards some shards
    stay empty, and a shard is never smaller than its largest text.
    """
    if law != "bytes":
        raise ValueError("the k-d tree balances bytes")
    slim = written(_slim(df, doc_id, text, dimensions, categories), "slim")
    axes = range(2 + len(dimensions) + len(categories))
    raw = lambda i: F.get("raw", F.lit(i))
    total = slim.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("s"), *[F.min(raw(i)).alias(f"lo{i}") for i in axes], *[F.max(raw(i)).alias(f"hi{i}") for i in axes]).first()
    groups = slim.groupBy("th").agg(F.sum("size").alias("s"), F.count("*").alias("n"), *[F.min(raw(i)).alias(f"least{i}") for i in axes]).where("n > 1")
    groups = written(groups.select(F.col("th").alias("gth"), (F.col("s") > total["s"] / shards * group_share).alias("hot"), F.array(*[F.col(f"least{i}") for i in axes]).alias("least")), "groups")
    groups = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    rows = slim.join(groups, F.col("th") == F.col("gth"), "left").withColumn("hot", F.coalesce("hot", F.lit(False))).withColumn("raw", F.coalesce("least", "raw"))
    places = []
    for i in axes:
        lo, hi = total[f"lo{i}"] or 0.0, total[f"hi{i}"] or 0.0
        places.append(F.floor((raw(i) - F.lit(lo)) / F.lit((hi - lo) or 1.0) * F.lit(float((1 << PLACE) - 1))).cast("long"))
    own = F.when(F.col("hot"), F.shiftleft(_low(F.shiftrightunsigned("th", 17), GROUP), SPREAD) + _low(F.shiftrightunsigned("h", 11), SPREAD)).otherwise(_low(F.shiftrightunsigned("th", 7), GROUP + SPREAD))
    rows = written(rows.select("doc_id", "size", "text_crc32", "th", "h", "hot", F.array(*places).alias("place"), own.alias("group")), "placed")

    tree, nodes = _Tree(), {0: (0, shards)}  # node: its first shard and number of shards
    while open_ := {k: v for k, v in nodes.items() if v[1] > 1}:
        _level(rows, tree, open_, len(axes))
        nodes = {k: v for k, v in nodes.items() if v[1] == 1}
        for n, (first, k) in open_.items():
            if n in tree.cuts:
                nodes |= {2 * n + 1: (first, k // 2), 2 * n + 2: (first + k // 2, k - k // 2)}
    leaves = _of({n: first for n, (first, _) in nodes.items()}, F.col("node"), max(nodes, default=0) + 1).cast("int")
    placed = rows.withColumn("node", tree.node()).select("doc_id", "size", "text_crc32", "th", "h", "hot", leaves.alias("shard"))
    placed = _evened(written(placed, "leaves"), shards, total["s"] / shards)
    return with_running_total(placed, ["shard"], "h", ["doc_id", "size"], "one", "slot").drop("one")


def _evened(rows: DataFrame, shards: int, mean: float) -> DataFrame:
    """``rows`` with shards nearer to the mean: what a shard has above it is handed, text by text, to those below.

    Of a shard those texts move, in the order of their hash, that are no larger than the least power of 2 up to which
    its texts have enough bytes together; so it ends within such a text of the mean. The bytes handed out are dealt to
    the shards below the mean in turn, each as much as it lacks. Copies of a text in one shard move together, but
    documents of a group that is spread one by one.
    """
    rows = rows.withColumn("unit", F.when(F.col("hot"), F.col("h")).otherwise(F.col("th")))
    have = {r["shard"]: r["s"] for r in rows.groupBy("shard").agg(F.sum("size").alias("s")).collect()}  # a row per shard
    excess = {i: have.get(i, 0) - mean for i in range(shards)}
    above, lacking = {i: e for i, e in excess.items() if e > 0}, {i: -e for i, e in excess.items() if e < 0}
    small = lambda data, schema: F.broadcast(rows.sparkSession.createDataFrame(data, schema))
    units = written(rows.groupBy("shard", "unit").agg(F.sum("size").alias("bytes")).withColumn("power", F.ceil(F.log2("bytes")).cast("int")), "units")
    most, given, offset = [], 0.0, {}
    powers = {}
    for r in units.groupBy("shard", "power").agg(F.sum("bytes").alias("s")).collect():  # at most 63 rows a shard
        powers.setdefault(r["shard"], {})[r["power"]] = r["s"]
    for i, e in sorted(above.items()):
        run = 0
        for p, s in sorted(powers[i].items()):
            run += s
            if run >= e:
                most.append((i, p, float(e), float(given)))
                given += e
                break
    if not most:
        return rows.select("doc_id", "size", "text_crc32", "h", "shard", F.lit(1).cast("long").alias("one"))
    ends, run = [], 0.0
    for i, lack in sorted(lacking.items()):
        ends.append((i, run, run + lack))
        run += lack
    movable = units.join(small(most, "ms int, most int, excess double, given double"), F.col("shard") == F.col("ms")).where("power <= most")
    moved = with_running_total(movable.drop("ms"), ["shard"], "unit", ["bytes"], "bytes", "begin", bits=6).where(F.col("begin") + F.col("bytes") <= F.col("excess"))
    middle = F.col("given") + F.col("begin") + F.col("bytes") / 2
    moved = moved.withColumn("middle", middle).join(small(ends, "new int, lo double, hi double"), (F.col("middle") >= F.col("lo")) & (F.col("middle") < F.col("hi")))
    moved = written(moved.select(F.col("shard").alias("ms"), F.col("unit").alias("mu"), "new"), "moved")
    moved = F.broadcast(moved) if moved.count() <= BROADCAST_ROWS else moved
    out = rows.join(moved, (F.col("shard") == F.col("ms")) & (F.col("unit") == F.col("mu")), "left").withColumn("shard", F.coalesce("new", "shard"))
    return written(out.select("doc_id", "size", "text_crc32", "h", "shard", F.lit(1).cast("long").alias("one")), "shards")


def sharded_documents(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` with shard and slot (columns of those names are replaced); rows alike in id and text share
    their places among themselves. Null texts and ids are values like others; no rows give none."""
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    keyed = packed(df.select(*[F.col(f"`{c}`") for c in names])).withColumn("h", F.xxhash64(F.col("_row.doc_id"), F.col("_row.text")))
    placed = written(kd_shards(df, **options).select(F.col("h").alias("ph"), "shard", "slot"), "placed")
    placed = numbered(placed, "ph", "pn", "slot")
    rows = numbered(keyed, "h", "n")
    return rows.join(placed, (F.col("h") == F.col("ph")) & (F.col("n") == F.col("pn"))).select("_row.*", "shard", "slot")
