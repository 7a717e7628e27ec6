"""Merkle manifest of a dataset: a content-addressed tree of digests, and proofs read from it.

Every row is a leaf. The leaves of a group (a source) stand in the order of their key; every 16 successive nodes are
hashed to one until one is left, the group's subroot, and the subroots are joined likewise to the root. The tree is kept
as records (digest, children), one table a height. A proof is found by descent: the requested leaves' ranks, written
in base 16, say which child to take from the root down; the children not taken are collected, and the path is reversed
at the end. Requests below one node descend together, so a node is looked up once and no row of the upper levels is
hot; what differs between the leaves of a last node is made where that node's record is read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.shared import DEALT, met, ranked, written

FANOUT, BITS = 16, 4


class Tree(NamedTuple):
    """``records[h]``: (digest, children, times) of the nodes of height h + 1; ``tops``: (group columns, height, digest);
    ``often[h]``: whether some digest of that height stands for more than DEALT nodes."""

    records: list[DataFrame]
    tops: DataFrame
    often: list[bool]


class Manifest(NamedTuple):
    """``leaves``: (group, key, leaf, rank and what else was asked for); a tree for the groups and one above them."""

    leaves: DataFrame
    groups: Tree
    roots: DataFrame
    above: Tree


def encoded(column: str, kind: str) -> Column:
    """``-`` if null, else the number of UTF-8 bytes, a colon and the value."""
    value = F.col(column) if kind == "string" else F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(df: DataFrame, columns: list[str], changed: dict[str, Column] | None = None) -> Column:
    """The digest of a row's ``columns``, those in ``changed`` with other values."""
    kinds, out = dict(df.dtypes), []
    for c in columns:
        if changed and c in changed:
            value = changed[c]
            out.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
        else:
            out.append(encoded(c, kinds[c]))
    return digest(*out)


def _joined(nodes: Column) -> Column:
    return F.array_join(nodes, "")


def tree(nodes: DataFrame, group: list[str], label: str) -> Tree:
    """The tree over ``nodes`` (group columns, rank, total, digest), where total counts the nodes of the group."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    level, height, records, tops, hot = nodes.select(*group, "rank", "total", "digest"), 0, [], [], []
    while True:
        tops.append(level.where("total = 1").select(*group, F.lit(height).alias("height"), "digest"))
        if most <= 1:
            break
        runs = level.where("total > 1").groupBy(*group, F.shiftright("rank", BITS).alias("rank"))
        runs = runs.agg(F.sort_array(F.collect_list(F.struct(F.col("rank").alias("r"), "digest")))["digest"].alias("children"), F.first("total").alias("total"))
        level = written(runs.select(*group, "rank", F.ceil(F.col("total") / FANOUT).cast("long").alias("total"), F.sha2(_joined(F.col("children")), 256).alias("digest"), "children"), label)
        kept = level.groupBy("digest").agg(F.first("children").alias("children"), F.count("*").alias("times"))
        records.append(kept)
        hot.append((kept.agg(F.max("times")).first()[0] or 0) > DEALT)
        height, most = height + 1, -(-most // FANOUT)
    out = tops[0]
    for t in tops[1:]:
        out = out.union(t)
    return Tree(records, out, hot)


def manifest(leaves: DataFrame, group: str, order: list[str]) -> Manifest:
    """The manifest of ``leaves`` (with a column ``leaf``), grouped and ordered by those columns, nulls first.

    Rows alike in group and order stand by their leaves; those alike in that too have equal digests, so that it does not
    matter which comes first. Groups are ordered by their UTF-8 bytes, a null one first. No rows give no root.
    """
    placed = ranked(leaves, [group], [*order, "leaf"], "leaves")
    below = tree(placed.select(group, "rank", "total", F.col("leaf").alias("digest")), [group], "nodes")
    roots = ranked(below.tops.withColumnRenamed("digest", "subroot"), [], [group], "subroots")
    above = tree(roots.select("rank", "total", F.col("subroot").alias("digest")), [], "top")
    return Manifest(placed, below, roots, above)


_PATH = "array<struct<left:string,right:string>>"


def _siblings(at: Column) -> Column:
    return F.struct(_joined(F.slice("children", F.lit(1), at)).alias("left"), _joined(F.slice("children", at + 2, F.lit(FANOUT))).alias("right"))


def _found(front: DataFrame, records: DataFrame, hot: bool, spread: list[str]) -> DataFrame:
    """``front`` with the children of its digests."""
    many = records.where(F.col("times") > DEALT).select("digest", F.ceil(F.col("times") / DEALT).cast("int").alias("parts")) if hot else None
    return met(front, records.select("digest", "children"), ["digest"], spread, many)


def _down(front: DataFrame, records: DataFrame, hot: bool, keep: list[str]) -> DataFrame:
    """One level down: each child with its rank and the path so far, to which its siblings are added."""
    taken = _found(front, records, hot, ["rank"]).select(*keep, "rank", "path", "children", F.posexplode("children").alias("digit", "child"))
    path = F.concat("path", F.array(_siblings(F.col("digit"))))
    return taken.select(*keep, (F.col("rank") * FANOUT + F.col("digit")).alias("rank"), F.col("child").alias("digest"), path.alias("path"))


def proofs(made: Manifest, requests: DataFrame, group: str) -> DataFrame:
    """``requests`` (rows of ``made.leaves``, with any further columns) with subroot, root, digest (the leaf that the
    descent came to) and path, leaf to root: the digests left and right of the path's node, each joined."""
    names = requests.columns
    same = lambda a, b: a[group].eqNullSafe(b[group])
    asked = requests.select(group, "rank")
    front = made.above.tops.select("digest", F.col("digest").alias("root"), F.lit(0).cast("long").alias("rank"), F.array().cast(_PATH).alias("path"))
    for records, hot in zip(reversed(made.above.records), reversed(made.above.often)):
        front = _down(front, records, hot, ["root"])
    start = made.roots.select(group, "height", "rank").join(front, "rank").drop("rank").withColumn("rank", F.lit(0).cast("long")).withColumn("subroot", F.col("digest"))
    carried, front, done = [group, "subroot", "root"], None, None
    for height in range(len(made.groups.records), -1, -1):
        here = start.where(F.col("height") == height).select(*carried, "rank", "digest", "path")
        front = here if front is None else front.unionByName(here) if height else here
        if height == 0:  # groups of one leaf
            alone = requests.join(front.withColumnRenamed("rank", "_r").withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("rank") == F.col("_r")))
            alone = alone.select(*names, "subroot", "root", "digest", F.reverse("path").alias("path"))
            return alone if done is None else done.unionByName(alone)
        wanted = asked.select(group, F.shiftright("rank", BITS * height).alias("rank")).distinct()
        records, hot = made.groups.records[height - 1], made.groups.often[height - 1]
        if height > 1:
            front = front.join(wanted, same(front, wanted) & (front["rank"] == wanted["rank"]), "left_semi")
            front = _down(front, records, hot, carried)
            continue
        each = requests.select(F.col(group).alias("_g"), F.shiftright("rank", BITS).alias("_r"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
        each = each.groupBy("_g", "_r").agg(F.collect_list("_row").alias("_rows"))  # FANOUT at most
        last = _found(front, records, hot, ["rank"]).join(each, F.col(group).eqNullSafe(F.col("_g")) & (F.col("rank") == F.col("_r")))
        last = last.select("subroot", "root", "path", "children", F.explode("_rows").alias("_row"))
        digit = (F.col("_row.rank") % FANOUT).cast("int")
        done = last.select("_row.*", "subroot", "root", F.get("children", digit).alias("digest"), F.reverse(F.concat("path", F.array(_siblings(digit)))).alias("path"))
    return done


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path, leaf to root, lead to."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def path_digest(path: Column) -> Column:
    return F.sha2(_joined(F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def verified(df: DataFrame, columns: list[str], group: str = "source", key: str = "doc_id", changed: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root and verified of every row, its columns ``changed`` where
    ``where`` holds.

    A leaf is the digest of a row's ``columns``; nulls are ``-``, and an empty text is ``0:``. Rows are grouped by
    ``group`` (null is a group, the first) and ordered by ``key``, null keys first, equal ones by their leaves; repeated
    rows are leaves of their own with equal results if they stand in places alike, else each with its own. The proof is
    that of the unchanged tree; folded_root starts from the changed row's leaf. Other columns are ignored and may have
    any name; an empty table gives an empty one.
    """
    leaf = leaf_digest(df, columns)
    read = leaf if not changed else F.when(F.lit(True) if where is None else where, leaf_digest(df, columns, changed)).otherwise(leaf)
    rows = df.select(F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("leaf"), read.alias("read"))
    made = manifest(rows, "group", ["key"])
    found = proofs(made, made.leaves.select("group", "rank", "key", "leaf", "read"), "group")
    out = found.select(F.col("key").alias(key), "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"), folded(F.col("read"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
