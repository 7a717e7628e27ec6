"""Merkle manifest against a tree built in memory, on odd rows, deep trees and subsets of requests."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from rasterloom.llm import merkle, shared

COLUMNS = ["doc_id", "source", "n_chars", "text"]
SCHEMA = "doc_id long, source string, n_chars long, text string, rank string, leaf string, `group` int, digest string, path string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(*[part(v) for v in (*row[:3], text)])


def tree(nodes):
    """The root of the nodes and per node the siblings' digests (left, right), level by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(places):
            run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
            paths[i].append(("".join(run[: p % 16]), "".join(run[p % 16 + 1 :])))
        nodes = [sha(*nodes[j : j + 16]) for j in range(0, len(nodes), 16)]
        places = [p // 16 for p in places]
    return nodes[0], paths


def expected(rows, asked):
    low = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    by = collections.defaultdict(list)
    for r in rows:
        mine = leaf(r, r[3])
        by[r[1]].append((r[0] is not None, r[0] or 0, mine, leaf(r, r[3].translate(low) if r[3] is not None else None) if asked(r[0]) else mine, r[0]))
    out, order = [], sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    roots = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    root, above = tree([roots[s][0] for s in order])
    for s, up in zip(order, above):
        for x, path in zip(sorted(by[s], key=lambda x: x[:3]), roots[s][1]):
            now = x[3]
            for left, right in path + up:
                now = sha(left, now, right)
            out.append((x[4], x[2], roots[s][0], root, sha(*[a + b for a, b in path + up]), now, now == root))
    return sorted(map(repr, out))


def wide(rows):
    return [(*r, "r", "l", 1, "d", "p") for r in rows]


def run(spark, rows, asked=lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0):
    df = spark.createDataFrame(wide(rows), SCHEMA)
    lowered = {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    got = merkle.verified(df, COLUMNS, changed=lowered, where=F.crc32(F.col("doc_id").cast("string")) % 5 == 0)
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(rows, asked)


def test_odd_rows(spark):
    run(spark, [(1, None, 3, "Ab"), (2, "", None, None), (None, "é", 0, ""), (None, "é", 0, "X"), (7, "é", 9, "Straße ÀB" * 9000), (7, "é", 9, "other"), (-5, "é", 1, "Q"), (8, "Z", 1, "a"), (8, "Z", 1, "a")])


@pytest.mark.parametrize("n", [1, 17, 5000])
def test_depths(spark, n):
    run(spark, [(i * 7 % 10007, f"s{i % 19}" if i % 3 else "hot", i, f"Text {i}") for i in range(n)])


def test_many_sources(spark):
    run(spark, [(i, f"source {i}", i, f"Text {i}") for i in range(290)])


def test_a_row_repeated_often(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEALT", 4)
    monkeypatch.setattr(shared, "DEALT", 4)
    run(spark, [(5, "hot", 1, "Same")] * 700 + [(i, "hot", 1, f"T{i}") for i in range(40)])


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.verified(df, COLUMNS).collect() == []


def test_some_requests(spark):
    rows = [(i, "a" if i % 4 else "b", 1, f"T{i}") for i in range(600)]
    df = spark.createDataFrame(wide(rows), SCHEMA).select(F.col("source").alias("group"), F.col("doc_id").alias("key"), merkle.leaf_digest(spark.createDataFrame(wide(rows), SCHEMA), COLUMNS).alias("leaf"))
    made = merkle.manifest(df, "group", ["key"])
    found = merkle.proofs(made, made.leaves.where("key % 97 = 3").select("group", "rank", "key", "leaf"), "group")
    got = found.select("key", "leaf", "digest", "root", merkle.folded(F.col("leaf"), F.col("path")).alias("folded")).collect()
    assert sorted(r.key for r in got) == [i for i in range(600) if i % 97 == 3]
    assert all(r.leaf == r.digest and r.folded == r.root for r in got)
