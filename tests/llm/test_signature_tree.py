"""Signature trees: bounds and descent against all pairs, the operator against brute force and SQL, odd rows."""

import collections
import random

import numpy as np
import pytest

from rasterloom.llm import neardup, shared
from rasterloom.llm import signature_tree as st

SCHEMA = "doc_id long, text string, id long, n int, place string, component string, s0 int, prefix string, tile string"


def shingles(text, k=5):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ")
    words = [w for w in words if w]
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return sorted((repr((d, len(sets[i]), least.get(top(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows)))


def run(spark, rows, percent=80):
    df = spark.createDataFrame([(*r, 1, 2, "p", "c", 3, "x", "t") for r in rows], SCHEMA)
    return sorted(repr((r.doc_id, r.n_shingles, r.component_id)) for r in st.similar_texts(df, percent=percent).collect())


def varied(rng, base, changes):
    words = list(base)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(rng, groups, size):
    rows, passage = [], [f"p{i}" for i in range(40)]
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 12, 60, 200]))]
        for _ in range(rng.randint(1, size)):
            rows.append((rng.randrange(10**9), varied(rng, base + (passage if g % 2 else []), rng.choice([0, 0, 1, 2, 3, 5]))))
    return rows


@pytest.mark.parametrize("seed", [1])
def test_against_all_pairs(spark, seed):
    rows = corpus(random.Random(seed), 40, 12)
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("percent", [50, 100])
def test_other_thresholds(spark, percent):
    rows = corpus(random.Random(5), 25, 8)
    assert run(spark, rows, percent) == brute(rows, percent)


def test_large_buckets_go_down_the_tree(spark, monkeypatch):
    """A template whose texts are all nearly similar, frequent shingles and tiles of a few members."""
    monkeypatch.setattr(neardup, "TILE", 12)
    monkeypatch.setattr(st, "PAIRED", 4)
    monkeypatch.setattr(st, "LOCAL", 2)
    monkeypatch.setattr(shared, "DEALT", 16)
    rng = random.Random(9)
    base = [f"t{i}" for i in range(70)]
    rows = [(i, varied(rng, base, rng.choice([1, 2, 3, 6]))) for i in range(160)]
    rows += [(1000 + i, " ".join(base[:20]) + f" tail{i} " + varied(rng, [f"u{i}x{j}" for j in range(20)], 0)) for i in range(60)]
    assert run(spark, rows) == brute(rows)


def test_descent_keeps_every_possible_pair():
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(90):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 3000), dtype=np.uint64)) if not sets or rng.random() < 0.5 else sets[rng.integers(len(sets))]
        sets.append(base[rng.random(len(base)) < 0.97] if len(base) > 3 else base)
    n, sigs = np.array([len(s) for s in sets]), np.array([st.bitmap(s) for s in sets])
    excess, part = n - np.bitwise_count(sigs).sum(axis=1), np.arange(len(sets))
    nodes = st._Nodes(n, excess, sigs, part)
    near = st.traversed(nodes, nodes, 80)
    for i in range(len(sets)):
        for j in range(len(sets)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if i != j and 100 * common >= 80 * (n[i] + n[j] - common):
                assert near[i, j]
    wide = [st.bitmap(s, st.width(len(s))) for s in sets]
    more = np.array([st.excess(len(s), b) for s, b in zip(sets, wide)])
    overlap = st.wide_overlap(near, wide, wide, more, more)
    assert all(overlap[i, j] >= len(np.intersect1d(sets[i], sets[j])) for i, j in zip(*np.nonzero(near)))
    assert near.mean() < 0.2


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(6)
    last = np.unique(rng.integers(0, 2**63, 200, dtype=np.uint64))
    times = rng.integers(32, 99, len(last))
    for _ in range(300):
        x = np.unique(np.concatenate([rng.integers(0, 2**63, rng.integers(1, 60), dtype=np.uint64), rng.choice(last, rng.integers(0, 40))]))
        y = x[rng.random(len(x)) < 0.85]
        if 100 * len(y) >= 80 * len(x) and len(y):
            assert np.intersect1d(st.prefix(x, 80, last, times), st.prefix(y, 80, last, times)).size


def test_odd_rows_and_repeats(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (2, None), (3, ""), (4, " \n"), (None, text), (None, "alone in here"), (6, text.upper()), (6, text.upper()), (6, "Other words under one id"), (7, "long " * 30000 + "end"), (8, "two words"), (9, "TWO WORDS"), (-3, "two  words"), (10, "naïve \U0001f600  text Ä"), (11, "naïve \U0001f600  text ä")]
    assert run(spark, rows) == brute(rows)


def test_copies_in_thousands(spark):
    rows = [(i, "same words in every one of these many rows here") for i in range(3000)] + [(-1, "same words in every one of these many rows here")]
    assert collections.Counter(run(spark, rows)) == collections.Counter(repr((d, 6, -1)) for d, _ in rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_leaves_are_deleted_once_their_classes_are_written(spark):
    import glob

    there = lambda name: set(glob.glob(f"{shared.shared_dir(spark).removeprefix('file://')}/rasterloom/{name}-*"))
    before = there("leaves"), there("rows")
    df = spark.createDataFrame([(i, f"a b c d e f g h {i // 2}") for i in range(20)], "doc_id long, text string")
    assert len({r.component_id for r in st.similar_texts(df).collect()}) == 10
    assert there("leaves") == before[0] and len(there("rows")) == len(before[1]) + 1


def test_pairs_are_tested_on_thin_bitmaps_and_sizes_go_first(spark, monkeypatch):
    """What is sent with a pair has two bits a shingle at most and allows each link; pairs of unlike sizes send none."""
    rng = np.random.default_rng(8)
    sets = []
    for n in (1, 2, 63, 64, 65, 130, 512, 513, 1100):
        s = rng.integers(0, 2**64, n, dtype=np.uint64)
        sets += [s, s[: max(1, -(-n * 80 // 100))]]
    rows = [(i, len(s), st.bitmap(s, st.width(len(s))).view(np.int64).tolist()) for i, s in enumerate(sets)]
    thin = st._thin(spark.createDataFrame(rows, "id long, n long, bits array<long>"))
    for r in thin.collect():
        want = st.bitmap(sets[r.id], 64 * len(r.bits))
        assert np.array(r.bits).view(np.uint64).tolist() == want.tolist() and r.excess == st.excess(r.n, want)
        assert r.n <= 64 * len(r.bits) < 2 * max(r.n, 64) or r.n == 1
    side = lambda p: thin.select(*[thin[c].alias(p + c) for c in thin.columns])
    met = {(r.aid, r.bid) for r in side("a").join(side("b")).where(st._may_link("a", "b", 80)).select("aid", "bid").collect()}
    assert {(i, i + 1) for i in range(0, len(sets), 2) if len(sets[i]) > 2} <= met

    seen, write = {}, st.written
    monkeypatch.setattr(st, "written", lambda df, label: seen.setdefault(label, write(df, label)))
    monkeypatch.setattr(st, "dropped", lambda *tables: None)
    texts = [(i, " ".join(f"w{j}" for j in range(8 + 20 * i))) for i in range(4)]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.component_id for r in st.similar_texts(rows).collect()} == {0, 1, 2, 3}
    assert seen["stars"].count() > 0 and seen["sized"].count() < seen["stars"].count()


def test_shingles_that_texts_share_by_chance_bring_few_together(spark, monkeypatch):
    """Phrases of some 15 texts each, too rare for the list of frequent shingles: they stay out of prefixes, nothing is lost."""
    seen, write = {}, st.written
    monkeypatch.setattr(st, "written", lambda df, label: seen.setdefault(label, write(df, label)))
    monkeypatch.setattr(st, "dropped", lambda *tables: None)
    rng = random.Random(11)
    phrases = [" ".join(f"c{i}x{j}" for j in range(8)) for i in range(40)]
    rows = [(i, " ".join(f"{rng.choice(phrases)} o{i}y{j} p{i}y{j}" for j in range(3)) + " " + " ".join(f"e{i}y{j}" for j in range(20))) for i in range(200)]
    rows += [(1000 + i, varied(rng, t.split(), 1)) for i, t in rows[:20]]
    assert run(spark, rows) == brute(rows)
    assert seen["buckets"].count() <= 80 and seen["buckets"].groupBy("key").count().where("count > 2").count() <= 20


def test_prefixes_meet_whatever_the_cells_say():
    rng = np.random.default_rng(7)
    cells = rng.integers(0, 5, st.CELLS).astype(np.uint16)
    none = np.zeros(0, np.uint64)
    last = np.unique(rng.integers(0, 2**64, 200, dtype=np.uint64))
    for listed, times in ((none, none.astype(np.int64)), (last, rng.integers(32, 99, len(last)))):
        for _ in range(300):
            x = np.unique(np.concatenate([rng.integers(0, 2**64, rng.integers(1, 60), dtype=np.uint64), rng.choice(last, rng.integers(0, 40))]))
            y = x[rng.random(len(x)) < 0.85]
            if 100 * len(y) >= 80 * len(x) and len(y):
                a, b = st.prefix(x, 80, listed, times, cells), st.prefix(y, 80, listed, times, cells)
                assert np.intersect1d(a, b).size and len(a) == len(x) - -(-len(x) * 80 // 100) + 1


def test_shuffles_of_written_tables_are_deleted(spark):
    import glob
    import os
    import time

    from pyspark.sql import functions as F

    folder = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0]
    there = lambda: {f for f in glob.glob(f"{folder}/*/shuffle_*") if os.path.getsize(f)}
    setting, before = spark.conf.get(shared.CLEANUP), there()
    shared.written(spark.range(20_000).groupBy((F.col("id") % 999).alias("k")).count(), "sums")
    for _ in range(50):  # files are deleted in the background
        if there() <= before:
            break
        time.sleep(0.1)
    assert there() <= before and spark.conf.get(shared.CLEANUP) == setting
