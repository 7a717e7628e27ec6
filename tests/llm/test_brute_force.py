"""Whole-table queries against plain Python on the smallest tables."""

import collections

import duckdb
import pytest

from rasterloom.llm import queries


@pytest.fixture(scope="module")
def documents(sf_dir):
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{sf_dir}/documents.parquet'").fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, sf_dir).toArrow(), con.execute(queries.ORACLE_SQL[name]).to_arrow_table()
    names = sorted(want.column_names)
    assert sorted(got.column_names) == names
    rows = lambda t: sorted(repr(r) for r in zip(*(t.column(n).to_pylist() for n in names)))
    assert rows(got) == rows(want)


def test_near_duplicates(spark, sf_dir, documents):
    sets = {}
    for i, t, *_ in documents:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j : j + 3]) for j in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])
    of = collections.defaultdict(list)
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = collections.Counter(j for s in sets[i] for j in of[s])
        for j, n in common.items():
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
        for s in sets[i]:
            of[s].append(i)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in queries.op7_minhash_hamming(spark, sf_dir).collect()}
    assert got == {i: (len(s), root(i), root(i) == i) for i, s in sets.items()}


def test_language(spark, sf_dir, documents):
    lang = {i: x for i, _, x, _ in documents}
    rows = [r for r in queries.op10_language_id(spark, sf_dir).collect() if r.held_out]
    assert rows and sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def test_language_by_plain_counting(spark, sf_dir, documents):
    import math
    import zlib

    from pyspark.sql import functions as F

    from rasterloom.llm import langid

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(langid.learnable(F.col("doc_id"), F.col("lang"))).select("doc_id", F.col("lang").cast("string"), "text"))
    text = {i: t for i, t, *_ in documents}

    def plain(t):
        low = "".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in t or "")
        if not low.split():
            return ("und", 0.0)
        codes = [0, *(x for w in low.split() for x in [*map(ord, w), 0])]
        if not low[-1].isspace():
            codes.pop()
        counts = collections.Counter()
        for i in range(len(codes)):
            for n in (1, 2, 3):
                if i + n <= len(codes):
                    h = 0
                    for k in range(n):
                        h = (h + codes[i + k] + k + 1) * 0x9E3779B97F4A7C15 % 2**64
                        h ^= h >> 32
                    counts[(h >> 11) & 0xFFFF] += 1
        total = sum(counts.values())
        z = [(math.fsum(float(w[f]) * math.sqrt(c / total) for f, c in counts.items()) + b) / model.temperature for w, b in zip(model.weights, model.bias)]
        e = [math.exp(x - max(z)) for x in z]
        return max(zip(e, [-i for i in range(len(e))]))[1], max(e) / sum(e)

    for r in queries.op10_language_id(spark, sf_dir).collect():
        best, score = plain(text[r.doc_id])
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        assert r.lang_pred == (best if best == "und" else model.languages[-best]) and abs(r.score - score) < 1e-5


def test_media_columns(spark, sf_dir, documents):
    import hashlib
    import zlib

    import numpy as np

    text = {i: t for i, t, *_ in documents}
    got = queries.op4_media_columns(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in got) == sorted(text)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        payload = raw + bytes(-len(raw) % 64 if raw else 64)
        n = len(payload)
        head = b"RIFF" + (36 + n).to_bytes(4, "little") + b"WAVEfmt " + b"".join(v.to_bytes(k, "little") for v, k in ((16, 4), (1, 2), (1, 2), (8000, 4), (8000, 4), (1, 2), (8, 2))) + b"data" + n.to_bytes(4, "little")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), n, hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-64:]), n + 44, hashlib.sha256(head + payload).hexdigest())
        x = np.array(list(payload), float) - 128
        told = dict(part.split("=") for part in r.feature.split(";"))
        power = sum(np.abs(np.fft.fft(x[i : i + 64])[:33]) ** 2 for i in range(0, n, 64))
        want = {"rms": np.sqrt((x**2).mean()), "crossings": sum((a < 0) != (b < 0) for a, b in zip(x, x[1:])) / (n - 1), "centroid": (power * np.arange(33)).sum() / max(power.sum(), 1e-9)}
        assert all(abs(float(told[k]) - v) < 1e-3 for k, v in want.items())


def test_mix_is_the_demand_poured_out(spark, sf_dir, documents):
    rows = queries.op3_curriculum_mix(spark, sf_dir).collect()
    words = {i: len((t or "").encode().split()) for i, t, *_ in documents}
    names = sorted({s for *_, s in documents if s is not None}) + ([None] if any(s is None for *_, s in documents) else [])
    of = {s: sum(words[i] for i, *_, x in documents if x == s) for s in names}
    weights, open_, left, want = dict(zip(names, [5, 2, 1] * len(names))), set(names), 1.5 * sum(of.values()), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if level * weights[s] > 2 * of[s]}
        if not over:
            want |= {s: level * weights[s] for s in open_}
            break
        want |= {s: 2.0 * of[s] for s in over}
        left -= sum(want[s] for s in over)
        open_ -= over
    source, taken = {i: s for i, *_, s in documents}, collections.Counter()
    for r in rows:
        s = source[r.doc_id]
        assert r["size"] == words[r.doc_id] and r.source_size == of[s] and abs(r.target - want[s]) <= 1e-6 * want[s] and r.taken in (0, r["size"], 2 * r["size"])
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= max(words[i] for i in words if source[i] == s) / 2 + 1 for s in names)


def test_token_counts_of_every_text(spark, sf_dir, documents):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_file())
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t, *_ in documents}
    assert {r.doc_id: (r.n_tokens, r.n_bytes, r.over_limit) for r in queries.op1_token_counts(spark, sf_dir).collect()} == {i: (want[i], len((t or "").encode()), want[i] > 512) for i, t, *_ in documents}


def test_secret_scan(spark, sf_dir, documents):
    import hashlib

    from rasterloom.llm.secrets import ACCESS, ASSIGN

    import re

    for r in queries.op6_secret_scan(spark, sf_dir).collect():
        t = next(x[1] for x in documents if x[0] == r.doc_id) or ""
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6] + [(m.start(), 1, m.end()) for m in ACCESS.finditer(t) if len(m[0]) >= 20]
        found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        text = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(found))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest() and set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_chunk_repeats(spark, sf_dir, documents):
    got = {r.doc_id: r for r in queries.op9_chunk_dedup(spark, sf_dir).collect()}
    words = {i: (t or "").split() for i, t, *_ in documents}

    def places(n):
        found = collections.defaultdict(set)
        for i, w in words.items():
            for j in range(len(w) - n + 1):
                found[tuple(w[j : j + n])].add((i, j))
        return found

    shared = set().union(*[{i for i, _ in s} for s in places(51).values() if len({i for i, _ in s}) > 1])
    assert len(shared) and all(got[i].repeated for i in shared)
    short = places(16)
    for i, r in got.items():
        spans = [tuple(map(int, s.split(":"))) for s in r.spans.split(",") if s]
        assert r.n_words == len(words[i]) and r.repeat_words == sum(e - a for a, e in spans) and spans == sorted(spans)
        for a, e in spans:
            assert all(len(short[tuple(words[i][j : j + 16])]) > 1 for j in range(a, e - 15)), (i, a, e)


def test_mix_and_shards_cover_every_document(spark, sf_dir, documents):
    mix, placed = queries.op3_curriculum_mix(spark, sf_dir).collect(), queries.op8_kd_sharding(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in mix) == sorted(r.doc_id for r in placed) == sorted(d[0] for d in documents)
    sizes = {i: len(t.encode().split()) if t else 0 for i, t, *_ in documents}
    assert all(r["size"] == sizes[r.doc_id] and r.taken <= 2 * r["size"] for r in mix)
    assert [r.position for r in mix if r.position is not None] == sorted(r.position for r in mix if r.position is not None)
    assert {r.shard for r in placed} <= set(range(40))
