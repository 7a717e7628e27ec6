"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts are cut into words; k-grams of words are hashed, and of every window of w successive k-grams the smallest hash is
kept as a fingerprint. A window of w + k - 1 words has one fingerprint wherever it stands, so every shared span of that
many words shares one, and documents that share none can't contain any window. For the others each window is joined to
the benchmark's by fingerprint and extended to its full words, which makes the result exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rasterloom.llm.shared import unused, written

WORD = r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fingerprints of the benchmark, and candidate documents, up to which they are broadcast (about 16 and 40 bytes each);
#: more are joined by shuffle.
BROADCAST_FINGERPRINTS, BROADCAST_DOCUMENTS = 1_000_000, 300_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(1))


def _grams(hashes: Column, k: int) -> Column:
    """Hash of each k successive words."""
    if k == 1:
        return hashes
    n = F.size(hashes)
    made = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]))
    return F.when(n >= k, made).otherwise(F.array().cast("array<bigint>"))


def _shape(length: int, k: int) -> tuple[int, int]:
    """Words of a gram, grams of a window."""
    return (min(k, length), length - min(k, length) + 1)


def _minima(grams: Column, w: int) -> Column:
    """Smallest hash of each w successive grams."""
    if w == 1:
        return grams
    n = F.size(grams)
    made = F.transform(F.sequence(F.lit(0), n - w), lambda i: F.least(*[F.get(grams, i + j) for j in range(w)]))
    return F.when(n >= w, made).otherwise(F.array().cast("array<bigint>"))


def _with_fingerprints(df: DataFrame, lengths: list[int], k: int) -> DataFrame:
    """Adds ``prints``: the distinct fingerprints for windows of every length; each length has hashes of its own.

    Grams and minima are columns of their own, each computed once a row, and not nested in each other's lambdas.
    """
    for n in lengths:
        a, w = _shape(n, k)
        df = df.withColumn(f"_g{n}", _grams(F.col("hashes"), a))
        df = df.withColumn(f"_m{n}", F.array_distinct(_minima(F.col(f"_g{n}"), w)))
    own = [F.col(f"_m{n}") if n == max(lengths) else _salted(F.col(f"_m{n}"), n) for n in lengths]
    return df.withColumn("prints", own[0] if len(own) == 1 else F.concat(*own))


def _salted(hashes: Column, n: int) -> Column:
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(n)))


def _windows(df: DataFrame, keep: list[str], lengths: list[int], k: int, longest: int) -> DataFrame:
    """A row per window of each length: keep, start, length, window (its words), f (its fingerprint)."""

    def of_length(n: int) -> DataFrame:
        a, w = _shape(n, k)
        x = df.withColumn("grams", _grams(F.col("hashes"), a)).where(F.size("words") >= n)
        x = x.withColumn("starts", F.sequence(F.lit(0), F.size("words") - n))
        window = lambda i: F.struct(
            i.alias("start"), F.array_join(F.slice("words", i + 1, n), " ").alias("window"), F.array_min(F.slice("grams", i + 1, w)).alias("f")
        )
        x = x.select(*keep, F.explode(F.transform("starts", window)).alias("x")).select(*keep, "x.start", F.lit(n).alias("length"), "x.window", "x.f")
        return x if n == longest else x.withColumn("f", F.xxhash64("f", F.lit(n)))

    return reduce(DataFrame.unionByName, [of_length(n) for n in lengths])


def contamination(df: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted array of item_ids as strings) and contaminated of every row.

    A word is hit if it lies in an occurrence of any window: ``window`` successive words of an item, or all words of an
    item that has fewer. Null or empty texts have no words and no hits; items without words have no windows; an item
    with a null id makes hits but isn't listed; rows alike in id and text get the same result, each its own row. Empty
    tables give no hits or no rows. Other columns are ignored.
    """
    return _judged(df, benchmark, window, k, doc_id, text, item_id, item_text).drop("key")


def _row_key(doc_id: Column, text: Column) -> Column:
    """A document's id, text hash and length, each told from a null."""
    return F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("-")) for c in (doc_id, F.hex(F.xxhash64(text)), F.length(text))])


def _judged(df: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``contamination`` with the ``key`` of every row."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text)).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x))).withColumn("n", F.least(F.size("words"), F.lit(window)))
    items = written(items, "items")
    lengths = sorted(r[0] for r in items.select("n").distinct().collect()) or [window]  # ``window`` values at most
    longest = max(lengths)
    own = reduce(DataFrame.unionByName, [_windows(items.where(F.col("n") == n), ["item"], [n], k, longest) for n in lengths])
    own = written(own.select("item", "length", "window", "f").distinct(), "item-windows")
    prints = own.select("f").distinct()
    few = prints.count() <= BROADCAST_FINGERPRINTS
    prints = F.broadcast(prints) if few else prints

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("key", _row_key(F.col("doc_id"), F.col("text")))
    cut = rows.withColumn("words", words_of(F.col("text"))).withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    marks = _with_fingerprints(cut, lengths, k).select("key", "doc_id", F.size("words").cast("long").alias("n_words"), F.posexplode_outer("prints").alias("at", "f"))
    met = prints.withColumnRenamed("f", "pf").withColumn("met", F.lit(1))
    joined = marks.join(F.broadcast(met) if few else met, F.col("f") == F.col("pf"), "left")
    all_docs = joined.groupBy("key", "doc_id", "n_words").agg(
        F.max("met").alias("met"), F.sum(F.when(F.col("at").isNull() | (F.col("at") == 0), 1).otherwise(0)).alias("times")
    )
    all_docs = written(all_docs, "fingerprinted")

    near = all_docs.where("met = 1").select("key")
    near = F.broadcast(near) if near.count() <= BROADCAST_DOCUMENTS else near
    found = rows.join(near, "key", "left_semi").dropDuplicates(["key"])
    found = found.withColumn("words", words_of(F.col("text"))).withColumn("hashes", F.transform("words", lambda x: F.xxhash64(x)))
    names = own.select("f", "window").distinct().withColumn("w", F.xxhash64("window", "f"))
    names = F.broadcast(names) if few else names
    hits = _windows(found.select("key", "words", "hashes"), ["key"], lengths, k, longest).join(names, ["f", "window"]).select("key", "start", "length", "w")
    hits = written(hits, "hits")

    order = Window.partitionBy("key").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    before = F.coalesce(F.max(end).over(order), F.lit(0))
    covered = hits.select("key", F.greatest(F.lit(0), end - F.greatest("start", before)).alias("new")).groupBy("key").agg(F.sum("new").cast("long").alias("n_hit"))
    of = own.select(F.xxhash64("window", "f").alias("w"), "item").distinct()
    listed = hits.select("key", "w").distinct().join(F.broadcast(of) if few else of, "w").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = covered.join(listed, "key", "left")
    out = all_docs.join(result, "key", "left").withColumn("_t", F.explode(F.sequence(F.lit(1), F.col("times"))))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return out.select("key", "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"), (n_hit > 0).alias("contaminated"))


def clean_documents(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` whose own text has no hit, with its columns; other rows of the same or a null doc_id stay.

    Null and empty texts have no words and stay, repeated rows stay or go together, and an empty benchmark lets all stay.
    """
    name = unused(df, "_bad")
    bad = _judged(df, benchmark, **options).where("contaminated").select(F.col("key").alias(name)).distinct()
    bad = written(bad, "contaminated")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_DOCUMENTS else bad
    key = _row_key(F.col(options.get("doc_id", "doc_id")), F.col(options.get("text", "text")))
    return df.join(bad, key == F.col(name), "left_anti")
