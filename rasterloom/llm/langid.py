"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

N-grams of 1 to 3 letters are hashed to 2^16 features. Document frequencies are counted over every learnable document
in one job. The weights are fitted by follow-the-regularised-leader with elastic-net penalties on a bounded sample of
labelled documents, so most are exactly 0; a temperature fitted on a held-back part of the sample calibrates the scores.
Scoring streams whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rasterloom.llm.shared import unused

FEATURES = 1 << 16
ORDERS = 3
UNKNOWN = "und"
#: Labelled documents a language that the fit may use (its bound); of more than LANGUAGES languages each has fewer, but
#: LEAST at least. All languages are learned; the rest of the corpus is used for the frequencies.
SAMPLE, LANGUAGES, LEAST = 400, 50, 20
#: Features of a document that the fit may use (the weightiest; about that many different ones are in 20,000 letters), so
#: that the driver holds 64 kB a document at most. Scores use all.
FIT_FEATURES = 8192
ALPHA, BETA, L1, L2, EPOCHS, BATCH = 0.5, 1.0, 1e-3, 1e-4, 6, 16


@lru_cache(1)
def _fold() -> np.ndarray:
    """Code point to its lower-case letter, 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _letters(text: str | None) -> np.ndarray | None:
    """Folded letters of the whole text, words bounded by one 0; None if it has no letter."""
    if not text:
        return None
    c = _fold()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    keep = c != 0
    if not keep.any():
        return None
    keep[1:] |= keep[:-1].copy()  # one 0 after each word
    return np.concatenate([np.zeros(1, np.uint32), c[keep]])


def _grams(letters: np.ndarray, known: int = 0) -> np.ndarray:
    """Hashed n-grams of all orders that end in ``letters`` behind the first ``known``."""
    c, out = letters.astype(np.uint64), []
    h = np.zeros(len(c), np.uint64)
    for n in range(1, ORDERS + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] + c[n - 1 :] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        out.append((h[max(0, known - n + 1) :] >> np.uint64(11)).astype(np.int64) & (FEATURES - 1))
    return np.concatenate(out)


def term_frequencies(text: str | None, step: int = 1 << 20) -> tuple[np.ndarray, np.ndarray] | None:
    """(features, root of their share) of the whole text; None if it has no letter.

    A long text is hashed in stretches that begin with the letters that an n-gram needs from the one before, so memory
    does not grow with it; each n-gram is counted where it ends.
    """
    if (c := _letters(text)) is None:
        return None
    if len(c) <= step:
        ids, n = np.unique(_grams(c), return_counts=True)
    else:
        total = np.zeros(FEATURES, np.int64)
        for i in range(0, len(c), step):
            known = min(i, ORDERS - 1)
            total += np.bincount(_grams(c[i - known : i + step], known), minlength=FEATURES)
        ids = np.flatnonzero(total)
        n = total[ids]
    return ids, np.sqrt(n / n.sum())


def learnable(doc_id: Column, lang: Column, fold: int = 2, folds: int = 4) -> Column:
    """Documents that may teach: labelled, and not of the held-out remainder of crc32(doc_id as text)."""
    return lang.isNotNull() & (held_out(doc_id, fold, folds) == F.lit(False))


def held_out(doc_id: Column, fold: int = 2, folds: int = 4) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


@dataclass
class Model:
    """weights: languages x features with the inverse document frequency multiplied in; temperature of the scores."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def scores(self, text: str | None) -> np.ndarray | None:
        """Calibrated probabilities; None if the text has no letter."""
        if (found := term_frequencies(text)) is None:
            return None
        ids, tf = found
        return _softmax((self.weights[:, ids] @ tf + self.bias) / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and in how many each feature occurs: summed per task, then over tasks; 2^16 numbers reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(FEATURES, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                n += 1
                if (found := term_frequencies(t)) is not None:
                    df[found[0]] += 1
        ids = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(ids, -1)), pa.array(np.append(df[ids], n))], names=["feature", "n"])

    found = texts.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df = np.zeros(FEATURES, np.int64)
    n = 0
    for f, c in found.collect():
        if f < 0:
            n = c
        else:
            df[f] = c
    return n, df


def _sample(docs: DataFrame) -> DataFrame:
    """About SAMPLE learnable documents of each language, fewer of many, by a hash of id and text: the same in every run."""
    counts = docs.groupBy("lang").agg(F.count("*").alias("of_lang"))
    most = max(LEAST, SAMPLE * LANGUAGES // max(LANGUAGES, counts.count()))
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    return docs.join(F.broadcast(counts), "lang").where(place * F.col("of_lang") < most).select("doc_id", "lang", "text")


def fit(docs: DataFrame) -> Model | None:
    """A model from learnable documents (doc_id, lang, text); None if they show no language.

    The sample reaches the driver as features, at most FIT_FEATURES a document, about SAMPLE documents a language; the
    weights take 2^16 numbers a language.
    """
    n, df = document_frequencies(docs.select("text"))
    idf = np.log((1 + n) / (1 + df)) + 1

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, lang, t in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (found := term_frequencies(t)) is not None:
                    ids, tf = found
                    if len(ids) > FIT_FEATURES:
                        top = np.sort(np.argsort(-tf * idf[ids], kind="stable")[:FIT_FEATURES])
                        ids, tf = ids[top], tf[top]
                    rows.append({"doc": str(doc), "lang": lang, "ids": ids.astype(np.int32).tobytes(), "tf": tf.astype(np.float32).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("doc", pa.string()), ("lang", pa.string()), ("ids", pa.binary()), ("tf", pa.binary())]))

    found = _sample(docs).mapInArrow(features, "doc string, lang string, ids binary, tf binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc"], r["lang"], r["ids"], r["tf"]))
    languages = sorted({r["lang"] for r in found})
    if not languages:
        return None
    x = [(np.frombuffer(r["ids"], np.int32), np.frombuffer(r["tf"], np.float32) * idf[np.frombuffer(r["ids"], np.int32)]) for r in found]
    y = np.array([languages.index(r["lang"]) for r in found])
    order = np.random.default_rng(5).permutation(len(x))
    cut = max(1, len(x) // 5) if len(x) >= 10 else 0
    tune, train = order[:cut], order[cut:]
    w, bias = _ftrl([x[i] for i in train], y[train], len(languages))
    temperature = 1.0
    if len(tune):
        z = np.array([w[:, i] @ v + bias for i, v in (x[k] for k in tune)])
        loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(z)), y[tune]] + 1e-12).mean()
        temperature = float(min(np.geomspace(0.05, 20, 121), key=loss))
    return Model(languages, (w * idf).astype(np.float32), bias, temperature)


def _ftrl(x: list, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights by FTRL-proximal with one step size a coordinate; the bias is not penalised."""
    z, n = np.zeros((k, FEATURES)), np.zeros((k, FEATURES))
    bz, bn = np.zeros(k), np.zeros(k)
    rng = np.random.default_rng(6)
    one = np.eye(k)

    def lazy(z, n, l1=L1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in rng.permutation(len(x)):
            ids, v = x[i]
            zi, ni = z[:, ids], n[:, ids]
            wi, b = lazy(zi, ni), lazy(bz, bn, 0.0)
            g = _softmax(wi @ v + b) - one[y[i]]
            gi = g[:, None] * v
            sigma = (np.sqrt(ni + gi * gi) - np.sqrt(ni)) / ALPHA
            z[:, ids], n[:, ids] = zi + gi - sigma * wi, ni + gi * gi
            s = (np.sqrt(bn + g * g) - np.sqrt(bn)) / ALPHA
            bz, bn = bz + g - s * b, bn + g * g
    return lazy(z, n), lazy(bz, bn, 0.0)


def with_language(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Adds lang_pred and score (columns of those names are replaced) from whole texts alone.

    ``und`` with score 0 where the text is null or has no letter, or there is no model; otherwise the most probable
    learned language and its calibrated probability. Equal texts get equal results.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)  # bounded by languages x features

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = sent.value
        for texts in batches:
            names, scores = [], []
            for t in texts.to_pylist():
                p = known.scores(t) if known else None
                names.append(UNKNOWN if p is None else known.languages[int(p.argmax())])
                scores.append(0.0 if p is None else float(p.max()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    name = unused(df, "_told")
    told = df.withColumn(name, predict(F.col(text)))
    return told.withColumns({c: F.col(f"{name}.{c}") for c in ("lang_pred", "score")}).drop(name)


def identified(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", fold: int = 2, folds: int = 4) -> DataFrame:
    """``df`` with held_out, lang_pred and score.

    Learns from text and non-null lang of the rows whose crc32(doc_id as text) mod ``folds`` is not ``fold``; a null
    doc_id is neither held out nor learned from. Repeated rows are learned from repeatedly. An empty table, or one
    without labels, gives ``und`` for every row.
    """
    d = F.col(doc_id)
    teach = df.where(learnable(d, F.col(lang), fold, folds) & d.isNotNull()).select(d.alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return with_language(df, fit(teach), text).withColumn("held_out", held_out(d, fold, folds))
