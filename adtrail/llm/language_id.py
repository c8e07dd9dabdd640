"""Operator 4: language ID by averaged hashed subword embeddings.

A text is the mean of the embeddings of its hashed byte n-grams (lower-cased;
everything but letters and non-ASCII bytes is a space, and n-grams without a
letter are left out); a linear softmax over it gives the languages.  Both are
trained by stochastic gradient descent in numpy.  The sample is bounded:
about ``PER_LANGUAGE`` labelled documents of each language, by a hash order,
each with ``SAMPLED`` n-grams drawn over its whole text on the executors, so
neither many nor long documents reach the driver.

One part of the sample in five is held back: it fits the temperature of the
softmax, so scores are calibrated, and the rejection threshold, the highest
(at most ``MAX_THRESHOLD``) that rejects no more than ``FALSE_REJECTION`` of the
rightly labelled ones.  After training, the embeddings are multiplied by the
softmax weights: prediction adds one row of language scores per n-gram.

Defined results: null text and text without a letter are ``und``, score 0 and
rejected.  Training rows with a null language are not used.  Without any
training row everything is ``und``.  Repeated rows are predicted alike.
Ties go to the language first in code-point order.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.llm import words as W

GRAMS = (2, 3, 4)
BUCKET_BITS = 15
DIMENSION = 16
PER_LANGUAGE = 600
MAX_LANGUAGES = 400
SAMPLED = 400
EPOCHS = 6
RATE = 0.5
SEED = 4
FALSE_REJECTION = 0.002
MAX_THRESHOLD = 0.5
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_CHUNK = 1 << 20


def grams(t: W.Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per n-gram size: (buckets, first), the n-grams of row ``i`` being
    ``first[i]:first[i+1]``.  Texts count with a space on both sides."""
    n = t.rows
    size = np.diff(t.offsets) + 2
    first = np.concatenate([[0], np.cumsum(size)])
    data = np.full(int(first[-1]) + 8, 32, np.uint8)
    data[np.arange(len(t.data)) + 1 + 2 * np.repeat(np.arange(n), size - 2)] = _FOLD[t.data]
    total = int(first[-1])
    eight = np.ndarray(shape=(total,), dtype="<u8", buffer=data.data, strides=(1,))
    letters = np.concatenate([[0], np.cumsum(data[:total] != 32)])
    for g in GRAMS:
        v = eight & np.uint64((1 << 8 * g) - 1)
        bucket = (((v + np.uint64(g)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
        end = np.minimum(np.arange(total) + g, total)
        ok = letters[end] > letters[:total]
        last = np.repeat(first[1:], size) - g
        ok &= np.arange(total) <= last
        at = np.flatnonzero(ok)
        yield bucket[at], np.searchsorted(at, first)


def has_letter(t: W.Texts) -> np.ndarray:
    """Per row: does it hold a letter?  (Non-ASCII bytes are looked at as text.)"""
    ascii_letter = (_FOLD[t.data] != 32) & (t.data < 128)
    found = W.sums(ascii_letter.astype(np.int64), t.offsets) > 0
    high = W.sums((t.data >= 128).astype(np.int64), t.offsets) > 0
    for i in np.flatnonzero(~found & high).tolist():
        found[i] = any(map(str.isalpha, t.data[t.offsets[i]:t.offsets[i + 1]].tobytes().decode("utf-8", "replace")))
    return found


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray         # (buckets, languages): embeddings times weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, t: W.Texts) -> np.ndarray:
        total = np.tile(np.zeros(len(self.languages)), (t.rows, 1))
        many = np.zeros(t.rows, np.int64)
        for bucket, first in grams(t):
            some = np.flatnonzero(np.diff(first))
            if len(some):
                total[some] += np.add.reduceat(self.scores[bucket], first[:-1][some], axis=0)
            many += np.diff(first)
        return total / np.maximum(many, 1)[:, None] + self.bias

    def predict(self, t: W.Texts) -> tuple[np.ndarray, np.ndarray]:
        """(language position, calibrated probability) per row."""
        p = softmax(self.logits(t) / self.temperature)
        best = p.argmax(axis=1)
        return best, p[np.arange(len(p)), best]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def sample(training: DataFrame, text: str, lang: str, key: str, seed: int = SEED) -> DataFrame:
    """``lang, order, grams``: the bounded training sample."""
    rows = training.select(training[key].alias("doc_id"), training[lang].cast("string").alias("lang"), training[text].cast("string").alias("text"))
    rows = rows.filter("lang is not null and text is not null").withColumn("order", F.xxhash64(F.lit(seed), F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    share = F.lit(0.0)
    for language, n in counts.items():       # a fixed share of each language, by hash
        share = F.when(F.col("lang") == language, F.lit(min(1.0, PER_LANGUAGE / n))).otherwise(share)
    rows = rows.filter(F.pmod("order", F.lit(1 << 30)) < F.lit(float(1 << 30)) * share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in W.texts(batch.column(2), _CHUNK):
                every = list(grams(t))
                out = []
                for i in range(t.rows):
                    mine = np.concatenate([b[f[i]:f[i + 1]] for b, f in every])
                    rng = np.random.default_rng(batch.column(1)[t.first + i].as_py() & 0x7FFFFFFF)
                    out.append(mine if len(mine) <= SAMPLED else rng.choice(mine, SAMPLED, replace=False))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(t.first, t.rows), batch.column(1).slice(t.first, t.rows), pa.array(out, pa.list_(pa.int32()))], ["lang", "order", "grams"])
        W.release_memory()

    return rows.select("lang", "order", "text").mapInArrow(run, "lang string, order bigint, grams array<int>")


def fit(rows: list[tuple[str, int, list[int]]], seed: int = SEED) -> Model:
    """Train on ``(lang, order, grams)`` rows; deterministic for a set of rows."""
    rows = sorted((r for r in rows if len(r[2])), key=lambda r: (r[1], r[0], r[2]))
    languages = sorted({r[0] for r in rows})
    rng = np.random.default_rng(seed)
    k = len(languages)
    emb = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSION))
    weights, bias = np.zeros((DIMENSION, k)), np.zeros(k)
    if not rows:
        return Model([], np.zeros((1 << BUCKET_BITS, 0)), bias, 1.0, 0.0)
    y = np.array([languages.index(r[0]) for r in rows])
    x = [np.array(r[2], dtype=np.int64) for r in rows]
    held = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~held)
    steps = EPOCHS * len(train)
    done = 0
    for _ in range(EPOCHS):
        for i in rng.permutation(train).tolist():
            rate = RATE * (1 - done / steps)
            done += 1
            mean = emb[x[i]].mean(axis=0)
            g = softmax(mean @ weights + bias)
            g[y[i]] -= 1
            back = weights @ g
            weights -= rate * np.outer(mean, g)
            bias -= rate * 0.1 * g
            np.subtract.at(emb, x[i], rate * back / len(x[i]) * 20)
    scores = emb @ weights
    calibration = np.flatnonzero(held) if held.any() else train
    logits = np.array([scores[x[i]].mean(axis=0) + bias for i in calibration])
    truth = y[calibration]
    grid = np.geomspace(0.02, 20, 60)
    # Probabilities are kept off 0 by the share of wrong labels that a small sample can hide.
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(truth)), truth], 1 / (len(truth) + 2))).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(logits / temperature)
    right = np.sort(p.max(axis=1)[p.argmax(axis=1) == truth])
    cut = right[int(FALSE_REJECTION * len(right))] if len(right) else 0.0
    return Model(languages, scores, bias, temperature, float(min(cut, MAX_THRESHOLD)))


def train(training: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    return fit([(r["lang"], r["order"], list(r["grams"])) for r in sample(training, text, lang, key).collect()])


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of ``docs`` in the struct ``row``, and ``lang_pred, score, rejected``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)   # buckets x languages, a fixed size
    source = docs.select(F.struct("*").alias("row"), docs[text].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for t in W.texts(batch.column(1), _CHUNK):
                known = has_letter(t) & bool(m.languages)
                best, p = m.predict(t) if m.languages else (np.zeros(t.rows, np.int64), np.zeros(t.rows))
                best = np.where(known, best, len(m.languages))
                p = np.where(known, p, 0.0)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(t.first, t.rows), pa.array(names[best].tolist(), pa.string()), pa.array(p),
                    pa.array(~known | (p < m.threshold))], ["row", "lang_pred", "score", "rejected"])
        W.release_memory()

    kind = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(run, f"row {kind}, lang_pred string, score double, rejected boolean")


def fold(key: Column, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``."""
    return F.crc32(key.cast("string").cast("binary")) % folds


def language_id(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``; one document in four is held out."""
    held = F.coalesce(fold(docs[key], 4) == 2, F.lit(False))
    model = train(docs.filter(~held), text, lang, key)
    slim = docs.select(docs[key].alias("doc_id"), docs[text].alias("text"), held.alias("held_out"))
    out = predict(slim.select("doc_id", "held_out", "text"), model)
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """The documents whose language is told with enough confidence."""
    model = train(docs, text, lang, key)
    return predict(docs, model, text).filter(~F.col("rejected")).select("row.*")
