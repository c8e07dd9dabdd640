"""Operator 1: importance resampling for quality.

Two generative models over hashed word unigrams and bigrams: one of the target
(labelled good texts), one of the raw texts (all of them).  A text's importance
is the ratio of its probabilities under the two; the sample is drawn without
replacement in proportion to it, by Gumbel top-k: a seeded Gumbel variable is
added to each log-weight and the ``k`` largest sums are kept.

The log-ratio is averaged over a text's n-grams and multiplied by ``STRENGTH``,
so long texts are neither favoured nor punished for their length.  The raw
model is gathered over all rows.  The sum at rank ``k`` is found by histograms
of bounded size, never by sorting all rows in one place; ties go to the smaller
id, and rows equal in both share the verdict.

Defined results: null, empty and wordless texts have weight -inf and are never
kept.  Without target texts all weights are 0.  Repeated rows get the same noise
(it comes from the id) and the same verdict.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.llm import words as W
from adtrail.staging import Staging

BUCKETS = 1 << 14
STRENGTH = 20.0
SMOOTHING = 0.5
KEEP_SHARE = 0.85         # k, as a share of the texts with words
SEED = 1
BINS = 4096


def gram_buckets(t: W.Texts, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, first) of the lower-cased word unigrams and bigrams of every row."""
    data = W.LOWER[t.data]
    starts, ends, first = W.spans(W.Texts(t.first, data, t.offsets))
    h = W.hashes(data, starts, ends)
    two = W.combine(h[:-1], h[1:]) if len(h) > 1 else h[:0]
    row = W.row_of(first)
    same = row[:-1] == row[1:]
    rows = np.concatenate([row, row[:-1][same]])
    every = np.concatenate([h, two[same]]) % np.uint64(buckets)
    order = np.argsort(rows, kind="stable")
    return every[order].astype(np.int64), np.searchsorted(rows[order], np.arange(t.rows + 1))


def gram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``bucket, n``, summed inside a task before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for t in W.texts(batch.column(0)):
                held += np.bincount(gram_buckets(t)[0], minlength=BUCKETS)
        at = np.flatnonzero(held)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["bucket", "n"])

    counted = docs.select(docs[text].cast("string").alias("t")).mapInArrow(run, "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame) -> np.ndarray:
    out = np.zeros(BUCKETS)
    for r in counts.collect():                # BUCKETS rows at most
        out[r["bucket"]] = r["n"]
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target / p_raw per bucket."""
    if not target.sum():
        return np.zeros(BUCKETS)
    smooth = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return smooth(target) - smooth(raw)


def gumbel(seed: int, key: Column) -> Column:
    """A standard Gumbel variable that is a function of the seed and the key."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(u))


def kth_largest(rows: DataFrame, value: str, k: int) -> tuple[float, int]:
    """(x, above): the ``k``-th largest value, and how many are larger.

    Each round counts ``BINS`` bins between two bounds and narrows them to the
    bin that holds rank ``k``, until one value is left there."""
    lo, hi = rows.agg(F.min(value), F.max(value)).first()
    above = 0
    while lo < hi:
        width = (hi - lo) / BINS
        if not width or lo + width == lo or hi - width == hi:
            bins = rows.filter(F.col(value).between(lo, hi)).groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc(value)).collect()
            for x, n in bins:                     # neighbouring doubles
                if above + n >= k:
                    return float(x), above
                above += n
        b = F.least(F.lit(BINS - 1), F.floor((F.col(value) - lo) / width)).cast("int")
        bins = rows.filter(F.col(value).between(lo, hi)).groupBy(b.alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).orderBy(F.desc("b")).collect()
        for r in bins:
            if above + r["n"] >= k:
                lo, hi = r["lo"], r["hi"]
                break
            above += r["n"]
    return float(lo), above


def resample(docs: DataFrame, target: DataFrame, staging: Staging, keep_share: float = KEEP_SHARE, seed: int = SEED,
             text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, n_grams, log_weight, noise, kept`` of every row of ``docs``; ``target`` holds the target texts."""
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(_vector(gram_counts(target, text)), _vector(gram_counts(docs, text))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in W.texts(batch.column(1)):
                bucket, first = gram_buckets(t)
                n = np.diff(first)
                total = W.sums(ratios.value[bucket], first)
                weight = np.where(n > 0, STRENGTH * total / np.maximum(n, 1), -np.inf)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(t.first, t.rows), pa.array(n), pa.array(weight)], ["doc_id", "n_grams", "log_weight"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, n_grams bigint, log_weight double")
    rows = staging.table(rows.withColumn("noise", gumbel(seed, F.coalesce("doc_id", F.lit(-1)))), "importance")
    drawn = rows.filter("n_grams > 0").withColumn("__key", F.col("log_weight") + F.col("noise"))
    k = math.ceil(keep_share * drawn.count())
    if not k:
        return rows.withColumn("kept", F.lit(False))
    x, above = kth_largest(drawn, "__key", k)
    ties = drawn.filter(F.col("__key") == x).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    last = ties.orderBy(F.asc_nulls_first("doc_id")).limit(k - above).agg(F.max("doc_id")).first()[0]
    sums = F.col("log_weight") + F.col("noise")
    tied = (sums == x) & (F.col("doc_id").isNull() | (F.col("doc_id") <= F.lit(last)))
    return rows.withColumn("kept", F.coalesce((F.col("n_grams") > 0) & ((sums > x) | tied), F.lit(False)))


def quality_sample(docs: DataFrame, labels: DataFrame, staging: Staging, **options) -> DataFrame:
    """:func:`resample` towards documents labelled good and not toxic."""
    good = labels.groupBy(F.col("doc_id").alias("__id")).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("__q"), F.max(F.coalesce("toxic", F.lit(0))).alias("__x")).filter("__q = 1 and __x = 0")
    # Labels grow with the documents: always a shuffle join, at any size.
    target = docs.join(good.hint("merge"), docs["doc_id"] == good["__id"], "left_semi")
    return resample(docs, target, staging, **options)
