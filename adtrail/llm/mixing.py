"""Operator 6: mixing sources to target weights by subset-sum budget fitting.

Targets.  Sources share all words in proportion to their weights; no source's
target is above ``max_repeats`` times its size, and the excess goes to the
others by weight until none is above (``target = min(cap, level * weight)``).

Fitting.  Of a source with target ``t`` and size ``s``, every document is taken
``floor(t / s)`` times; the remaining budget is met by documents taken once
more.  Documents are counted by exact length, so a source is a table of lengths
and counts however many documents it has.  Of each length the same share is
taken first (rounded down), then one more of each, longest first, where it
fits; what is left is below the longest length that remains, and a bounded
knapsack over the unused lengths and counts finds the sum nearest below it.
How many of each length are taken is then fixed; *which* ones is the order of a
seeded hash, found by counts per hash range and a rank inside one range only.

Defined results: null text has size 0 and is never taken.  Null sources are one
source, last in order.  Repeated rows count each; among equal rows it does not
matter which one is taken.  An empty table gives an empty result, extra columns
are ignored.  Reruns give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.staging import Staging

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
SEED = 20
RANGE_ROWS = 512            # rows of one hash range of a length
_SPACES = "[\\x20\\x09-\\x0D]+"


def sizes(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """``doc_id, source, size`` (words) of every row."""
    words = F.filter(F.split(F.coalesce(docs[text].cast("string"), F.lit("")), _SPACES), lambda w: w != "")
    return docs.select(docs[key].alias("doc_id"), docs[source].cast("string").alias("source"), F.size(words).cast("bigint").alias("size"))


def targets(per_source: DataFrame, staging: Staging, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Weights repeat along the sources in code-point order, null last.  The level
    is raised until no capped source changes; each round is one aggregate."""
    ranked = _ranked(per_source, staging)
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = staging.table(ranked.select("source", "source_size", pick.alias("weight"), (F.col("source_size") * max_repeats).cast("double").alias("cap")), "source_weights")
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        over = F.col("cap") <= F.lit(level) * F.col("weight")
        capped, free = t.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
        if not free:
            break
        new = (total - capped) / free
        if new <= level:
            break
        level = new
    return t.select("source", "source_size", F.least("cap", F.lit(level) * F.col("weight")).alias("target"))


def _ranked(per_source: DataFrame, staging: Staging) -> DataFrame:
    """``rank`` from 0 in code-point order, null last: ranges of sources are
    sorted side by side, and only the ranges' row counts are put in one order."""
    parts = per_source.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
    parts = staging.table(parts, "source_ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # a row per range
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    return parts.join(offsets, "part").withColumn("rank", F.col("before") + inside).drop("part", "before")


def fit_counts(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many documents of each length to take so that their words come as
    near to ``budget`` as possible without exceeding it."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    take = [c * budget // total if total else 0 for c in counts]
    left = budget - sum(n * k for n, k in zip(lengths, take))
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    for i in order:                              # one more of each, longest first
        if take[i] < counts[i] and 0 < lengths[i] <= left:
            take[i] += 1
            left -= lengths[i]
    spare = [counts[i] - take[i] for i in range(len(lengths))]
    for i, k in enumerate(_knapsack(lengths, spare, left)):
        take[i] += k
    return take


def _knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """Bounded knapsack by sums: bit ``s`` of ``reached`` says that ``s`` words
    can be made.  Counts are split into powers of two; each step keeps the sums
    it was the first to reach, so the best sum can be traced back."""
    mask = (1 << (budget + 1)) - 1
    reached, steps = 1, []
    for i, (n, c) in enumerate(zip(lengths, counts)):
        c = min(c, budget // n) if n else 0
        many = 1
        while c > 0 and not reached >> budget & 1:
            many = min(many, c)
            new = (reached << n * many) & mask & ~reached
            if new:
                steps.append((new, i, many))
                reached |= new
            c -= many
            many *= 2
    best = reached.bit_length() - 1
    take = [0] * len(lengths)
    for new, i, many in reversed(steps):
        if new >> best & 1:
            take[i] += many
            best -= lengths[i] * many
    return take


def _plan(pairs: DataFrame, max_repeats: int) -> DataFrame:
    """Per (source, size): ``repeats`` of all documents and ``extra``, the
    number of documents taken once more."""
    schema = "source string, size bigint, n bigint, repeats bigint, extra bigint, source_size bigint, target double"

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        size, target = int(rows.source_size[0]), float(rows.target[0])
        repeats = min(max_repeats, int(target // size)) if size else 0
        left = int(target - repeats * size) if repeats < max_repeats else 0
        extra = fit_counts(rows["size"].tolist(), rows["n"].tolist(), left) if size else [0] * len(rows)
        return rows.assign(repeats=repeats, extra=[e if s else 0 for e, s in zip(extra, rows["size"])])[
            ["source", "size", "n", "repeats", "extra", "source_size", "target"]]

    # A group is one source's table of lengths, not its documents.
    return pairs.groupBy("source").applyInPandas(fit, schema)


def mix(docs: DataFrame, staging: Staging, weights: tuple[float, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        seed: int = SEED, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row; ``source`` too."""
    rows = staging.table(sizes(docs, text, source, key), "sizes")
    lengths = staging.table(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    per_source = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = targets(per_source, staging, weights, max_repeats)
    pairs = lengths.join(goals.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    plan = staging.table(_plan(pairs, max_repeats), "mix_plan")
    # Seeded choice: hash ranges of about RANGE_ROWS rows; whole ranges are taken
    # until the count runs out inside one, and only rows of a range are ranked.
    mine = plan.select(F.col("source").alias("s"), F.col("size").alias("z"), "n", "repeats", "extra", "source_size", "target")
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n") / RANGE_ROWS))
    u = F.xxhash64(F.lit(seed), F.col("doc_id"))
    hashed = rows.join(mine, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))).drop("s", "z")
    hashed = hashed.withColumn("u", u).withColumn("range", F.pmod(F.shiftrightunsigned("u", 20), ranges).cast("bigint"))
    held = rows.withColumn("u", u).join(mine.select("s", "z", "n"), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    held = held.groupBy("source", "size", F.pmod(F.shiftrightunsigned("u", 20), ranges).cast("bigint").alias("range")).agg(F.count(F.lit(1)).alias("here"))
    order = Window.partitionBy("source", "size").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select(F.col("source").alias("s"), F.col("size").alias("z"), F.col("range").alias("r"),
                         F.coalesce(F.sum("here").over(order), F.lit(0)).alias("before"))
    placed = hashed.join(before, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("range") == F.col("r")))
    place = F.row_number().over(Window.partitionBy("source", "size", "range").orderBy("u", "doc_id"))
    more = (F.col("before") + place <= F.col("extra")).cast("bigint")
    return placed.select("doc_id", "source", "size", "source_size", "target", ((F.col("repeats") + more) * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, staging: Staging, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    # Rows of one id may differ in source and size, so both are part of the key.
    taken = mix(docs, staging, **options).filter("taken > 0").groupBy("doc_id", "source", "size").agg(
        F.sum(F.expr("taken div size")).alias("__times"))
    measured = docs.select(F.struct("*").alias("__row"), docs["text"], docs["source"], docs["doc_id"])
    words = F.filter(F.split(F.coalesce("text", F.lit("")), _SPACES), lambda w: w != "")
    rows = measured.select("__row", F.col("doc_id").alias("__id"), F.col("source").alias("__source"), F.size(words).cast("bigint").alias("__size"))
    # Repeated rows share their total: the first ones get the larger part.
    same = Window.partitionBy("__id", "__source", "__size")
    joined = rows.join(taken, F.col("__id").eqNullSafe(F.col("doc_id")) & F.col("__source").eqNullSafe(F.col("source")) & (F.col("__size") == F.col("size")))
    joined = joined.withColumn("__n", F.count(F.lit(1)).over(same)).withColumn("__i", F.row_number().over(same.orderBy("__size")))
    times = F.expr("__times div __n + if(__i <= __times % __n, 1, 0)").cast("int")
    return joined.select("__row", times.alias("__times")).filter("__times > 0").select(
        "__row", F.explode(F.sequence(F.lit(1), "__times"))).select("__row.*")
