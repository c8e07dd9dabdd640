"""Operator 9: language-model scores by online logistic mixing of bit predictors.

A text is coded as a sequence of bits: each token (lower-cased word, then one
end) by a Huffman code over the ``VOCABULARY`` most frequent training tokens;
any other word by the escape code and its bytes, Huffman-coded in turn.  Every
bit is predicted three times, from hashed contexts: a word's bits after 0, 1
and 2 words, a byte's bits after 1, 2 and 3 bytes of its word.  Each predictor
is a fixed-size table of counts of zeros and ones, gathered over *all* training
texts.  A gate (how often the contexts were seen, words or bytes) chooses the
weights that mix the three log-odds; the weights are refined by online
gradient steps as the text goes on.  The score is the log10 probability of all
bits; total bits per byte of text follows from it.

Base score: smoothed unigram probabilities from exact counts of every training
token (rare tokens are joined, not broadcast).

What is sent to every task has a fixed bound: the tables (``TABLE_BITS``) and
the codes of ``VOCABULARY`` tokens.  Tokens are named by 64-bit hashes.

Defined results: null text = empty text = the end alone.  Without training
rows all counts are 0.  Repeated rows are scored alike and each counts in
training.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm import words as W
from adtrail.staging import Staging

VOCABULARY = 1 << 18
TABLE_BITS = (19, 20, 20)
BLOCK = 1 << 14               # table slots of one gathered row
STEP = 128                    # bits between weight updates
SEGMENT = 1 << 14             # bits after which weights start afresh
GATES = 18
RATE = 0.02
START_WEIGHT = 0.4
END = np.uint64(0x5E9D)       # the end token's name
ESCAPE = np.uint64(0xE5C)
_CHUNK = 1 << 19
_PENDING = 1 << 22            # bits counted at a time
_PARTIAL = 1_500_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def huffman(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, length) per symbol; ties by symbol, so reruns agree."""
    n = len(counts)
    if n == 1:
        return np.zeros(1, np.int64), np.ones(1, np.int64)
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = [0] * (2 * n - 1)
    for new in range(n, 2 * n - 1):
        (a, i), (b, j) = heapq.heappop(heap), heapq.heappop(heap)
        parent[i], parent[j] = new, new
        heapq.heappush(heap, (a + b, new))
    depth = [0] * (2 * n - 1)
    for i in range(2 * n - 3, -1, -1):
        depth[i] = depth[parent[i]] + 1
    length = np.array(depth[:n], dtype=np.int64)
    code = np.zeros(n, np.int64)           # canonical: by length, then symbol
    order = np.lexsort((np.arange(n), length))
    now, at = 0, int(length[order[0]])
    for i in order.tolist():
        now <<= int(length[i]) - at
        at = int(length[i])
        code[i] = now
        now += 1
    return code, length


class Names:
    """Open-addressing table from 64-bit names to positions."""

    def __init__(self, names: np.ndarray):
        self.bits = max(4, int(len(names) * 3).bit_length())
        size = 1 << self.bits
        self.keys, self.at = np.zeros(size, np.uint64), np.full(size, -1, np.int64)
        left, slot = np.arange(len(names)), self._slot(names)
        while len(left):
            free = self.at[slot] < 0
            self.at[slot[free]] = left[free]           # of several, the last stays
            self.keys[slot[free]] = names[left[free]]
            lost = self.at[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & (size - 1)

    def _slot(self, names: np.ndarray) -> np.ndarray:
        return ((names * _B) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, names: np.ndarray) -> np.ndarray:
        """Positions, -1 where a name is not in the table."""
        out = np.full(len(names), -1, np.int64)
        left, slot = np.arange(len(names)), self._slot(names)
        while len(left):
            at = self.at[slot]
            hit = (at >= 0) & (self.keys[slot] == names[left])
            out[left[hit]] = at[hit]
            go = (at >= 0) & ~hit
            left, slot = left[go], (slot[go] + 1) & (len(self.at) - 1)
        return out


@dataclass
class Code:
    """Token and byte codes; position 0 is the escape, 1 the end."""

    names: np.ndarray
    counts: np.ndarray
    word: tuple[np.ndarray, np.ndarray]
    byte: tuple[np.ndarray, np.ndarray]      # 256 is the end of a spelt word

    def index(self) -> "Names":
        if not hasattr(self, "_index"):
            self._index = Names(self.names)
        return self._index


def make_code(tokens: np.ndarray, known: np.ndarray, total: int, ends: int, byte_counts: np.ndarray) -> Code:
    """``tokens``: the signed names of the most frequent words, in a fixed order; ``known``: their counts."""
    names = np.concatenate([np.array([ESCAPE, END], np.uint64), tokens.astype(np.int64).view(np.uint64)])
    known = known.astype(np.int64)
    rest = max(1, total - ends - int(known.sum()))
    counts = np.concatenate([[0, ends], known]).astype(np.int64)
    weights = np.concatenate([[rest, max(1, ends)], known])
    weights = np.maximum(weights, int(weights.sum()) >> 20)     # no code above 31 bits
    byte_counts = np.maximum(byte_counts, 1 + (int(byte_counts.sum()) >> 20))
    return Code(names, counts, huffman(weights), huffman(byte_counts))


@dataclass
class Bits:
    """The bits of some rows, in order: value, table slots, gate kind, row."""

    bit: np.ndarray
    slots: list[np.ndarray]
    spelt: np.ndarray
    first: np.ndarray        # first bit of each row
    tokens: np.ndarray       # token positions in the code (-1: not in it)
    names: np.ndarray
    token_first: np.ndarray


def token_names(t: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, names, first) of the lower-cased words."""
    data = W.LOWER[t.data]
    starts, ends, first = W.spans(W.Texts(t.first, data, t.offsets))
    return data, starts, ends, W.hashes(data, starts, ends), first


def bits_of(t: W.Texts, code: Code) -> Bits:
    data, starts, ends, names, first = token_names(t)
    rows, n = t.rows, len(names)
    # Words, and an end after each row's words.
    at = np.arange(n) + W.row_of(first)
    token = np.full(n + rows, END, dtype=np.uint64)
    token[at] = names
    tfirst = first + np.arange(rows + 1)
    found = np.ones(n + rows, np.int64)
    found[at] = code.index().find(names)
    esc = found < 0
    size = np.zeros(n + rows, np.int64)
    size[at] = ends - starts
    begin = np.zeros(n + rows, np.int64)
    begin[at] = starts
    # Contexts: the one and two tokens before, within the row.
    prev = np.zeros((2, n + rows), np.uint64)
    place = np.arange(n + rows) - np.repeat(tfirst[:-1], np.diff(tfirst))
    prev[0, 1:] = token[:-1]
    prev[0, place < 1] = 0
    prev[1, 2:] = token[:-2]
    prev[1, place < 2] = 0
    one = prev[0] * _A
    two = (one ^ prev[1]) * _B
    # One symbol per token, and size + 1 more for each word that is spelt.
    many = 1 + np.where(esc, size + 1, 0)
    sfirst = np.concatenate([[0], np.cumsum(many)])
    total = int(sfirst[-1])
    value = np.zeros(total, np.int64)
    length = np.zeros(total, np.int64)
    context = np.zeros((3, total), np.uint64)
    head = sfirst[:-1]
    symbol = np.where(esc, 0, found)
    value[head], length[head] = code.word[0][symbol], code.word[1][symbol]
    context[1, head], context[2, head] = W.mix(one), W.mix(two)
    spelt = np.ones(total, bool)
    spelt[head] = False
    s = np.flatnonzero(spelt)
    if len(s):
        owner = np.repeat(np.arange(n + rows), many - 1)
        j = s - head[owner] - 1
        pos = begin[owner] + j
        get = lambda back: np.where(j >= back, data[np.minimum(pos - np.minimum(back, j), len(data) - 1)], 0).astype(np.uint64)
        char = np.where(j < size[owner], data[np.minimum(pos, len(data) - 1)].astype(np.int64), 256)
        value[s], length[s] = code.byte[0][char], code.byte[1][char]
        c1, c2, c3 = get(1) + np.uint64(1), get(2) + np.uint64(1), get(3) + np.uint64(1)
        context[0, s] = W.mix(c1 * _B)
        context[1, s] = W.mix((c1 + (c2 << np.uint64(9))) * _B)
        context[2, s] = W.mix((c1 + (c2 << np.uint64(9)) + (c3 << np.uint64(18))) * _B)
    # Bits: value, and the path so far (with a leading one) as part of the slot.
    bfirst = np.concatenate([[0], np.cumsum(length)])
    left = np.repeat(bfirst[1:].astype(np.int32) - 1, length)
    left -= np.arange(len(left), dtype=np.int32)                                # bits still to come
    path = np.repeat((value | (np.int64(1) << length)).astype(np.uint32), length) >> left.view(np.uint32)
    bit = path & np.uint32(1)
    path >>= np.uint32(1)
    path *= np.uint32(0x9E3779B1)
    slots = []
    for order in range(3):
        h = np.repeat((context[order] >> np.uint64(32)).astype(np.uint32), length)
        h += path
        h *= np.uint32(0x85EBCA6B)
        h >>= np.uint32(32 - TABLE_BITS[order])
        slots.append(h)
    return Bits(bit, slots, np.repeat(spelt, length), bfirst[sfirst[tfirst]], found, token, tfirst)


@dataclass
class Tables:
    """Per predictor: log-odds and how often a slot was seen (0, few, many)."""

    odds: list[np.ndarray]
    seen: list[np.ndarray]


def make_tables(counts: list[np.ndarray]) -> Tables:
    odds, seen = [], []
    for c in counts:                            # (slots, 2)
        n = c.sum(axis=1)
        odds.append(np.clip(np.log((c[:, 1] + 0.4) / (c[:, 0] + 0.4)), -9, 9).astype(np.float32))
        seen.append(np.where(n == 0, 0, np.where(n < 12, 1, 2)).astype(np.int8))
    return Tables(odds, seen)


def score_bits(b: Bits, tables: Tables, rate: float = RATE) -> np.ndarray:
    """log10 probability of every row's bits."""
    rows = len(b.first) - 1
    size = np.diff(b.first)
    # Lanes of at most SEGMENT bits, each padded to whole steps.
    parts = -(-size // SEGMENT)
    lane_row = np.repeat(np.arange(rows), parts)
    nth = np.arange(len(lane_row)) - np.repeat(np.cumsum(parts) - parts, parts)
    lane_bits = np.minimum(SEGMENT, size[lane_row] - nth * SEGMENT)
    blocks = -(-lane_bits // STEP)
    start = np.concatenate([[0], np.cumsum(blocks)])
    at = np.arange(len(b.bit)) + np.repeat(start[:-1] * STEP - (np.cumsum(lane_bits) - lane_bits), lane_bits)
    total = int(start[-1]) * STEP

    def padded(values: np.ndarray, kind: type) -> np.ndarray:
        out = np.zeros(total, kind)
        out[at] = values
        return out.reshape(-1, STEP)

    x = [padded(tables.odds[i][b.slots[i]], np.float32) for i in range(3)]
    gate = padded(tables.seen[2][b.slots[2]] * np.int8(3) + tables.seen[1][b.slots[1]] + b.spelt * np.int8(9), np.int8)
    against = padded(np.float32(1) - b.bit * np.float32(2), np.float32)   # 1 for a zero, -1 for a one, 0: padding
    order = np.argsort(-blocks, kind="stable")
    steps, first = blocks[order], start[:-1][order]
    weights = [np.full(len(order) * GATES, START_WEIGHT, np.float32) for _ in range(3)]
    loss = np.zeros(len(order))
    lane = (np.arange(len(order)) * GATES)[:, None]
    live = len(order)
    for s in range(int(steps.max(initial=0))):
        while live and steps[live - 1] <= s:
            live -= 1
        now = first[:live] + s
        xs, ag = [v[now] for v in x], against[now]
        which = lane[:live] + gate[now]
        dot = weights[0][which] * xs[0] + weights[1][which] * xs[1] + weights[2][which] * xs[2]
        e = np.exp(np.minimum(ag * dot, np.float32(80)))
        one = e + np.float32(1)
        loss[:live] += np.log(one).sum(axis=1, dtype=np.float64)
        err = ag * (e / one) * np.float32(-rate)                   # rate * (bit - p)
        flat = which.ravel()
        for i in range(3):
            weights[i][:live * GATES] += np.bincount(flat, (err * xs[i]).ravel(), live * GATES).astype(np.float32)
    loss -= (steps * STEP - lane_bits[order]) * math.log(2)        # padding is an even bet
    out = np.zeros(rows)
    np.add.at(out, lane_row[order], -loss / math.log(10))
    return out


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    return docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))


def token_counts(training: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``kind, token, n``: words (kind 0), bytes of words (1; 256: words), ends (2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        letters, ends = np.zeros(257, np.int64), 0

        def out(kind, token, n):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(token.view(np.int64)), pa.array(n)], ["kind", "token", "n"])

        def merged():
            names, where = np.unique(np.concatenate([w[0] for w in waiting]), return_inverse=True)
            return names, np.bincount(where, np.concatenate([w[1] for w in waiting]), len(names)).astype(np.int64)

        for batch in batches:
            for t in W.texts(batch.column(1)):
                data, starts, ends_at, h, _ = token_names(t)
                letters[:256] += np.bincount(data[~W.SPACE[data]], minlength=256)
                letters[256] += len(starts)
                ends += t.rows
                waiting.append(np.unique(h, return_counts=True))
                if sum(len(w[0]) for w in waiting) > _PARTIAL:
                    yield out(0, *merged())
                    waiting = []
        if waiting:
            yield out(0, *merged())
        if ends:
            yield out(1, np.arange(257, dtype=np.uint64), letters)
            yield out(2, np.zeros(1, np.uint64), np.array([ends]))

    found = _rows(training, text, key).mapInArrow(run, "kind int, token bigint, n bigint")
    return found.groupBy("kind", "token").agg(F.sum("n").alias("n"))


def gather_tables(training: DataFrame, code, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``part, counts``: the predictors' counts, in rows of ``BLOCK`` slots."""
    sizes = [1 << b for b in TABLE_BITS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(2 * s, np.uint32) for s in sizes]
        used, waiting, bits = False, [], 0

        def count():
            for i in range(3):
                held[i] += np.bincount(np.concatenate([w[i] for w in waiting]), minlength=2 * sizes[i]).astype(np.uint32)
                for w in waiting:
                    w[i] = None

        for batch in batches:
            for t in W.texts(batch.column(1), _CHUNK):
                b = bits_of(t, code.value)
                used = True
                waiting.append([(v * np.uint32(2) + b.bit).view(np.int32) for v in b.slots])
                bits += len(b.bit)
                if bits >= _PENDING:
                    count()
                    waiting, bits = [], 0
        if waiting:
            count()
        for i in range(3 if used else 0):
            rows = held[i].astype("<u4").reshape(-1, 2 * BLOCK)
            held[i], before = None, sum(sizes[:i]) // BLOCK
            for lo in range(0, len(rows), 16):
                part = rows[lo:lo + 16]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(part), dtype=np.int32) + before + lo), pa.array([r.tobytes() for r in part], pa.binary())], ["part", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                row = np.frombuffer(raw.as_buffer(), "<u4")
                held[part] = held[part] + row if part in held else row.astype(np.int64)
        if held:
            keys = sorted(held)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([held[k].tobytes() for k in keys], pa.binary())], ["part", "counts"])

    partial = _rows(training, text, key).mapInArrow(run, "part int, counts binary")
    # Added up as a stream: a task holds one row per part, however many come.
    return partial.repartition("part").mapInArrow(add, "part int, counts binary")


def _collect_tables(gathered: DataFrame) -> Tables:
    """At most ``sum(2 ** TABLE_BITS) / BLOCK`` rows of fixed size."""
    sizes = [1 << b for b in TABLE_BITS]
    every = np.zeros(2 * sum(sizes), np.int64)
    for row in gathered.collect():
        every[row["part"] * 2 * BLOCK:(row["part"] + 1) * 2 * BLOCK] = np.frombuffer(row["counts"], np.int64)
    cuts = np.cumsum([2 * s for s in sizes])[:-1]
    return make_tables([c.reshape(-1, 2) for c in np.split(every, cuts)])


def score(docs: DataFrame, training_rule, staging: Staging, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores of all ``docs``, learning from those where ``training_rule`` (a
    function of the frame giving a boolean column) holds.

    Columns: ``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``."""
    spark = docs.sparkSession
    training = docs.filter(training_rule(docs))
    counts = staging.table(token_counts(training, text, key), "token_counts")
    words = counts.filter("kind = 0").select("token", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = sum(r["n"] for r in counts.filter("kind = 2").collect())         # one row
    letters = np.zeros(257, np.int64)
    for r in counts.filter("kind = 1").collect():                           # 257 rows
        letters[r["token"]] = r["n"]
    total += ends
    distinct += 1 if ends else 0
    top = words.orderBy(F.desc("n"), "token").limit(VOCABULARY).toArrow()    # a fixed bound
    tokens, known = top.column("token").to_numpy(), top.column("n").to_numpy()
    code = spark.sparkContext.broadcast(make_code(tokens, known, total, ends, letters))
    tables = spark.sparkContext.broadcast(_collect_tables(gather_tables(training, code, text, key)))
    least = int(known.min(initial=2 ** 62))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = code.value
        logs = np.log10(c.counts + 0.5)
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            for t in W.texts(batch.column(1), _CHUNK):
                b = bits_of(t, c)
                here = b.tokens >= 0
                owner = W.row_of(b.token_first)
                n = np.diff(b.token_first)
                sure = np.bincount(owner, here & (c.counts[np.maximum(b.tokens, 0)] > 0), t.rows).astype(np.int64)
                base = np.bincount(owner, np.where(here, logs[np.maximum(b.tokens, 0)], 0.0), t.rows)
                rare = ~here
                per = np.bincount(owner, rare, t.rows).astype(np.int64)
                tails = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), pa.array(b.names[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays([
                    pa.array((np.int64(task) << 40) + row + np.arange(t.rows)), batch.column(0).slice(t.first, t.rows), pa.array(n.astype(np.int64)),
                    pa.array(sure), pa.array(base), pa.array(score_bits(b, tables.value)), pa.array(np.diff(t.offsets)), tails],
                    ["row", "doc_id", "n_tokens", "sure", "base", "score", "bytes", "rare"])
                row += t.rows

    kind = docs.schema[key].dataType.simpleString()
    scored = staging.table(_rows(docs, text, key).mapInArrow(
        run, f"row bigint, doc_id {kind}, n_tokens bigint, sure bigint, base double, score double, bytes bigint, rare array<bigint>"), "scores")
    # Tokens without a code: their exact counts are joined.  Tokens with one
    # need not take part, so only counts up to the least coded one are read.
    rare = scored.select("row", F.explode("rare").alias("token")).groupBy("row", "token").agg(F.count(F.lit(1)).alias("times"))
    rare = rare.join(words.filter(F.col("n") <= least), "token", "left")
    c = F.coalesce("n", F.lit(0))
    rest = rare.groupBy("row").agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("more"),
                                   F.sum(F.col("times") * F.log10(c + 0.5)).alias("more_base"))
    every = math.log10(total + 0.5 * (distinct + 1))
    return scored.drop("rare").join(rest, "row", "left").select(
        "doc_id", "n_tokens", (F.col("sure") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) - F.col("n_tokens") * every).alias("base_score"), "score",
        (F.col("score") * -math.log2(10) / F.greatest("bytes", F.lit(1))).alias("bits_per_byte"))
