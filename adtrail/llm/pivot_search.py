"""Operator 10: exact top-k inner products by a pivot-distance index.

Vectors are turned into integers.  Inner product becomes distance by one more
component: with ``M`` the largest norm, ``v' = (v, sqrt(M^2 - |v|^2))`` and
``q' = (q, 0)`` give ``|q' - v'|^2 = |q|^2 + M^2 - 2 q.v``.

Index.  Every vector is keyed by its nearest pivot and its distance to it; a
pivot's vectors are cut into annuli by distance (histograms of a fixed number
of bins, never a sort of a whole pivot), an annulus with many equal distances
into several tiles.  Pivots come from a bounded sample; every row is indexed.

Search.  A query first visits the annuli nearest to its own key until they hold
enough rows.  Its ``k``-th best score so far is a radius, and by the triangle
inequality an annulus ``[lo, hi]`` of a pivot at distance ``d`` can hold a
better row only if ``lo - radius <= d <= hi + radius``; those are visited next,
all others are not.  In a tile, the rows stand still and the queries stream by.

Defined results: vectors that are null or hold null, NaN or infinite
components take no part.  Vectors of different lengths are not compared.  Every
row with a query id is a query; all rows but itself are candidates, so repeated
rows find each other.  Null ids are no queries; as candidates they come last
among ties.  Scores beyond 2**62 are clipped.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.staging import Staging

K = 5
EVERY = 50
SCALE = 256
PIVOTS = 24
SAMPLE = 2048
BINS = 512
TILE_ROWS = 2048
_LAST = np.iinfo(np.int64).max


def integer_vectors(table: DataFrame, staging: Staging, vector: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """``uid, vec_id, dim, norm2, v``: valid vectors as whole numbers."""
    bad = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = table.select(table[key].cast("bigint").alias("vec_id"), table[vector].cast("array<double>").alias("x")).filter(
        F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True)))
    # Doubles of 2**53 and more are whole already.
    whole = F.transform("x", lambda c: F.when(F.abs(c) * scale < 2.0 ** 53, F.floor(F.least(F.greatest(c * scale, F.lit(-2.0 ** 53)), F.lit(2.0 ** 53))).cast("double")).otherwise(c * scale))
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), "vec_id", F.size("x").alias("dim"), whole.alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda a, c: a + c * c)
    return staging.table(rows.withColumn("norm2", norm), "vectors")


@dataclass
class Space:
    """Pivots of one vector length, in the longer space; ``top``: largest norm squared."""

    top: float
    pivots: np.ndarray

    def distances(self, v: np.ndarray, last: np.ndarray) -> np.ndarray:
        p = self.pivots
        d2 = (v * v).sum(1)[:, None] + (last * last)[:, None] + (p * p).sum(1)[None, :] - 2 * (v @ p[:, :-1].T + last[:, None] * p[None, :, -1])
        return np.sqrt(np.maximum(d2, 0))

    def extra(self, v: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(self.top - (v * v).sum(1), 0))

    @property
    def reach(self) -> float:
        """No two points are further apart."""
        return 2 * np.sqrt(self.top) + 1


def choose_pivots(v: np.ndarray, top: float, pivots: int = PIVOTS) -> Space:
    """Points far from each other, out of a sample (farthest first)."""
    space = Space(top, np.zeros((0, v.shape[1] + 1)))
    points = np.hstack([v, space.extra(v)[:, None]])
    chosen, far = [0], np.full(len(points), np.inf)
    while len(chosen) < min(pivots, len(points)):
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(1))
        best = int(far.argmax())
        if far[best] <= 0:
            break
        chosen.append(best)
    return Space(top, points[chosen])


@dataclass
class Annuli:
    """Annuli of one length: pivot, distance range, rows, tiles, first tile."""

    pivot: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    rows: np.ndarray
    tiles: np.ndarray
    first_tile: np.ndarray
    of_bin: np.ndarray        # (pivots, bins) -> annulus


def cut_annuli(bins: list[tuple[int, int, int, float, float]], pivots: int, tile_rows: int, first_tile: int) -> Annuli:
    """Neighbouring bins ``(pivot, bin, n, lo, hi)`` joined up to ``tile_rows`` rows."""
    out, of = [], np.zeros((pivots, BINS), np.int64)
    for pivot, b, n, lo, hi in sorted(bins):
        if out and out[-1][0] == pivot and out[-1][3] + n <= tile_rows:
            out[-1][2], out[-1][3] = hi, out[-1][3] + n
        else:
            out.append([pivot, lo, hi, n])
        of[pivot, b] = len(out) - 1
    p, lo, hi, n = (np.array(c) for c in zip(*out))
    tiles = -(-n // tile_rows)
    return Annuli(p, lo, hi, n, tiles, first_tile + np.concatenate([[0], np.cumsum(tiles)[:-1]]), of)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim).astype(np.float64)


def _by_dim(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    dims = batch.column("dim").to_numpy()
    for d in np.unique(dims):
        yield int(d), batch.filter(pa.array(dims == d))


KEYED = "uid bigint, vec_id bigint, dim int, v array<double>, pivot int, distance double"


def key_vectors(vectors: DataFrame, spaces) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, b in _by_dim(batch):
                v, s = _matrix(b.column("v"), dim), spaces.value[dim]
                d = s.distances(v, s.extra(v))
                near = d.argmin(1)
                yield pa.RecordBatch.from_arrays([
                    b.column("uid"), b.column("vec_id"), b.column("dim"), b.column("v"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(near)), near])],
                    ["uid", "vec_id", "dim", "v", "pivot", "distance"])

    return vectors.select("uid", "vec_id", "dim", "v").mapInArrow(run, KEYED)


def _bin(distance: np.ndarray, reach: float) -> np.ndarray:
    return np.minimum((distance / reach * BINS).astype(np.int64), BINS - 1)


def place_rows(keyed: DataFrame, spaces, annuli) -> DataFrame:
    """``tile, kind = 0`` and the rows of every tile."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, b in _by_dim(batch):
                a = annuli.value[dim]
                at = a.of_bin[b.column("pivot").to_numpy(), _bin(b.column("distance").to_numpy(), spaces.value[dim].reach)]
                uid = b.column("uid").to_numpy()
                spread = (uid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                n = len(uid)
                yield pa.RecordBatch.from_arrays([
                    pa.array(a.first_tile[at] + spread % a.tiles[at]), pa.array(np.zeros(n, np.int32)), b.column("uid"), b.column("vec_id"), b.column("dim"), b.column("v")], _TILED)

    return keyed.mapInArrow(run, TILED)


TILED = "tile bigint, kind int, uid bigint, vec_id bigint, dim int, v array<double>"
_TILED = ["tile", "kind", "uid", "vec_id", "dim", "v"]


def visits(queries: DataFrame, spaces, annuli, k: int, bounded: bool) -> DataFrame:
    """``tile, kind = 1`` and the query, a row per tile to visit: the nearest
    annuli that hold more than ``k`` rows, or (``bounded``, with the ``kth``
    score so far) every other annulus that the bound does not exclude."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, b in _by_dim(batch):
                v, s, a = _matrix(b.column("v"), dim), spaces.value[dim], annuli.value[dim]
                d = s.distances(v, np.zeros(len(v)))[:, a.pivot]
                gap = np.maximum(np.maximum(a.lo - d, d - a.hi), 0)      # no row of the annulus is nearer
                # Nearest annuli first, among equals those of the nearest pivot.
                order = np.lexsort((np.broadcast_to(np.arange(len(a.lo)), gap.shape), d, gap), axis=1)
                rows = np.cumsum(a.rows[order], axis=1)
                start = np.concatenate([np.zeros((len(v), 1), rows.dtype), rows[:, :-1]], axis=1) <= k
                want = np.zeros(gap.shape, bool)
                np.put_along_axis(want, order, start, axis=1)
                if bounded:
                    kth = b.column("kth").to_numpy(zero_copy_only=False)    # NaN: fewer than k rows found
                    radius = np.sqrt(np.maximum((v * v).sum(1) + s.top - 2 * kth, 0)) * (1 + 1e-9) + 1e-3
                    want = ~want & ~(gap > radius[:, None])
                q, at = np.nonzero(want)
                tiles = a.tiles[at]
                q, first = np.repeat(q, tiles), np.repeat(a.first_tile[at], tiles)
                nth = np.arange(len(q)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
                for lo in range(0, len(q), 4096):
                    part = pa.array(q[lo:lo + 4096])
                    n = len(part)
                    yield pa.RecordBatch.from_arrays([
                        pa.array((first + nth)[lo:lo + 4096]), pa.array(np.ones(n, np.int32)), b.column("uid").take(part),
                        b.column("vec_id").take(part), b.column("dim").take(part), b.column("v").take(part)], _TILED)

    return queries.mapInArrow(run, TILED)


def best_of(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) of the ``k`` best rows per query; rows stand in tie order,
    ``own`` marks the query's own row."""
    n = scores.shape[1]
    if np.abs(scores).max(initial=0) < 2 ** 49 and n < 2 ** 13:
        keys = scores.astype(np.int64) * 2 ** 13 + (n - 1 - np.arange(n))
        keys[own] = np.iinfo(np.int64).min
        m = min(k, n)
        top = np.argpartition(keys, n - m, axis=1)[:, n - m:]
    else:
        ranked = np.where(own, -np.inf, scores)
        top = np.argsort(-ranked, axis=1, kind="stable")[:, :k]
    q = np.repeat(np.arange(len(scores)), top.shape[1])
    r = top.ravel()
    keep = ~own[q, r]
    return q[keep], r[keep]


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products, exact while they fit a double's 53 bits; else by long doubles, clipped."""
    if q.size and v.size and np.abs(q).max() * np.abs(v).max() * q.shape[1] < 2.0 ** 52:
        return q @ v.T
    out = np.empty((len(q), len(v)), dtype=object)
    for i, a in enumerate(q):
        for j, b in enumerate(v):
            out[i, j] = max(-2 ** 62, min(2 ** 62, sum(int(x) * int(y) for x, y in zip(a, b))))
    return out.astype(np.float64) if not out.size or max(abs(x) for x in out.ravel()) < 2 ** 53 else out.astype(np.int64)


def search_tiles(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query, query_id, vec_id, score``: per tile the ``k`` best rows of every query that visits it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, ids, uids, v = None, [], None, None, None
        for batch in batches:
            tiles, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((tiles[1:] != tiles[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(tiles)]):
                b = batch.slice(lo, hi - lo)
                if tiles[lo] != tile:
                    tile, held, v = int(tiles[lo]), [], None
                if kinds[lo] == 0:
                    held.append(b)
                    continue
                dim = b.column(4)[0].as_py()
                if v is None:
                    if not held:
                        continue
                    t = pa.Table.from_batches(held).combine_chunks()
                    ids = t.column(3).fill_null(_LAST).to_numpy()
                    order = np.argsort(ids, kind="stable")
                    ids, uids = ids[order], t.column(2).to_numpy()[order]
                    v = _matrix(t.column(5).combine_chunks(), dim)[order] if dim else np.zeros((len(order), 0))
                q = _matrix(b.column(5), dim) if dim else np.zeros((len(b), 0))
                for at in range(0, len(q), 256):
                    part = q[at:at + 256]
                    mine = b.column(2).to_numpy()[at:at + 256]
                    score = products(part, v)
                    qi, ri = best_of(score, mine[:, None] == uids[None, :], k)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(mine[qi]), pa.array(b.column(3).to_numpy()[at:at + 256][qi]), pa.array(ids[ri]), pa.array(score[qi, ri].astype(np.int64))],
                        ["query", "query_id", "vec_id", "score"])

    both = rows.unionByName(queries).repartition("tile").sortWithinPartitions("tile", "kind")
    return both.mapInArrow(run, "query bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(table: DataFrame, staging: Staging, k: int = K, every: int = EVERY, vector: str = "embedding", key: str = "vec_id",
          pivots: int = PIVOTS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows of every query."""
    spark = table.sparkSession
    vectors = integer_vectors(table, staging, vector, key)
    tops = {r["dim"]: r["m"] for r in vectors.groupBy("dim").agg(F.max("norm2").alias("m")).collect()}     # a row per vector length
    sampled: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id", "uid")).limit(SAMPLE).collect():
        sampled.setdefault(r["dim"], []).append(r["v"])
    for dim in tops.keys() - sampled.keys():       # a rare length: one row of it
        sampled[dim] = [vectors.filter(F.col("dim") == dim).orderBy("vec_id", "uid").first()["v"]]
    spaces = {d: choose_pivots(np.array(x, dtype=np.float64).reshape(len(x), d), tops[d], pivots) for d, x in sampled.items()}
    shared = spark.sparkContext.broadcast(spaces)
    keyed = staging.table(key_vectors(vectors, shared), "keyed")
    reach = F.lit(1.0)
    for d, s in spaces.items():
        reach = F.when(F.col("dim") == d, F.lit(float(s.reach))).otherwise(reach)
    b = F.least((F.col("distance") / reach * BINS).cast("bigint"), F.lit(BINS - 1))
    found: dict[int, list] = {}
    for r in keyed.groupBy("dim", "pivot", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("distance").alias("lo"), F.max("distance").alias("hi")).collect():
        found.setdefault(r["dim"], []).append((r["pivot"], r["bin"], r["n"], r["lo"], r["hi"]))      # at most PIVOTS * BINS
    annuli, tiles = {}, 0
    for d in sorted(found):
        annuli[d] = cut_annuli(found[d], len(spaces[d].pivots), tile_rows, tiles)
        tiles += int(annuli[d].tiles.sum())
    index = spark.sparkContext.broadcast(annuli)
    rows = place_rows(keyed, shared, index)
    queries = keyed.filter(F.col("vec_id") % every == 0).select("uid", "vec_id", "dim", "v")
    near = staging.table(search_tiles(rows, visits(queries, shared, index, k, False), k), "near")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    near_best = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    kth = near_best.filter(F.col("rank") == k).select(F.col("query").alias("uid"), F.col("score").cast("double").alias("kth"))
    ahead = queries.join(kth, "uid", "left").withColumn("kth", F.coalesce("kth", F.lit(float("nan"))))
    rest = search_tiles(rows, visits(ahead, shared, index, k, True), k)
    both = near_best.drop("rank").unionByName(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return both.select("query_id", "rank", F.when(F.col("vec_id") != _LAST, F.col("vec_id")).alias("vec_id"), "score")
