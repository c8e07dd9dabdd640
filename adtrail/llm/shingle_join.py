"""Operator 5: n-gram Jaccard join and its connected components.

A text's set holds the 64-bit hashes of its distinct word shingles.  Two texts
link when ``den * |A & B| >= num * |A | B|``.

1. Copies.  Every row gets the name of its set (a 64-bit hash of the whole set);
   rows with one name are one node from here on, so copies are never paired.
   Sets that cannot link are left out of the steps to follow: a linked set shares
   all but ``n - ceil(n * num / den)`` of its ``n`` shingles with its partner, so of
   those in a hash sample at least ``need`` occur in another set.  The sample's
   size is known per set, so the test is one-sided: no set with a link is left out.
2. Size bands and parts.  Linked sets differ in at most ``k`` shingles, where
   ``k = floor((|A| + |B|) * (den - num) / (den + num))``.  Sizes are cut into
   bands; in a band the hash range is cut into ``k + 1 + spare`` parts, so two
   linked sets agree on more than ``spare`` whole parts.  Sets that agree on a
   part meet under its key.  Empty parts are left out, except by the rare sets
   with more than ``spare`` of them (``spare_parts`` keeps them rare at any
   threshold).  A set also enters the bands below if a linked partner can lie there.  Equal keys are merged inside a task before
   the shuffle, so a key has at most a row per task.
3. Candidate clusters.  The sets under one key form a star (never all pairs);
   connected components of the stars are the clusters.  Every link lies inside one.
4. Tiles.  A cluster's sets are brought together, a cluster above
   ``TILE_SHINGLES`` in blocks.  First each block meets itself and names its hub,
   the root of its largest group; the hubs meet; groups whose hubs link with the
   commonest one are the cluster's core, connected already.  Then only sets
   outside the core meet the others of fitting size (size bands, cut into
   blocks), so copies of one original cost a few readings, however many there are.  With ``link_counts``
   all blocks meet pairwise instead.  Inside a tile, sets are taken
   in order of how common their shingles are there (the original of a group of
   near copies first) and compared with those of fitting size that are not yet
   connected to them (with ``link_counts``: with all, so every link is met
   exactly once and counted): first by bitmap signatures, whose differing bits bound the
   overlap from above, then by intersecting the sorted arrays.
5. A row's links are the other rows it links with: those of its own name, and
   the copies of every linked name.  The links' connected components give every row the smallest id it reaches.

No pair, partner or candidate is dropped anywhere.  The probability that two
different shingles or sets share a 64-bit hash is about ``n**2 / 2**65``.

Defined results: null, empty and wordless texts have an empty set and only
reach themselves.  Texts with fewer words than a shingle have one shingle, the
whole sequence.  Repeated rows reach each other.  Rows whose id is null reach
the smallest non-null id, if any.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtrail.llm import words as W
from adtrail.staging import Staging

SHINGLE = 3
NUM, DEN = 90, 100
SPARE = 2                     # parts that may agree by being empty, at least
BAND_GROWTH = 1.5
TILE_SHINGLES = 2_000_000     # shingles of one tile side
SAMPLE_FACTOR = 2             # the sample's share of all shingles, as a multiple of 1 - num / den
_KEYS_HELD = 1_000_000
_BAND_BLOCKS = 1 << 40       # numbers of blocks kept apart per size band


def shingle_sets(t: W.Texts, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row."""
    data = W.LOWER[t.data]
    starts, ends, first = W.spans(W.Texts(t.first, data, t.offsets))
    h = W.hashes(data, starts, ends)
    n = max(len(h) - size + 1, 0)
    grams = W.combine(*[h[i:i + n] for i in range(size)])
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(grams[a:b - size + 1])
        elif b > a:
            short = W.combine(*[h[i:i + 1] for i in range(a, b)])
            yield W.mix(short + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def set_name(x: np.ndarray) -> int:
    """A set's name: a hash of its size, sum and xor."""
    m = W.mix(x)
    parts = [np.array([v], dtype=np.uint64) for v in (len(x), m.sum(dtype=np.uint64), np.bitwise_xor.reduce(x, initial=0))]
    return int(W.combine(*parts).view(np.int64)[0])


def _edges() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * BAND_GROWTH)))
    return np.array(out, dtype=np.int64)


EDGES = _edges()


def max_difference(total: int, num: int, den: int) -> int:
    """The most shingles in which linked sets of ``total`` shingles together differ."""
    return total * (den - num) // (den + num)


@lru_cache(maxsize=None)
def spare_parts(n: int, k: int) -> int:
    """How many parts may agree by being empty, for sets of ``n`` shingles or
    more that differ in at most ``k``: the fewest that such a set's empty parts
    exceed by four standard deviations only, or the best there are."""
    best, s = (-math.inf, SPARE), SPARE
    while s <= SPARE + n:
        p = k + 1 + s
        empty = math.exp(-n / p)
        z = (s - p * empty) / math.sqrt(max(p * (empty - empty * empty * (1 + n / p)), 1e-9))
        if z >= 4:
            return s
        best = max(best, (z, s))
        s += max(1, s >> 4)
    return best[1]


def part_keys(x: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """The part keys under which the set ``x`` must be entered."""
    n = len(x)
    if not n:
        return np.zeros(0, np.int64)
    least = -(-n * num // den)
    out = []
    own = int(np.searchsorted(EDGES, n, side="right")) - 1
    for band in range(int(np.searchsorted(EDGES, least, side="right")) - 1, own + 1):
        most = int(EDGES[band + 1]) - 1
        k = max_difference(most + most * den // num, num, den)
        if not k:
            continue                     # only equal sets link: they have one name
        spare = spare_parts(int(EDGES[band]), k)
        p = k + 1 + spare
        part = ((x >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)   # ascending, as x is
        at = np.searchsorted(part, np.arange(p + 1, dtype=np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(x), dtype=np.uint64)])
        sums, count = total[at[1:]] - total[at[:-1]], np.diff(at)
        keep = np.flatnonzero(count) if np.count_nonzero(count == 0) <= spare else np.arange(p)
        tag = np.full(len(keep), band, np.uint64)
        out.append(W.combine(tag, keep.astype(np.uint64), count[keep].astype(np.uint64), sums[keep]).view(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def sampled(x: np.ndarray, num: int = NUM, den: int = DEN) -> np.ndarray:
    """The shingles of the set that are in the hash sample."""
    limit = min((den - num) * SAMPLE_FACTOR * (1 << 32) // den, 1 << 32)
    return x[(W.mix(x) >> np.uint64(32)) < np.uint64(limit)]


def least_shared(x: np.ndarray, num: int = NUM, den: int = DEN) -> int:
    """How many sampled shingles of ``x`` occur in another set, if ``x`` links with one."""
    return len(sampled(x, num, den)) - (len(x) - -(-len(x) * num // den))


def set_names(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE,
              num: int = NUM, den: int = DEN) -> DataFrame:
    """``doc_id, n_shingles, name, need`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in W.texts(batch.column(1)):
                sets = list(shingle_sets(t, size))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(t.first, t.rows), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([set_name(x) for x in sets], pa.int64()),
                    pa.array([least_shared(x, num, den) for x in sets], pa.int64())], ["doc_id", "n_shingles", "name", "need"])
        W.release_memory()

    return _rows(docs, key, text).mapInArrow(run, "doc_id bigint, n_shingles bigint, name bigint, need bigint")


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(docs[key].cast("bigint").alias("doc_id"), docs[text].cast("string").alias("text"))


def _flush(keys: list[np.ndarray], names: list[int]) -> pa.RecordBatch:
    """A row per key: one of its names, and the others."""
    k = np.concatenate(keys)
    c = np.repeat(np.array(names, dtype=np.int64), [len(x) for x in keys])
    order = np.lexsort((c, k))
    k, c = k[order], c[order]
    new_key = np.ones(len(k), bool)
    new_key[1:] = k[1:] != k[:-1]
    fresh = new_key.copy()
    fresh[1:] |= c[1:] != c[:-1]
    k, c, new_key = k[fresh], c[fresh], new_key[fresh]
    heads = np.flatnonzero(new_key)
    offsets = np.concatenate([heads, [len(k)]]) - np.arange(len(heads) + 1)
    members = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(c[~new_key], pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(k[heads]), pa.array(c[heads]), members], ["key", "head", "members"])


def _merged(pairs: Iterator[tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
    """(keys, name) of a task's sets as rows, equal keys merged."""
    keys, names, held = [], [], 0
    for k, name in pairs:
        if len(k):
            keys.append(k)
            names.append(name)
            held += len(k)
        if held >= _KEYS_HELD:
            yield _flush(keys, names)
            keys, names, held = [], [], 0
    if held:
        yield _flush(keys, names)
    keys, names = [], []
    W.release_memory()


def _shared(met: DataFrame) -> DataFrame:
    """``key, head, members, b`` of the keys with two names or more; ``b`` is the least head."""
    w = Window.partitionBy("key")   # at most a row per flush of a task
    met = met.select("key", "head", "members", F.min("head").over(w).alias("b"), F.max("head").over(w).alias("last"))
    return met.filter((F.col("b") != F.col("last")) | (F.size("members") > 0))


def shared_counts(docs: DataFrame, num: int = NUM, den: int = DEN, text: str = "text", key: str = "doc_id",
                  size: int = SHINGLE) -> DataFrame:
    """``name, shared``: how many sampled shingles of a set occur in another set (no row: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged((sampled(x, num, den).view(np.int64), set_name(x)) for batch in batches
                           for t in W.texts(batch.column(1)) for x in shingle_sets(t, size))

    found = _shared(_rows(docs, key, text).mapInArrow(run, "key bigint, head bigint, members array<bigint>"))
    # Rows of a key are in one task already; a set that came by copies in many tasks counts once.
    pairs = found.select("key", F.explode(F.concat("members", F.array("head"))).alias("name")).distinct()
    return pairs.groupBy("name").agg(F.count(F.lit(1)).alias("shared"))


def candidate_stars(sets: DataFrame, num: int = NUM, den: int = DEN) -> DataFrame:
    """Edges ``a, b`` between names of ``sets`` (name, hashes) that agree on a part, one star per part key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _merged((part_keys(np.frombuffer(raw.as_buffer(), dtype=np.uint64), num, den), name)
                           for batch in batches for name, raw in zip(batch.column(0).to_pylist(), batch.column(1)))

    stars = _shared(sets.select("name", "hashes").mapInArrow(run, "key bigint, head bigint, members array<bigint>"))
    return stars.select(F.explode(F.concat("members", F.array("head"))).alias("a"), "b").filter("a != b").distinct()


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``node, root``: the smallest node that each node of the edges ``a, b``
    reaches (the roots' own rows included).  Alternating large and small stars,
    each round a staged table that replaces the round's before; only minima per
    node are gathered."""
    e = staging.table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "edges")
    seen, old = None, staging.paths[-1]
    while True:
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
        large = both.filter("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staging.table(large, "large_star")
        low = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        small = large.join(low, F.col("a") == F.col("n")).select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        star = staging.paths[-1]
        e = staging.table(small.filter("a != b").distinct(), "edges")
        staging.drop(old, star)
        old = staging.paths[-1]
    roots = e.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def with_blocks(members: DataFrame, tile_shingles: int) -> DataFrame:
    """``members`` with ``blocks``: into how many its cluster is cut."""
    blocks = F.greatest(F.lit(1), F.ceil(F.sum("n") / tile_shingles)).cast("int")
    return members.drop("n").join(members.groupBy("cluster").agg(blocks.alias("blocks")), "cluster")


def _tiles(member_sets: DataFrame) -> DataFrame:
    """``member_sets`` (name, cluster, n, hashes, copies, blocks) with ``tile, side``: a row
    per tile that the set takes part in.  No shuffle: the sets carry their cluster's cut."""
    placed = member_sets.withColumn("block", _block("blocks"))
    return _meetings(placed.withColumn("others", F.sequence(F.lit(0), F.col("blocks") - 1)))


def _block(count: str) -> Column:
    return F.pmod(F.xxhash64("name"), F.greatest(F.lit(1), F.col(count))).cast("int")


def _meetings(placed: DataFrame) -> DataFrame:
    """A row per tile of every set that stands in ``block`` and meets the blocks ``others``."""
    tiled = placed.select("cluster", "name", "hashes", "copies", "block", F.explode("others").alias("other"))
    return tiled.select(F.xxhash64("cluster", F.least("block", "other"), F.greatest("block", "other")).alias("tile"), "cluster",
                        F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "name", "hashes", "copies")


def bitmaps(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """One row of ``bits`` bits (as 64-bit words) per set."""
    out = np.zeros((len(sets), bits // 8), dtype=np.uint8)
    for i, x in enumerate(sets):
        at = (W.mix(x) & np.uint64(bits - 1)).astype(np.int64)
        marks = np.zeros(bits, dtype=bool)
        marks[at] = True
        out[i] = np.packbits(marks)
    return out.view(np.uint64)


def link_tile(sets: list[np.ndarray], side: np.ndarray, num: int = NUM, den: int = DEN,
              copies: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The local root of every set, and its linked sets' ``copies`` in all.  Sets
    of different sides are compared, or, if all have one side, all.  Without
    ``copies``, pairs already connected are not compared and the sums are 0."""
    n = np.array([len(x) for x in sets], dtype=np.int64)
    root = np.arange(len(sets))
    links = np.zeros(len(sets), np.int64)
    parent_members = {i: [i] for i in range(len(sets))}
    every = np.concatenate(sets)
    _, where, times = np.unique(every, return_inverse=True, return_counts=True)
    common = np.add.reduceat(times[where].astype(np.float64), np.concatenate([[0], np.cumsum(n)[:-1]])) / n
    one_side = (side == side[0]).all()
    # Bands of the tile, each with bitmaps of a width that fits its sets; a set
    # is compared with its own and the neighbouring sizes.
    order = np.argsort(-common, kind="stable")
    done = np.zeros(len(sets), dtype=bool)
    maps: dict[int, np.ndarray] = {}
    band = np.searchsorted(EDGES, n, side="right") - 1
    for i in order.tolist():
        done[i] = True
        open_ = ~done & (n * den >= n[i] * num) & (n * num <= n[i] * den)
        if copies is None:
            open_ &= root != root[i]
        if not one_side:
            open_ &= side != side[i]
        at = np.flatnonzero(open_)
        if not len(at):
            continue
        width = int(EDGES[band[i]])
        if width not in maps:                    # all sets that this band's sets can link with
            near = np.abs(band - band[i]) <= 1
            rows = np.full(len(sets), -1)
            rows[near] = np.arange(near.sum())
            bits = max(64, 1 << (16 * width - 1).bit_length())
            maps[width] = (rows, bitmaps([sets[j] for j in np.flatnonzero(near)], bits))
        rows, signs = maps[width]
        most = (n[at] + n[i]) * (den - num) // (den + num)
        for lo in range(0, len(at), 4096):
            part = at[lo:lo + 4096]
            differ = np.bitwise_count(signs[rows[part]] ^ signs[rows[i]]).sum(axis=1, dtype=np.int64)
            part = part[differ <= most[lo:lo + 4096]]
            if copies is None:
                part = part[root[part] != root[i]]
            if not len(part):
                continue
            stack = np.concatenate([sets[j] for j in part])
            hit = sets[i][np.minimum(np.searchsorted(sets[i], stack), n[i] - 1)] == stack
            both = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(n[part])[:-1]]))
            linked = part[den * both >= num * (n[part] + n[i] - both)]
            if copies is not None:
                links[linked] += copies[i]
                links[i] += copies[linked].sum()
            for j in linked[root[linked] != root[i]].tolist():
                a, b = root[i], root[j]
                if a != b:
                    if len(parent_members[a]) < len(parent_members[b]):
                        a, b = b, a
                    moved = parent_members.pop(b)
                    root[moved] = a
                    parent_members[a] += moved
    return root, links


def link_tiles(tiles: DataFrame, num: int = NUM, den: int = DEN, count: bool = False, hubs: bool = False) -> DataFrame:
    """Edges ``a, b`` that connect the linked sets of every tile.  With ``count``
    a row for every set with a link, ``links`` of the tile; a root's ``b`` is itself.
    With ``hubs`` a further row for the root of every tile's largest group, with
    its ``cluster`` and ``hashes`` (null in the other rows)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, sides, sets, copies = [], [], [], []
        now = None

        def meet() -> bool:                          # a block that meets an empty one has met itself elsewhere
            return len(sets) > 1 and (now[1] == now[2] or len(set(sides)) > 1)

        def edges():
            root, links = link_tile(sets, np.array(sides), num, den, np.array(copies, dtype=np.int64) if count else None)
            name = np.array(names, dtype=np.int64)
            off = np.flatnonzero((root != np.arange(len(root))) | (links > 0))
            cluster, hashes = [None] * len(off), [None] * len(off)
            if hubs:
                hub = int(np.bincount(root).argmax())
                off = np.append(off, hub)
                cluster.append(now[0])
                hashes.append(sets[hub].tobytes())
            return pa.RecordBatch.from_arrays([
                pa.array(name[off]), pa.array(name[root[off]]), pa.array(links[off]), pa.array(cluster, pa.int64()),
                pa.array(hashes, pa.binary())], ["a", "b", "links", "cluster", "hashes"])

        for batch in batches:
            cols = [batch.column(i) for i in range(7)]
            for row in range(batch.num_rows):
                at = tuple(cols[i][row].as_py() for i in range(3))      # cluster, lo, hi
                if at != now:
                    if meet():
                        yield edges()
                    names, sides, sets, copies, now = [], [], [], [], at
                elif cols[4][row].as_py() == names[-1]:
                    continue                         # a repeated row
                names.append(cols[4][row].as_py())
                sides.append(cols[3][row].as_py())
                sets.append(np.frombuffer(cols[5][row].as_buffer(), dtype=np.uint64))
                copies.append(cols[6][row].as_py())
        if meet():
            yield edges()
        names, sides, sets, copies = [], [], [], []
        W.release_memory()

    ordered = tiles.repartition("tile").sortWithinPartitions("cluster", "lo", "hi", "name")
    return ordered.select("cluster", "lo", "hi", "block", "name", "hashes", "copies").mapInArrow(
        run, "a bigint, b bigint, links bigint, cluster bigint, hashes binary")


def link_sets(sets: DataFrame, staging: Staging, num: int = NUM, den: int = DEN, tile_shingles: int = TILE_SHINGLES) -> DataFrame:
    """Edges ``a, b`` that connect all linked ``sets`` (name, cluster, n, hashes, copies, blocks)."""
    whole = staging.table(link_tiles(_tiles(sets.filter("blocks = 1")), num, den), "links")
    # Clusters that are cut into blocks: each block by itself, then the blocks' hubs.
    cut = sets.filter("blocks > 1")
    alone = cut.withColumn("block", _block("blocks")).withColumn("others", F.array("block"))
    inner = staging.table(link_tiles(_meetings(alone), num, den, hubs=True), "block_links")
    hubs = inner.filter("hashes is not null").select(
        F.col("a").alias("name"), "cluster", (F.length("hashes") / 8).alias("n"), "hashes", F.lit(1).cast("bigint").alias("copies"))
    between = staging.table(link_tiles(_tiles(with_blocks(hubs, tile_shingles)), num, den), "hub_links")
    # The core: the commonest hub, those linked with it, and their groups.
    times = between.groupBy(F.col("b").alias("name")).agg(F.count(F.lit(1)).alias("times"))
    ranked = hubs.select("name", "cluster").join(times, "name", "left").withColumn("times", F.coalesce("times", F.lit(0)))
    first = ranked.groupBy("cluster").agg(F.max_by("name", F.struct("times", "name")).alias("hub")).select("hub")
    near = between.join(first, between["b"] == first["hub"]).select(F.col("a").alias("hub"))
    core_hubs = staging.table(first.unionByName(near).distinct(), "core_hubs")
    core = inner.select(F.col("a").alias("name"), F.col("b").alias("hub")).join(core_hubs, "hub").select("name").distinct()
    # Linked sets lie in one size band or in neighbouring ones (a little wider than the
    # threshold's ratio of sizes, for rounding).  In a band the others are blocks
    # 0 to rest - 1, the core's follow; only tiles with a block of others are needed.
    flagged = cut.select("name", "cluster", "n").distinct().join(core.withColumn("core", F.lit(True)), "name", "left")
    flagged = flagged.withColumn("core", F.coalesce("core", F.lit(False))).withColumn(
        "band", F.floor(F.log("n") / (1.001 * math.log(den / num))).cast("int"))
    blocks = {flag: F.ceil(F.sum(F.when(F.col("core") == flag, F.col("n")).otherwise(0)) / tile_shingles).cast("int") for flag in (False, True)}
    sizes = flagged.groupBy("cluster", "band").agg(blocks[False].alias("rest"), blocks[True].alias("inside"))
    bands = sizes.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("band", F.struct("rest", "inside")))).alias("bands"))
    count = "try_element_at(bands, b).rest + if(core, 0, try_element_at(bands, b).inside)"
    others = F.expr(f"flatten(transform(filter(array(band - 1, band, band + 1), b -> coalesce({count}, 0) > 0), "
                    f"b -> transform(sequence(0, {count} - 1), i -> b * {_BAND_BLOCKS}L + i)))")
    own = F.when(F.col("core"), F.col("rest") + _block("inside")).otherwise(_block("rest"))
    places = flagged.join(sizes, ["cluster", "band"]).join(bands, "cluster").select(
        "name", (F.col("band") * F.lit(_BAND_BLOCKS).cast("bigint") + own).alias("block"), others.alias("others")).filter(F.size("others") > 0)
    places = staging.table(places, "places")
    outer = staging.table(link_tiles(_meetings(cut.join(places.hint("merge"), "name")), num, den), "outer_links")
    edges = [x.select("a", "b") for x in (whole, inner, between, outer)]
    return edges[0].unionByName(edges[1]).unionByName(edges[2]).unionByName(edges[3]).filter("a != b")


def member_sets(docs: DataFrame, members: DataFrame, text: str = "text", key: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """``name, n, hashes, copies``: the set of one row per name in ``members`` (doc_id, name, copies);
    of a row that is repeated so often that a task's share of it was split, one per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, done = None, set()                     # names already given of the id at hand
        for batch in batches:
            for t in W.texts(batch.column(1)):
                sets = list(shingle_sets(t, size))
                names = batch.column(0).slice(t.first, t.rows).to_pylist()
                ids = batch.column(3).slice(t.first, t.rows).to_pylist()
                ok = []
                for x, name, i in zip(sets, names, ids):
                    if i != last:
                        last, done = i, set()
                    # A repeated id may bring another text here: only the set named counts.
                    ok.append(name not in done and set_name(x) == name)
                    if ok[-1]:
                        done.add(name)
                ok = pa.array(ok, pa.bool_())
                out = pa.RecordBatch.from_arrays([
                    batch.column(0).slice(t.first, t.rows), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([x.tobytes() for x in sets], pa.binary()), batch.column(2).slice(t.first, t.rows)], ["name", "n", "hashes", "copies"])
                yield out.filter(ok)
        W.release_memory()

    # Members grow with the documents: always a shuffle join, at any size.
    rows, members = _rows(docs, key, text).withColumnRenamed("doc_id", "__id"), members.hint("merge")
    found = rows.join(members, rows["__id"].eqNullSafe(members["doc_id"])).select("name", "text", "copies", "__id")
    # The join leaves rows of one id side by side, so repeats are seen without a shuffle of the sets.
    return found.mapInArrow(run, "name bigint, n bigint, hashes binary, copies bigint")


def link_components(docs: DataFrame, staging: Staging, num: int = NUM, den: int = DEN, text: str = "text",
                    key: str = "doc_id", tile_shingles: int = TILE_SHINGLES, size: int = SHINGLE, link_counts: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row, by shingles of ``size`` words; with
    ``link_counts`` also ``n_links``, the number of other rows that it links with."""
    named = staging.table(set_names(docs, text, key, size, num, den), "set_names")
    firsts = named.filter("n_shingles > 0").groupBy("name").agg(
        F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"), F.min("n_shingles").alias("n"), F.min("need").alias("need"))
    shared = staging.table(shared_counts(docs, num, den, text, key, size), "shared_counts")
    able = firsts.join(shared.hint("merge"), "name", "left").filter(F.coalesce("shared", F.lit(0)) >= F.col("need"))
    found = staging.table(member_sets(docs, able.select("doc_id", "name", "copies"), text, key, size), "found_sets")
    staging.drop(staging.paths[-2])
    found_path = staging.paths[-1]
    clusters = components(candidate_stars(found, num, den), staging).select(F.col("node").alias("name"), F.col("root").alias("cluster"))
    cluster_path = staging.paths[-1]
    members = with_blocks(found.select("name", "n").distinct().join(clusters, "name"), tile_shingles)
    sets = staging.table(found.join(members.hint("merge"), "name").select("name", "cluster", "n", "hashes", "copies", "blocks"), "member_sets")
    staging.drop(found_path, cluster_path)
    used = staging.paths[-1:]
    if link_counts:
        links = staging.table(link_tiles(_tiles(sets), num, den, True), "links")
    else:
        links = link_sets(sets, staging, num, den, tile_shingles)
    staging.drop(*used)
    linked = components(links.select("a", "b"), staging)
    # Names without a link are components of their own.
    rooted = firsts.join(linked, firsts["name"] == linked["node"], "left").select(
        "name", "doc_id", "copies", F.coalesce("root", "name").alias("root"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = rooted.select("name", "root", "copies").join(least, "root").select("name", "component_id", "copies")
    shown = [F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")]
    if link_counts:
        sums = links.groupBy(F.col("a").alias("name")).agg(F.sum("links").alias("links"))
        labels = labels.join(sums, "name", "left").withColumn("links", F.coalesce("links", F.lit(0)))
        shown.append(F.when(F.col("n_shingles") > 0, F.col("copies") - 1 + F.col("links")).otherwise(F.lit(0)).cast("bigint").alias("n_links"))
    return named.join(labels, "name", "left").select("doc_id", "n_shingles", *shown)


def one_of_each(docs: DataFrame, staging: Staging, num: int = NUM, den: int = DEN, size: int = SHINGLE) -> DataFrame:
    """The documents without later near copies: of each component the rows that
    stand at its smallest id stay (one row, if that row is repeated), and every
    document without words."""
    with Staging(docs.sparkSession) as inner:
        found = link_components(docs, inner, num, den, size=size)
        stay = found.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__id")).distinct()
        stay = staging.table(stay, "first_of_each")
    kept = docs.join(stay, docs["doc_id"].eqNullSafe(stay["__id"]), "left_semi")
    return kept.dropDuplicates(["doc_id", "text"])
