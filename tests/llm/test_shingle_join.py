import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from adtrail.llm import shingle_join as S
from adtrail.llm import words as W
from llm.conftest import documents


def shingles(text, size=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(rows, size=3, num=90):
    sets = [shingles(t, size) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= num * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), doc if not sets[i] else min(ids, default=None)))
    return sorted(out, key=repr)


def near_copies(seed, groups=12, copies=9):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 12, 13, 20, 40, 120, 300]))]
        for c in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(base) // 40])):
                at = rng.randrange(len(text))
                kind = rng.random()
                if kind < 0.4:
                    text[at] = rng.choice(words)
                elif kind < 0.7 and len(text) > 1:
                    del text[at]
                else:
                    text.insert(at, rng.choice(words))
            rows.append((doc, " ".join(text)))
            doc += rng.randint(1, 3)
    chain = [rng.choice(words) for _ in range(100)]          # a drifting chain: ends far apart
    for step in range(15):
        rows.append((doc + step, " ".join(chain)))
        chain[3 * step] = f"new{step}"
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_components_against_brute_force(spark, staging):
    for seed in (1, 2):
        rows = near_copies(seed)
        docs = documents(spark, [(i, t, None, None) for i, t in rows]).repartition(5)
        assert result(S.link_components(docs, staging)) == brute(rows)


def test_clusters_in_blocks_give_the_same(spark, staging):
    rows = near_copies(3)
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    assert result(S.link_components(docs, staging, tile_shingles=300)) == brute(rows)


def test_a_cut_cluster_with_core_chain_and_strangers(spark, staging):
    """One cluster in many blocks: copies of one original, a chain that leads away
    from it, a second group and sets without any link."""
    rng = np.random.default_rng(12)
    sets = [np.arange(200)] + [np.delete(np.arange(200), rng.choice(200, 8, replace=False)) for _ in range(30)]
    sets += [np.arange(10 * i, 200 + 10 * i) for i in range(1, 12)]
    sets += [np.delete(np.arange(5000, 5150), i) for i in range(12)] + [np.arange(9000 + 300 * i, 9200 + 300 * i) for i in range(10)]
    sets = [W.mix(np.sort(x).astype(np.uint64)) for x in sets]
    sets = [np.sort(x) for x in sets]
    root = list(range(len(sets)))
    for i, x in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(x, sets[j]))
            if 100 * both >= 90 * (len(x) + len(sets[j]) - both):
                root = [root[j] if r == root[i] else r for r in root]
    want = {frozenset(i for i, r in enumerate(root) if r == v) for v in set(root) if root.count(v) > 1}
    for tile in (250, 1000, 4000, 10 ** 6):
        rows = [(i, 7, len(x), bytearray(x.tobytes()), 1) for i, x in enumerate(sets)]
        members = spark.createDataFrame(rows, "name long, cluster long, n long, hashes binary, copies long")
        blocks = members.select("name", F.greatest(F.lit(1), F.ceil(F.lit(sum(map(len, sets)) / tile))).cast("int").alias("blocks"))
        edges = S.link_sets(members.join(blocks, "name"), staging, tile_shingles=tile)
        found = {}
        for r in S.components(edges, staging).collect():
            found.setdefault(r["root"], set()).add(r["node"])
        assert set(map(frozenset, found.values())) == want, tile


def test_edge_rows(spark, edge, empty, staging):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    assert result(S.link_components(edge, staging)) == brute(rows)
    assert S.link_components(empty, staging).count() == 0


def test_part_keys_meet_for_every_linked_pair():
    rng = np.random.default_rng(4)
    for n in [*range(9, 60), 130, 500, 2000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            drop = int(rng.integers(0, S.max_difference(2 * n, 90, 100) + 1))
            add = int(rng.integers(0, drop + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[drop - add:], rng.integers(0, 2 ** 63, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(S.part_keys(a), S.part_keys(b))), (n, drop, add)


def test_bitmap_bound_never_hides_a_link():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 200, 60).astype(np.uint64)) for _ in range(30)]
    for bits in (64, 1024):
        m = S.bitmaps(sets, bits)
        for i in range(30):
            for j in range(i):
                assert np.bitwise_count(m[i] ^ m[j]).sum() <= len(np.setxor1d(sets[i], sets[j]))


def test_one_of_each_keeps_smallest_and_wordless(spark, edge, staging):
    kept = S.one_of_each(edge, staging)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for _, _, c in brute([(r["doc_id"], r["text"]) for r in edge.collect()])}
    assert sorted(ids, key=repr) == sorted(want | {d for d in ids if d is None}, key=repr)


def test_word_spans_do_not_cross_rows():
    col = pa.array(["ab", "cd ef", "", None, " x", "y"])
    for size in (1, 3, 100):
        found = []
        for t in W.texts(col, size):
            s, e, first = W.spans(t)
            for i in range(t.rows):
                found.append([t.data[a:b].tobytes().decode() for a, b in zip(s[first[i]:first[i + 1]], e[first[i]:first[i + 1]])])
        assert found == [["ab"], ["cd", "ef"], [], [], ["x"], ["y"]]


def test_hashes_tell_spans_apart():
    data = np.frombuffer(b"abcdefgh abcdefghi abcdefgh\0 abcdefghabcdefgh", np.uint8)
    s, e, _ = W.spans(W.Texts(0, data, np.array([0, len(data)])))
    assert len(set(W.hashes(data, s, e).tolist())) == 4


def test_part_keys_meet_for_every_linked_pair_at_eight_tenths():
    rng = np.random.default_rng(6)
    for n in [*range(4, 60), 130, 500, 2000]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            drop = int(rng.integers(0, S.max_difference(2 * n, 80, 100) + 1))
            add = int(rng.integers(0, drop + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[drop - add:], rng.integers(0, 2 ** 63, add).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and len(np.setxor1d(a, b)):
                assert len(np.intersect1d(S.part_keys(a, 80, 100), S.part_keys(b, 80, 100))), (n, drop, add)


def test_unlike_sets_do_not_meet_by_empty_parts():
    rng = np.random.default_rng(7)
    for n in (60, 200, 1000):
        keys = [S.part_keys(np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64)), 80, 100) for _ in range(60)]
        every = np.concatenate([np.unique(k) for k in keys])
        assert len(every) - len(np.unique(every)) <= 20, n


def test_links_are_counted_against_brute_force(spark, staging):
    rows = near_copies(8, groups=3)
    base = [f"b{i}" for i in range(150)]                    # all of these link with each other, two are copies
    rows += [(10_000 + c, " ".join(base[:10 * c] + ["x"] + base[10 * c + 1:])) for c in (0, 1, 2, 3, 4, 4, 5)]
    sets = [shingles(t) for _, t in rows]

    def linked(a, b):
        both = len(a & b)
        return bool(a) and 100 * both >= 90 * (len(a) + len(b) - both)

    want = sorted((d, sum(i != j and linked(a, b) for j, b in enumerate(sets))) for i, ((d, _), a) in enumerate(zip(rows, sets)))
    docs = documents(spark, [(i, t, None, None) for i, t in rows])
    for tile in (S.TILE_SHINGLES, 300):
        found = S.link_components(docs, staging, tile_shingles=tile, link_counts=True)
        assert result(found) == brute(rows)
        assert sorted((r["doc_id"], r["n_links"]) for r in found.collect()) == want
    assert max(n for _, n in want) == 6


def test_sets_with_a_link_share_what_they_need():
    rng = np.random.default_rng(9)
    for num in (80, 90):
        for n in [*range(1, 40), 130, 900]:
            for _ in range(6):
                a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
                drop = int(rng.integers(0, S.max_difference(2 * n, num, 100) + 1))
                b = np.unique(np.concatenate([rng.permutation(a)[drop:], rng.integers(0, 2 ** 63, drop // 2).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if 100 * both >= num * (len(a) + len(b) - both):
                    for x in (a, b):
                        shared = len(np.intersect1d(S.sampled(x, num, 100), np.intersect1d(a, b)))
                        assert shared >= S.least_shared(x, num, 100), (num, n, drop)


def test_passages_alone_do_not_make_candidates(spark, staging):
    """Texts that share passages only are left out before the parts; copies are not."""
    rng = random.Random(10)
    passages = [" ".join(f"p{i}x{j}" for j in range(60)) for i in range(5)]
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(250)) + " " + rng.choice(passages)) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(5)] + [(200 + i, rows[0][1]) for i in range(30)]
    docs = documents(spark, [(i, t, None, None) for i, t in rows]).repartition(4)
    shared = {r["name"]: r["shared"] for r in S.shared_counts(docs).collect()}
    need = {r["doc_id"]: (r["name"], r["need"]) for r in S.set_names(docs).collect()}
    able = {i for i, (name, least) in need.items() if shared.get(name, 0) >= least}
    assert able == {*range(5), *range(100, 105), *range(200, 230)}
    assert result(S.link_components(docs, staging)) == brute(rows)


def test_components_of_the_pipeline_against_brute_force(spark, staging):
    rows = near_copies(11, groups=14)
    docs = documents(spark, [(i, t, None, None) for i, t in rows]).repartition(3)
    want = brute(rows, 5, 80)
    assert result(S.link_components(docs, staging, 80, 100, size=5)) == want
    assert result(S.link_components(docs, staging, 80, 100, size=5, tile_shingles=400)) == want
    assert len({c for _, _, c in want}) < len(want) - 30
