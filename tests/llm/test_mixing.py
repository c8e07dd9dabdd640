import itertools
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from adtrail.llm import mixing
from llm.conftest import documents


def plain_targets(per_source, weights=mixing.WEIGHTS, most=3):
    """Share by weight; cap; share the excess among the others until none is above."""
    names = sorted((s for s in per_source if s is not None)) + ([None] if None in per_source else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped = {}, set()
    total = sum(per_source.values())
    while True:
        left = total - sum(most * per_source[s] for s in capped)
        free = [s for s in names if s not in capped]
        over = set()
        for s in free:
            target[s] = left * weight[s] / sum(weight[x] for x in free)
            if target[s] > most * per_source[s]:
                over.add(s)
        for s in capped:
            target[s] = most * per_source[s]
        if not over:
            return target
        capped |= over


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(docs, staging, tolerance=0):
    rows = docs.collect()
    out = mixing.mix(docs, staging).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r["doc_id"], size(r["text"])) for r in rows)
    per = defaultdict(int)
    for r in rows:
        per[r["source"]] += size(r["text"])
    want = plain_targets(dict(per))
    taken = defaultdict(int)
    for r in out:
        assert r["source_size"] == per[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-9, abs=1e-9)
        assert r["taken"] in [r["size"] * k for k in range(4)]
        taken[r["source"]] += r["taken"]
    for s, t in taken.items():
        assert want[s] - 1 - tolerance <= t <= want[s] + 1e-6, (s, t, want[s])
    return out


def test_targets_are_met_and_reruns_agree(spark, staging):
    rows = [(i, " ".join(["w"] * (1 + (i * 37) % 90)), None, ["a", "b", "c", "d", "e", "f", None][(i * i) % 7 if i % 3 else 0]) for i in range(600)]
    docs = documents(spark, rows)
    first = check(docs, staging)
    again = mixing.mix(docs.repartition(7), staging).collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)


def test_one_large_group_of_one_length(spark, staging, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    rows = [(i, "five words in this text", None, "a") for i in range(700)] + [(1000 + i, "x y", None, "b") for i in range(300)]
    check(documents(spark, rows), staging, tolerance=5)


def test_edges(spark, edge, empty, staging):
    out = mixing.mix(edge, staging).collect()
    assert len(out) == edge.count() and all(r["taken"] <= 3 * r["size"] for r in out)
    assert mixing.mix(empty, staging).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(1, 3)), min_size=1, max_size=4, unique_by=lambda t: t[0]), st.integers(0, 70))
def test_knapsack_finds_the_nearest_sum(pairs, budget):
    lengths, counts = [a for a, _ in pairs], [b for _, b in pairs]
    take = mixing._knapsack(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(take, counts))
    best = max(s for t in itertools.product(*[range(c + 1) for c in counts]) if (s := sum(a * b for a, b in zip(t, lengths))) <= budget)
    assert sum(a * b for a, b in zip(take, lengths)) == best


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.integers(1, 40)), min_size=1, max_size=20, unique_by=lambda t: t[0]), st.integers(0, 5000))
def test_fit_stays_within_counts_and_budget(pairs, budget):
    lengths, counts = [a for a, _ in pairs], [b for _, b in pairs]
    take = mixing.fit_counts(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(take, counts))
    total = sum(a * b for a, b in zip(take, lengths))
    assert total <= budget and (budget - total < max(lengths) or total == sum(a * b for a, b in zip(lengths, counts)))


def test_mixed_documents_repeat_as_taken(spark, edge, staging):
    taken = mixing.mix(edge, staging).collect()
    want = Counter()
    for r in taken:
        if r["taken"]:
            want[r["doc_id"], r["size"]] += r["taken"] // r["size"]
    got = mixing.mixed_documents(edge, staging)
    assert got.columns == edge.columns
    assert Counter((r["doc_id"], size(r["text"])) for r in got.collect()) == want
