"""Operators 11 and 13."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from adtrail.llm import conversation_repair as repair
from adtrail.llm import conversation_trie as trie

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    # Columns whose names an operator might use itself.
    T.StructField("pos", T.LongType()), T.StructField("name", T.StringType()), T.StructField("block", T.StringType()), T.StructField("node", T.LongType()),
    T.StructField("seq", T.LongType()), T.StructField("kind", T.StringType()), T.StructField("audit", T.StringType()), T.StructField("_part", T.LongType())])


def conversations(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", None, 3, "z", "K", 5) for r in rows], SCHEMA)


def in_order(rows):
    """conversation -> its (turn, role, text) by turn (null first), role, text."""
    out = defaultdict(list)
    for c, t, r, x in rows:
        out[c].append((t, r or "", x or ""))
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())) for c, v in out.items()}


def sample(seed, n_convs=40, longest=30):
    """Rows with nulls, ties, repeated rows, shared beginnings and a very long text."""
    rng = random.Random(seed)
    words = ["", None, "Hi.", "what?", "so", " ", "é!", "a b.", "x\ny", "same."]
    rows = []
    for c in [*range(-7, n_convs), 2 ** 62 + 4]:
        if rng.random() < 0.15:
            continue
        n, start = rng.choice([1, 2, 3, 9, 12, longest]), rng.choice([0, 0, 5, -3])
        like = rng.random() < 0.5
        for t in range(n):
            turn = None if rng.random() < 0.05 else start + t + (rng.random() < 0.05)
            role = "user" if t % 2 == 0 else "assistant"
            role = rng.choice([role] * 9 + ["system", None, "tool", "ulf"])
            text = f"t{t}." if like and t < 6 else rng.choice(words)
            rows.append((c, turn, role, text))
            if rng.random() < 0.04:
                rows.append(rows[-1])
    rows.append((3, 1, "user", "long " * 300_000))
    return rows


def brute_trie(sequences):
    """Nodes of {conv: [(role, text)]} by walking every prefix."""
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[tuple(sequences[c][:d])].append(c)
    out = []
    children, below = Counter(), defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]] += 1
        for d in range(len(p) + 1):
            below[p[:d]].append(p)
    for p, m in members.items():
        saved = sum((len(members[q]) - 1) * (len(q[-1][1].encode()) if q else 0) for q in below[p])
        ends = ",".join(str(c) for c in m if len(sequences[c]) == len(p))
        out.append((m[0], len(p), members[p[:-1]][0] if p else None, len(m), children[p], sum(children[q] == 0 for q in below[p]), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = {c: [(r, x) for _, r, x in v] for c, v in in_order(rows).items() if c is not None}
    out = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_against_brute_force(spark, staging, seed):
    rows = sample(seed)
    rows.append((None, 0, "user", "nowhere."))
    got = trie.rebuilt_trie(conversations(spark, rows), staging)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint"] * 7 + ["string"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(rebuilt(rows))


def test_trie_of_many_blocks(spark, staging, monkeypatch):
    monkeypatch.setattr(trie, "RUN", 3)
    rows = [(c, t, "user", f"{t if t < 70 + c else c}") for c in range(4) for t in range(90)] + [(9, 0, "user", "0")]
    got = trie.conversation_trie(conversations(spark, rows), staging)
    want = brute_trie({c: [(r, x) for _, r, x in v] for c, v in in_order(rows).items()})
    assert sorted(map(tuple, got.collect()), key=str) == want


def test_trie_without_rows(spark, staging):
    assert trie.rebuilt_trie(conversations(spark, []), staging).count() == 0
    # Nothing but a conversation whose own turns all go: the root alone.
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    got = trie.rebuilt_trie(conversations(spark, [(c, 0, "user", "a")]), staging).collect()
    assert [tuple(r) for r in got] == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


# ------------------------------------------------------------------ operator 11
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def brute_edits(rows):
    """(cost, audit, repaired) of [(role, text, fault)] by plain relaxation over all arcs, least audits first."""
    best = [{} for _ in range(len(rows) + 1)]
    best[-1] = {"": (0, "", ()), "a": (0, "", ())}
    for i in range(len(rows), -1, -1):
        here = best[i]
        for _ in range(4):                                # inserts lead round in a column
            for q in ("", "s", "u", "a"):
                ways = [here[q]] if q in here else []
                want = "a" if q == "u" else "u"
                full = {"u": "user", "a": "assistant"}[want]
                if want in here:
                    c, s, t = here[want]
                    ways.append((c + 5, "I" + s, ((full, ""), *t)))
                if i < len(rows):
                    role, text, fault = rows[i]
                    after = best[i + 1]
                    c, s, t = after[q]
                    ways.append((c + 2, "D" + s, t))
                    if fault not in ("blank", "duplicate"):
                        more = 5 if fault == "truncated" else 0
                        if (q, role[:1]) in STEP:
                            c, s, t = after[STEP[q, role[:1]]]
                            ways.append((c + more, "K" + s, ((role, text), *t)))
                        c, s, t = after[want]
                        ways.append((c + 1 + more, "R" + s, ((full, text), *t)))
                if ways:
                    here[q] = min(ways, key=lambda w: w[:2])
    return best[0][""]


def brute_repair(rows):
    """The query's rows by conversation."""
    damaged, ids = [], {r[0] for r in rows}
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        a = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if a == 1 else "".join(ch for ch in x if ch not in ".!?") if a == 2 else x
        damaged += [(c, t, "user" if a == 4 else r, x)] * (0 if a == 0 else 2 if a == 3 else 1)
    out = []
    by = in_order(damaged)
    for c in ids:
        v, seen, faults = by.get(c, []), set(), []
        for _, r, x in v:
            body = x.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((r, x))
        turns = [t for t, _, _ in v if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(v, v[1:]))
        cost, audit, fixed = brute_edits([(r, x, f) for (_, r, x), f in zip(v, faults)])
        text = "\n".join(f"{r}:{x}" for r, x in fixed)
        out.append((c, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def code_rows(codes):
    return [({"u": "user", "a": "assistant", "s": "system", "-": "x"}[repair._INITIALS[c & 3]], "t", "blank" if c & repair._DEAD else "truncated" if c & repair.CUT else "")
            for c in codes]


def test_auction_against_relaxation():
    rng = random.Random(5)
    kinds = [0, 1, 2, 3, 4, 5, 6, 7, 8]
    for _ in range(1500):
        codes = bytes(rng.choices(kinds, [6, 6, 1, 1, 2, 2, 1, 1, 2], k=rng.choice([0, 1, 2, 5, 9, 16, 17, 40])))
        assert repair.cheapest_edits(codes) == brute_edits(code_rows(codes))[:2], codes


def test_auction_prices_are_dual_feasible_costs():
    rows = bytes([0, 4, 1, 8, 3, 2, 0, 1])
    prices, traced = repair.auction(rows, (0, None, None, 0), True)
    arcs = repair._arcs(rows, (0, None, None, 0), True)
    cost = {"D": 2, "I": 5, "K": 0, "R": 1, "": 0}
    for q in range(4):          # the traced letters cost what the entry's price says
        node, total = q, 0
        for letter in [*traced[q][0], ""]:
            (head, c), = [(j, c) for x, j, c in arcs[node] if x == letter]
            assert c in (cost[letter], cost[letter] + 5)
            node, total = head, total + c
        assert node == len(arcs) and total == prices[q]


def test_a_long_conversation_is_linear():
    codes = bytes(random.Random(1).choices([0, 1, 2, 3, 4, 8], [8, 8, 1, 1, 2, 2], k=20_000))
    cost, audit = repair.cheapest_edits(codes)
    assert cost > 0 and sum(x != "I" for x in audit) == len(codes)


@pytest.mark.parametrize("seed", [3, 4])
def test_repair_against_brute_force(spark, staging, seed):
    rows = sample(seed, 60) + [(None, t, r, "a." + str(t)) for t, r in enumerate(["user", None, "assistant"])] + [(None, None, None, None)]
    got = repair.damaged_and_repaired(conversations(spark, rows), staging)
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["bigint"] * 7 + ["string"] * 2
    assert sorted(map(tuple, got.collect()), key=str) == brute_repair(rows)


def test_repaired_turns_are_legal(spark, staging):
    rows = sample(8)
    out = repair.repaired_turns(conversations(spark, rows), staging).collect()
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: (r["conv_id"], r["place"])):
        got[r["conv_id"]].append((r["role"], r["text"]))
    for c, v in in_order(rows).items():
        seen, coded = set(), []
        for _, r, x in [(t, r or " ", x or " ") for t, r, x in v]:
            body = x.strip(" \t\n\x0b\x0c\r")
            coded.append((r, x, "blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else ""))
            seen.add((r, x))
        assert tuple(got[c]) == brute_edits(coded)[2]


def test_repair_without_rows(spark, staging):
    assert repair.damaged_and_repaired(conversations(spark, []), staging).count() == 0
    t = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = repair.damaged_and_repaired(conversations(spark, [(1, t, "user", "a")]), staging).collect()
    assert [tuple(r) for r in got] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    extreme = [(1, -2 ** 63, "user", "a."), (1, 2 ** 63 - 1, "assistant", "b.")]
    (row,) = repair.repair(conversations(spark, extreme), staging).collect()
    assert row["gaps"] == 2 ** 63 - 1 and row["audit"] == "KK"
