"""Operator 12."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from adtrail.llm import disclosure
from llm.conftest import EDGE_TEXTS, LONG, documents

PIECES = ["a@b.c", "x.y+z@mail-1.example.com", "@", "a@b", ".c", "@d.e.", "_%", "1.2.3.4", "255.255.255.256", "0001.02.3.4", "1.2.3.4.5.6.7.8", "9" * 20, ".", "4041894974608795",
          "4111 1111 1111 1111", "4111-1111-1111-1112", "5", "  ", "+1 (988) 555-2485", "+49 30 1234", "+", "(", ")", "-", "\n", "é", "\U0001f642", "word"]
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_entities(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            ok = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                  "card": 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0, "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PIECES), st.text("a@.1+ -", max_size=4)), max_size=10))
def test_entities_against_the_patterns(pieces):
    text = "".join(pieces)
    assert disclosure.entities(text) == brute_entities(text)


def test_long_runs_take_linear_time():
    n = 400_000
    for text in ("a" * n, "1" * n, "1." * n, "1 " * n, "+1" + "(" * n, "a@" * n, "@a.b" * (n // 4), "+" * n, "1-" * n):
        disclosure.entities(text)


def words(text):
    return [(m.group().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), *m.span())
            for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]


def word_class(w):
    return "number" if re.fullmatch("[0-9]+", w) else "code" if re.search("[0-9]", w) else "word"


def value(kind, text):
    return kind, re.sub("[^0-9]", "", text) if kind in ("card", "phone") else text.lower()


def brute_data(texts, share, support):
    """(per text: base, term spans with what becomes of them) from plain counts."""
    n_term, total, near = Counter(), 0, defaultdict(set)
    split = []
    for text in texts:
        w = words(text)
        blocks = [w[i:i + disclosure.CONTEXT] for i in range(0, len(w), disclosure.CONTEXT)]
        total += len(blocks)
        for b in blocks:
            n_term.update({x for x, _, _ in b} | {("class", word_class(x)) for x, _, _ in b})
        found = brute_entities(text)
        free = [x for x in w if not any(x[1] < b and a < x[2] for _, a, b in found)]
        here = []
        for kind, a, b in found:
            at = next(i for i, x in enumerate(w) if x[2] > a) // disclosure.CONTEXT
            block = blocks[at]
            members = [x for x in block if x in free]
            terms = {x for x, _, _ in members} | {("class", word_class(x)) for x, _, _ in members}
            near[value(kind, text[a:b])].add((text[block[0][1]:block[-1][2]], frozenset(terms)))
            here.append((value(kind, text[a:b]), {x for x, _, _ in members}))
        split.append((found, free, here))
    told = set()
    for e, contexts in near.items():
        both = Counter(t for _, ts in contexts for t in ts)
        for t, n in both.items():
            alone = total / len(contexts)
            if n >= support and math.log(n * alone / n_term[t]) / math.log(max(alone, 1 + 1e-9)) >= share:
                told.add((e, t))
    out = []
    for found, free, here in split:
        spans = {}
        for e, terms in here:
            for x, a, b in free:
                if x in terms and (e, x) in told:
                    spans[a, b] = spans.get((a, b), True) and (e, ("class", word_class(x))) not in told
        out.append((found, sorted((a, b, g) for (a, b), g in spans.items())))
    return out


def corpus(seed):
    """Texts in which a name stands by one address, a place by another, in new words each time."""
    rng = random.Random(seed)
    filler = [f"{c}{v}{d}" for c in "bdfgklm" for v in "aeiou" for d in ("", "n", "st")]
    texts = [t for _, t, *_ in EDGE_TEXTS if t and len(t) < 5000]
    for i in range(260):
        w = rng.choices(filler, k=rng.choice([3, 20, 60]))
        if i % 4 == 0:
            w[1:1] = ["Contact", "Zaphod", "zaphod@heart.example.org,", "or"]
        if i % 9 == 0:
            w[0:0] = ["call", "+1 (988) 555-2485", "in", "Elbonia42,"]
        if i % 20 == 0:
            w += ["from", "10.20.30.40", "nothing"]
        texts.append(" ".join(w))
    texts += ["same passage with Trillian trillian@heart.example.org in it"] * 30      # one context, however often
    return texts


def test_spans_against_brute_force(spark, staging):
    texts = corpus(3)
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)] + [(9000, None, None, None), (None, "a@b.c", None, None)])
    got = {r["doc_id"]: r for r in disclosure.personal_data(docs, staging).collect()}
    assert got[9000]["spans"] == "" and got[9000]["base_sha256"] == hashlib.sha256(b"").hexdigest() and got[None]["spans"] == "email:0:5"
    want = brute_data([*texts, "a@b.c"], disclosure.SHARE, disclosure.SUPPORT)
    seen = set()
    for i, text in enumerate(texts):
        found, terms = want[i]
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        every = ",".join(x for x in (base, ",".join(f"term:{a}:{b}" for a, b, _ in terms)) if x)
        assert (got[i]["base_sha256"], got[i]["spans"]) == (hashlib.sha256(base.encode()).hexdigest(), every)
        assert [got[i][f"n_{k}"] for k in disclosure.KINDS] == [sum(k == f[0] for f in found) for k in disclosure.KINDS]
        assert got[i]["n_terms"] == len(terms)
        seen |= {text[a:b] for a, b, _ in terms}
    assert {"Zaphod", "Elbonia42"} <= seen and "Trillian" not in seen and not seen & {"ba", "dan"}


def test_sanitised_texts(spark, staging):
    texts = corpus(4)
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)] + [(9000, None, None, None)])
    out = disclosure.sanitised(docs, staging)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    want = brute_data(texts, disclosure.SHARE, disclosure.SUPPORT)
    assert got[9000] is None
    for i, text in enumerate(texts):
        found, terms = want[i]
        edits = [{"start": a, "stop": b, "becomes": k} for k, a, b in found]
        edits += [{"start": a, "stop": b, "becomes": word_class(words(text[a:b])[0][0]) if g else None} for a, b, g in terms]
        assert got[i] == disclosure.apply_edits(text, sorted(edits, key=lambda e: (e["start"], e["stop"])))
    assert "[email]" in got[len(texts) - 1] and any("[word] [email]" in t for t in got.values() if t)


def test_edits_do_not_overlap():
    e = [{"start": 1, "stop": 4, "becomes": "ip"}, {"start": 2, "stop": 6, "becomes": None}, {"start": 6, "stop": 7, "becomes": None}]
    assert disclosure.apply_edits("a123456b", e) == "a[ip]b"


def test_edge_rows(spark, edge, empty, staging):
    out = disclosure.personal_data(edge, staging).collect()
    assert sorted((r["doc_id"] or -1) for r in out) == sorted((i or -1) for i, *_ in EDGE_TEXTS)
    assert all(r["spans"] == "" and r["n_terms"] == 0 for r in out)
    assert disclosure.personal_data(empty, staging).count() == 0 and disclosure.sanitised(empty, staging).count() == 0
    long = LONG + " me@here.example.org " + LONG
    (row,) = disclosure.personal_data(documents(spark, [(1, long, None, None)]), staging).collect()
    assert row["spans"] == f"email:{len(LONG) + 1}:{len(LONG) + 20}"
