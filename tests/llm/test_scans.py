"""Operators 7, 8 and 10."""

import re
from collections import Counter
from fractions import Fraction
from math import comb

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtrail.llm import licenses, pivot_search, quality_rules, queries, sql
from conftest import SMOKE
from llm.conftest import documents

PIECES = ["MIT License", "mit  license", "the MIT-license", "Apache License, Version 2.0", "GNU General Public License", "lesser general public license",
          "license mit", "mit mit license", "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0\n",
          "SPDX-License-Identifier: MIT OR\n", "spdx-license-identifier bsd-3-clause\n", "general publić license", "été", "1mit license2", "\n", "public domain"]


def license_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=8), st.sampled_from([" ", "_", ". "]))
def test_places_against_brute_force(pieces, joint):
    text = joint.join(pieces)
    words = license_words(text)
    places = [(label, i) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    row = licenses.scan(text.encode(), licenses.WordAutomaton(licenses.PHRASES))
    starts = [i for _, i in places]
    assert row[:5] == (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({a for a, _ in places})))
    extra = {label for phrase, label in licenses.NOTICES.items() for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()}
    # Labels beyond the phrases' are those of the tags: all of one tag's licences.
    tags = set(row[5].split(",")) - {""} - {a for a, _ in places} - extra
    assert {a for a, _ in places} | extra <= set(row[5].split(",")) | {""}
    assert tags <= set().union(*(re.split(r"[|+]", row[8]),)) and bool(row[8]) == (row[9] is not None)
    assert 0 <= row[7] <= 1


def test_expressions():
    e = licenses.evaluate
    for text, choices, known in [
            ("MIT", "mit", True), ("MIT OR GPL-2.0", "gpl|mit", True), ("MIT AND GPL-2.0", "gpl+mit", True),
            ("MIT OR Apache-2.0 AND BSD-2-Clause", "apache+bsd|mit", True), ("(MIT OR Apache-2.0) AND BSD-2-Clause", "apache+bsd|bsd+mit", True),
            ("(MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0", "apache+gpl|gpl+mit", True),
            ("CC-BY-SA-4.0", "cc-by-sa", True), ("gpl-2.0+", "gpl", True), ("MIT OR MIT AND Zlib", "mit", True),
            ("MIT AND No-Such-1.0", "mit", False), ("No-Such-1.0 OR Apache-2.0", "apache", False), ("no-such-licence", "", False),
            ("MIT and this is prose", "mit", True), ("MIT then prose", "mit", True), ("MIT and others", "mit", False)]:
        assert (str(e(text)), e(text).all_known) == (choices, known), text
    assert e("MIT OR (MIT AND GPL-2.0)").named == {"mit", "gpl"}
    for bad in ("", "MIT OR", "OR MIT", "(MIT", "MIT)", "MIT WITH", "()", ")("):
        assert e(bad) is None, bad
    wide = " and ".join(f"({a} or {b})" for a, b in zip(list(licenses.IDENTIFIERS)[::2], list(licenses.IDENTIFIERS)[1::2]))
    assert e(wide).alternatives is None and len(e(wide).named) > 40


NAMES = ["mit", "apache", "gpl", "bsd", "zlib"]
trees = st.recursive(st.sampled_from(NAMES), lambda t: st.tuples(st.sampled_from(["or", "and"]), t, t), max_leaves=8)


def written(t, above=0):
    if isinstance(t, str):
        return t
    rank = {"or": 1, "and": 2}[t[0]]
    text = f"{written(t[1], rank)} {t[0]} {written(t[2], rank)}"
    return f"({text})" if rank < above else text


def holds(t, have):
    return t in have if isinstance(t, str) else (any if t[0] == "or" else all)(holds(x, have) for x in t[1:])


@settings(max_examples=150, deadline=None)
@given(trees)
def test_alternatives_hold_where_the_expression_does(tree):
    """Brute force: a set of licences meets the expression if and only if it holds an alternative."""
    value = licenses.evaluate(written(tree))
    for bits in range(1 << len(NAMES)):
        have = {n for i, n in enumerate(NAMES) if bits >> i & 1}
        assert any(a <= have for a in value.alternatives) == holds(tree, have)


def test_license_rows(spark, edge, empty):
    docs = documents(spark, [(1, "Released under the MIT License. SPDX-License-Identifier: Apache-2.0", None, None), (2, None, None, None)])
    out = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert out[1]["labels"] == "apache,mit" and out[1]["base_labels"] == "mit" and out[1]["first_word"] == 3 and out[1]["score"] > 0.9
    assert tuple(out[2])[1:] == (0, 0, None, None, "", "", "", 0.0, "", None)
    texts = {3: "SPDX-License-Identifier: MIT OR GPL-2.0\n", 4: "spdx license_identifier = MIT AND GPL-2.0", 5: "SPDX-License-Identifier: MIT AND Odd-1\n",
             6: "notSPDX-License-Identifier: MIT", 7: "SPDX-License-Identifier: see the file", 8: "SPDX-License-Identifier: MIT\n" + "word " * 300_000}
    tagged = licenses.scan_licenses(documents(spark, [(i, t, None, None) for i, t in texts.items()])).collect()
    got = {r["doc_id"]: (r["labels"], r["alternatives"], r["all_known"], r["score"]) for r in tagged}
    assert got == {3: ("gpl,mit", "gpl|mit", True, 0.95), 4: ("gpl,mit", "gpl+mit", True, 0.95), 5: ("mit", "mit", False, 0.8),
                   6: ("", "", None, 0.0), 7: ("", "", None, 0.0), 8: ("mit", "mit", True, 0.95)}
    assert {r["doc_id"]: r["n_words"] for r in tagged}[8] == 300_004
    assert licenses.scan_licenses(edge).count() == edge.count() and licenses.scan_licenses(empty).count() == 0


def base_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    g = Counter(zip(w, w[1:], w[2:]))
    covered = {i + j for i in range(len(w) - 2) if g[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_base_counts(spark, edge, empty, staging):
    out = quality_rules.quality_rules(edge, labels(spark, []), staging).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in out)
    assert got == Counter((r["doc_id"], *base_counts(r["text"])) for r in edge.collect())
    assert all(r["kept"] == (not r["base_failed"]) for r in out)        # no labels, no cutoffs
    assert quality_rules.quality_rules(empty, labels(spark, [(1, 1, 0)]), staging).count() == 0


def exact_cdf(k, n, p):
    p = Fraction(p).limit_denominator(10**6)
    return float(sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)))


def test_binomial_bound_is_exact(spark):
    cases = [(k, n) for n in (1, 5, 40, 300, 2000) for k in (0, 1, 2, 5, 30) if k <= n]
    df = spark.createDataFrame(cases, "k long, n long").withColumn("p", quality_rules.binomial_cdf("k", "n", 0.02))
    for r in df.collect():
        want = exact_cdf(r["k"], r["n"], 0.02)
        assert r["p"] == 1.0 if r["k"] >= r["n"] * 0.02 else r["p"] == pytest.approx(want, rel=1e-9)


def test_cutoffs_are_the_strictest_that_pass(spark):
    rng = np.random.default_rng(2)
    rows = [(s, *[int(v) for v in rng.integers(0, 400, len(quality_rules.RULES))]) for s, n in (("=en", 6000), ("=de", 1500), ("=xx", 20)) for _ in range(n)]
    good = spark.createDataFrame(rows, "stratum string, " + ", ".join(f"{r} int" for r in quality_rules.RULES))
    got = {r["stratum"]: r for r in quality_rules.fit_cutoffs(good, 0.02, 0.05).collect()}
    level = 0.05 / (3 * len(quality_rules.RULES))
    for s in ("=en", "=de", "=xx"):
        for j, rule in enumerate(quality_rules.RULES):
            values = sorted(r[j + 1] for r in rows if r[0] == s)
            q = 0.02 / len(quality_rules.RULES)
            ok = [c for c in set(values) if (k := sum(v > c for v in values)) < len(values) * q and exact_cdf(k, len(values), q) <= level]
            assert (got[s][f"max_{rule}"] if s in got else None) == min(ok, default=None)


def test_rules_reject_junk_and_keep_clean(spark, staging):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghij"), rng.integers(2, 9)))
    rows, marks = [], []
    for i in range(3000):
        bad = i % 25 == 24
        rows.append((i, " ".join(word() + ("$$$" if bad else "") for _ in range(60)), "en", "s"))
        marks.append((i, 0 if bad else 1, 0))
    docs = documents(spark, rows)
    out = quality_rules.quality_rules(docs, labels(spark, marks), staging).collect()
    assert not any(r["kept"] for r in out if r["doc_id"] % 25 == 24)
    assert np.mean([r["kept"] for r in out if r["doc_id"] % 25 != 24]) >= 1 - quality_rules.ALPHA
    kept = quality_rules.keep_good(docs, labels(spark, marks), staging)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in out if r["kept"]}


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, rank int")


def plain_top(rows, k=5, every=50):
    good = [(i, np.floor(np.array(x, dtype=np.float32).astype(np.float64) * 256).astype(object)) for i, x, *_ in rows
            if x is not None and not any(c is None or not np.isfinite(c) for c in x)]
    out = []
    for a, (q, v) in enumerate(good):
        if q is None or q % every:
            continue
        found = sorted((-sum(int(x) * int(y) for x, y in zip(v, w)), i is None, i or 0, i) for b, (i, w) in enumerate(good) if a != b and len(v) == len(w))
        out += [(q, n + 1, f[3], -f[0]) for n, f in enumerate(found[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("tile_rows", [7, 2048])
def test_top_k_against_brute_force(spark, staging, tile_rows):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.2, 1, 3])).tolist(), 1, 1) for i in range(400)]
    rows += [(1000 + i, [0.5] * 8, 1, 1) for i in range(60)]                      # ties
    rows += [(2000, [1.0, 2.0], 1, 1), (2050, [1.0, -2.0], 1, 1), (2100, [3.0], 1, 1), (2150, [], 1, 1)]
    rows += [(2200, None, 1, 1), (2250, [None, 1.0], 1, 1), (2300, [float("nan")] * 8, 1, 1), (2350, [float("inf")] * 8, 1, 1), (None, [0.4] * 8, 1, 1)]
    rows += [rows[0], rows[0], (50, [9.0] * 8, 1, 1)]                             # repeated rows and ids
    got = pivot_search.top_k(vectors(spark, rows).repartition(3), staging, pivots=5, tile_rows=tile_rows)
    assert sorted(map(tuple, got.select("query_id", "rank", "vec_id", "score").collect()), key=repr) == plain_top(rows)


def test_far_tiles_are_not_visited(spark, staging):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(6, 4)) * 40
    rows = [(i, (centres[i % 6] + rng.normal(size=4) * 0.01).tolist(), 0, 0) for i in range(3000)]
    table = vectors(spark, rows)
    v = pivot_search.integer_vectors(table, staging)
    space = pivot_search.choose_pivots(np.array([r["v"] for r in v.collect()]), max(r["norm2"] for r in v.collect()), 6)
    assert len(space.pivots) == 6
    got = pivot_search.top_k(table, staging, pivots=6, tile_rows=50)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_top(rows)


def test_no_vectors(spark, staging):
    assert pivot_search.top_k(vectors(spark, []), staging).count() == 0


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    rel = con.sql(sql.ORACLE[name])
    df = queries.QUERIES[name](spark, SMOKE)
    assert sorted(df.columns) == sorted(rel.columns)
    got = sorted(map(tuple, df.select(*rel.columns).collect()), key=repr)
    assert got == sorted(rel.fetchall(), key=repr)
