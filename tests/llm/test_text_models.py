"""Operators 1, 4 and 9."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adtrail.llm import bit_mixing, importance, language_id, queries
from adtrail.llm import words as W
from conftest import SF01
from llm.conftest import documents

LANGS = {"en": ["the", "of", "and", "thing", "where", "with"], "de": ["der", "und", "nicht", "straße", "über", "ich"],
         "fr": ["le", "où", "été", "avec", "dans", "être"]}


def texts_in(lang, rng, n):
    return " ".join(rng.choice(LANGS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def speech(spark):
    rng = random.Random(8)
    rows = []
    for i in range(240):
        lang = rng.choice(list(LANGS))
        rows.append((i, texts_in(lang, rng, rng.randint(2, 60)), lang, "s"))
    return documents(spark, rows).cache()


def test_language_accuracy_on_held_out(speech):
    out = language_id.language_id(speech).collect()
    truth = {r["doc_id"]: r["lang"] for r in speech.collect()}
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_of_sf001_held_out(spark):
    out = queries.op4_language_id(spark, SF01)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang")
    right = out.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert out.filter("rejected").count() <= 0.02 * out.count()


def test_language_prediction_ignores_labels(speech):
    model = language_id.train(speech)
    a = language_id.predict(speech, model)
    b = language_id.predict(speech.withColumns({"lang": F.lit("zz"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 5}), model)
    assert [r["lang_pred"] for r in a.collect()] == [r["lang_pred"] for r in b.collect()]


def test_language_edges(spark, edge, empty, speech):
    model = language_id.train(speech)
    got = {(r["row"]["doc_id"], r["row"]["text"]): r for r in language_id.predict(edge, model).collect()}
    for (_, text), r in got.items():
        letter = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] == "und") == (not letter)
        assert letter or (r["score"] == 0 and r["rejected"])
    assert {r["lang_pred"] for r in language_id.predict(edge, language_id.train(empty)).collect()} == {"und"}
    kept = language_id.keep_known(edge)
    assert kept.columns == edge.columns and kept.count() > 0
    assert language_id.language_id(empty).count() == 0


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) + [None]


def brute_base(rows, train):
    c = Counter(t for r in rows if train(r) for t in tokens_of(r["text"]))
    n, v = sum(c.values()), len(c)
    return n, {i: (len(tokens_of(r["text"])), sum(c[t] > 0 for t in tokens_of(r["text"])),
                   sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens_of(r["text"]))) for i, r in enumerate(rows)}


@pytest.mark.parametrize("vocabulary", [1 << 18, 40])
def test_base_scores(spark, speech, edge, staging, monkeypatch, vocabulary):
    monkeypatch.setattr(bit_mixing, "VOCABULARY", vocabulary)
    docs = speech.unionByName(edge)
    held = lambda d: F.coalesce(language_id.fold(d["doc_id"], 5) == 1, F.lit(False))
    out = bit_mixing.score(docs, lambda d: ~held(d), staging).collect()
    rows = docs.collect()
    n, want = brute_base(rows, lambda r: r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1)
    key = lambda t: (repr(t[0]), t[1], round(t[3], 6))
    got = sorted([(r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in out], key=key)
    exp = sorted([(rows[i]["doc_id"], *w) for i, w in want.items()], key=key)
    for a, b in zip(got, exp, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9)
    assert {r["train_tokens"] for r in out} == {n}
    assert all(r["score"] < 0 and r["bits_per_byte"] >= 0 for r in out)


def test_mixing_learns_more_than_unigrams(spark, staging):
    rows = [(i, "one two three four five six seven eight nine ten " * 6, None, None) for i in range(60)]
    held = lambda d: language_id.fold(d["doc_id"], 5) == 1
    out = bit_mixing.score(documents(spark, rows), lambda d: ~held(d), staging).collect()
    assert all(r["score"] > 0.5 * r["base_score"] for r in out)


def test_scores_of_an_empty_table(empty, staging):
    assert bit_mixing.score(empty, lambda d: F.lit(True), staging).count() == 0


def test_huffman_is_a_complete_prefix_code():
    code, length = bit_mixing.huffman(np.array([5, 1, 1, 9, 30, 2, 2]))
    words = [format(c, f"0{n}b") for c, n in zip(code.tolist(), length.tolist())]
    assert sum(2.0 ** -len(w) for w in words) == 1
    assert not any(a != b and b.startswith(a) for a in words for b in words)


def test_bits_spell_the_text():
    names = W.hashes(np.frombuffer(b"ab", np.uint8), np.array([0]), np.array([2]))
    code = bit_mixing.make_code(names.view(np.int64), np.array([10]), 20, 3, np.arange(1, 258))
    t = next(W.texts(pa.array(["ab Zz ab", "", "q"])))
    b = bit_mixing.bits_of(t, code)
    words = {format(c, f"0{n}b"): i for i, (c, n) in enumerate(zip(*[x.tolist() for x in code.word]))}
    chars = {format(c, f"0{n}b"): i for i, (c, n) in enumerate(zip(*[x.tolist() for x in code.byte]))}
    out = []
    for lo, hi in zip(b.first[:-1], b.first[1:]):
        now, table, row, word = "", words, [], b""
        for bit in b.bit[lo:hi]:
            now += str(bit)
            if now in table:
                s, now = table[now], ""
                if table is chars:
                    if s == 256:
                        row.append(word)
                        table, word = words, b""
                    else:
                        word += bytes([s])
                elif s == 0:
                    table = chars
                else:
                    row.append(s)
        assert now == "" and table is words
        out.append(row)
    assert out == [[2, b"zz", 2, 1], [1], [b"q", 1]]


def test_probabilities_sum_to_one_over_all_texts_of_a_tiny_code():
    # Without counts every bit is even; two equal long texts then cost the same.
    code = bit_mixing.make_code(np.zeros(0, np.int64), np.zeros(0, np.int64), 1, 1, np.ones(257, np.int64))
    t = next(W.texts(pa.array(["abc", "abd"])))
    b = bit_mixing.bits_of(t, code)
    tables = bit_mixing.make_tables([np.zeros((1 << n, 2)) for n in bit_mixing.TABLE_BITS])
    score = bit_mixing.score_bits(b, tables)
    assert score == pytest.approx(-np.diff(b.first) * math.log10(2))


def test_importance_against_brute_force(spark, speech, staging):
    target = speech.filter("lang = 'en'")
    out = importance.resample(speech, target, staging, keep_share=0.3).collect()
    rows = speech.collect()

    def grams(text):
        w = text.lower().split()
        return Counter([(a,) for a in w] + list(zip(w, w[1:])))

    raw = sum((grams(r["text"]) for r in rows), Counter())
    goal = sum((grams(r["text"]) for r in rows if r["lang"] == "en"), Counter())
    a, size = importance.SMOOTHING, importance.BUCKETS
    ratio = {g: math.log((goal[g] + a) / (sum(goal.values()) + a * size)) - math.log((raw[g] + a) / (sum(raw.values()) + a * size)) for g in raw}
    got = {r["doc_id"]: r for r in out}
    for r in rows:
        g = grams(r["text"])
        want = importance.STRENGTH * sum(ratio[x] * n for x, n in g.items()) / sum(g.values())
        assert got[r["doc_id"]]["log_weight"] == pytest.approx(want, abs=0.6)     # few buckets are shared
    ranked = sorted(out, key=lambda r: -(r["log_weight"] + r["noise"]))
    k = math.ceil(0.3 * len(rows))
    assert {r["doc_id"] for r in out if r["kept"]} == {r["doc_id"] for r in ranked[:k]}
    assert np.mean([r["lang"] == "en" for r in rows if got[r["doc_id"]]["kept"]]) > 0.8


def test_importance_edges(spark, edge, empty, staging):
    out = importance.resample(edge, empty, staging).collect()
    assert len(out) == edge.count()
    assert not any(r["kept"] for r in out if not r["n_grams"])
    assert importance.resample(empty, empty, staging).count() == 0


def test_kth_largest_with_ties(spark):
    values = [1.0] * 50 + [2.0] * 30 + [float(i) for i in range(40)] + [math.nextafter(2.0, 3.0)]
    df = spark.createDataFrame([(v,) for v in values], "v double").cache()
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 38, 39, 40, 70, 71, len(values)):
        x, above = importance.kth_largest(df, "v", k)
        assert x == ordered[k - 1] and above == sum(v > x for v in values)
