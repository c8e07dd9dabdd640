"""Operators 2 and 3 against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adtrail.llm import id_codec, token_automaton
from adtrail.llm.queries import END_ID, tokenizer_path

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


TEXT = st.text(st.sampled_from(list("abdelmrstvw' 09!?<|>endoftx\t\n\x0b\x0c\r\x1c\x85 éÀ́ßİΣ中\U0001f642½\x00")), max_size=30)


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_words_encode_as_the_library_does(text):
    lib = Tokenizer.from_file(PATH)if not hasattr(test_words_encode_as_the_library_does, "t") else test_words_encode_as_the_library_does.t
    test_words_encode_as_the_library_does.t = lib
    want = lib.encode(text, add_special_tokens=False).ids
    codec = token_automaton.codec(PATH)
    got = np.frombuffer(codec.encode(text.encode()), "<u4").tolist()
    assert got == want
    assert " ".join(codec.automaton.decode(got)) == lib.decode(want, skip_special_tokens=False)
    assert np.frombuffer(id_codec.encoder(PATH)(text.encode()), "<u4").tolist() == want


def plain_bpe(symbols, merges):
    """Merges applied one after the other, each from the left."""
    word = list(symbols)
    for u, v in merges:
        out = []
        for s in word:
            if out and out[-1] == u and s == v:
                out[-1] = None
                out[-1] = (u, v)
            else:
                out.append(s)
        word = ["".join(s) if isinstance(s, tuple) else s for s in out]
    return word


def test_automaton_accepts_exactly_what_merging_gives():
    rng = random.Random(5)
    for _ in range(40):
        vocabulary, merges = {s: i for i, s in enumerate("abc")}, []
        while len(merges) < 12:
            u, v = rng.choice(list(vocabulary)), rng.choice(list(vocabulary))
            if u + v not in vocabulary and len(u + v) < 7:
                vocabulary[u + v] = len(vocabulary)
                merges.append((u, v))
        a = token_automaton.TokenAutomaton(vocabulary, merges)
        a.link(list(vocabulary.values()))
        for _ in range(60):
            word = tuple(rng.choice("abc") for _ in range(rng.randint(1, 9)))
            want = plain_bpe(word, merges)
            got = [a.labels[i] for i in a.encode(word)]
            assert got == want, (word, merges)
            assert all(a.has_arc(vocabulary[x], vocabulary[y]) for x, y in zip(want, want[1:]))


def test_encode_decode_rows(spark, edge, empty, library):
    out = token_automaton.encode_decode(edge, PATH).collect()
    want = []
    for r in edge.collect():
        ids = ids_of(library, r["text"])
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    key = lambda t: (t[0] is None, t)
    assert sorted(map(tuple, out), key=repr) == sorted(want, key=repr)
    assert token_automaton.encode_decode(empty, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 400) | st.integers(0, id_codec.MAX_ID), max_size=300), st.integers(1, 40))
def test_segments_round_trip(ids, block):
    assert id_codec.unpack(id_codec.pack(np.array(ids, dtype="<u4"), block)).tolist() == ids


def test_blocks_are_checked_and_independent():
    rng = np.random.default_rng(3)
    ids = rng.zipf(1.3, 9000).clip(0, 49_000).astype("<u4")
    data = id_codec.pack(ids, 1000)
    assert len(data) < 2 * len(ids)
    for at in range(40, len(data), 997):
        bad = bytearray(data)
        bad[at] ^= 0x10
        with pytest.raises(ValueError):
            id_codec.unpack(bytes(bad))
    with pytest.raises(ValueError):
        id_codec.pack(np.array([id_codec.MAX_ID + 1], dtype="<u4"))
    first = id_codec.unpack(id_codec.pack(ids[:1000], 1000))
    assert (first == ids[:1000]).all()


def test_repeating_ids_become_cheap():
    assert len(id_codec.pack(np.tile(np.arange(50, dtype="<u4"), 400))) < 3000


def test_files_are_smaller_than_order0_and_zlib(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").limit(400).collect()
    texts = pa.array([r["text"] for r in rows], pa.string())
    ids, sizes = id_codec.encoder(PATH).encode(texts, np.array([END_ID], "<u4"))
    assert sizes.sum() == len(ids) and len(sizes) == len(rows)
    share = np.bincount(ids)[np.unique(ids)] / len(ids)
    data = id_codec.pack(ids)
    assert (id_codec.unpack(data) == ids).all()
    assert 8 * len(data) < len(ids) * -(share * np.log2(share)).sum()
    assert len(data) < len(zlib.compress(ids.astype("<u2").tobytes()))


@pytest.mark.parametrize("bound", [3, id_codec.TABLE_WORDS])
def test_chunks_of_texts_encode_as_the_library_does(library, monkeypatch, bound):
    monkeypatch.setattr(id_codec, "TABLE_WORDS", bound)
    enc = id_codec.LibraryEncoder(PATH)
    rng = random.Random(2)
    words = ["the", "The", "it's", "<|endoftext|>", "\x01", "a\x01b", "É", "e\u0301", "x9", "中文", "\x1c", "\x85", *"abcdefg"]
    for _ in range(4):
        texts = [None, "", " ", *(rng.choice([" ", "\n", "\t "]).join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(20))]
        ids, sizes = enc.encode(pa.array(texts, pa.string()).slice(1), np.array([END_ID], "<u4"))
        want = [[*ids_of(library, t), END_ID] for t in texts[1:]]
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])
    assert len(enc.words) <= max(bound, 2 * len(words))


def test_new_words_go_to_the_library_together(monkeypatch):
    enc, calls = id_codec.LibraryEncoder(PATH), []
    plain = enc._ids
    monkeypatch.setattr(enc, "_ids", lambda text: calls.append(text) or plain(text))
    enc.encode(pa.array([f"w{i} word{i}" for i in range(1000)] * 2), np.zeros(0, "<u4"))
    assert len(calls) == 2000 // id_codec.JOINED


def test_files_give_ids_back(spark, edge, empty, staging, library):
    out = id_codec.write_and_read(edge, PATH, END_ID, staging, with_ids=True).collect()
    rows = sorted(edge.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))
    start, want = 0, []
    for r in rows:
        ids = [*ids_of(library, r["text"]), END_ID]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert sorted((tuple(r) for r in out), key=lambda r: r[1]) == want
    assert id_codec.write_and_read(empty, PATH, END_ID, staging).count() == 0


def test_documents_never_straddle_segments(spark, edge, staging):
    small = id_codec.encode_segments(edge, PATH, END_ID, segment_ids=50)
    rows = small.collect()
    assert len(rows) > 5 and all(sum(r["lengths"]) == r["n_ids"] for r in rows)
