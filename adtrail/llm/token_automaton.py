"""Operator 3: byte-pair encoding and decoding by a tokenisation automaton.

The automaton accepts exactly the token sequences that byte-pair encoding can
produce.  It starts as one state that loops on every base symbol.  Each merge
``(u, v) -> c``, in order, applies a *merge gadget*: the arcs labelled ``u``
are led to a copy of their target that has lost its ``v`` arc, and wherever a
``u`` arc stands, an arc ``c`` is added that leads where ``u`` then ``v`` led.
All arcs with one label end in one state, so a state is named by the label
that enters it.  (Where ``v`` never follows ``u``, a gadget changes nothing.)
The copies are not written out (tens of thousands of states
by as many arcs): a state keeps the arcs that *it* lost, with the number of
the gadget, and shares everything older with the state it was copied from
(that of ``v``, for a token ``c``).  An arc is looked up along these two short
chains once and then stands in a transition table.

Because the automaton is deterministic, a word has one accepting path.  The
encoder follows table transitions over a trie of the arc labels, longest arc
first, and remembers positions from which no path leads to the end.  Decoding
walks the ids and emits the arc labels.

Defined results: null text = empty text = no ids, empty decoded text.  Repeated
rows give repeated results; other columns are ignored.  Ids outside the
vocabulary emit nothing, as the tokenizers library does.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from adtrail.llm.words import WordTable, release_memory

_NEVER = 1 << 60
TRANSITIONS = 1 << 18      # looked-up transitions kept per Python worker (about 40 MB)


class TokenAutomaton:
    """Tokenisation automaton of an ordered merge list over base symbols."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        self.ids = vocabulary
        size = max(vocabulary.values(), default=-1) + 1
        self.labels: list[str | None] = [None] * size
        for label, i in vocabulary.items():
            self.labels[i] = label
        self.born = [-1] * size               # gadget that added the token's arcs
        self.left = [-1] * size
        self.right = [-1] * size
        self.lost: dict[tuple[int, int], int] = {}   # (state, arc) -> gadget that removed it
        self.table: dict[tuple[int, int], bool] = {}  # transitions looked up so far
        self.trie: dict = {}
        self.made = {u + v for u, v in merges}
        self.idle: set[int] = set()           # labels whose gadget found no place
        for number, (u, v) in enumerate(merges):
            self._add_gadget(number, vocabulary[u], vocabulary[v], vocabulary[u + v])

    def _add_gadget(self, number: int, u: int, v: int, c: int) -> None:
        if self.born[c] >= 0:
            raise ValueError(f"merge {number} makes a label that an earlier one made")
        if not (self._stands(u) and self._stands(v) and self._arc(u, v)):
            self.idle.add(c)              # v never follows u here: nothing to lead elsewhere
            return
        self.lost[u, v] = number
        self.born[c], self.left[c], self.right[c] = number, u, v

    def _stands(self, token: int) -> bool:
        return self.born[token] >= 0 or self.labels[token] not in self.made

    def link(self, tokens: list[int]) -> None:
        """Enter these tokens' labels (as symbol sequences) into the trie."""
        for i in tokens:
            if i in self.idle:
                continue
            node = self.trie
            for s in symbols(self.labels[i]):
                node = node.setdefault(s, {})
            node[None] = i

    def has_arc(self, p: int, c: int) -> bool:
        """Is there an arc ``c`` from the state that ``p`` leads to?"""
        known = self.table.get((p, c))
        if known is None:
            if len(self.table) >= TRANSITIONS:
                self.table.clear()
            known = self.table[p, c] = self._arc(p, c)
        return known

    def _arc(self, p: int, c: int) -> bool:
        # State of p: its own losses, then those of the state it was copied
        # from, up to the copy.  Arc c: present if the arc it was added beside
        # was there when it was added.  (<=: in a run of one symbol the gadget
        # itself pairs from the left.)
        x, copied = p, _NEVER
        while x >= 0:
            y, added = c, _NEVER
            while y >= 0:
                gadget = self.lost.get((x, y), _NEVER)
                if gadget < copied and gadget <= added and gadget != _NEVER:
                    return False
                added, y = self.born[y], self.left[y]
            copied, x = self.born[x], self.right[x]
        return True

    def encode(self, word: tuple[str, ...]) -> list[int]:
        """The one accepting path over the word's symbols."""
        n, path, starts = len(word), [], [0]
        options = [self._arcs(word, 0, -1)]
        dead = set()                          # (position, state) without a way to the end
        while starts[-1] < n:
            if options[-1]:
                c, end = options[-1].pop()
                if (end, c) in dead:
                    continue
                path.append(c)
                starts.append(end)
                options.append(self._arcs(word, end, c) if end < n else [])
            else:
                if not path:
                    raise ValueError(f"no token sequence for {word!r}")
                dead.add((starts.pop(), path.pop()))
                options.pop()
        return path

    def _arcs(self, word: tuple[str, ...], at: int, state: int) -> list[tuple[int, int]]:
        """Arcs that match from ``at``, the longest last."""
        found, node = [], self.trie
        for end in range(at, len(word)):
            node = node.get(word[end])
            if node is None:
                break
            c = node.get(None)
            if c is not None and (state < 0 or self.has_arc(state, c)):
                found.append((c, end + 1))
        return found

    def decode(self, ids: list[int]) -> list[str]:
        """The arc labels, in order."""
        return [self.labels[i] for i in ids if 0 <= i < len(self.labels) and self.labels[i] is not None]


END = "</w>"


def symbols(label: str) -> tuple[str, ...]:
    """A label as base symbols: its characters, the last with the word end."""
    if label.endswith(END) and label != END:
        return (*label[:-len(END) - 1], label[-len(END) - 1:])
    return tuple(label)


class WordCodec:
    """A word-end BPE tokenizer file, encoded word by word.

    The file's normaliser and splitter never join text across the six ASCII
    white-space characters, so a text's ids are the ids of its words in turn;
    words seen before are taken from a bounded table.
    """

    # The splitter of the file for printable ASCII.
    ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    PRINTABLE = re.compile(rb"[!-~]*\Z")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.library = Tokenizer.from_file(path)   # normaliser and splitter of rare, non-ASCII words
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = model["vocab"] | self.special
        self.automaton = TokenAutomaton(vocabulary, merges)
        base = [i for s, i in model["vocab"].items() if s in self.automaton.made or len(symbols(s)) == 1]
        self.automaton.link(base)
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = WordTable(self._encode_word)

    def _encode_word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        ids: list[int] = []
        for piece in self.cuts.split(text) if self.cuts and "<" in text else [text]:
            if piece in self.special:
                ids.append(self.special[piece])
            elif piece:
                for part in self._split(piece):
                    ids += self.automaton.encode((*part[:-1], part[-1] + END))
        return np.array(ids, dtype="<u4").tobytes()

    def _split(self, piece: str) -> list[str]:
        if self.PRINTABLE.match(piece.encode()):
            return self.ASCII.findall(piece.lower())
        plain = self.library.normalizer.normalize_str(piece)
        return [s for s, _ in self.library.pre_tokenizer.pre_tokenize_str(plain) if s]

    def encode(self, text: bytes) -> bytes:
        """Ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.words.__getitem__, text.split()))


@functools.lru_cache(maxsize=2)
def codec(path: str) -> WordCodec:
    """The codec of a tokenizer file, built once per Python worker."""
    return WordCodec(path)


def encode_decode(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id",
                  with_ids: bool = False) -> DataFrame:
    """Encode every text and decode the ids again.

    Columns: ``key``, ``n_tokens``, ``ids_sha256`` (of the ids as little-endian
    unsigned 32-bit integers), ``decoded_sha256`` (of the decoded text in
    UTF-8); with ``with_ids`` also ``token_ids`` and ``decoded``.
    """
    one = docs.select(docs[key].alias("__key"), docs[text].cast("string").alias("__text"))
    key_type = one.schema["__key"].dataType.simpleString()
    schema = f"`{key}` {key_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        schema += ", token_ids array<bigint>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        labels = [(s or "").encode() for s in c.automaton.labels]
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                n, a, b, ids, out = [], [], [], [], []
                for t in part.column(1).cast(pa.binary()).to_pylist():
                    raw = c.encode(t or b"")
                    tokens = np.frombuffer(raw, dtype="<u4").tolist()
                    plain = b" ".join(map(labels.__getitem__, tokens))
                    n.append(len(tokens))
                    a.append(hashlib.sha256(raw).hexdigest())
                    b.append(hashlib.sha256(plain).hexdigest())
                    if with_ids:
                        ids.append(tokens)
                        out.append(plain.decode())
                cols = [part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                if with_ids:
                    cols += [pa.array(ids, pa.list_(pa.int64())), pa.array(out, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, [key, "n_tokens", "ids_sha256", "decoded_sha256", "token_ids", "decoded"][:len(cols)])
        release_memory()

    return one.mapInArrow(run, schema)
