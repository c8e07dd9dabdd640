"""Operator 2: token-id files, packed by an adaptive context-mixing range coder.

File format.  A *segment* holds the ids of consecutive documents, cut into
blocks of ``BLOCK`` ids.  Every block is coded on its own: the adaptive state
starts afresh, and a CRC-32 of the block's ids is kept, so a damaged block is
found and harms no other.  Blocks of a segment are coded side by side, one
numpy lane each.  A segment's bytes are, little-endian: ``magic, n_blocks,
n_ranks, table bytes, crc32`` (u4; the last of all that is before the blocks'
words), per block ``n_ids, n_words, crc32`` (u4), per group of ranks its start
count (u2), the table of the segment's ids, most frequent first (compressed by
zlib), then the blocks' 24-bit words.

Model of a block, over ranks in that table.  Order 0: adaptive frequencies of
groups of ranks (eight single ones, then four an octave), begun with the
segment's.  Order 1 and order 2: the rank that last followed the previous
one, or the previous two, with how often in a row it was right.  The three are
mixed: the mass of order 0 is fixed, and each candidate adds a weight that is
learnt per context (both counts of recent hits, and whether both orders name
the same).  One range coder step then codes the rank under the mixed
frequencies.  Candidates are brought up to date every ``EPOCH`` ids, weights
and order 0 whenever the number of epochs has doubled: within an epoch nothing
depends on the ids before, so the coder models all its steps at once.

Spark: documents are range-partitioned and sorted by id, each partition writes
its segments (rows of a Parquet table in the shared folder: the writer that
reaches every store), and the files are read back and decoded.

Defined results: null text = empty text, the end id alone.  Rows with equal
ids are ordered by text, so repeated rows are interchangeable; a null id sorts
first.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.staging import Staging

MAGIC = 0x32444954
BLOCK = 4096          # ids per block
EPOCH = 64            # ids between updates of the candidates
SEGMENT_IDS = 8 << 20
MAX_ID = (1 << 17) - 1
TOTAL0 = 1 << 20      # mass of order 0
_SLOTS, _SLOT = 1 << 12, 1 << 8       # groups get whole slots of that mass
_PRIOR = 0.25                         # weight of the segment's frequencies
_T1, _T2 = 10, 11                     # log2 of a lane's order-1 and order-2 table
_WEIGHT_MAX = 1 << 22
_GATES = 32                           # contexts of the weights
_LIKELY = np.array([0.02, 0.1, 0.3, 0.6])   # a candidate's start share, by its hits in a row


@functools.lru_cache(maxsize=4)
def rank_groups(n_ranks: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Log2 of the size and first rank of each group, and the ranks covered."""
    bits, first, at = [], [], 0
    while at < max(n_ranks, 1):
        b = max(at.bit_length() - 3, 0)
        bits.append(b)
        first.append(at)
        at += 1 << b
    return np.array(bits), np.array(first), at


class Model:
    """The adaptive state of ``lanes`` blocks that advance together.  Only
    ``update``, at the end of an epoch, changes it."""

    def __init__(self, lanes: int, steps: int, n_ranks: int, start: np.ndarray):
        bits, first, self.cover = rank_groups(n_ranks)
        self.lanes, self.groups = lanes, len(bits)
        self.first, self.size = first.astype(float), (1 << bits).astype(float)
        self.group = np.repeat(np.arange(self.groups), 1 << bits)
        self.offset = (np.arange(self.cover) - np.repeat(first, 1 << bits)).astype(float)
        self.least = np.cumsum(np.maximum((1 << bits) // _SLOT, 1))   # each rank gets 1 at least
        self.hash = (np.arange(self.cover) * 0x9E37 >> 3) & ((1 << _T1) - 1)
        lane = np.arange(lanes)
        self.at1 = lane * ((1 << _T1) + (1 << _T2))
        self.at2 = self.at1 + (1 << _T1)
        self.at_gate, self.at_group, self.at_slot = lane * _GATES, lane * self.groups, lane * _SLOTS
        self.table = np.zeros(lanes * ((1 << _T1) + (1 << _T2)), np.int32)   # rank * 16 + hits in a row
        self.counts = np.tile(start * _PRIOR, (lanes, 1))
        gate = np.arange(_GATES)
        p1 = _LIKELY[gate & 3]
        p2 = np.where(gate & 16, 0, _LIKELY[gate >> 2 & 3] * (1 - p1))
        self.seen = np.tile(np.stack([1 - p1 - p2, p1, p2]) * 4 + 0.02, lanes)   # outcomes by lane and gate
        self.epochs, self.kept = 0, []
        self.last = 1 << max(-(-steps // EPOCH) - 1, 1).bit_length() - 1    # the last epoch that matters to later ones
        self._order0()
        self._weights()

    def _order0(self) -> None:
        """Starts and widths of the groups' ranks, and the group of each slot."""
        c = np.cumsum(self.counts, axis=1)
        ends = (c * ((_SLOTS - self.least[-1]) / c[:, -1:])).astype(np.int64) + self.least
        ends[:, -1] = _SLOTS
        low = np.zeros_like(ends)
        low[:, 1:] = ends[:, :-1]
        spans = np.empty(ends.shape, complex)            # start and width: one look-up for both
        spans.real, spans.imag = low * _SLOT, np.floor((ends - low) * _SLOT / self.size)
        self.spans = spans.reshape(-1)
        marks = np.zeros(self.lanes * _SLOTS, np.uint8)
        marks[(low[:, 1:] + self.at_slot[:, None]).reshape(-1)] = 1
        self.slot = np.cumsum(marks.reshape(self.lanes, _SLOTS), axis=1, dtype=np.uint8).reshape(-1)

    def _weights(self) -> None:
        w1, w2 = np.clip(np.floor(self.seen[1:] * (TOTAL0 / self.seen[0])), 1, _WEIGHT_MAX)
        self.weights = np.empty(len(w1), complex)        # order 1's, and the total
        self.weights.real, self.weights.imag = w1, w1 + w2 + TOTAL0

    @staticmethod
    def gates(e1: np.ndarray, e2: np.ndarray, same: np.ndarray) -> np.ndarray:
        return ((e1 | e2) & 15) + (same.view(np.int8) << 4)

    def update(self, ranks: np.ndarray, index: tuple[np.ndarray, np.ndarray], entries: tuple[np.ndarray, np.ndarray]) -> None:
        """Learn an epoch: candidates at once, weights and order 0 whenever the
        number of epochs has doubled."""
        new, hits = ranks << 4, []
        for i, e, one in zip(index, entries, (1, 4)):
            x = (e ^ new).view(np.uint32)                # after a hit: the hits in a row
            hits.append(x < 16)
            self.table[i] = new + np.minimum(x + np.uint32(one), np.uint32(3 * one)).view(np.int32) * hits[-1]
        self.epochs += 1
        if self.epochs > self.last:
            return
        k = ranks.shape[1]
        e1, e2 = entries
        gate = self.gates(e1, e2, (e1 ^ e2) < 16) + self.at_gate[:k]
        gate += (hits[0] + 2 * (hits[1] > hits[0])) * (_GATES * self.lanes)
        self.kept.append((gate.reshape(-1), (self.group[ranks] + self.at_group[:k]).reshape(-1)))
        if self.epochs & (self.epochs - 1) == 0:
            gate, group = map(np.concatenate, zip(*self.kept))
            self.kept = []
            self.seen += np.bincount(gate, minlength=self.seen.size).reshape(3, -1)
            self.counts += np.bincount(group, minlength=self.counts.size).reshape(self.counts.shape)
            self._weights()
            self._order0()


def _epochs(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first step, end, lanes that reach the first step); ``sizes`` longest first."""
    steps = int(sizes.max(initial=0))
    for t in range(0, steps, EPOCH):
        yield t, min(t + EPOCH, steps), int(np.searchsorted(-sizes, -t, side="left"))


# Range coder in doubles (all values are whole and below 2**53): 48-bit window,
# 24-bit words out, range kept at 2**24 or above, which one word a step suffices for.
_WORD = float(1 << 24)


def _encode(lanes: np.ndarray, sizes: np.ndarray, m: Model) -> tuple[np.ndarray, np.ndarray]:
    """The words of all lanes, and how many each has; ``lanes`` is (steps, lanes)."""
    steps, n = lanes.shape
    words, out = np.zeros((steps + 2, n), np.uint32), np.zeros((steps + 2, n), bool)
    low, rng = np.zeros(n), np.full(n, _WORD * _WORD)
    past = np.zeros((2, n), lanes.dtype)
    for t, end, k in _epochs(sizes):
        ranks = lanes[t:end, :k]
        h = m.hash[np.concatenate([past[:, :k], ranks[:-1]])]
        past = lanes[max(end - 2, 0):end] if end > 1 else np.concatenate([past[1:], lanes[:1]])
        i1, i2 = h[1:] + m.at1[:k], (h[1:] ^ 2 * h[:-1]) + m.at2[:k]
        e1, e2 = m.table[i1], m.table[i2]
        weights = m.weights[m.gates(e1, e2, (e1 ^ e2) < 16) + m.at_gate[:k]]
        w1, total = np.ascontiguousarray(weights.real), np.ascontiguousarray(weights.imag)
        by1 = e1 >> 4 == ranks
        by2 = (e2 >> 4 == ranks) > by1
        by0 = ~(by1 | by2)
        span = m.spans[m.group[ranks] + m.at_group[:k]]
        cum = (total - TOTAL0 + span.real + m.offset[ranks] * span.imag) * by0 + w1 * by2
        f = span.imag * by0 + w1 * by1 + (total - TOTAL0 - w1) * by2
        lo, rg = low[:k], rng[:k]
        for i in range(end - t):
            r = np.floor(rg / total[i])
            lo += r * cum[i]
            np.multiply(r, f[i], out=rg)
            short = np.less(rg, _WORD, out=out[t + i, :k]).astype(float)
            w = np.floor(lo * (1 / _WORD))
            words[t + i, :k] = w                        # 25 bits where a carry is due
            w *= _WORD
            w *= short
            lo -= w
            short *= _WORD - 1
            short += 1
            lo *= short
            rg *= short
        m.update(ranks, (i1, i2), (e1, e2))
    words[steps], words[steps + 1] = np.floor(low / _WORD), low % _WORD   # the window ends the block
    out[steps:] = True
    seq = np.ascontiguousarray(words.T)[out.T]
    over = np.flatnonzero(seq >> 24)
    while len(over):                                    # carries into the words before
        seq[over] &= 0xFFFFFF
        over = over - 1
        seq[over] += 1
        over = over[seq[over] >> 24 > 0]
    return seq, out.sum(axis=0)


def _decode(words: np.ndarray, n_words: np.ndarray, sizes: np.ndarray, m: Model) -> np.ndarray:
    """The ranks, (steps, lanes); lanes ordered by size, longest first."""
    n, steps = len(sizes), int(sizes.max(initial=0))
    src = np.zeros(len(words) + steps + 2)
    src[:len(words)] = words
    pos = np.cumsum(n_words) - n_words
    code = src[pos] * _WORD + src[pos + 1]              # minus low
    pos += 2
    rng = np.full(n, _WORD * _WORD)
    lanes = np.zeros((steps, n), np.int32)
    ranks, before = np.zeros(n, np.int64), 2 * m.hash[np.zeros(n, np.int64)]
    k = -1
    for t, end, live in _epochs(sizes):
        if live != k:
            k = live
            index, entries = np.empty((EPOCH, 2, k), np.int64), np.empty((EPOCH, 2, k), np.int32)
            lane, at1, at2 = np.arange(k), m.at1[:k], m.at2[:k]
            at_gate, at_group, at_slot = m.at_gate[:k], m.at_group[:k], m.at_slot[:k]
            code, rng, pos, ranks, before = code[:k], rng[:k], pos[:k], ranks[:k], before[:k]
            # Rows: coded by order 0, by order 2's candidate, by order 1's.
            rank, cum, f = np.zeros((3, k), np.int64), np.zeros((3, k)), np.zeros((3, k))
            flat_rank, flat_cum, flat_f = rank.reshape(-1), cum.reshape(-1), f.reshape(-1)
        for i in range(end - t):
            h, ix = m.hash[ranks], index[i]
            np.add(h, at1, out=ix[0])
            np.bitwise_xor(h, before, out=ix[1])
            ix[1] += at2
            before = h + h
            e = m.table[ix]
            entries[i] = e
            e1, e2 = e
            weights = m.weights[m.gates(e1, e2, (e1 ^ e2) < 16) + at_gate]
            w1, total = weights.real, weights.imag
            both = total - TOTAL0
            r = np.floor(rng / total)
            v = np.floor(code / r)
            u = v - both
            row = (u < 0).view(np.int8) + (v < w1).view(np.int8)
            np.maximum(u, 0, out=u)
            np.minimum(u, TOTAL0 - 1, out=u)            # damaged blocks
            g = m.slot[(u * (1 / _SLOT)).astype(np.int64) + at_slot].astype(np.int64)
            span = m.spans[at_group + g]
            low, width = span.real, span.imag
            off = np.floor((u - low) / width)
            rank[0] = np.minimum(m.first[g] + off, m.cover - 1)
            rank[1], rank[2] = e2 >> 4, e1 >> 4
            off *= width
            off += low
            np.add(off, both, out=cum[0])
            cum[1] = w1
            f[0] = width
            np.subtract(both, w1, out=f[1])
            f[2] = w1
            chosen = row * np.int64(k) + lane
            ranks = flat_rank[chosen]
            code -= r * flat_cum[chosen]
            np.multiply(r, flat_f[chosen], out=rng)
            low = rng < _WORD
            short = low.astype(float)
            word = src[pos]
            word *= short
            pos += low
            short *= _WORD - 1
            short += 1
            code *= short
            code += word
            rng *= short
            lanes[t + i, :k] = ranks
            if i % 32 == 0:
                np.minimum(code, rng, out=code)         # damaged blocks
        m.update(lanes[t:end, :k], (index[:end - t, 0], index[:end - t, 1]), (entries[:end - t, 0], entries[:end - t, 1]))
    return lanes


def pack(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """A segment: the ids in independently coded, checksummed blocks."""
    ids = np.ascontiguousarray(ids, dtype="<u4")
    if len(ids) and int(ids.max()) > MAX_ID:
        raise ValueError(f"ids above {MAX_ID} do not fit this format")
    counts = np.bincount(ids, minlength=1)
    names = np.argsort(-counts, kind="stable")[:np.count_nonzero(counts)]
    rank = np.zeros(len(counts), np.int32)
    rank[names] = np.arange(len(names))
    n = -(-len(ids) // block)
    sizes = np.full(n, block)
    if n:
        sizes[-1] = len(ids) - (n - 1) * block
    padded = np.zeros(n * block, np.int32)
    padded[:len(ids)] = rank[ids]
    lanes = np.ascontiguousarray(padded.reshape(n, block).T[:int(sizes.max(initial=0))])
    _, first, _ = rank_groups(len(names))
    start = np.add.reduceat(counts[names], first) if len(names) else np.zeros(1)
    start = (start * (_SLOTS / max(len(ids), 1))).astype("<u2") + np.uint16(1)
    if n:
        seq, n_words = _encode(lanes, sizes, Model(n, len(lanes), len(names), start))
    else:
        seq, n_words = np.zeros(0, "<u4"), np.zeros(0)
    head = np.zeros((n, 3), dtype="<u4")
    head[:, 0], head[:, 1] = sizes, n_words
    head[:, 2] = [zlib.crc32(ids[i * block:(i + 1) * block]) for i in range(n)]
    table = zlib.compress(names.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
    rest = head.tobytes() + start.astype("<u2").tobytes() + table
    fixed = np.array([MAGIC, n, len(names), len(table), zlib.crc32(rest)], dtype="<u4").tobytes()
    return b"".join([fixed, rest, seq.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()])


def unpack(data: bytes) -> np.ndarray:
    """The ids of a segment; raises ValueError where a checksum fails."""
    if len(data) < 20:
        raise ValueError("not a segment of token ids")
    magic, n, n_names, n_table, crc = np.frombuffer(data, dtype="<u4", count=5).tolist()
    groups = len(rank_groups(n_names)[0]) if n_names <= MAX_ID + 1 else 0
    end = 20 + 12 * n + 2 * groups + n_table
    if magic != MAGIC or zlib.crc32(data[20:end]) != crc:
        raise ValueError("not a segment of token ids")
    if not n:
        return np.zeros(0, "<u4")
    head = np.frombuffer(data, dtype="<u4", count=3 * n, offset=20).reshape(n, 3)
    start = np.frombuffer(data, dtype="<u2", count=groups, offset=20 + 12 * n)
    names = np.frombuffer(zlib.decompress(data[end - n_table:end]), np.uint8).reshape(4, -1)
    model = Model(n, int(head[:, 0].max()), n_names, start)
    ids_of = np.zeros(model.cover, "<u4")
    ids_of[:n_names] = np.ascontiguousarray(names.T).view("<u4").reshape(-1)
    n_words = head[:, 1].astype(np.int64)
    if len(data) != end + 3 * n_words.sum():
        raise ValueError("a segment of another length")
    raw = np.zeros((int(n_words.sum()), 4), np.uint8)
    raw[:, :3] = np.frombuffer(data, np.uint8, offset=end).reshape(-1, 3)
    sizes = head[:, 0].astype(np.int64)
    lanes = _decode(raw.view("<u4").reshape(-1), n_words, sizes, model)
    blocks = ids_of[np.ascontiguousarray(lanes.T)]
    for i in range(n):
        if zlib.crc32(blocks[i, :sizes[i]]) != head[i, 2]:
            raise ValueError(f"block {i} fails its checksum")
    return blocks[np.arange(blocks.shape[1]) < sizes[:, None]]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` (``sizes[i]`` of them), one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


CHUNK_BYTES = 32 << 20     # text encoded at a time
TABLE_WORDS = 3_000_000    # distinct words kept per Python worker (about 200 MB)
JOINED = 200               # new words given to the library in one text
DIVIDER = "\x01"


class LibraryEncoder:
    """Ids of texts by the tokenizers library.  The file's rules never join
    text across ASCII white space (tested), so each distinct word of a chunk is
    looked up once, and new words are encoded once and kept in a bounded table.
    New words go to the library in one text, with a word of one id between them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.divider = self._ids(DIVIDER)
        self.words, self.ids, self.ends = pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(1, np.int64)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _library_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        if len(self.divider) == 1 and len(words) > 1:
            ids = self._ids(f" {DIVIDER} ".join(words))
            divides = ids == self.divider[0]
            cuts = np.flatnonzero(divides)
            if len(cuts) == len(words) - 1:             # else a word has that id itself
                return ids[~divides], np.diff(cuts, prepend=-1, append=len(ids)) - 1
        each = [self._ids(w) for w in words]
        return np.concatenate(each), np.array(list(map(len, each)))

    def _learn(self, words: pa.Array) -> None:
        new = [w.decode("utf-8", "replace") for w in words.cast(pa.binary()).to_pylist()]
        ids, sizes = zip(*(self._library_ids(new[lo:lo + JOINED]) for lo in range(0, len(new), JOINED)))
        self.words = pa.concat_arrays([self.words, words])
        self.ids = np.concatenate([self.ids, *ids])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))])

    def encode(self, texts: pa.Array, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: none), ``end`` after each, and the lengths."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.string()))
        words = split.flatten().dictionary_encode()
        found = pc.index_in(words.dictionary, value_set=self.words)
        new = found.is_null()
        rest, at = new.to_numpy(zero_copy_only=False), found.fill_null(0).to_numpy().copy()
        if found.null_count:
            if len(self.words) + found.null_count > TABLE_WORDS:
                known = at[~rest]                       # this chunk's words stay
                at[~rest] = np.arange(len(known))
                sizes = np.diff(self.ends)[known]
                self.ids = self.ids[_ranges(self.ends[known], sizes)]
                self.ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
                self.words = self.words.take(pa.array(known))
            at[rest] = len(self.words) + np.arange(found.null_count)
            self._learn(words.dictionary.filter(new))
        after = np.asarray(split.offsets)[1:] - split.offsets[0].as_py()
        codes = np.insert(at[words.indices.to_numpy()], after, len(self.words))
        starts = np.concatenate([self.ends[:-1], [self.ends[-1]]])
        sizes = np.concatenate([np.diff(self.ends), [len(end)]])[codes]
        ids = np.concatenate([self.ids, end])[_ranges(starts[codes], sizes)]
        return ids, np.diff(np.cumsum(sizes)[after + np.arange(len(after))], prepend=0)

    def __call__(self, text: bytes) -> bytes:
        return self.encode(pa.array([text], pa.binary()).view(pa.string()), np.zeros(0, "<u4"))[0].tobytes()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES`` of text; a longer text is one of its own."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64))
    lo = 0
    while lo < len(ends):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, side="right")))
        yield lo, hi
        lo = hi


SEGMENTS = "shard int, segment int, doc_ids array<bigint>, lengths array<bigint>, n_ids bigint, data binary"


def encode_segments(docs: DataFrame, path: str, end_id: int, text: str = "text", key: str = "doc_id",
                    segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """The segments of all documents in ascending ``key`` order (shards are
    ranges of the key, segments ascend within a shard)."""
    one = (docs.select(docs[key].cast("bigint").alias("k"), docs[text].cast("string").alias("t"))
           .repartitionByRange("k").sortWithinPartitions("k", "t")
           .select("k", "t", F.spark_partition_id().alias("p")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], dtype="<u4")
        shard, segment, keys, lengths, parts, held = 0, 0, [], [], [], 0

        def flush():
            data = pack(np.concatenate(parts))
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([segment], pa.int32()),
                pa.array([keys], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                pa.array([held], pa.int64()), pa.array([data], pa.binary())],
                ["shard", "segment", "doc_ids", "lengths", "n_ids", "data"])

        for batch in batches:
            for lo, hi in chunks(batch.column(1)):
                b = batch.slice(lo, hi - lo)
                shard = b.column(2)[0].as_py()
                ids, sizes = enc.encode(b.column(1), end)
                for k, n, stop in zip(b.column(0).to_pylist(), sizes.tolist(), np.cumsum(sizes).tolist()):
                    if held and held + n > segment_ids:
                        yield flush()
                        segment, keys, lengths, parts, held = segment + 1, [], [], [], 0
                    keys.append(k)
                    lengths.append(n)
                    parts.append(ids[stop - n:stop])
                    held += n
        if keys:
            yield flush()

    return one.mapInArrow(run, SEGMENTS)


def decode_segments(segments: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of the segments: ``shard, segment, at`` (ids before it in the
    segment), ``doc_id, n_tokens, ids_crc32``; with ``with_ids`` also ``token_ids``."""
    schema = "shard int, segment int, at bigint, doc_id bigint, n_tokens bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", token_ids array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, segment, keys, lengths, _, data = (batch.column(i)[row].as_py() for i in range(6))
                raw = unpack(data)
                ends = np.cumsum(lengths, dtype=np.int64)
                at = ends - lengths
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(at, ends)]
                n = len(keys)
                cols = [pa.array([shard] * n, pa.int32()), pa.array([segment] * n, pa.int32()), pa.array(at),
                        pa.array(keys, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())]
                names = ["shard", "segment", "at", "doc_id", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([raw[a:b].tolist() for a, b in zip(at, ends)], pa.list_(pa.int64())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    return segments.mapInArrow(run, schema)


def write_and_read(docs: DataFrame, path: str, end_id: int, staging: Staging, text: str = "text",
                   key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Write the segments to the shared folder, read them back, and return per
    document ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32``."""
    files = staging.table(encode_segments(docs, path, end_id, text, key), "token_ids")
    sizes = files.select("shard", "segment", "n_ids")
    # Two levels: the shards' totals (as many rows as shuffle partitions), then
    # the segments within a shard.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))
    starts = sizes.join(shards, "shard").select(
        "shard", "segment", (F.col("shard_start") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("first"))
    rows = decode_segments(files, with_ids).join(starts, ["shard", "segment"])
    out = ["doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return rows.select(*out, *(["token_ids"] if with_ids else []))
