"""Operator 11: repair of a conversation's turn structure by an auction shortest-path algorithm.

A conversation should read ``(s?(ua)+)?`` in its roles' initials.  Its rows, in order,
span a lattice of nodes (rows read, state of that pattern); edits are its arcs, with
integer costs: Keep 0, Rerole 1, Delete 2, Insert 5, and 5 more for a truncated row
that is not deleted.  Blank and duplicate rows can only be deleted.

*Auction.*  Every node has a price, at first 0.  A path starts at an entry node; its last
node is either priced too low (below the least arc cost plus price over its arcs): then
the price is raised to that and the path contracts by one node, or the path is extended
along the best arc, until it reaches the sink.  The path is then a shortest one and the
entry's price its cost.  The lattice is cut into segments of ``SEGMENT`` rows, auctioned
from the last to the first: the prices at a segment's entries are the arc costs into the
sink of the segment before.  Prices in a segment are small differences, so the number of
auction steps stays proportional to the rows, and equal segments are auctioned once.

*Trace.*  With the final prices, every shortest path runs over tight arcs only (price =
cost + price of the head).  From an entry, the letters of the tight arcs that lead to the
sink over tight arcs are followed, least letter first: the ASCII-least of the cheapest
edit sequences (a letter leads from a node to one node only).

On Spark: rows are put in order by range parts and staged once; the first copy of a row
in a conversation is found by an aggregate.  Per conversation, one byte a row streams
through the auction.  The texts pass a second sorted stream that applies the edits; it
holds one row at a time.  (A digest of a whole conversation is sequential by nature.)

Defined results: null role or text is one space, so it is blank text or no legal role.
Rows without ``conv_id`` are one conversation with null id.  Null turns come first; rows
of equal turn are ordered by role, then text; copies are adjacent.  ``gaps`` beyond a
bigint is the greatest bigint.  A conversation without rows has zeros, an empty audit
and the hash of the empty string.  An empty table has no conversations.  Very long texts
are only looked at for their last character.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.operators.ordered import ordered_rows
from adtrail.staging import Staging

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SEGMENT = 16                     # rows of one auction
_KNOWN = 1 << 16                 # auctions kept per Python worker
WHITE = " \t\n\x0b\x0c\r"
# States of the pattern: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
_AFTER = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
_NEXT = {START: "u", S: "u", U: "a", A: "u"}        # the role an edit can give in a state
_ROLE = {"u": "user", "a": "assistant"}
_INITIALS = "uas-"
_LEGAL = {(2, 0), (0, 1), (1, 0)}                   # su, ua, au
# A row's code: its initial's place in _INITIALS, and these bits.
CUT, BLANK, COPY = 4, 8, 16
_DEAD = BLANK | COPY


def _arcs(rows: bytes, exits: tuple, closing: bool) -> list[list[tuple[str, int, int]]]:
    """(letter, head, cost) of every node's arcs, letters ascending; the sink comes last."""
    n = len(rows)
    out = []
    for i in range(n + 1):
        for q in range(4):
            arcs = []
            insert = ("I", 4 * i + _AFTER[q, _NEXT[q]], INSERT)
            if i == n:
                if exits[q] is not None:
                    arcs.append(("", 4 * (n + 1), exits[q]))
                if closing:                        # else the next segment inserts
                    arcs.append(insert)
            else:
                row = rows[i]
                arcs += [("D", 4 * (i + 1) + q, DELETE), insert]
                if not row & _DEAD:
                    more = TRUNCATED if row & CUT else 0
                    initial = _INITIALS[row & 3]
                    if (q, initial) in _AFTER:
                        arcs.append(("K", 4 * (i + 1) + _AFTER[q, initial], KEEP + more))
                    if initial != _NEXT[q]:
                        arcs.append(("R", 4 * (i + 1) + _AFTER[q, _NEXT[q]], REROLE + more))
            out.append(arcs)
    return out


@functools.lru_cache(maxsize=_KNOWN)
def auction(rows: bytes, exits: tuple, closing: bool = False) -> tuple[tuple, tuple]:
    """(cost, (letters, exit state)) per entry state of one segment.

    ``exits``: the cost from each exit state on (None: no way), the least of them 0;
    ``closing``: the conversation ends here."""
    arcs = _arcs(rows, exits, closing)
    sink = len(arcs)
    price = [0] * (sink + 1)
    for entry in range(4):
        path = [entry]
        while path[-1] != sink:
            node = path[-1]
            worth, head = min((cost + price[j], k) for k, (_, j, cost) in enumerate(arcs[node]))
            if price[node] < worth:
                price[node] = worth                # raise and contract
                if len(path) > 1:
                    path.pop()
            else:
                path.append(arcs[node][head][1])   # extend
    tight = [[(letter, j) for letter, j, cost in a if price[i] == cost + price[j]] for i, a in enumerate(arcs)]
    through = {sink: True}

    def leads(node: int) -> bool:
        """Do tight arcs lead from here to the sink?  (They form no cycle: one of cost 0 would be needed.)"""
        if node not in through:
            through[node] = any(leads(j) for _, j in tight[node])
        return through[node]

    traced = []
    for entry in range(4):
        node, letters = entry, []
        while True:
            letter, head = next((x, j) for x, j in tight[node] if leads(j))
            if head == sink:
                break
            letters.append(letter)
            node = head
        traced.append(("".join(letters), node % 4))
    return tuple(price[:4]), tuple(traced)


def cheapest_edits(rows: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation's row codes."""
    least, found = 0, []
    exits, closing = (0, None, None, 0), True
    for at in range(len(rows) // SEGMENT * SEGMENT, -1, -SEGMENT):
        prices, traced = auction(rows[at:at + SEGMENT], exits, closing)
        found.append(traced)
        least += min(prices)
        exits, closing = tuple(p - min(prices) for p in prices), False
    state, out = START, []
    for traced in reversed(found):
        letters, state = traced[state]
        out.append(letters)
    return least + exits[START], "".join(out)


# ------------------------------------------------------------------ the rows
def damage(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults put in by a checksum of ``conv_id:turn``, modulo 20: 0 drops a row, 1
    empties its text, 2 removes its full stops, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    c, t = conversations[conv_id], conversations[turn]
    fault = F.crc32(F.concat(F.coalesce(c.cast("string"), space), F.lit(":"), F.coalesce(t.cast("string"), space))) % 20
    rows = conversations.select(c.alias("conv_id"), t.cast("bigint").alias("turn"), F.coalesce(conversations[role].cast("string"), space).alias("role"),
                                F.coalesce(conversations[text].cast("string"), space).alias("text"), fault.alias("fault"))
    return rows.where(F.col("fault") != 0).select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def coded_rows(rows: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id, seq, turn, role, text, code, name``: the rows in order, staged.  ``code`` has
    all but the mark of copies; ``name`` is a digest of conversation, role and text."""
    rows = rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "u", 0).when(initial == "a", 1).when(initial == "s", 2).otherwise(3)
    code = code + F.when(last == "", BLANK).when(last.isin(".", "!", "?"), 0).otherwise(CUT)
    whose = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("none"))
    name = F.unhex(F.md5(F.concat(F.encode(F.concat(whose, F.lit("/"), F.octet_length("role").cast("string"), F.lit(":")), "utf-8"),
                                  F.encode("role", "utf-8"), F.encode("text", "utf-8"))))
    return ordered_rows(rows.select("*", code.cast("int").alias("code"), name.alias("name")), ["conv_id", "turn", "role", "text"], staging, name="coded_rows")


def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "seq")


_MOST = 2 ** 63 - 1


class _Conversation:
    """What is known of a conversation while its rows stream by."""

    def __init__(self, key):
        self.key, self.codes = key, bytearray()
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, code: int) -> None:
        self.codes.append(code)
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.turns += turn != self.last
            self.last = turn

    def row(self) -> tuple:
        c = self.codes
        gaps = 0 if self.first is None else min(self.last - self.first + 1 - self.turns, _MOST)
        blank = sum(1 for x in c if x & BLANK)
        copies = sum(1 for x in c if x & COPY and not x & BLANK)
        cut = sum(1 for x in c if x & CUT and not x & _DEAD)
        illegal = sum((a & 3, b & 3) not in _LEGAL for a, b in zip(c, c[1:]))
        return (self.key, gaps, blank, copies, cut, illegal, *cheapest_edits(bytes(c)))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def audits(coded: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, its counts, ``cost`` and ``audit``."""
    kind = coded.schema["conv_id"].dataType
    firsts = (coded.where(F.col("code").bitwiseAND(BLANK) == 0).groupBy("name").agg(F.min("seq").alias("original"), F.count(F.lit(1)).alias("n"))
              .where(F.col("n") > 1).select("name", "original"))
    rows = coded.select("conv_id", "seq", "turn", "code", "name").join(firsts, "name", "left")
    copy = F.when(F.col("seq") > F.col("original"), COPY).otherwise(0)
    rows = rows.select("conv_id", "seq", "turn", (F.col("code") + copy).alias("code"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found):
            cols = list(zip(*[c.row() for c in found]))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], schema), *[pa.array(c, pa.int64()) for c in cols[1:7]], pa.array(cols[7], pa.string())],
                                              ["conv_id", *COUNTS, "audit"])

        at, schema = None, None
        for batch in batches:
            done, schema = [], batch.schema.field(0).type
            for key, turn, code in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if at is None or key != at.key:
                    if at is not None:
                        done.append(at)
                    at = _Conversation(key)
                at.add(turn, code)
            if done:
                yield out(done)
        if at is not None:
            yield out([at])

    columns = ", ".join(f"{c} bigint" for c in COUNTS)
    return _by_conversation(rows).mapInArrow(run, f"conv_id {kind.simpleString()}, {columns}, audit string")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation's row, None) at its start, then (None, (role, text)) per repaired turn.

    A conversation's stream is its audit row, then its turns in order."""
    head, letters, at, state = None, "", 0, START

    def inserts():
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            at, initial = at + 1, _NEXT[state]
            state = _AFTER[state, initial]
            yield None, (_ROLE[initial], "")

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("conv_id", "seq", "role", "text", "audit", *COUNTS)]
        for key, seq, role, text, audit, *counts in zip(*columns):
            if seq < 0:
                yield from inserts()
                letters, at, state = audit, 0, START
                yield (key, *counts, audit), None
                continue
            yield from inserts()
            letter, at = letters[at], at + 1
            if letter == "K":
                state = _AFTER[state, role[0]]
                yield None, (role, text)
            elif letter == "R":
                initial = _NEXT[state]
                state = _AFTER[state, initial]
                yield None, (_ROLE[initial], text)
    yield from inserts()


def _with_audits(coded: DataFrame) -> DataFrame:
    found = audits(coded)
    empty = [F.lit(None).cast("bigint").alias(c) for c in COUNTS]
    heads = found.select("conv_id", F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "audit", *COUNTS)
    rows = coded.select("conv_id", "seq", "role", "text", F.lit(None).cast("string").alias("audit"), *empty)
    return _by_conversation(heads.unionByName(rows))


def repaired_turns(rows: DataFrame, staging: Staging) -> DataFrame:
    """The repaired conversations: ``conv_id, place, role, text``, places from 0."""
    coded = coded_rows(rows, staging)
    kind = coded.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema, held, key, place = first.schema.field(0).type, [], None, 0

        def out():
            cols = list(zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], schema), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
                                              ["conv_id", "place", "role", "text"])

        size = 0
        for head, turn in _repaired(_chain(first, batches)):
            if head is not None:
                key, place = head[0], 0
                continue
            held.append((key, place, *turn))
            place, size = place + 1, size + len(turn[1])
            if len(held) >= 1000 or size > 1 << 22:
                yield out()
                size = 0
        if held:
            yield out()

    return _with_audits(coded).mapInArrow(run, f"conv_id {kind}, place bigint, role string, text string")


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def repair(rows: DataFrame, staging: Staging) -> DataFrame:
    """One row per conversation of ``rows``: ``conv_id``, its counts, ``cost``, ``audit`` and
    ``repaired_sha256`` (``role:text`` of its repaired turns, newline-joined)."""
    coded = coded_rows(rows, staging)
    kind = coded.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        schema, held, head, state, some = first.schema.field(0).type, [], None, None, False

        def out():
            cols = list(zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(cols[0], schema), *[pa.array(c, pa.int64()) for c in cols[1:7]], *[pa.array(c, pa.string()) for c in cols[7:]]],
                                              ["conv_id", *COUNTS, "audit", "repaired_sha256"])

        for new, turn in _repaired(_chain(first, batches)):
            if new is not None:
                if head is not None:
                    held.append((*head, state.hexdigest()))
                    if len(held) >= 1000:
                        yield out()
                head, state, some = new, hashlib.sha256(), False
            else:
                state.update(("\n" * some + f"{turn[0]}:{turn[1]}").encode())
                some = True
        held.append((*head, state.hexdigest()))
        yield out()

    columns = ", ".join(f"{c} bigint" for c in COUNTS)
    return _with_audits(coded).mapInArrow(run, f"conv_id {kind}, {columns}, audit string, repaired_sha256 string")


def damaged_and_repaired(conversations: DataFrame, staging: Staging) -> DataFrame:
    """:func:`repair` of the damaged rows, with a row for every original conversation."""
    every = conversations.select(F.col("conv_id").alias("every_id")).distinct()
    done = repair(damage(conversations), staging)
    out = every.join(done, F.col("every_id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("every_id").alias("conv_id"), *[F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
