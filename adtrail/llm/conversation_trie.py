"""Operator 13: the prefix trie of conversations, by ROLLUP over positional turn ids.

A conversation is a sequence of turns; every distinct sequence of its first ``d``
turns is a node.  ``BLOCK`` turns of a conversation are one row with one column
per position, so one ``GROUP BY block, node, ROLLUP (t0, ..., t7)`` makes the
nodes of all depths at once: ``grouping_id`` tells the depth inside the block, and
``node`` is the name of the node where the block before ended.  That name is a
running sum over the earlier blocks' digests, so all blocks of all conversations
take part in the same ROLLUP, however long a conversation is: no loop over depths.

Subtree sums need no walk either.  A node belongs to its smallest member; a member
owns the nodes of its path from some depth on.  Over the members of a node, the
bytes that they own and the leaves that they own add up to those of its subtree
(its owner's path counts from the node on), so a second ROLLUP with these two
numbers per conversation gives them.

Names: turns, blocks and nodes are named by 128-bit digests (MD5; nodes by a sum
of four 32-bit pieces per earlier block, digested).

Hot groups: positions come from range parts (``operators.ordered``), blocks hold
``BLOCK`` rows of a conversation, running sums go by runs of ``RUN`` blocks and then
over the runs, node counts are aggregated before the shuffle.  The list of the
conversations that end in a node is read as a sorted stream into its hash.

Defined results: null role or text is empty.  Rows of one conversation with equal
turn are ordered by role, then text; repeated rows stay, as turns of their own.
Rows without ``conv_id`` belong to no conversation.  A conversation without turns
after the rebuild is a member of the root and ends there.  An empty table has no
nodes.  Very long texts only enter digests and byte counts.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.operators.ordered import positions
from adtrail.staging import Staging

BLOCK = 8          # turns of one row, positional columns of the ROLLUP
RUN = 4096         # blocks of one window
HEAD = 9           # a rebuilt conversation starts with 0 to HEAD - 1 turns of another
EVERY = 5          # ... of the one whose id is the next lower multiple of EVERY


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text``: the given columns, role and text never null."""
    one = conversations.select(conversations[conv_id].cast("bigint").alias("conv_id"), conversations[turn].alias("turn"),
                               F.coalesce(conversations[role].cast("string"), F.lit("")).alias("role"),
                               F.coalesce(conversations[text].cast("string"), F.lit("")).alias("text"))
    return one.where(F.col("conv_id").isNotNull())


def _digest(*parts: str) -> str:
    """A 128-bit digest of binary SQL expressions."""
    return f"unhex(md5(concat({', '.join(parts)})))"


def named_turns(rows: DataFrame, staging: Staging) -> DataFrame:
    """``conv_id, pos, tid, bytes``: the turns in order, without their texts."""
    tid = _digest("encode(concat(octet_length(role), ':'), 'utf-8')", "encode(role, 'utf-8')", "encode(text, 'utf-8')")
    rows = rows.select("*", F.expr(tid).alias("tid"), F.octet_length("text").cast("bigint").alias("bytes"))
    return positions(rows, ["conv_id"], ["turn", "role", "text"], staging, keep=["tid", "bytes"])


def rebuild(named: DataFrame, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after the rebuild: ``conv_id, pos, tid, bytes`` and
    ``conv_id, n_turns``, the latter with every conversation.

    A conversation takes the first ``h`` turns of the one at the next lower multiple
    of ``EVERY`` and its own turns after its first ``h``."""
    named = staging.table(named, "turns")
    h = (F.crc32(F.col("conv_id").cast("string")) % HEAD).cast("int")
    heads = (named.where(F.col("pos") < HEAD - 1).groupBy("conv_id")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "tid", "bytes"))).alias("head")))     # at most HEAD - 1 turns
    # Every conversation has a first turn, so ``heads`` has every conversation once.
    every = heads.select("conv_id", (F.col("conv_id") - F.col("conv_id") % EVERY).alias("base"), h.alias("h"))
    taken = every.join(heads.select(F.col("conv_id").alias("base"), "head"), "base", "left")
    taken = staging.table(taken.select("conv_id", F.coalesce(F.expr("slice(head, 1, h)"), F.array().cast(heads.schema["head"].dataType)).alias("head"), "h"), "heads")
    first = taken.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.pos", "x.tid", "x.bytes")
    # Most conversations keep their positions; only those whose base is short move up.
    short = taken.where(F.size("head") < F.col("h")).select("conv_id", (F.size("head") - F.col("h")).alias("move"))
    own = named.where(F.col("pos") >= h).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("pos") + F.coalesce("move", F.lit(0))).alias("pos"), "tid", "bytes")
    built = staging.table(first.unionByName(own), "rebuilt")
    size = built.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    return built, taken.select("conv_id").join(size, "conv_id", "left").na.fill(0, ["n_turns"])


T, L = [f"t{i}" for i in range(BLOCK)], [f"l{i}" for i in range(BLOCK)]
SUMS = ["s0", "s1", "s2", "s3"]


def _pieces(block: str, tids: list[str]) -> list[str]:
    """Four 32-bit numbers that name a whole block of turns and its place."""
    d = f"md5(concat(encode(string({block}), 'utf-8'), {', '.join(tids)}))"
    return [f"bigint(conv(substring({d}, {8 * i + 1}, 8), 16, 10))" for i in range(4)]


def _node(block: str, sums: list[str]) -> str:
    """The name of the node where the blocks before ``block`` end."""
    return _digest(f"encode(concat_ws(',', string({block}), {', '.join(f'string({x})' for x in sums)}), 'utf-8')")


def blocks(built: DataFrame, conversations: DataFrame, staging: Staging) -> DataFrame:
    """One row per conversation and ``BLOCK`` turns: ``conv_id, block, node, s0..s3,
    before`` (bytes of the turns before), ``t0..t7, l0..l7, n, last``."""
    at, i = F.col("pos") % BLOCK, range(BLOCK)
    rows = built.withColumn("block", F.floor(F.col("pos") / BLOCK)).groupBy("conv_id", "block").agg(
        *[F.max(F.when(at == k, F.col("tid"))).alias(T[k]) for k in i], *[F.max(F.when(at == k, F.col("bytes"))).alias(L[k]) for k in i],
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("size"))
    # Every conversation's last block; one without turns gets an empty first block.
    ends = conversations.select("conv_id", F.floor((F.greatest("n_turns", F.lit(1)) - 1) / BLOCK).alias("block"), F.lit(True).alias("last"))
    rows = rows.join(ends, ["conv_id", "block"], "full").na.fill(0, ["n", "size"]).na.fill(False, ["last"])
    own = [F.expr(f"if(n = {BLOCK}, {p}, 0)").alias(f"own_{s}") for s, p in zip(SUMS, _pieces("block", T))]
    rows = staging.table(rows.select("*", *own, F.floor(F.col("block") / RUN).alias("run")), "blocks")
    # Sums before a block: those of the earlier runs, and those of its run.
    summed = {"own_" + s: s for s in SUMS} | {"size": "before"}
    runs = rows.where(F.col("run") > 0).select("conv_id").distinct()      # conversations with more than RUN blocks
    w = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = rows.join(runs, "conv_id", "left_semi").groupBy("conv_id", "run").agg(*[F.sum(c).alias(c) for c in summed])
    earlier = earlier.select("conv_id", "run", *[F.sum(c).over(w).alias(f"_{s}") for c, s in summed.items()]).where(F.col("run") > 0)
    w = Window.partitionBy("conv_id", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    out = rows.select("*", *[F.coalesce(F.sum(c).over(w), F.lit(0)).alias(s) for c, s in summed.items()]).join(earlier, ["conv_id", "run"], "left")
    out = out.select("conv_id", "block", "n", "last", *T, *L, *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in summed.values()])
    return staging.table(out.withColumn("node", F.expr(_node("block", SUMS))), "placed")


def _name(level: str) -> str:
    """The name of the node ``level`` turns into a block (columns of ``blocks``)."""
    inside = " ".join(f"WHEN {k} THEN {_digest('node', *T[:k])}" for k in range(1, BLOCK))
    whole = _node("block + 1", [f"({s} + {p})" for s, p in zip(SUMS, _pieces("block", T))])
    return f"CASE {level} WHEN 0 THEN node {inside} ELSE {whole} END"


def rolled(rows: DataFrame, extra: str = "") -> DataFrame:
    """Every node once: ``name, parent, depth, conv_id`` (smallest member), ``n_convs,
    bytes`` (of its last text), ``before`` (bytes of the turns before it) and the
    aggregates ``extra`` (``, 'name', aggregate ...``) over its members."""
    by = ", ".join(T)
    tops = ", ".join(f"max({c}) AS {c}" for c in [*L, *SUMS, "before"])
    case = lambda then: f"CASE level WHEN 0 THEN 0 {' '.join(f'WHEN {k} THEN {then(k)}' for k in range(1, BLOCK + 1))} END"
    # A turn that is not there gives a null column, no node; a block's level 0 is
    # the node that ended the block before, but for the first block, where it is the root.
    there = "CASE level WHEN 0 THEN block = 0 " + " ".join(f"WHEN {k} THEN {T[k - 1]} IS NOT NULL" for k in range(1, BLOCK + 1)) + " END"
    return rows.sparkSession.sql(f"""
        WITH made AS (
          SELECT block, node, {by}, CAST({BLOCK} - log2(grouping_id() + 1) AS INT) AS level, min(conv_id) AS conv_id, count(*) AS n_convs, {tops},
                 named_struct('none', 0 {extra}) AS extra
          FROM {{rows}} GROUP BY block, node, ROLLUP ({by}))
        SELECT {_name("level")} AS name, CASE WHEN level > 0 THEN {_name("level - 1")} END AS parent, block * {BLOCK} + level AS depth, conv_id, n_convs,
               {case(lambda k: L[k - 1])} AS bytes, before + {case(lambda k: " + ".join(["0", *L[:k - 1]]))} AS before, extra.*
        FROM made WHERE {there}""", rows=rows)


def end_hashes(ends: DataFrame) -> DataFrame:
    """``name, ends_sha256`` of ``(name, conv_id)``: the ids of a name, ascending and
    comma-joined, go into the hash as a stream; no list of them is held."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, None
        for batch in batches:
            names, shas = [], []
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != name:
                    if state is not None:
                        names.append(name)
                        shas.append(state.hexdigest())
                    name, state = n, hashlib.sha256(str(c).encode())
                else:
                    state.update(b",%d" % c)
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(shas, pa.string())], ["name", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["name", "ends_sha256"])

    rows = ends.select("name", "conv_id").repartition("name").sortWithinPartitions("name", "conv_id")
    return rows.mapInArrow(run, "name binary, ends_sha256 string")


def trie(built: DataFrame, conversations: DataFrame, staging: Staging) -> DataFrame:
    """One row per node of ``(conv_id, pos, tid, bytes)`` and ``(conv_id, n_turns)``."""
    rows = blocks(built, conversations, staging)
    nodes = staging.table(rolled(rows), "nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    children = staging.table(children, "children")
    # What each conversation owns: the bytes of its nodes, and whether one is a leaf.
    # An own table, read twice: a conversation is one row in it.
    owned = (nodes.join(children.select("name", F.lit(0).alias("leaf")), "name", "left")
             .groupBy("conv_id").agg(F.sum("bytes").alias("owned"), F.sum(F.coalesce("leaf", F.lit(1))).alias("leaves")))
    total = built.groupBy("conv_id").agg(F.sum("bytes").alias("total"))
    per = conversations.select("conv_id").join(owned, "conv_id", "left").join(total, "conv_id", "left").na.fill(0, ["owned", "leaves", "total"])
    weighed = rows.join(per, "conv_id")
    summed = rolled(weighed, """, 'all_owned', sum(owned), 'all_total', sum(total), 'n_leaves', sum(leaves),
        'owner', min(struct(conv_id, owned, total))""")
    ends = rows.where("last").select(F.expr(_name("n")).alias("name"), "conv_id")
    # The parent's smallest member: the own one, but where a member's own nodes begin.
    up = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = summed.join(children, "name", "left").join(end_hashes(ends), "name", "left").join(up, "parent", "left")
    others = F.col("all_owned") - F.col("owner.owned")
    path = F.col("owner.total") - F.col("before")
    saved = F.col("all_total") - F.col("n_convs") * F.col("before") - others - path
    empty = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
                      saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def rebuilt_trie(conversations: DataFrame, staging: Staging) -> DataFrame:
    """The trie of the rebuilt conversations: one row per node."""
    return trie(*rebuild(named_turns(turns(conversations), staging), staging), staging)


def conversation_trie(conversations: DataFrame, staging: Staging) -> DataFrame:
    """The trie of the conversations as they are: one row per node."""
    built = staging.table(named_turns(turns(conversations), staging), "turns")
    return trie(built, built.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns")), staging)
