"""Operator 12: personal data, and the terms around it that would give it away.

*Entities.*  E-mail addresses, IP addresses, card and phone numbers are found by fixed
patterns (leftmost, non-overlapping per kind; a match that fails its check is dropped).
An entity is a kind and a value: letters in lower case, of cards and phones the digits.

*Disclosure.*  Texts are cut into contexts of ``CONTEXT`` words.  Corpus counts give how
much a term tells about an entity: its pointwise mutual information with the entity, as
a share of the entity's information content,

    disclosure(e, t) = log(n(e,t) N / (n(e) n(t))) / log(N / n(e)),

1 where the term stands nowhere else.  ``n(t)`` and ``N`` count all contexts of all
texts; ``n(e)`` and ``n(e,t)`` count different contexts only (by digest), so copies of
one passage are no evidence.  A term of at least ``SUPPORT`` such contexts whose
disclosure reaches ``SHARE`` reveals the entity: removing the entity alone would not
hide it.  In a text that mentions the entity, every place of a revealing term that
stands in a context of the entity is a span of kind ``term``.  Texts without entities are left alone.

*Sanitisation.*  Entities are replaced by their kind.  A revealing term is generalised to
its class (number, code, word) if the class itself does not reveal the entity by the
same measure, else removed.

On Spark: one pass over the texts writes a row per text (its entities, the terms of their
contexts and their places) and the term counts, added up per task and batch.  The rest
joins and aggregates these narrow rows: an entity or term with a third of all rows is
combined before the shuffle.  Nothing that grows is collected or broadcast.

Names: terms, entities and contexts by 64-bit digests.

Defined results: null text = empty text: no spans, zero counts, the empty string's hash.
Texts are whole, however long; all patterns are searched in linear time.  An empty table
gives no rows.  Repeated rows give repeated results.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.llm import words as W
from adtrail.staging import Staging

CONTEXT = 32        # words of a context
SUPPORT = 5         # different contexts of an entity that a revealing term stands in
SHARE = 0.9         # of the entity's information
KINDS = ("email", "ip", "card", "phone")
CLASSES = ("number", "code", "word")
# Words of the terms: everything but ASCII characters that are no letter or digit.
OUTSIDE = np.zeros(256, dtype=bool)
OUTSIDE[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True
_WAITING = 1_500_000      # counted terms held by a task at a time

# ------------------------------------------------------------------ the patterns
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_NUMBER = re.compile(r"[0-9]+(?:[\x20-][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY_DIGIT = re.compile("[0-9]")
_NO_DIGITS = re.compile("[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Places of ``local@domain``.  The local part is read backwards from each ``@`` (up to
    the last place found or the ``@`` before), so no run is read twice."""
    out, done, seen = [], 0, 0
    for m in _DOMAIN.finditer(text):
        # Between two domains other @ may stand; a local part never crosses one.
        at = m.start()
        low = max(done, text.rfind("@", seen, at) + 1)
        back = _LOCAL_BACK.match(text[low:at][::-1])
        if back:
            out.append((at - back.end(), m.end()))
            done = m.end()
        seen = at
    return out


def addresses(text: str) -> list[tuple[int, int]]:
    """Places of four dotted numbers up to 255; a longer run is cut into fours."""
    out = []
    for m in _DOTTED.finditer(text):
        parts = m[0].split(".")
        if len(parts) < 4:
            continue
        at = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _NUMBER.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGITS.sub("", m[0])) <= 15]


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in ``KINDS``, then start."""
    out = [("email", *x) for x in emails(text)] if "@" in text else []
    if _ANY_DIGIT.search(text):
        out += [("ip", *x) for x in addresses(text)]
        out += [("card", *x) for x in cards(text)]
        if "+" in text:
            out += [("phone", *x) for x in phones(text)]
    return out


def _digest(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=8).digest(), "little", signed=True)


def _entity(kind: str, value: str) -> int:
    return _digest(f"{kind}:{_NO_DIGITS.sub('', value) if kind in ('card', 'phone') else value.lower()}")


# ------------------------------------------------------------------ one pass over the texts
_ROW = ("row bigint, {key}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base string, "
        "contexts array<struct<entity:bigint,context:bigint,term:bigint>>, places array<struct<term:bigint,kind:int,start:bigint,stop:bigint>>, "
        "term bigint, n bigint, marked binary")
_CONTEXT = pa.struct([("entity", pa.int64()), ("context", pa.int64()), ("term", pa.int64())])
_PLACE = pa.struct([("term", pa.int64()), ("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])


def _classes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each word's place in ``CLASSES``."""
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    n = digits[ends] - digits[starts]
    return np.where(n == ends - starts, 0, np.where(n > 0, 1, 2))


def _around(text: str, found: list, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, terms: np.ndarray, kinds: np.ndarray) -> tuple[list, list]:
    """(contexts, places) of one text's entities; ``starts`` and ``ends`` are bytes of the text."""
    if not len(starts):
        return [], []
    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])         # code points before a byte
    lo, hi = points[starts], points[ends]
    edges = np.zeros(points[-1] + 1, np.int64)
    for _, a, b in found:
        edges[a] += 1
        edges[b] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edges) > 0)])
    free = covered[hi] == covered[lo]                                          # not a part of an entity
    contexts, named = set(), {}
    for kind, a, b in found:
        c = min(int(np.searchsorted(hi, a, side="right")), len(lo) - 1) // CONTEXT
        if c not in named:
            x, y = c * CONTEXT, min((c + 1) * CONTEXT, len(lo))
            mine = np.flatnonzero(free[x:y]) + x
            named[c] = (_digest(text[lo[x]:hi[y - 1]]), {*terms[mine].tolist(), *kinds[mine].tolist()})
        name, members = named[c]
        e = _entity(kind, text[a:b])
        contexts.add((e, name, None))
        contexts.update((e, name, t) for t in members)
    wanted = np.array(sorted({t for _, members in named.values() for t in members}), np.int64)
    at = np.flatnonzero(free & np.isin(terms, wanted))
    places = [{"term": int(t), "kind": int(k), "start": int(a), "stop": int(b)} for t, k, a, b in zip(terms[at], kinds[at], lo[at], hi[at])]
    return [{"entity": e, "context": c, "term": t} for e, c, t in sorted(contexts, key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0))], places


def scanned(docs: DataFrame, staging: Staging, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Two sorts of rows, staged: a row per text with ``row`` (its entities, the terms of their
    contexts and these terms' places), and ``term, n`` (contexts it stands in; null: contexts)."""
    one = docs.select(docs[key].alias("__key"), docs[text].cast("string").alias("__text"))
    kind = one.schema["__key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, row, key_type = TaskContext.get().partitionId(), 0, None
        held_terms, held_counts, held, n_contexts = [], [], 0, 0

        def counted(terms, n):
            nulls = [pa.nulls(len(n), t) for t in (pa.int64(), key_type, *[pa.int64()] * 4, pa.string(), pa.list_(_CONTEXT), pa.list_(_PLACE))]
            return pa.RecordBatch.from_arrays([*nulls, terms, n, pa.nulls(len(n), pa.binary())], names)

        def merged():
            names_, where = np.unique(np.concatenate(held_terms), return_inverse=True)
            return names_, np.bincount(where, np.concatenate(held_counts), len(names_)).astype(np.int64)

        names = ["row", "__key", *[f"n_{k}" for k in KINDS], "base", "contexts", "places", "term", "n", "marked"]
        for batch in batches:
            key_type = batch.schema.field(0).type
            for t in W.texts(batch.column(1)):
                low = W.LOWER[t.data]
                starts, ends, first = W.spans(t, OUTSIDE)
                terms = W.hashes(low, starts, ends).view(np.int64)
                kinds = _classes(t.data, starts, ends)
                owner = W.row_of(first)
                # Contexts are numbered through the slice; a term counts once in each.
                per = -(-np.diff(first) // CONTEXT)
                base = np.concatenate([[0], np.cumsum(per)])
                context = base[owner] + (np.arange(len(starts)) - first[owner]) // CONTEXT
                for some in (terms, kinds):
                    order = np.argsort(some, kind="stable")       # contexts ascend already
                    a, b = some[order], context[order]
                    new = np.ones(len(a), bool)
                    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                    each, n = np.unique(a[new], return_counts=True)
                    held_terms.append(each)
                    held_counts.append(n)
                    held += len(each)
                n_contexts += int(base[-1])
                if held > _WAITING:
                    each, n = merged()
                    yield counted(pa.array(each, pa.int64()), pa.array(n))
                    held_terms, held_counts, held = [], [], 0
                out = []
                raw = t.data.tobytes()
                for i in range(t.rows):
                    x, y = t.offsets[i], t.offsets[i + 1]
                    body = raw[x:y].decode()
                    found = entities(body)
                    n = [sum(k == f[0] for f in found) for k in KINDS]
                    contexts, places, mark = [], [], None
                    if found:
                        a, b = first[i], first[i + 1]
                        contexts, places = _around(body, found, t.data[x:y], starts[a:b] - x, ends[a:b] - x, terms[a:b], kinds[a:b])
                        mark = hashlib.md5(raw[x:y]).digest()
                    out.append(((task << 40) + row, *n, ",".join(f"{k}:{a}:{b}" for k, a, b in found), contexts, places, mark))
                    row += 1
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), batch.column(0).slice(t.first, t.rows), *[pa.array(c, pa.int64()) for c in cols[1:5]], pa.array(cols[5], pa.string()),
                     pa.array(cols[6], pa.list_(_CONTEXT)), pa.array(cols[7], pa.list_(_PLACE)), pa.nulls(t.rows, pa.int64()), pa.nulls(t.rows, pa.int64()),
                     pa.array(cols[8], pa.binary())], names)
        if held_terms:
            each, n = merged()
            yield counted(pa.array(each, pa.int64()), pa.array(n))
            yield counted(pa.nulls(1, pa.int64()), pa.array([n_contexts], pa.int64()))

    return staging.table(one.mapInArrow(run, _ROW.format(key=f"__key {kind}")), "scanned")


# ------------------------------------------------------------------ disclosure
def revealing(found: DataFrame, staging: Staging, share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """``entity, term, disclosure, general``: the terms (and classes, below ``len(CLASSES)``) that
    reveal an entity; ``general``: the term's class does not."""
    pairs = found.where(F.size("contexts") > 0).select(F.explode("contexts").alias("x")).select("x.*").distinct()
    joint = staging.table(pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("both")), "pairs")
    own = joint.where(F.col("term").isNull()).select("entity", F.col("both").alias("of_entity"))
    counts = found.where(F.col("row").isNull()).groupBy("term").agg(F.sum("n").alias("of_term"))
    total = found.where(F.col("row").isNull() & F.col("term").isNull()).agg(F.sum("n")).first()[0]
    enough = joint.where(F.col("term").isNotNull() & (F.col("both") >= support))
    told = enough.join(own, "entity").join(counts, "term")
    alone = F.lit(float(total or 0)) / F.col("of_entity")
    told = told.withColumn("disclosure", F.log(F.col("both") * alone / F.col("of_term")) / F.log(F.greatest(alone, F.lit(1.0 + 1e-9))))
    return told.where(F.col("disclosure") >= share).select("entity", "term", "disclosure")


def term_spans(found: DataFrame, staging: Staging, share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """``row, start, stop, class, general``: the places of revealing terms."""
    told = staging.table(revealing(found, staging, share, support), "revealing")
    classes = told.where(F.col("term").between(0, len(CLASSES) - 1)).select("entity", F.col("term").alias("class"), F.lit(False).alias("plain"))
    here = found.where(F.size("contexts") > 0)
    near = here.select("row", F.explode("contexts").alias("x")).select("row", "x.entity", "x.term").distinct()
    hits = near.join(told.where(~F.col("term").between(0, len(CLASSES) - 1)), ["entity", "term"]).select("row", "entity", "term")
    places = here.select("row", F.explode("places").alias("x")).select("row", "x.term", F.col("x.kind").alias("class"), "x.start", "x.stop")
    spans = hits.join(places, ["row", "term"]).join(classes, ["entity", "class"], "left")
    # A term that reveals two entities is generalised only if its class reveals neither.
    return spans.groupBy("row", "start", "stop", "class").agg(F.min(F.coalesce("plain", F.lit(True))).alias("general"))


def personal_data(docs: DataFrame, staging: Staging, text: str = "text", key: str = "doc_id", share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """One row per text: its counts per kind, ``base_sha256``, ``spans`` and ``n_terms``."""
    found = scanned(docs, staging, text, key)
    spans = term_spans(found, staging, share, support)
    listed = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("terms"))       # places in one text
    out = found.where(F.col("row").isNotNull()).select("row", F.col("__key").alias("key"), *[f"n_{k}" for k in KINDS], "base").join(listed, "row", "left")
    terms = F.transform("terms", lambda x: F.concat_ws(":", F.lit("term"), x["start"], x["stop"]))
    spans = F.concat_ws(",", F.when(F.col("base") != "", F.array("base")), terms)
    return out.select(F.col("key").alias(key), *[f"n_{k}" for k in KINDS], F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"),
                      F.when(F.col("terms").isNull(), 0).otherwise(F.size("terms")).cast("bigint").alias("n_terms"))


def sanitised(docs: DataFrame, staging: Staging, text: str = "text", share: float = SHARE, support: int = SUPPORT) -> DataFrame:
    """``docs`` with ``text`` sanitised: entities as ``[kind]``, revealing terms as ``[class]`` or removed."""
    found = scanned(docs, staging, text, docs.columns[0])
    terms = term_spans(found, staging, share, support).select("row", "start", "stop", F.when(
        F.col("general"), F.element_at(F.array(*[F.lit(c) for c in CLASSES]), F.col("class") + 1)).alias("becomes"))
    base = (found.where(F.col("base") != "").select("row", F.explode(F.split("base", ",")).alias("x")).select("row", F.split("x", ":").alias("x"))
            .select("row", F.col("x")[1].cast("bigint").alias("start"), F.col("x")[2].cast("bigint").alias("stop"), F.col("x")[0].alias("becomes")))
    edits = base.unionByName(terms).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "stop", "becomes"))).alias("__edits"))
    # Spans depend on the text alone: equal texts share them.
    per = edits.join(found.select("row", F.col("marked").alias("__mark")), "row").groupBy("__mark").agg(F.first("__edits").alias("__edits"))
    names = docs.columns
    marked = docs.withColumn("__mark", F.unhex(F.md5(F.encode(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), "utf-8"))))
    joined = marked.join(per, "__mark", "left").select(*[F.col(f"`{n}`") for n in names], "__edits")
    at, schema = names.index(text), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if e is None else apply_edits(t, e) for t, e in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist())]
            columns = [batch.column(i) for i in range(len(names))]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, schema)


def apply_edits(text: str, edits: list[dict]) -> str:
    """The text with its spans replaced; of overlapping spans the first (then the shorter) stands,
    and what another covers beyond it goes too."""
    out, done = [], 0
    for e in edits:
        if e["start"] >= done:
            out.append(text[done:e["start"]])
            out.append("" if e["becomes"] is None else f"[{e['becomes']}]")
        done = max(done, e["stop"])
    return "".join([*out, text[done:]])
