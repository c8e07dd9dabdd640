"""DuckDB statements for the queries that SQL can express."""

from __future__ import annotations

from adtrail.llm import quality_rules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP5 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER (ORDER BY doc_id, text) AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) END) AS s FROM docs),
names AS (SELECT r, doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS name, s FROM sets),
one AS (SELECT name, any_value(n) AS n, any_value(s) AS s FROM names WHERE n > 0 GROUP BY name),
items AS (SELECT name, n, unnest(s) AS x FROM one),
links AS (
  SELECT a.name AS a, b.name AS b FROM items a JOIN items b ON a.x = b.x AND a.name <> b.name
  GROUP BY a.name, b.name HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
least_id AS (SELECT name, min(doc_id) AS d FROM names WHERE n > 0 GROUP BY name),
reach AS (
  SELECT name AS start, name AS at FROM least_id
  UNION SELECT reach.start, links.b FROM reach JOIN links ON reach.at = links.a),
component AS (SELECT start, min(d) AS component_id FROM reach JOIN least_id ON reach.at = least_id.name GROUP BY start)
SELECT doc_id, n AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id
FROM names LEFT JOIN component ON names.name = component.start
"""


def _op8() -> str:
    rules = quality_rules.RULES
    q, delta = quality_rules.ALPHA / len(rules), quality_rules.DELTA
    each = " UNION ALL ".join(f"SELECT stratum, '{r}' AS rule, {r} AS value FROM good" for r in rules)
    pivot = ", ".join(f"min(cutoff) FILTER (rule = '{r}') AS max_{r}" for r in rules)
    ok = " AND ".join(f"coalesce({r} <= max_{r}, true)" for r in rules)
    share = lambda a, b: f"CAST(CASE WHEN {b} > 0 THEN least(1000, {a} * 1000 // {b}) ELSE 0 END AS INTEGER)"
    return rf"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, 'none') AS stratum, coalesce(text, '') AS t, {_WORDS} AS w
  FROM documents),
grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM w)),
found AS (SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM found, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w),
base AS (
  SELECT w.r, doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(t, '[^A-Z!]', '', 'g')) AS BIGINT) AS n_shouts,
    len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM w JOIN lines ON w.r = lines.r LEFT JOIN covered ON w.r = covered.r),
feats AS (
  SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    {share("n_symbols", "word_chars")} AS symbol_share, {share("n_dup_lines", "n_lines")} AS dup_line_share,
    {share("n_repeat_words", "n_words")} AS repeat_share, {share("n_shouts", "word_chars")} AS shout_share,
    CAST(CASE WHEN n_words > 0 THEN least(1000, word_chars * 25 // n_words) ELSE 0 END AS INTEGER) AS word_length
  FROM base),
good AS (
  SELECT * FROM feats WHERE NOT base_failed AND doc_id IN (
    SELECT doc_id FROM labels GROUP BY doc_id HAVING min(coalesce(quality, 0)) = 1)),
vals AS ({each}),
cuts AS (SELECT DISTINCT stratum, rule, value AS cutoff FROM vals),
lost AS (
  SELECT c.stratum, c.rule, c.cutoff, count(*) AS n, count(*) FILTER (v.value > c.cutoff) AS k
  FROM cuts c JOIN vals v ON c.stratum = v.stratum AND c.rule = v.rule GROUP BY ALL),
tested AS (
  SELECT *, CASE WHEN k >= n * {q!r} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
      exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({q!r}) + (n - i) * ln(1 - {q!r})))) END AS p FROM lost),
limits AS (
  SELECT stratum, {pivot} FROM tested
  WHERE p <= {delta!r} / ({len(rules)} * (SELECT count(DISTINCT stratum) FROM vals)) GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {ok} AS kept, {", ".join(rules)}
FROM feats LEFT JOIN limits USING (stratum)
"""


OP10 = r"""
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


# CRC-32 of an ASCII string, bit by bit.
def _crc32(text: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::UBIGINT)), "
            "lambda acc, b: list_reduce([xor(acc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384::UBIGINT * (x & 1)))), 4294967295)")


OP13 = rf"""
WITH own AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
lists AS (
  SELECT c, list({{'r': role, 't': text}} ORDER BY turn NULLS FIRST, role, text) AS l, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM own GROUP BY c),
built AS (
  SELECT a.c, list_concat(CASE WHEN b.l IS NULL THEN [] ELSE b.l[1:a.h] END, a.l[a.h + 1:]) AS l
  FROM lists a LEFT JOIN lists b ON b.c = a.c - a.c % 5),
prefixes AS (
  SELECT c, d, sha256(CAST(l[1:d] AS VARCHAR) || '/' || CAST(d AS VARCHAR)) AS name, CASE WHEN d > 0 THEN sha256(CAST(l[1:d-1] AS VARCHAR) || '/' || CAST(d - 1 AS VARCHAR)) END AS parent,
         CASE WHEN d > 0 THEN strlen(l[d].t) ELSE 0 END AS bytes, len(l) = d AS ends
  FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM built)),
nodes AS (
  SELECT name, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '') AS ends
  FROM prefixes GROUP BY name),
children AS (SELECT parent AS name, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT DISTINCT a.name, b.name AS under FROM prefixes a JOIN prefixes b ON a.c = b.c AND b.d >= a.d),
subtree AS (
  SELECT below.name, count(*) FILTER (children.n IS NULL) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved
  FROM below JOIN nodes u ON u.name = below.under LEFT JOIN children ON children.name = below.under GROUP BY below.name)
SELECT nodes.conv_id, CAST(nodes.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, nodes.n_convs, coalesce(children.n, 0) AS n_children,
       subtree.n_leaves, CAST(subtree.saved AS BIGINT) AS saved_tokens, sha256(nodes.ends) AS ends_sha256
FROM nodes JOIN subtree USING (name) LEFT JOIN children USING (name) LEFT JOIN nodes up ON up.name = nodes.parent
"""


def _op11() -> str:
    """Cheapest edits by backward relaxation: per row (last first) and state the least
    (cost, audit) with its text, inserts up to two in a row (more never pay)."""
    add = lambda x, cost, letter, text: (
        f"{{'k': lpad(CAST(CAST({x}.k[1:9] AS INTEGER) + {cost} AS VARCHAR), 9, '0') || '{letter}' || {x}.k[10:], 't': {text} || {x}.t}}")
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    end = {"e": (0, "", "''"), "s": (10, "II", f"{user} || {assistant}"), "u": (5, "I", assistant), "a": (0, "", "''")}
    first = ", ".join(f"{{'k': '{c:09d}{k}', 't': {t}}} AS {q}" for q, (c, k, t) in end.items())
    # Without inserts: delete, keep (per legal initial), rerole.
    legal = {"e": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    plain = []
    for q, to in legal.items():
        ways = [add(f"b.{q}", 2, "D", "''")]
        keep = " ".join(f"WHEN r.role[1:1] = '{i}' THEN {add(f'b.{n}', 'r.more', 'K', 'chr(10) || r.role || chr(58) || r.text')}" for i, n in to.items())
        want = "a" if q == "u" else "u"
        full = assistant if want == "a" else user
        ways.append(f"CASE WHEN r.fault IN ('blank', 'duplicate') THEN NULL {keep} END")
        ways.append(f"CASE WHEN r.fault NOT IN ('blank', 'duplicate') THEN {add(f'b.{want}', '1 + r.more', 'R', f'{full} || r.text')} END")
        plain.append(f"list_min([{', '.join(ways)}]) AS {q}")
    ui, ai = add("w.u", 5, "I", user), add("w.a", 5, "I", assistant)
    two = add("w.a", 10, "II", f"{user} || {assistant}")
    close = f"list_min([w.e, {ui}, {two}]) AS e, list_min([w.s, {ui}, {two}]) AS s, list_min([w.u, {ai}]) AS u, list_min([w.a, {ui}]) AS a"
    crc = _crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")
    white = r"'^[\x20\x09-\x0D]*|[\x20\x09-\x0D]*$'"
    return rf"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS f FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN f = 1 THEN '' WHEN f = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(CASE WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM marked WHERE f <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged),
faults AS (
  SELECT *, regexp_replace(text, {white}, '', 'g') AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
named AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faults),
r AS (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more FROM named),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before[1:1] || role[1:1] NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM r GROUP BY conv_id),
b AS (
  SELECT conv_id, n AS i, {first} FROM counts
  UNION ALL
  SELECT w.conv_id, w.i - 1, {close}
  FROM (SELECT b.conv_id, b.i, {", ".join(plain)} FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i) w),
done AS (SELECT * FROM b WHERE i = 0)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(CAST(done.e.k[1:9] AS INTEGER), 0) AS BIGINT) AS cost, coalesce(done.e.k[10:], '') AS audit,
  sha256(coalesce(done.e.t[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


ORACLE = {"op5_shingle_join": OP5, "op8_quality_rules": _op8(), "op10_pivot_search": OP10,
          "op11_conversation_repair": _op11(), "op13_conversation_trie": OP13}
