"""A literal index for regular expressions kept in a table.

``agent rlike pattern`` against a table of patterns is a theta join.  Most
patterns contain characters that every match must hold; their 3-grams are an
index: a pattern is met only with the agents that hold its rarest 3-gram (an
equi-join), and the expression is tried on those.  Patterns without such
characters (alternatives, classes only, fewer than three characters) are tried
on every distinct agent.  Neither table is collected, and none has a cap.

What a match must hold is told conservatively: escapes, classes, groups,
quantified characters, dots and anchors end a piece; a pattern with flags,
look-around, quoted parts, numeric escapes, unusual classes or a top-level
alternative has no pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3
_SEP = "\x01"
_UNSURE = r"\(\?|\\[xucpPNkQE0-9]|\[[^\]]*\[|\[\^?\]|\\[\[\]()|]|&&"
_QUANTITY = r"(?:[?*+]|\{[^}]*\})?[?+]?"
_CUTS = (r"\\.", rf"\[[^\]]*\]{_QUANTITY}", rf"\([^()]*\){_QUANTITY}", rf"\([^()]*\){_QUANTITY}", r".(?:[?*]|\{[^}]*\})[?+]?", r"[.^$+]")


def required_pieces(pattern: str | Column) -> Column:
    """Strings that every match of the pattern holds (empty array: none known)."""
    p = F.col(pattern) if isinstance(pattern, str) else pattern
    x = p
    for cut in _CUTS:
        x = F.regexp_replace(x, cut, _SEP)
    sure = ~p.rlike(_UNSURE) & ~x.rlike(r"[|()\[\]{}]")
    return F.when(sure, F.array_remove(F.split(x, _SEP), "")).otherwise(F.array().cast("array<string>"))


def grams(text: Column) -> Column:
    """The distinct 3-grams of a string."""
    return F.when(F.length(text) >= GRAM, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (GRAM - 1)), lambda i: F.substring(text, i, F.lit(GRAM))))).otherwise(F.array().cast("array<string>"))


def matches(agents: DataFrame, patterns: DataFrame, agent: str = "_agent", pattern: str = "pattern") -> DataFrame:
    """``(agent, pattern)``: every distinct pattern with every agent it is found in.  ``agents``
    are distinct and staged (they are read several times); NULL matches nothing."""
    every = patterns.select(pattern).where(F.col(pattern).isNotNull()).distinct()
    needed = every.select(pattern, F.array_distinct(F.flatten(F.transform(required_pieces(pattern), grams))).alias("_needed"))
    indexed = needed.where(F.size("_needed") > 0).select(pattern, F.explode("_needed").alias("_gram"))
    held = agents.select(agent, F.explode(grams(F.col(agent))).alias("_gram"))
    often = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # The rarest 3-gram; one that no agent holds ends the pattern's search.
    rarest = (indexed.join(often, "_gram", "left").groupBy(pattern)
              .agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram")))
    tried = F.expr(f"`{agent}` rlike `{pattern}`")
    found = held.join(rarest, "_gram").where(tried).select(agent, pattern)
    rest = needed.where(F.size("_needed") == 0).select(pattern)
    return found.unionByName(agents.select(agent).join(rest, tried).select(agent, pattern))
