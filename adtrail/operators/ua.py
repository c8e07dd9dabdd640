"""User-agent parsing with a rule table, run on distinct agents.

The rule table has one row per (attribute, priority, pattern, value,
version_pattern).  For every attribute the matching rule with the lowest
priority wins; the version is ``regexp_extract(ua, version_pattern, 1)``.
Agents matching no rule of an attribute get ``Unknown`` and a NULL version.

The agents are deduplicated first (one regex pass per distinct agent, not per
event).  A short rule list is a parameter of the job: each attribute is one
``CASE`` chain of literal patterns, compiled once per task, and a chain stops at
its first match.  A rule table of any length is joined by a literal index
(:mod:`adtrail.operators.literals`), and the first match by priority is an
aggregate, so the plan does not grow with the rules.
The result is joined back on the agent string.  The rule table below is ours:
the third-party library the warehouse used is not part of it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.operators.literals import matches
from adtrail.plans.broadcast import join_small
from adtrail.schemas import UA_RULES
from adtrail.staging import Staging, session_scope

UNKNOWN = "Unknown"

# --- fixed values: our UA rule table (attribute, priority, pattern, value, version_pattern)
# Patterns use the syntax common to Java regex and RE2.
UA_RULE_ROWS = [
    ("browser", 1, "Edg/", "MSEdge", "Edg/([0-9.]+)"),
    ("browser", 2, "OPR/", "Opera", "OPR/([0-9.]+)"),
    ("browser", 3, "Googlebot", "Googlebot", "Googlebot/([0-9.]+)"),
    ("browser", 4, "Baiduspider", "Baiduspider", "Baiduspider/([0-9.]+)"),
    ("browser", 5, "Chrome/", "Chrome", "Chrome/([0-9.]+)"),
    ("browser", 6, "Firefox/", "Firefox", "Firefox/([0-9.]+)"),
    ("browser", 7, "Version/[0-9.]+.*Safari/", "Safari", "Version/([0-9.]+)"),
    ("browser", 8, "MSIE |Trident/", "MSIE", "MSIE ([0-9.]+)"),
    ("engine", 1, "Trident/", "Trident", "Trident/([0-9.]+)"),
    ("engine", 2, "AppleWebKit/", "Webkit", "AppleWebKit/([0-9.]+)"),
    ("engine", 3, "Gecko/", "Gecko", "rv:([0-9.]+)"),
    ("os", 1, "Windows NT", "Windows", "Windows NT ([0-9.]+)"),
    ("os", 2, "iPhone OS", "iPhone", "iPhone OS ([0-9_]+)"),
    ("os", 3, "Android", "Android", "Android ([0-9.]+)"),
    ("os", 4, "Mac OS X", "OSX", "Mac OS X ([0-9_.]+)"),
    ("os", 5, "Linux", "Linux", None),
    ("platform", 1, "iPhone", "iPhone", None),
    ("platform", 2, "iPad", "iPad", None),
    ("platform", 3, "Android", "Android", None),
    ("platform", 4, "Windows", "Windows", None),
    ("platform", 5, "Macintosh", "Mac", None),
    ("platform", 6, "Linux", "Linux", None),
    ("mobile", 1, "Mobile|Android|iPhone|iPad", "true", None),
]

ATTRIBUTES = ("browser", "engine", "os", "platform", "mobile")


def default_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(UA_RULE_ROWS, UA_RULES)


def _chain(rules: list[tuple], ua: Column, result, default) -> Column:
    """The first matching rule's result."""
    out = None
    for r in rules:
        out = (F if out is None else out).when(ua.rlike(r[2]), result(r))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def parse_agents(agents: DataFrame, rules: DataFrame | Iterable[tuple], ua_col: str = "ua") -> DataFrame:
    """Distinct agents -> ``(ua_col, ua_struct)``."""
    if isinstance(rules, DataFrame):
        return _parse_by_table(agents, rules, ua_col)
    by: dict[str, list[tuple]] = {a: [] for a in ATTRIBUTES}
    for r in sorted(rules, key=lambda r: (r[0], r[1])):
        if r[0] in by:
            by[r[0]].append(r)
    ua = F.col(ua_col)
    no_version = F.lit(None).cast("string")

    def name(a: str) -> Column:
        return _chain(by[a], ua, lambda r: F.lit(r[3]), UNKNOWN)

    def version(a: str) -> Column:
        return _chain(by[a], ua, lambda r: F.regexp_extract(ua, r[4], 1) if r[4] else no_version, None).cast("string")

    st = F.struct(
        name("browser").alias("browser"), version("browser").alias("browserVersion"),
        name("engine").alias("engine"), version("engine").alias("engineVersion"),
        name("os").alias("os"), version("os").alias("osVersion"),
        name("platform").alias("platform"),
        (_chain(by["mobile"], ua, lambda r: F.lit(r[3]), "false") == "true").alias("isMobile"),
    )
    return agents.select(ua_col, st.alias("ua_struct"))


def _parse_by_table(agents: DataFrame, rules: DataFrame, ua_col: str) -> DataFrame:
    """The same from a rule table; of two rules with one priority the lesser pattern wins."""
    agents = session_scope(agents.sparkSession).table(agents.select(ua_col), "agents")
    rules = rules.select("attribute", "priority", "pattern", "value", "version_pattern").where(F.col("attribute").isin(*ATTRIBUTES))
    won = (matches(agents, rules, ua_col).join(rules, "pattern").groupBy(ua_col, "attribute")
           .agg(F.min_by(F.struct("value", "version_pattern"), F.struct("priority", "pattern")).alias("rule")))
    version = F.when(F.col("rule.version_pattern") != "", F.expr(f"regexp_extract(`{ua_col}`, rule.version_pattern, 1)"))
    won = won.select(ua_col, "attribute", F.col("rule.value").alias("value"), version.alias("version"))
    of = lambda a, c: F.max(F.when(F.col("attribute") == a, F.col(c)))
    found = won.groupBy(ua_col).agg(*[of(a, "value").alias(f"_{a}") for a in ATTRIBUTES], *[of(a, "version").alias(f"_{a}_v") for a in ("browser", "engine", "os")])
    name = lambda a: F.coalesce(f"_{a}", F.lit(UNKNOWN)).alias(a)
    st = F.struct(name("browser"), F.col("_browser_v").alias("browserVersion"), name("engine"), F.col("_engine_v").alias("engineVersion"),
                  name("os"), F.col("_os_v").alias("osVersion"), name("platform"),
                  (F.coalesce("_mobile", F.lit("false")) == "true").alias("isMobile"))
    return agents.join(found, ua_col, "left").select(ua_col, st.alias("ua_struct"))


def distinct_agents(df: DataFrame, ua_col: str = "client_ua") -> DataFrame:
    """Non-empty agents, once each (``''`` and NULL parse to a NULL struct)."""
    return df.select(F.col(ua_col).alias("_agent")).where(F.col("_agent") != "").distinct()


def attach_ua_struct(df: DataFrame, rules: DataFrame | Iterable[tuple], ua_col: str = "client_ua",
                     max_rows: int | None = None, scope: Staging | None = None) -> DataFrame:
    parsed = parse_agents(distinct_agents(df, ua_col), rules, "_agent")
    joined = join_small(df, parsed, (ua_col, "_agent"), "left", max_rows, stage=scope or session_scope(df.sparkSession))
    return joined.drop("_agent")
