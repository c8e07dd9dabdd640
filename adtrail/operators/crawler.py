"""Crawler user-agent match (a regex theta join).

``log LEFT JOIN crawler ON client_ua rlike pattern`` gives one output row per
matching pattern (and one row with NULL pattern columns when none matches).
The patterns are a short list, a parameter of the job (then every pattern is a
literal of the plan, and the distinct agents are matched in one projection), or
a table of any length, which is joined by a literal index
(:mod:`adtrail.operators.literals`).  The (agent, pattern) pairs are joined back
on the agent string, which keeps the multiplicity.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.operators.literals import matches
from adtrail.plans.broadcast import join_small
from adtrail.schemas import CRAWLER_JSON
from adtrail.staging import Staging, session_scope

# --- fixed values: sample crawler patterns used by the queries ---------------
CRAWLER_ROWS = [
    ("Googlebot", "2024-01-01", "http://www.google.com/bot.html",
     ["Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)"]),
    ("bot", "2024-01-01", None, []),
    ("[Ss]pider", "2024-01-02", None, ["Baiduspider/2.0"]),
    ("curl/", "2024-01-03", "https://curl.se", ["curl/8.4.0"]),
]


def default_patterns(spark: SparkSession) -> DataFrame:
    """Crawler dimension rows (``instance`` column) from the sample list."""
    raw = spark.createDataFrame(CRAWLER_ROWS, CRAWLER_JSON)
    return raw.select("pattern", "addition_date", "url", F.col("instances").alias("instance"))


def agent_patterns(df: DataFrame, patterns: DataFrame | Iterable[str], ua_col: str = "client_ua",
                   scope: Staging | None = None) -> DataFrame:
    """``(_agent, pattern)`` for every distinct non-NULL agent and every pattern it matches;
    a pattern that is given several times matches as often."""
    agents = df.select(F.col(ua_col).alias("_agent")).where(F.col("_agent").isNotNull()).distinct()
    if isinstance(patterns, DataFrame):
        agents = (scope or session_scope(df.sparkSession)).table(agents, "agents")
        times = patterns.groupBy("pattern").agg(F.count(F.lit(1)).cast("int").alias("_times"))
        return (matches(agents, patterns).join(times, "pattern")
                .select("_agent", F.explode(F.array_repeat("pattern", F.col("_times"))).alias("pattern")))
    hits = [F.when(F.col("_agent").rlike(p), F.lit(p)) for p in sorted(patterns)]
    found = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return agents.select("_agent", F.explode(found).alias("pattern"))


def crawler_match(df: DataFrame, patterns: DataFrame | Iterable[str], ua_col: str = "client_ua",
                  max_rows: int | None = None, scope: Staging | None = None) -> DataFrame:
    """Fan-out form: ``df`` + ``crawler_pattern``, one row per matching pattern."""
    scope = scope or session_scope(df.sparkSession)
    pairs = agent_patterns(df, patterns, ua_col, scope).withColumnRenamed("pattern", "crawler_pattern")
    out = join_small(df, pairs, (ua_col, "_agent"), "left", max_rows, stage=scope)
    return out.drop("_agent")


def crawler_flag(df: DataFrame, patterns: DataFrame | Iterable[str], ua_col: str = "client_ua",
                 max_rows: int | None = None, scope: Staging | None = None) -> DataFrame:
    """No fan-out form: ``df`` + ``is_crawler``."""
    scope = scope or session_scope(df.sparkSession)
    hits = agent_patterns(df, patterns, ua_col, scope).select("_agent").distinct().withColumn("is_crawler", F.lit(True))
    out = join_small(df, hits, (ua_col, "_agent"), "left", max_rows, stage=scope)
    return out.withColumn("is_crawler", F.coalesce(F.col("is_crawler"), F.lit(False))).drop("_agent")


def crawler_match_naive(df: DataFrame, patterns: DataFrame, ua_col: str = "client_ua") -> DataFrame:
    """Reference form: every row against every pattern; for tests and benchmarks."""
    p = F.broadcast(patterns.select(F.col("pattern").alias("crawler_pattern")))
    return df.join(p, F.expr(f"{ua_col} rlike crawler_pattern"), "left")
