"""The wide event fact (``dwd_ads_event_inc``): one DataFrame plan.

    coarse log ──┬─> 4 rule key sets (shuffles on (key, ad, t); skew-safe) ─┐
                 └─> + region (bucketed range join, broadcast ranges)        │
                     + agent info (distinct agents: UA rules + crawler pairs) │
                     + is_invalid_traffic  <──────────────────────────────────┘
                     + ads dim + platform dim  -> 25 columns (+ dt)

Every side joined onto the log is either a reference table or the product of
an aggregation; each is size-checked and broadcast when within the bound, so
in the common case the log itself is never shuffled for the joins.  Sides over
the bound fall back to shuffle joins (AQE splits skewed partitions).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.operators.crawler import agent_patterns
from adtrail.operators.flags import KEYS, RuleParams, join_flags, prepare_flagged, key_rules
from adtrail.operators.geo import attach_region, prepare_ranges
from adtrail.operators.ua import parse_agents
from adtrail.plans.broadcast import bounded
from adtrail.schemas import FACT_COLUMNS
from adtrail.staging import Staging, session_scope


def agent_info(log: DataFrame, ua_rules, crawler, crawler_mode: str = "fanout",
               ua_col: str = "client_ua") -> DataFrame:
    """One row per (distinct agent, matching crawler pattern):
    ``(_agent, ua_struct, crawler_pattern)``; or, with ``crawler_mode='flag'``,
    one row per agent with ``is_crawler``."""
    agents = log.select(F.col(ua_col).alias("_agent")).where(F.col("_agent").isNotNull()).distinct()
    parsed = parse_agents(agents.where(F.col("_agent") != ""), ua_rules, "_agent")
    info = agents.join(parsed, "_agent", "left")
    if crawler is None:
        return info
    pairs = agent_patterns(log, crawler, ua_col).withColumnRenamed("pattern", "crawler_pattern")
    if crawler_mode == "flag":
        hits = pairs.select("_agent").distinct().withColumn("is_crawler", F.lit(True))
        return (info.join(hits, "_agent", "left")
                .withColumn("is_crawler", F.coalesce(F.col("is_crawler"), F.lit(False))))
    return info.join(pairs, "_agent", "left")


def used(dim: DataFrame, key: str, log: DataFrame, column: str) -> DataFrame:
    """The dimension's rows that the log can meet: what is broadcast to every task is
    bounded by the values in the log, not only by the dimension's size."""
    found = log.select(F.col(column).alias("_used")).where(F.col("_used").isNotNull()).distinct()
    return dim.join(found, F.col(key) == F.col("_used"), "left_semi")


def enrich(log: DataFrame, ads_dim: DataFrame, platform_dim: DataFrame, ranges: DataFrame,
           ua_rules, crawler, params: RuleParams = RuleParams(), crawler_mode: str = "fanout",
           max_rows: int | None = None, stage_log: bool = True, scope: Staging | None = None) -> DataFrame:
    """Coarse log -> every fact input column joined on (before projection).

    With ``stage_log`` the coarse log is written once as a columnar table in
    the shared folder (like the warehouse's temporary table): the four rules
    and the enrichment read pruned columns of it instead of parsing URLs five
    times, and lineage is cut there.  The two dimensions are then cut to the
    rows whose keys are in the log (two more reads of one column each).

    The sides joined onto the log are prepared (computed, staged, measured)
    first.  They do not depend on each other, so their jobs are submitted
    together from a small thread pool and overlap on the cluster; the joins
    themselves are then one map-side pass over the log.
    """
    scope = scope or session_scope(log.sparkSession)
    if stage_log:
        log = scope.table(log, "coarse_log")
    ads = ads_dim.select(F.col("ad_id").alias("_ad_id"), "ad_name", "product_id", "product_name",
                         "product_price", "material_id", "material_url", "group_id")
    plat = platform_dim.select(F.col("id").alias("platform_id"), F.col("platform_name_en").alias("_pne"),
                               "platform_name_zh")
    if stage_log:
        ads, plat = used(ads, "_ad_id", log, "ad_id"), used(plat, "_pne", log, "platform_name_en")
    tasks = {
        "region": lambda: prepare_ranges(ranges, max_rows=max_rows),
        "info": lambda: bounded(agent_info(log, ua_rules, crawler, crawler_mode), max_rows, stage=scope),
        "ads": lambda: bounded(ads, max_rows, stage=scope),       # staged: measured and joined, computed once
        "plat": lambda: bounded(plat, max_rows, stage=scope),
    }
    # Keys are de-duplicated once, in the flagged-key table.
    with ThreadPoolExecutor(max_workers=len(tasks) + len(KEYS)) as pool:
        found = [pool.submit(key_rules, log, key, params, False, scope) for key in KEYS]
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        flags = prepare_flagged({rule: df for f in found for rule, df in f.result().items()}, scope)
        side = {k: f.result() for k, f in futures.items()} | {"flags": flags}

    x = attach_region(log, ranges, "client_ip", prepared=side["region"])
    info = side["info"][0]
    x = x.join(info, x["client_ua"] == info["_agent"], "left").drop("_agent")
    x = join_flags(x, *side["flags"], max_rows)
    a = side["ads"][0]
    x = x.join(a, x["ad_id"] == a["_ad_id"], "left")
    p = side["plat"][0]
    x = x.join(p, x["platform_name_en"] == p["_pne"], "left")
    return x


def project_fact(x: DataFrame, keep_dt: bool = True) -> DataFrame:
    ua = F.col("ua_struct")
    region = F.col("region_struct")
    cols = [
        F.col("event_time").cast("bigint").alias("event_time"),
        F.col("event_type"),
        F.col("ad_id"),
        F.col("ad_name"),
        F.col("product_id").alias("ad_product_id"),
        F.col("product_name").alias("ad_product_name"),
        F.col("product_price").cast("string").alias("ad_product_price"),
        F.col("material_id").alias("ad_material_id"),
        F.col("material_url").alias("ad_material_url"),
        F.col("group_id").alias("ad_group_id"),
        F.col("platform_id"),
        F.col("platform_name_en"),
        F.col("platform_name_zh"),
        region["country"].alias("client_country"),
        region["area"].alias("client_area"),
        region["province"].alias("client_province"),
        region["city"].alias("client_city"),
        F.col("client_ip"),
        F.col("client_device_id"),
        F.when(F.col("client_os_type") != "", F.col("client_os_type")).otherwise(ua["os"]).alias("client_os_type"),
        F.coalesce(ua["osVersion"], F.lit("")).alias("client_os_version"),
        F.coalesce(ua["browser"], F.lit("")).alias("client_browser_type"),
        F.coalesce(ua["browserVersion"], F.lit("")).alias("client_browser_version"),
        F.col("client_ua").alias("client_user_agent"),
        F.col("is_invalid_traffic"),
    ]
    if "is_crawler" in x.columns:          # crawler_mode="flag": one row per event, flag kept
        cols.append(F.col("is_crawler"))
    if keep_dt and "dt" in x.columns:
        cols.append(F.col("dt"))
    out = x.select(*cols)
    assert tuple(out.columns[:len(FACT_COLUMNS)]) == FACT_COLUMNS
    return out


def build_event_fact(log: DataFrame, ads_dim: DataFrame, platform_dim: DataFrame, ranges: DataFrame,
                     ua_rules, crawler, params: RuleParams = RuleParams(), crawler_mode: str = "fanout",
                     keep_dt: bool = True, max_rows: int | None = None, stage_log: bool = True,
                     scope: Staging | None = None) -> DataFrame:
    """The 25-column fact from the coarse (parsed) log.  ``crawler_mode``:
    ``fanout`` (one row per matching crawler pattern, the warehouse behaviour)
    or ``flag`` (no fan-out; an ``is_crawler`` column follows the 25 columns)."""
    x = enrich(log, ads_dim, platform_dim, ranges, ua_rules, crawler, params, crawler_mode, max_rows,
               stage_log, scope)
    return project_fact(x, keep_dt)
