"""Invalid-traffic flag: the event's IP or device is in any of the four rule sets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.fixed import (CYCLE_DEVICE_THRESHOLD, CYCLE_IP_THRESHOLD, FREQUENCY_THRESHOLD,
                           FREQUENCY_WINDOW_MS)
from adtrail.operators import traffic
from adtrail.plans.broadcast import join_small, measure
from adtrail.staging import Staging, session_scope

@dataclass(frozen=True)
class RuleParams:
    frequency_window_ms: int = FREQUENCY_WINDOW_MS
    frequency_threshold: int = FREQUENCY_THRESHOLD
    cycle_ip_threshold: int = CYCLE_IP_THRESHOLD
    cycle_device_threshold: int = CYCLE_DEVICE_THRESHOLD
    # Where events without a time stand in the fixed-period rules; None: nowhere.
    cycle_null_time: int | None = None


RULES = ("high_frequency_ip", "high_frequency_device", "cycle_ip", "cycle_device")
KEYS = {"client_ip": ("high_frequency_ip", "cycle_ip"), "client_device_id": ("high_frequency_device", "cycle_device")}


def rule_sets(log: DataFrame, p: RuleParams = RuleParams(), distinct: bool = True,
              scope: Staging | None = None) -> dict[str, DataFrame]:
    """The four key sets, computed from the coarse log (``distinct=False``
    leaves duplicates for a caller that de-duplicates their union)."""
    scope = scope or session_scope(log.sparkSession)
    found = {}
    for key in KEYS:
        found |= key_rules(log, key, p, distinct, scope)
    return {rule: found[rule] for rule in RULES}


def key_rules(log: DataFrame, key: str, p: RuleParams = RuleParams(), distinct: bool = True,
              scope: Staging | None = None) -> dict[str, DataFrame]:
    """The two key sets of one key column, from one count per exact timestamp.

    The count is staged (a row per timestamp of a group that a rule may flag):
    the log is filtered and shuffled once per key column."""
    scope = scope or session_scope(log.sparkSession)
    least = min(p.frequency_threshold, p.cycle_ip_threshold if key == "client_ip" else p.cycle_device_threshold) + 1
    counts = scope.table(traffic.timestamp_counts(log, key, min_events=least), "timestamp_counts")
    tasks = traffic.count_tasks(counts)
    return {rule: rule_set(log, rule, p, distinct, counts, tasks) for rule in KEYS[key]}


def rule_set(log: DataFrame, rule: str, p: RuleParams = RuleParams(), distinct: bool = True,
             counts: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """One of the four key sets; ``counts``: its key column's staged counts, if at hand, and ``tasks`` for their sorts."""
    w, th, kw = p.frequency_window_ms, p.frequency_threshold, {"distinct": distinct, "counts": counts, "tasks": tasks}
    if rule == "high_frequency_ip":
        return traffic.high_frequency_ip(log, w, th, **kw)
    if rule == "high_frequency_device":
        return traffic.high_frequency_device(log, w, th, **kw)
    kw["null_time"] = p.cycle_null_time
    if rule == "cycle_ip":
        return traffic.cycle_ip(log, p.cycle_ip_threshold, **kw)
    return traffic.cycle_device(log, p.cycle_device_threshold, **kw)


def flag_reasons(sets: dict[str, DataFrame]) -> DataFrame:
    """``(key_type, key, rule)``: which rule flagged which key."""
    parts = []
    for rule, df in sets.items():
        kt = "client_ip" if rule.endswith("_ip") else "client_device_id"
        parts.append(df.select(F.lit(kt).alias("key_type"), F.col(kt).alias("key"), F.lit(rule).alias("rule")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def flagged_table(sets: dict[str, DataFrame]) -> DataFrame:
    """``(key_type, key)``: every flagged IP and device once.  NULL keys never
    match a join, so they are dropped here."""
    return (flag_reasons(sets).where(F.col("key").isNotNull())
            .select("key_type", "key").distinct())


def prepare_flagged(sets: dict[str, DataFrame], scope: Staging | None = None) -> tuple[DataFrame, tuple[int, int]]:
    """The four rule outputs computed in one job and written once as a small
    table (lineage cut), with its measured (rows, bytes)."""
    flagged = flagged_table(sets)
    flagged = (scope or session_scope(flagged.sparkSession)).table(flagged, "flagged_keys")
    return flagged, measure(flagged)


def join_flags(df: DataFrame, flagged: DataFrame, size: tuple[int, int],
               max_rows: int | None = None) -> DataFrame:
    """``df`` + ``is_invalid_traffic`` from a prepared flagged-key table: the IP
    and device parts are joined on (broadcast within the bound).  Distinct
    keys: no fan-out."""
    ips = (flagged.where(F.col("key_type") == "client_ip")
           .select(F.col("key").alias("_fip"), F.lit(True).alias("_ip_hit")))
    devices = (flagged.where(F.col("key_type") == "client_device_id")
               .select(F.col("key").alias("_fdev"), F.lit(True).alias("_dev_hit")))
    out = join_small(df, ips, ("client_ip", "_fip"), "left", max_rows, known=size)
    out = join_small(out, devices, ("client_device_id", "_fdev"), "left", max_rows, known=size)
    flag = F.coalesce(F.col("_ip_hit"), F.col("_dev_hit"), F.lit(False))
    return out.withColumn("is_invalid_traffic", flag).drop("_fip", "_ip_hit", "_fdev", "_dev_hit")


def attach_invalid_flag(df: DataFrame, sets: dict[str, DataFrame], max_rows: int | None = None,
                        scope: Staging | None = None) -> DataFrame:
    """``df`` + ``is_invalid_traffic``: the event's IP or device is in any of
    the four key sets."""
    flagged, size = prepare_flagged(sets, scope)
    return join_flags(df, flagged, size, max_rows)
