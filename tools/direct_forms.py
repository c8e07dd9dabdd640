"""Direct window forms of the rules: one window per (key, ad) over the raw rows.

For tests and benchmarks only; the library always runs the bounded plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.functions.url import valid_event_time


def _source(log: DataFrame, key: str, ad: str, t: str, exclude_empty: bool) -> DataFrame:
    src = log.select(F.col(key).alias("key"), F.col(ad).alias("ad"), valid_event_time(F.col(t).cast("bigint")).alias("t"))
    return src.where(F.col("key") != "") if exclude_empty else src


def high_frequency_keys_direct(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
                               window_ms: int = 300_000, threshold: int = 100, exclude_empty: bool = False) -> DataFrame:
    src = _source(log, key, ad, t, exclude_empty)
    w = Window.partitionBy("key", "ad").orderBy("t").rangeBetween(-window_ms, 0)
    hit = src.withColumn("cnt", F.count(F.lit(1)).over(w)).where(F.col("cnt") > threshold)
    return hit.select(F.col("key").alias(key)).distinct()


def cycle_islands_direct(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
                         dedup: bool = True, lead_default: int | None = 0) -> DataFrame:
    """Reference form: lag / lead / running sum over whole (key, ad) groups."""
    src = _source(log, key, ad, t, False).where(F.col("t").isNotNull())
    if dedup:
        src = src.distinct()
    w = Window.partitionBy("ad", "key").orderBy("t")
    w2 = Window.partitionBy("ad", "key").orderBy(F.col("t"), F.col("time_diff").desc())
    lead = (F.lead("time_diff", 1).over(w2) if lead_default is None
            else F.lead("time_diff", 1, lead_default).over(w2))
    x = (src.withColumn("time_diff", F.col("t") - F.lag("t", 1, 0).over(w))
         .withColumn("tag", F.when(F.col("time_diff") - lead != 0, 1).otherwise(0))
         .withColumn("sum_tag", F.sum("tag").over(w)))
    return x.groupBy("key", "ad", "sum_tag").agg(F.count(F.lit(1)).alias("n"))


def cycle_keys_direct(log: DataFrame, key: str, threshold: int, dedup: bool = True, lead_default: int | None = 0) -> DataFrame:
    isl = cycle_islands_direct(log, key, dedup=dedup, lead_default=lead_default)
    return isl.where(F.col("n") > threshold).select(F.col("key").alias(key)).distinct()
