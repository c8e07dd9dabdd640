"""Dimension builds: ads (ads x product), platform, crawler user agents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.plans.broadcast import join_small


def _day(df: DataFrame, dt: str | None) -> DataFrame:
    # Partition equality: prunes directories when df is a dt-partitioned scan.
    if dt is None or "dt" not in df.columns:
        return df
    return df.where(F.col("dt") == F.lit(dt))


def dim_ads(ads: DataFrame, products: DataFrame, dt: str | None = None,
            max_rows: int | None = None) -> DataFrame:
    """Ads LEFT JOIN product on ``product_id = id``, both pruned to the day first."""
    a = _day(ads, dt).select("id", "ad_name", "product_id", "material_id", "material_url", "group_id")
    p = _day(products, dt).select(F.col("id").alias("_pid"), F.col("name").alias("product_name"),
                                  F.col("price").cast("decimal(16,2)").alias("product_price"))
    j = join_small(a, p, ("product_id", "_pid"), "left", max_rows)
    return j.select(F.col("id").alias("ad_id"), "ad_name", "product_id", "product_name", "product_price",
                    "material_id", "material_url", "group_id")


def dim_platform(platforms: DataFrame, dt: str | None = None) -> DataFrame:
    return _day(platforms, dt).select("id", "platform_name_en", "platform_name_zh")


def dim_crawler(raw: DataFrame) -> DataFrame:
    """``select *`` with a positional rename: ``instances`` becomes ``instance``."""
    return raw.toDF("pattern", "addition_date", "url", "instance")
