"""Request-log parsing: coarse parse (URL fields) and the fine parse (geo + UA)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.fixed import PATH_EVENT_TYPE_INDEX, PATH_PLATFORM_INDEX
from adtrail.functions.url import absolute_url, decode, pair_value, query_pairs, split_element, to_bigint, url_part, valid_event_time
from adtrail.staging import Staging


def parse_log(log: DataFrame, uri_col: str = "request_uri", keep: tuple[str, ...] = ("dt",)) -> DataFrame:
    """Coarse parse of ``request_uri`` into the event columns.

    ``event_time`` is cast to bigint once, here (NULL when ``t`` is not a
    number or outside the valid domain); ``client_ua`` is URL-decoded.  Malformed URLs give NULL fields and
    the row is kept.  Columns named in ``keep`` that exist are passed through.
    """
    url = absolute_url(F.col(uri_col))
    passthrough = [F.col(c) for c in keep if c in log.columns]
    # The URL is parsed twice per row (query, path) instead of once per field;
    # the key values come from the query with parse_url's own key rule.
    parts = log.select(query_pairs(url_part(url, "QUERY")).alias("_q"), url_part(url, "PATH").alias("_p"), *passthrough)
    q, p = F.col("_q"), F.col("_p")
    cols = [
        valid_event_time(to_bigint(pair_value(q, "t"))).alias("event_time"),
        split_element(p, PATH_EVENT_TYPE_INDEX).alias("event_type"),
        pair_value(q, "id").alias("ad_id"),
        pair_value(q, "ip").alias("client_ip"),
        split_element(p, PATH_PLATFORM_INDEX).alias("platform_name_en"),
        decode(pair_value(q, "ua")).alias("client_ua"),
        pair_value(q, "os_type").alias("client_os_type"),
        pair_value(q, "device_id").alias("client_device_id"),
    ]
    return parts.select(*cols, *passthrough)


def fine_log(parsed: DataFrame, ranges: DataFrame, rules, max_rows: int | None = None,
             scope: Staging | None = None) -> DataFrame:
    """Coarse log + ``region_struct`` (IP range lookup) + ``ua_struct`` (UA rules;
    NULL when the agent is empty or NULL)."""
    from adtrail.operators.geo import attach_region
    from adtrail.operators.ua import attach_ua_struct

    with_region = attach_region(parsed, ranges, ip_col="client_ip", max_rows=max_rows)
    return attach_ua_struct(with_region, rules, "client_ua", max_rows, scope)
