"""Schemas of every layer (ODS text, DIM, DWD, reference tables).

Text layers have no header, so column order is the contract.  Field comments
are kept in the field metadata.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


S = T.StringType()

# ---------------------------------------------------------------- ODS (text)
ODS_ADS_INFO = T.StructType([
    _f("id", S, "ad id"), _f("product_id", S, "product id"), _f("material_id", S, "material id"),
    _f("group_id", S, "ad group id"), _f("ad_name", S, "ad name"), _f("material_url", S, "material url"),
])
ODS_PLATFORM_INFO = T.StructType([
    _f("id", S, "platform id"), _f("platform_name_en", S, "platform name (en)"),
    _f("platform_name_zh", S, "platform name (zh)"),
])
ODS_PRODUCT_INFO = T.StructType([
    _f("id", S, "product id"), _f("name", S, "product name"),
    _f("price", T.DecimalType(16, 2), "product price"),
])
ODS_ADS_PLATFORM = T.StructType([
    _f("id", S), _f("ad_id", S), _f("platform_id", S), _f("create_time", S), _f("cancel_time", S),
])
ODS_SERVER_HOST = T.StructType([_f("id", S), _f("ipv4", S)])
ODS_AD_LOG = T.StructType([
    _f("time_local", S, "time the log server received the request"),
    _f("request_method", S, "HTTP method"), _f("request_uri", S, "request path and query"),
    _f("status", S, "response status"), _f("server_addr", S, "log server ip"),
])

ODS_TABLES = {
    "ods_ads_info_full": ODS_ADS_INFO,
    "ods_platform_info_full": ODS_PLATFORM_INFO,
    "ods_product_info_full": ODS_PRODUCT_INFO,
    "ods_ads_platform_full": ODS_ADS_PLATFORM,
    "ods_server_host_full": ODS_SERVER_HOST,
    "ods_ad_log_inc": ODS_AD_LOG,
}

CRAWLER_JSON = T.StructType([
    _f("pattern", S, "regular expression"), _f("addition_date", S, "date added"),
    _f("url", S, "crawler homepage"), _f("instances", T.ArrayType(S), "UA examples"),
])

# ---------------------------------------------------------------- reference tables
IP_RANGES = T.StructType([
    _f("start_ip", T.LongType()), _f("end_ip", T.LongType()),
    _f("country", S), _f("area", S), _f("province", S), _f("city", S), _f("isp", S),
])
UA_RULES = T.StructType([
    _f("attribute", S), _f("priority", T.IntegerType()), _f("pattern", S),
    _f("value", S), _f("version_pattern", S),
])

REGION_STRUCT = T.StructType([_f(n, S) for n in ("country", "area", "province", "city", "isp")])
UA_STRUCT = T.StructType([
    _f("browser", S), _f("browserVersion", S), _f("engine", S), _f("engineVersion", S),
    _f("os", S), _f("osVersion", S), _f("platform", S), _f("isMobile", T.BooleanType()),
])

# ---------------------------------------------------------------- parsed log
PARSED_LOG_COLUMNS = ("event_time", "event_type", "ad_id", "client_ip", "platform_name_en",
                      "client_ua", "client_os_type", "client_device_id")

# ---------------------------------------------------------------- DIM
DIM_ADS_INFO = T.StructType([
    _f("ad_id", S), _f("ad_name", S), _f("product_id", S), _f("product_name", S),
    _f("product_price", T.DecimalType(16, 2)), _f("material_id", S), _f("material_url", S),
    _f("group_id", S),
])
DIM_PLATFORM_INFO = T.StructType([_f("id", S), _f("platform_name_en", S), _f("platform_name_zh", S)])
DIM_CRAWLER_UA = T.StructType([
    _f("pattern", S), _f("addition_date", S), _f("url", S), _f("instance", T.ArrayType(S)),
])

# ---------------------------------------------------------------- DWD
DWD_ADS_EVENT = T.StructType(
    [_f("event_time", T.LongType(), "event time, epoch ms")]
    + [_f(n, S) for n in (
        "event_type", "ad_id", "ad_name", "ad_product_id", "ad_product_name", "ad_product_price",
        "ad_material_id", "ad_material_url", "ad_group_id", "platform_id", "platform_name_en",
        "platform_name_zh", "client_country", "client_area", "client_province", "client_city",
        "client_ip", "client_device_id", "client_os_type", "client_os_version",
        "client_browser_type", "client_browser_version", "client_user_agent")]
    + [_f("is_invalid_traffic", T.BooleanType(), "invalid traffic flag")]
)
FACT_COLUMNS = tuple(f.name for f in DWD_ADS_EVENT.fields)
