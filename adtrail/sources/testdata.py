"""Adapter: warehouse inputs derived from the driver's tables.

The driver gives TPC-H-like tables plus an ``events`` table.  This module
derives, identically in Spark (DataFrame functions) and DuckDB (SQL strings,
used only by the oracle), the inputs the warehouse expects:

* the raw request log (``ods_ad_log_inc`` shape) from ``events``
* ads (``ods_ads_info_full``) from ``part``; products from ``supplier``;
  platforms from ``customer``
* IP ranges from ``nation`` x ``region``

Every derivation is a plain projection of whole tables, so its work grows
with the data.  The log's query string is built from the event like this:

====================  ==============================================
path                  ``/ad/<platform>/<event_type>``; platform is
                      ``p<event_id % 150>``, or ``unknown`` when
                      ``event_id % 13 = 0`` (no platform match)
``t``                 epoch ms of ``ts`` (clock ``ms``; of the day of ``ts``
                      for ``user_id % 4 = 1``, so equal gaps occur) or of
                      the day (clock ``day``); absent when ``event_id % 23
                      = 5``; the smallest bigint, the largest, or -1 when
                      ``event_id % 97`` is 7, 8 or 9
``id``                ``user_id % 7 * 5 + <event type index>``; the key
                      is absent when ``event_id % 17 = 0``
``ip``                ``10.<user_id % 256>.<user_id div 256>.1``;
                      ``10.300.<user_id>.1`` (malformed) when
                      ``user_id % 50 = 48``; absent when ``event_id % 101 = 0``
``ua``                one of six encoded agents by ``event_id % 8``;
                      6 gives ``ua=`` (empty), 7 leaves the key out
``os_type``           ``''`` / ``android`` / absent by ``event_id % 3``
``device_id``         ``''`` when ``user_id % 10 = 0``, else ``d<user_id>``
====================  ==============================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.sources.text import spread  # noqa: F401  (re-exported for callers)

# --- fixed values: encoded user agents used by the adapter -------------------
ENCODED_AGENTS = (
    "Mozilla%2F5.0+%28Windows+NT+10.0%3B+Win64%3B+x64%29+AppleWebKit%2F537.36+%28KHTML%2C+like+Gecko%29+Chrome%2F120.0.0.0+Safari%2F537.36",
    "Mozilla%2F5.0+%28compatible%3B+Googlebot%2F2.1%3B+%2Bhttp%3A%2F%2Fwww.google.com%2Fbot.html%29",
    "Mozilla%2F5.0+%28iPhone%3B+CPU+iPhone+OS+17_1+like+Mac+OS+X%29+AppleWebKit%2F605.1.15+%28KHTML%2C+like+Gecko%29+Version%2F17.1+Mobile%2F15E148+Safari%2F604.1",
    "Mozilla%2F5.0+%28Linux%3B+Android+13%3B+Pixel+7%29+AppleWebKit%2F537.36+%28KHTML%2C+like+Gecko%29+Chrome%2F119.0.6045.163+Mobile+Safari%2F537.36",
    "Mozilla%2F5.0+%28Macintosh%3B+Intel+Mac+OS+X+10.15%3B+rv%3A121.0%29+Gecko%2F20100101+Firefox%2F121.0",
    "Mozilla%2F5.0+%28compatible%3B+Baiduspider%2F2.0%3B+%2Bhttp%3A%2F%2Fwww.baidu.com%2Fsearch%2Fspider.html%29",
)
EVENT_TYPES = ("view", "click", "error", "purchase", "signup")
# Times that no event has, by ``event_id % 97``.
HOSTILE_TIMES = ((7, "-9223372036854775808"), (8, "9223372036854775807"), (9, "-1"))
# First address of the derived IP space: 10.0.0.0
IP_BASE = 167772160
# Each nation owns eight /16 blocks.
BLOCKS_PER_NATION = 8

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_ms(ts: Column) -> Column:
    # timestamp_ntz arithmetic: independent of the session time zone
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def _event_type_index(c: Column) -> Column:
    expr = None
    for i, name in enumerate(EVENT_TYPES):
        expr = F.when(c == name, F.lit(i)) if expr is None else expr.when(c == name, F.lit(i))
    return expr


def request_log(events: DataFrame, clock: str = "ms") -> DataFrame:
    """``ods_ad_log_inc`` rows (+ ``dt``) from ``events``."""
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    coarse = F.lit(True) if clock == "day" else uid % 4 == 1
    t = F.when(coarse, _epoch_ms(F.date_trunc("DAY", ts))).otherwise(_epoch_ms(ts)).cast("string")
    for rest, hostile in HOSTILE_TIMES:
        t = F.when(eid % 97 == rest, F.lit(hostile)).otherwise(t)
    platform = F.when(eid % 13 == 0, F.lit("unknown")).otherwise(F.concat(F.lit("p"), (eid % 150).cast("string")))
    ad = ((uid % 7) * 5 + _event_type_index(F.col("event_type"))).cast("string")
    ip = F.when(uid % 50 == 48, F.concat(F.lit("10.300."), uid.cast("string"), F.lit(".1"))) \
        .otherwise(F.concat(F.lit("10."), (uid % 256).cast("string"), F.lit("."),
                            F.expr("user_id div 256").cast("string"), F.lit(".1")))
    ua_sel = eid % 8
    ua = F.lit(None).cast("string")
    for i, a in enumerate(ENCODED_AGENTS):
        ua = F.when(ua_sel == i, F.lit(a)).otherwise(ua)
    ua = F.when(ua_sel == 6, F.lit("")).otherwise(ua)
    os_sel = eid % 3
    os_type = F.when(os_sel == 0, F.lit("")).when(os_sel == 1, F.lit("android"))
    device = F.when(uid % 10 == 0, F.lit("")).otherwise(F.concat(F.lit("d"), uid.cast("string")))

    def kv(key: str, val: Column, absent: Column | None = None) -> Column:
        pair = F.concat(F.lit(key + "="), val)
        return pair if absent is None else F.when(~absent, pair)

    query = F.concat_ws(
        "&",
        kv("t", t, eid % 23 == 5),
        kv("id", ad, eid % 17 == 0),
        kv("ip", ip, eid % 101 == 0),
        kv("ua", ua),
        kv("os_type", os_type),
        kv("device_id", device),
    )
    uri = F.concat(F.lit("/ad/"), platform, F.lit("/"), F.col("event_type"), F.lit("?"), query)
    return events.select(
        ts.cast("string").alias("time_local"),
        F.lit("GET").alias("request_method"),
        uri.alias("request_uri"),
        F.lit("200").alias("status"),
        F.concat(F.lit("192.168.1."), (eid % 3 + 1).cast("string")).alias("server_addr"),
        ts.cast("date").cast("string").alias("dt"),
    )


def ads_info(part: DataFrame) -> DataFrame:
    """``ods_ads_info_full`` rows from ``part``."""
    k = F.col("p_partkey")
    return part.select(
        k.cast("string").alias("id"),
        (k % 103).cast("string").alias("product_id"),
        F.col("p_size").cast("string").alias("material_id"),
        F.col("p_brand").alias("group_id"),
        F.col("p_name").alias("ad_name"),
        F.concat(F.lit("http://img.example.com/"), F.lower(F.col("p_type")), F.lit("/"),
                 k.cast("string"), F.lit(".jpg")).alias("material_url"),
    )


def product_info(supplier: DataFrame) -> DataFrame:
    """``ods_product_info_full`` rows from ``supplier``."""
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.col("s_name").alias("name"),
        F.col("s_acctbal").cast("decimal(16,2)").alias("price"),
    )


def platform_info(customer: DataFrame) -> DataFrame:
    """``ods_platform_info_full`` rows from ``customer``."""
    k = F.col("c_custkey")
    return customer.select(
        k.cast("string").alias("id"),
        F.concat(F.lit("p"), k.cast("string")).alias("platform_name_en"),
        F.concat(F.col("c_mktsegment"), F.lit("-"), F.col("c_name")).alias("platform_name_zh"),
    )


def ip_ranges(nation: DataFrame, region: DataFrame) -> DataFrame:
    """IP range table: nation k owns 10.(8k).0.0 - 10.(8k+7).255.255."""
    width = BLOCKS_PER_NATION * 65536
    k = F.col("n_nationkey").cast("bigint")
    start = F.lit(IP_BASE) + k * width
    return (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(start.alias("start_ip"), (start + width - 1).alias("end_ip"),
                    F.col("n_name").alias("country"), F.col("r_name").alias("area"),
                    F.concat(F.lit("province-"), k.cast("string")).alias("province"),
                    F.concat(F.lit("city-"), k.cast("string")).alias("city"),
                    F.concat(F.lit("isp-"), (k % 3).cast("string")).alias("isp")))


# ----------------------------------------------------------------- DuckDB side
def _duck_case(sel: str, values: tuple[str, ...]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {sel} {whens} END"


def request_log_sql(clock: str = "ms") -> str:
    """DuckDB SQL equal to :func:`request_log` (for the oracle)."""
    coarse = "true" if clock == "day" else "user_id % 4 = 1"
    hostile = " ".join(f"WHEN event_id % 97 = {r} THEN '{v}'" for r, v in HOSTILE_TIMES)
    t = (f"CASE {hostile} WHEN {coarse} THEN CAST(epoch_us(date_trunc('day', ts)) // 1000 AS VARCHAR) "
         "ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END")
    type_idx = "CASE event_type " + " ".join(
        f"WHEN '{n}' THEN {i}" for i, n in enumerate(EVENT_TYPES)) + " END"
    ua = f"CASE WHEN event_id % 8 = 6 THEN '' ELSE {_duck_case('event_id % 8', ENCODED_AGENTS)} END"
    return f"""
SELECT CAST(ts AS VARCHAR) AS time_local, 'GET' AS request_method,
       '/ad/' || CASE WHEN event_id % 13 = 0 THEN 'unknown' ELSE 'p' || CAST(event_id % 150 AS VARCHAR) END
       || '/' || event_type || '?' || concat_ws('&',
            CASE WHEN event_id % 23 = 5 THEN NULL ELSE 't=' || ({t}) END,
            CASE WHEN event_id % 17 = 0 THEN NULL ELSE 'id=' || CAST(user_id % 7 * 5 + {type_idx} AS VARCHAR) END,
            CASE WHEN event_id % 101 = 0 THEN NULL
                 WHEN user_id % 50 = 48 THEN 'ip=10.300.' || CAST(user_id AS VARCHAR) || '.1'
                 ELSE 'ip=10.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(user_id // 256 AS VARCHAR) || '.1' END,
            'ua=' || ({ua}),
            'os_type=' || (CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'android' END),
            'device_id=' || (CASE WHEN user_id % 10 = 0 THEN '' ELSE 'd' || CAST(user_id AS VARCHAR) END)
       ) AS request_uri,
       '200' AS status, '192.168.1.' || CAST(event_id % 3 + 1 AS VARCHAR) AS server_addr,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS dt
FROM events"""


ADS_INFO_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_partkey % 103 AS VARCHAR) AS product_id,
       CAST(p_size AS VARCHAR) AS material_id, p_brand AS group_id, p_name AS ad_name,
       'http://img.example.com/' || lower(p_type) || '/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS material_url
FROM part"""

PRODUCT_INFO_SQL = """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CAST(s_acctbal AS DECIMAL(16,2)) AS price
FROM supplier"""

PLATFORM_INFO_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, 'p' || CAST(c_custkey AS VARCHAR) AS platform_name_en,
       c_mktsegment || '-' || c_name AS platform_name_zh
FROM customer"""

IP_RANGES_SQL = f"""
SELECT {IP_BASE} + CAST(n_nationkey AS BIGINT) * {BLOCKS_PER_NATION * 65536} AS start_ip,
       {IP_BASE} + CAST(n_nationkey AS BIGINT) * {BLOCKS_PER_NATION * 65536} + {BLOCKS_PER_NATION * 65536 - 1} AS end_ip,
       n_name AS country, r_name AS area, 'province-' || CAST(n_nationkey AS VARCHAR) AS province,
       'city-' || CAST(n_nationkey AS VARCHAR) AS city, 'isp-' || CAST(n_nationkey % 3 AS VARCHAR) AS isp
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""
