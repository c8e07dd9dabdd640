"""Column expressions built from native Spark functions."""

from adtrail.functions.ip import ip_bucket, ipv4_to_long, long_to_ipv4, region_split
from adtrail.functions.types import apply_ingest_types, warehouse_type, warehouse_type_name
from adtrail.functions.url import (absolute_url, decode, path_element, pair_value, query_pairs, query_param,
                                   split_element, to_bigint, url_part)

__all__ = [
    "absolute_url", "apply_ingest_types", "decode", "ip_bucket", "ipv4_to_long", "long_to_ipv4",
    "pair_value", "path_element", "query_pairs", "query_param", "region_split", "split_element", "to_bigint", "url_part",
    "warehouse_type",
    "warehouse_type_name",
]
