from pyspark.sql import functions as F

from adtrail.functions.url import decode
from adtrail.operators.parse import parse_log


def _parse(spark, uris):
    df = spark.createDataFrame([(u,) for u in uris], "request_uri string")
    return [r.asDict() for r in parse_log(df).collect()]


def test_fields_and_missing_vs_empty(spark):
    r = _parse(spark, ["/ad/p1/click?t=12&id=3&ip=1.2.3.4&ua=Mozilla%2F5.0+%28X11%29&os_type=&device_id=d9"])[0]
    assert r == {"event_time": 12, "event_type": "click", "ad_id": "3", "client_ip": "1.2.3.4",
                 "platform_name_en": "p1", "client_ua": "Mozilla/5.0 (X11)", "client_os_type": "",
                 "client_device_id": "d9"}


def test_missing_key_is_null(spark):
    r = _parse(spark, ["/ad/p1/view?t=5"])[0]
    assert r["ad_id"] is None and r["client_ua"] is None and r["client_device_id"] is None


def test_short_path_keeps_row(spark):
    r = _parse(spark, ["/ad?t=7&id=1"])[0]
    assert r["event_type"] is None and r["platform_name_en"] is None and r["event_time"] == 7


def test_malformed_url_and_bad_number(spark):
    rows = _parse(spark, ["/a b/%zz?t=1", "/ad/p/v?t=abc"])
    assert all(v is None for v in rows[0].values())
    assert rows[1]["event_time"] is None and rows[1]["event_type"] == "v"


def test_bad_escape_decodes_to_null(spark):
    df = spark.createDataFrame([("a%zzb",), ("a+b%2Fc",), (None,)], "s string")
    got = [r[0] for r in df.select(decode(F.col("s"))).collect()]
    assert got == [None, "a b/c", None]


def test_single_parse_equals_parse_url_per_key(spark):
    from adtrail.functions.url import absolute_url, pair_value, query_pairs, query_param, url_part

    uris = ["/a/b/c?t=1&t=2", "/a?xt=1&t=2", "/a?t=&id=3#frag&t=9", "/a?id=a%26b&t=5", "/a", "/a?",
            "/a b?t=1", "/a?ua=x+y&os_type=&device_id", "/a?T=1&t=2", "/p/q/r/s?ip=1.2.3.4&ip=5.6.7.8"]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    url = absolute_url(F.col("u"))
    for key in ("t", "id", "ip", "ua", "os_type", "device_id"):
        got = df.select(pair_value(query_pairs(url_part(url, "QUERY")), key).alias("a"),
                        query_param(url, key).alias("b")).collect()
        assert all(r["a"] == r["b"] for r in got), key
