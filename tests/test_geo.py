import random

from pyspark.sql import functions as F

from adtrail.functions.ip import ipv4_to_long, long_to_ipv4, region_split
from adtrail.operators.geo import attach_region, lookup_ip, lookup_ip_naive


def _ranges(spark):
    # disjoint ranges, some inside one /16, some spanning several /16 blocks
    rows, start, rnd = [], 167772160, random.Random(7)
    for i in range(60):
        width = rnd.choice([255, 4095, 65535, 300000, 900000])
        rows.append((start, start + width, f"c{i}|a{i % 3}|p{i}|city{i}|isp{i % 2}"))
        start += width + 1 + rnd.choice([0, 0, 1000])
    return spark.createDataFrame(rows, "start_ip bigint, end_ip bigint, region string")


def test_ipv4_roundtrip_and_malformed(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("10.300.1.1",), ("1.2.3",), ("",), (None,), ("255.255.255.255",)], "ip string")
    got = [r[0] for r in df.select(ipv4_to_long(F.col("ip"))).collect()]
    assert got == [167838211, None, None, None, None, 4294967295]
    assert df.select(long_to_ipv4(F.lit(167838211))).first()[0] == "10.1.2.3"


def test_region_split_missing_parts(spark):
    df = spark.createDataFrame([("A|B|C|D|E",), ("A|B",)], "r string")
    got = [tuple(r[0]) for r in df.select(region_split(F.col("r"))).collect()]
    assert got == [("A", "B", "C", "D", "E"), ("A", "B", None, None, None)]


def test_bucketed_equals_naive(spark):
    rnd = random.Random(3)
    ips = [f"10.{rnd.randrange(0, 60)}.{rnd.randrange(256)}.{rnd.randrange(256)}" for _ in range(3000)]
    ips += ["bad", None, "10.999.0.1", ""]
    log = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id int, client_ip string")
    r = _ranges(spark)
    cols = ["id", "country", "area", "province", "city", "isp"]
    fast = sorted(map(tuple, lookup_ip(log, r).select(*cols).collect()), key=repr)
    naive = sorted(map(tuple, lookup_ip_naive(log, r).select(*cols).collect()), key=repr)
    assert fast == naive and len(fast) == len(ips)
    # the shuffle form (above the broadcast bound) gives the same rows
    shuffled = sorted(map(tuple, lookup_ip(log, r, max_rows=0).select(*cols).collect()), key=repr)
    assert shuffled == naive


def test_unknown_ip_keeps_row_with_null_region(spark):
    log = spark.createDataFrame([("192.168.0.1",), (None,)], "client_ip string")
    rows = attach_region(log, _ranges(spark)).collect()
    assert len(rows) == 2 and all(r["region_struct"]["country"] is None for r in rows)


def test_plan_is_broadcast_hash_join(spark):
    log = spark.createDataFrame([("10.0.0.1",)], "client_ip string")
    plan = lookup_ip(log, _ranges(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
