"""IP -> region lookup as a bucketed range join.

A plain ``ip BETWEEN start_ip AND end_ip`` join can only run as a nested-loop
join.  Instead every range is exploded into the /16 buckets it touches (at most
65,536 buckets for disjoint ranges, plus one row per range), both sides are
keyed by bucket, and the join becomes an equi-join on the bucket with the range
test as a residual condition.

The range table is a reference table whose size does not grow with the log;
it is broadcast after its row count is checked, so the log is never shuffled
for this join.  Beyond the bound, distinct IPs (at most 65,536 per bucket) are
resolved with a shuffle join on the bucket and joined back on the address.

Ranges must be disjoint (as in an IP library); unknown, malformed or NULL
addresses keep their row and get NULL region fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtrail.functions.ip import ip_bucket, ipv4_to_long, region_split
from adtrail.plans.broadcast import bounded

REGION_FIELDS = ("country", "area", "province", "city", "isp")


def normalize_ranges(ranges: DataFrame) -> DataFrame:
    """Accept either five region columns or one ``region`` string
    (``country|area|province|city|isp``) and return the five columns."""
    if "region" in ranges.columns and "country" not in ranges.columns:
        r = region_split(F.col("region"))
        return ranges.select("start_ip", "end_ip", *[r[f].alias(f) for f in REGION_FIELDS])
    return ranges.select("start_ip", "end_ip", *REGION_FIELDS)


def bucket_ranges(ranges: DataFrame, prefix_bits: int = 16) -> DataFrame:
    """One row per (range, bucket touched)."""
    r = normalize_ranges(ranges)
    return r.withColumn("_bucket", F.explode(F.sequence(ip_bucket(F.col("start_ip"), prefix_bits),
                                                        ip_bucket(F.col("end_ip"), prefix_bits))))


def check_disjoint(ranges: DataFrame, prefix_bits: int = 16) -> None:
    """Raise if two ranges share an address (neighbours are compared inside a
    bucket: ranges that overlap touch a common bucket)."""
    r = ranges.select("start_ip", "end_ip")
    r = r.withColumn("_bucket", F.explode(F.sequence(ip_bucket(F.col("start_ip"), prefix_bits), ip_bucket(F.col("end_ip"), prefix_bits))))
    upto = Window.partitionBy("_bucket").orderBy("start_ip", "end_ip").rowsBetween(Window.unboundedPreceding, -1)
    bad = r.withColumn("_upto", F.max("end_ip").over(upto)).where(F.col("_upto") >= F.col("start_ip")).limit(1).collect()
    if bad:
        raise ValueError(f"IP ranges overlap at {bad[0]['start_ip']}")


def prepare_ranges(ranges: DataFrame, prefix_bits: int = 16,
                   max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """The bucketed range side and whether it is broadcast (size measured).
    Ranges that overlap would multiply events: they are an error."""
    check_disjoint(ranges, prefix_bits)
    return bounded(bucket_ranges(ranges, prefix_bits), max_rows)


def lookup_ip(df: DataFrame, ranges: DataFrame, ip_col: str = "client_ip", prefix_bits: int = 16,
              max_rows: int | None = None, prepared: tuple[DataFrame, bool] | None = None) -> DataFrame:
    """``df`` + the five region columns (NULL when not found).  ``prepared``
    is the result of :func:`prepare_ranges` when computed ahead."""
    side, is_broadcast = prepared or prepare_ranges(ranges, prefix_bits, max_rows)
    left = df.withColumn("_ipn", ipv4_to_long(F.col(ip_col)))
    left = left.withColumn("_ipb", ip_bucket(F.col("_ipn"), prefix_bits))
    if is_broadcast:
        cond = ((left["_ipb"] == side["_bucket"])
                & left["_ipn"].between(side["start_ip"], side["end_ip"]))
        out = left.join(side, cond, "left")
    else:
        # Resolve each distinct address once (bounded per bucket), then join back.
        ips = left.select("_ipn", "_ipb").where(F.col("_ipn").isNotNull()).distinct()
        cond = ((ips["_ipb"] == side["_bucket"])
                & ips["_ipn"].between(side["start_ip"], side["end_ip"]))
        resolved = ips.join(side, cond, "inner").select("_ipn", *REGION_FIELDS)
        # Rows without an address match nothing and would all meet in one partition.
        known = left.where(F.col("_ipn").isNotNull()).join(resolved, "_ipn", "left")
        out = known.unionByName(left.where(F.col("_ipn").isNull()), allowMissingColumns=True)
    return out.drop("_ipn", "_ipb", "_bucket", "start_ip", "end_ip")


def attach_region(df: DataFrame, ranges: DataFrame, ip_col: str = "client_ip",
                  out_col: str = "region_struct", **kw) -> DataFrame:
    """``df`` + ``region_struct`` (struct of the five fields)."""
    looked = lookup_ip(df, ranges, ip_col, **kw)
    return (looked.withColumn(out_col, F.struct(*[F.col(f) for f in REGION_FIELDS]))
            .drop(*REGION_FIELDS))


def lookup_ip_naive(df: DataFrame, ranges: DataFrame, ip_col: str = "client_ip") -> DataFrame:
    """Reference form: BETWEEN join (nested loop); for tests and benchmarks."""
    r = normalize_ranges(ranges)
    left = df.withColumn("_ipn", ipv4_to_long(F.col(ip_col)))
    out = left.join(r, left["_ipn"].between(r["start_ip"], r["end_ip"]), "left")
    return out.drop("_ipn", "start_ip", "end_ip")
