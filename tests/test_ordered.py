from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adtrail.operators.ordered import ordered_rows, positions
from adtrail.staging import Staging


def key(v):
    return (v is not None, v if v is not None else 0)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 1, 1, 1, 2, 3]), st.one_of(st.none(), st.integers(0, 400)), st.sampled_from(["", "a", "é", "b" * 40, "b" * 39 + "a"])),
                max_size=300))
def test_positions_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "g long, t long, s string")
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    want = sorted(((g, t, s, i) for v in groups.values() for i, (g, t, s) in enumerate(sorted(v, key=lambda r: (key(r[1]), r[2].encode())))),
                  key=lambda r: (key(r[0]), r[3]))
    with Staging(spark) as scope:
        got = sorted(map(tuple, positions(df, ["g"], ["t", "s"], scope).collect()), key=lambda r: (key(r[0]), r[3]))
    assert got == want


def test_one_group_spans_parts(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(2000).select(F.when(F.col("id") < 5, 0).when(F.col("id") > 1990, 9).otherwise(4).alias("g"), (-F.col("id")).alias("t"))
        with Staging(spark) as scope:
            parts = ordered_rows(df, ["g", "t"], scope).groupBy(F.shiftright("seq", 33)).count().collect()
            assert len(parts) == 4 and max(r["count"] for r in parts) < 1000
            out = positions(df, ["g"], ["t"], scope, keep=["t"])
            assert out.columns == ["g", "t", "pos"]
            bad = out.where(F.col("pos") != F.when(F.col("g") == 0, 0).when(F.col("g") == 9, -1).otherwise(0) + F.when(
                F.col("g") == 0, F.lit(4) + F.col("t")).when(F.col("g") == 9, F.lit(2000) + F.col("t")).otherwise(F.lit(1990) + F.col("t")))
            assert bad.count() == 0 and out.count() == 2000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
