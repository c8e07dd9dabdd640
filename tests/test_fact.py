from decimal import Decimal

from pyspark.sql import functions as F

from adtrail.operators.crawler import default_patterns
from adtrail.operators.dims import dim_ads, dim_platform
from adtrail.operators.flags import RuleParams
from adtrail.operators.parse import parse_log
from adtrail.operators.ua import default_rules
from adtrail.plans.fact import build_event_fact
from adtrail.schemas import FACT_COLUMNS

CHROME = "Mozilla%2F5.0+%28Windows+NT+10.0%3B+Win64%3B+x64%29+Chrome%2F120.0.0.0"


def _inputs(spark):
    log = spark.createDataFrame([
        (f"/ad/web/click?t=1000&id=1&ip=10.0.0.1&ua={CHROME}&os_type=&device_id=d1", "2024-01-01"),
        (f"/ad/web/view?t=2000&id=2&ip=10.0.0.2&ua={CHROME}&os_type=ios&device_id=d2", "2024-01-01"),
        ("/ad/app/view?t=3000&id=9&ip=10.0.0.3&ua=&device_id=d3", "2024-01-01"),
        (f"/ad/web/view?t=4000&id=1&ip=&ua={CHROME}&device_id=d4", "2024-01-01"),
    ], "request_uri string, dt string")
    ads = spark.createDataFrame([("1", "p1", "m1", "g1", "ad one", "u1"), ("2", "p404", "m2", "g2", "ad two", "u2")],
                                "id string, product_id string, material_id string, group_id string, ad_name string, material_url string")
    products = spark.createDataFrame([("p1", "prod", Decimal("12.5"))], "id string, name string, price decimal(16,2)")
    plats = spark.createDataFrame([("7", "web", "W")], "id string, platform_name_en string, platform_name_zh string")
    ranges = spark.createDataFrame([(167772160, 167772162, "CN|East|P|C|ISP")], "start_ip bigint, end_ip bigint, region string")
    return parse_log(log), dim_ads(ads, products), dim_platform(plats), ranges


def test_fact_columns_and_rules(spark):
    log, ads, plats, ranges = _inputs(spark)
    fact = build_event_fact(log, ads, plats, ranges, default_rules(spark), default_patterns(spark), RuleParams())
    assert tuple(fact.columns) == FACT_COLUMNS + ("dt",)
    all_rows = fact.collect()
    r4 = [r for r in all_rows if r["client_device_id"] == "d4"][0]
    assert r4["client_os_type"] == "Windows"          # os_type absent (NULL) -> agent's os
    assert r4["client_ip"] == "" and r4["client_country"] is None   # empty ip: row kept, no region
    rows = {r["ad_id"]: r for r in all_rows if r["client_device_id"] != "d4"}
    r1, r2, r9 = rows["1"], rows["2"], rows["9"]
    assert r1["ad_product_price"] == "12.50" and r1["ad_product_name"] == "prod"
    assert r1["client_os_type"] == "Windows"          # '' os_type -> agent's os
    assert r2["client_os_type"] == "ios"
    assert r2["ad_product_id"] == "p404" and r2["ad_product_name"] is None   # ad without product kept
    assert r1["platform_id"] == "7" and r9["platform_id"] is None            # event without platform kept
    assert r1["client_country"] == "CN" and r2["client_country"] == "CN" and r9["client_country"] is None
    assert r9["ad_name"] is None                                            # event without ad kept
    # empty agent: '' for versions and browser, os NULL because os_type is missing too
    assert (r9["client_os_version"], r9["client_browser_type"], r9["client_browser_version"]) == ("", "", "")
    assert r9["client_os_type"] is None
    assert not any(r["is_invalid_traffic"] for r in rows.values())


def test_fact_flags_and_no_stage(spark):
    log, ads, plats, ranges = _inputs(spark)
    p = RuleParams(frequency_window_ms=10_000, frequency_threshold=0)
    fact = build_event_fact(log, ads, plats, ranges, default_rules(spark), None, p, stage_log=False)
    assert fact.where(F.col("is_invalid_traffic")).count() == 4


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fact_same_with_every_join_shuffled(spark):
    from adtrail.plans import registry as R
    from conftest import SMOKE

    def fact(max_rows=None):
        return build_event_fact(R.coarse_log(spark, SMOKE), R.ads_dim(spark, SMOKE), R.platform_dim(spark, SMOKE),
                                R.ranges_as_library(spark, SMOKE), default_rules(spark), default_patterns(spark),
                                R.PARAMS, max_rows=max_rows)

    base = _sorted(fact())
    assert base == _sorted(fact(max_rows=0))
    assert any(r[-2] for r in base)                                                 # some rows flagged


def test_period_rules_flag_keys_in_the_fact(spark):
    from adtrail.operators.flags import rule_sets
    from adtrail.plans import registry as R
    from conftest import SF01

    sets = rule_sets(R.staged_log(spark, SF01), R.PARAMS)
    assert all(df.count() > 0 for df in sets.values())


def test_crawler_flag_mode_has_no_fanout(spark):
    from adtrail.plans import registry as R
    from conftest import SMOKE

    args = (R.coarse_log(spark, SMOKE), R.ads_dim(spark, SMOKE), R.platform_dim(spark, SMOKE),
            R.ranges_as_library(spark, SMOKE), default_rules(spark), default_patterns(spark), R.PARAMS)
    flagged = build_event_fact(*args, crawler_mode="flag")
    fanout = build_event_fact(*args)
    assert flagged.columns[-2:] == ["is_crawler", "dt"]
    n_events = R.coarse_log(spark, SMOKE).count()
    assert flagged.count() == n_events < fanout.count()
    assert flagged.where(F.col("is_crawler")).count() > 0


def test_only_dimension_rows_of_the_log_are_joined_on(spark):
    """Dimensions far over the broadcast bound, of which the log uses two rows and one."""
    log, ads, plats, ranges = _inputs(spark)
    more = [F.concat(F.lit("x"), F.col("id").cast("string")).alias("k")]
    many = spark.range(500).select(*more)
    ads = ads.unionByName(many.select(F.col("k").alias("ad_id")), allowMissingColumns=True)
    plats = plats.unionByName(many.select(F.col("k").alias("id"), F.col("k").alias("platform_name_en")), allowMissingColumns=True)
    build = lambda ads, plats: build_event_fact(log, ads, plats, ranges, default_rules(spark), default_patterns(spark), max_rows=20)
    got = build(ads, plats)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 5, plan
    small = _inputs(spark)
    assert _sorted(got) == _sorted(build(small[1], small[2]))
