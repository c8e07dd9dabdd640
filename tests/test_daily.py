import json

from pyspark.sql import functions as F

from adtrail.fixed import LOG_FIELD_DELIMITER
from adtrail.operators.crawler import CRAWLER_ROWS, default_patterns
from adtrail.operators.dims import dim_ads, dim_platform
from adtrail.operators.parse import parse_log
from adtrail.operators.ua import UA_RULE_ROWS
from adtrail.plans import daily
from adtrail.plans import registry as R
from adtrail.plans.fact import build_event_fact
from adtrail.session import fresh_dir
from adtrail.sinks.partitions import write_text
from adtrail.sources import testdata as td
from conftest import SMOKE

DAY = "2024-01-03"


def _origin(spark, wh):
    log = R.raw_log(spark, SMOKE).where(F.col("dt") == DAY).drop("dt")
    write_text(log, wh.origin("ods_ad_log_inc", DAY), LOG_FIELD_DELIMITER)
    write_text(td.ads_info(td.read_table(spark, SMOKE, "part")), wh.origin("ods_ads_info_full", DAY))
    write_text(td.product_info(td.read_table(spark, SMOKE, "supplier")), wh.origin("ods_product_info_full", DAY))
    write_text(td.platform_info(td.read_table(spark, SMOKE, "customer")), wh.origin("ods_platform_info_full", DAY))


def test_daily_layers_end_to_end(spark, tmp_path):
    wh = daily.Warehouse(fresh_dir(spark, "warehouse"))
    _origin(spark, wh)
    assert set(daily.load_ods(spark, wh, DAY)) == {"ods_ad_log_inc", "ods_ads_info_full",
                                                   "ods_product_info_full", "ods_platform_info_full"}
    daily.run(spark, "dim", wh, date=DAY)
    crawler_json = tmp_path / "crawler.json"
    crawler_json.write_text("\n".join(json.dumps(dict(zip(("pattern", "addition_date", "url", "instances"), r)))
                                      for r in CRAWLER_ROWS))
    daily.run(spark, "crawler", wh, json_path=str(crawler_json))
    ranges = R.ranges_as_library(spark, SMOKE)
    daily.run(spark, "dwd", wh, date=DAY, ranges=ranges, params=R.PARAMS)
    daily.run(spark, "dwd", wh, date=DAY, ranges=ranges, params=R.PARAMS)   # re-run: idempotent

    got = spark.read.orc(f"{wh.dwd('dwd_ads_event_inc')}/dt={DAY}")
    # same day computed in memory from the adapter, without the text/ORC round trips
    log = parse_log(R.raw_log(spark, SMOKE).where(F.col("dt") == DAY))
    ads = dim_ads(td.ads_info(td.read_table(spark, SMOKE, "part")), td.product_info(td.read_table(spark, SMOKE, "supplier")))
    plats = dim_platform(td.platform_info(td.read_table(spark, SMOKE, "customer")))
    want = build_event_fact(log, ads, plats, ranges, UA_RULE_ROWS, default_patterns(spark), R.PARAMS,
                            keep_dt=False)
    assert got.columns == want.columns
    key = lambda rows: sorted(map(tuple, rows), key=repr)
    assert key(got.collect()) == key(want.collect())

    views = daily.register_views(spark, wh)
    assert {"ods_ad_log_inc", "dim_ads_info_full", "dim_crawler_user_agent", "dwd_ads_event_inc"} <= set(views)
    q = spark.sql(f"SELECT count(*) FROM dwd_ads_event_inc WHERE dt = '{DAY}'")
    assert "PartitionFilters: [isnotnull(dt" in q._jdf.queryExecution().executedPlan().toString()
    assert q.first()[0] == got.count()


def _staged_now(spark):
    import os
    from adtrail.session import shared_dir
    root = shared_dir(spark, "staged").removeprefix("file:")
    return {(d, x) for d in (os.listdir(root) if os.path.isdir(root) else []) for x in os.listdir(f"{root}/{d}")}


def _ready(spark):
    wh = daily.Warehouse(fresh_dir(spark, "warehouse"))
    _origin(spark, wh)
    daily.load_ods(spark, wh, DAY)
    daily.run(spark, "dim", wh, date=DAY)
    return wh


def test_builds_release_their_own_tables_only(spark):
    from concurrent.futures import ThreadPoolExecutor
    from adtrail.staging import Staging
    ranges = R.ranges_as_library(spark, SMOKE)
    with Staging(spark) as other:
        held = other.table(spark.range(5), "other")
        before = _staged_now(spark)
        places = [_ready(spark) for _ in range(2)]
        with ThreadPoolExecutor(2) as pool:                     # side by side
            list(pool.map(lambda wh: daily.build_dwd(spark, wh, DAY, ranges, params=R.PARAMS, crawler_mode="none"), places))
        got = [sorted(map(tuple, spark.read.orc(f"{wh.dwd('dwd_ads_event_inc')}/dt={DAY}").collect()), key=repr) for wh in places]
        assert got[0] and got[0] == got[1]
        assert _staged_now(spark) == before and held.count() == 5


def test_a_failing_build_releases_its_tables(spark):
    import pytest
    wh = _ready(spark)
    before = _staged_now(spark)
    overlapping = spark.createDataFrame([(1, 10, "a|b|c|d|e"), (5, 20, "a|b|c|d|e")], "start_ip bigint, end_ip bigint, region string")
    with pytest.raises(ValueError, match="overlap"):
        daily.build_dwd(spark, wh, DAY, overlapping, params=R.PARAMS, crawler_mode="none")
    assert _staged_now(spark) == before


def test_missing_crawler_dimension_is_an_error(spark):
    import pytest
    wh = _ready(spark)
    with pytest.raises(FileNotFoundError):
        daily.build_dwd(spark, wh, DAY, R.ranges_as_library(spark, SMOKE))


def test_import_layer_copies_tables(spark):
    wh = daily.Warehouse(fresh_dir(spark, "warehouse"))
    ads = td.ads_info(td.read_table(spark, SMOKE, "part"))
    for _ in range(2):                                          # a re-run replaces the day
        daily.run(spark, "import", wh, "ods_ads_info_full", DAY, reader=lambda t: ads)
    daily.load_ods(spark, wh, DAY)
    back = daily.read_ods(spark, wh, "ods_ads_info_full", DAY).drop("dt")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, ads.select(*back.columns).collect()))


def test_missing_origin_is_skipped(spark):
    wh = daily.Warehouse(fresh_dir(spark, "warehouse"))
    assert daily.load_ods(spark, wh, "2030-01-01") == []


def test_business_date_default():
    import datetime as dt
    assert daily.business_date() == (dt.date.today() - dt.timedelta(days=1)).isoformat()
    assert daily.business_date("2023-01-07") == "2023-01-07"


def test_table_selection():
    import pytest
    from adtrail import schemas
    assert daily._select("all", schemas.ODS_TABLES) == list(schemas.ODS_TABLES)
    assert daily._select("ods_ad_log_inc, ods_ads_info_full", schemas.ODS_TABLES) == ["ods_ad_log_inc", "ods_ads_info_full"]
    with pytest.raises(ValueError):
        daily._select("nope", schemas.ODS_TABLES)
