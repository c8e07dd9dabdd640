import uuid

from pyspark.sql import functions as F

from adtrail import schemas
from adtrail.plans import catalog, daily
from adtrail.plans import registry as R
from adtrail.session import fresh_dir
from adtrail.sinks.partitions import overwrite_partition, write_text
from adtrail.sources import testdata as td
from conftest import SMOKE

DAYS = ("2024-01-03", "2024-01-04")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _made(spark):
    wh, db = daily.Warehouse(fresh_dir(spark, "warehouse")), f"wh_{uuid.uuid4().hex}"
    return wh, db, catalog.create_tables(spark, wh, db)


def test_empty_tables_and_comments(spark):
    wh, db, made = _made(spark)
    assert set(made) == set(schemas.ODS_TABLES) | set(catalog.ORC_SCHEMAS)
    assert catalog.create_tables(spark, wh, db) == made          # again: nothing changes
    for t in made:
        if t != catalog.CRAWLER:                                 # unpartitioned: no folder yet
            assert spark.table(f"{db}.{t}").count() == 0
    comments = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {db}.ods_ads_info_full").collect()}
    assert comments["ad_name"] == "ad name"
    assert spark.table(f"{db}.dwd_ads_event_inc").columns == [*schemas.FACT_COLUMNS, "dt"]
    assert catalog.add_days(spark, wh, db) == {}


def test_two_days_by_name_with_pruning(spark):
    wh, db, _ = _made(spark)
    ads = R.ads_dim(spark, SMOKE)
    overwrite_partition(ads, wh.dim("dim_ads_info_full"), DAYS[0])
    overwrite_partition(ads.limit(0), wh.dim("dim_ads_info_full"), DAYS[1])
    assert catalog.add_days(spark, wh, db, [DAYS[0]]) == {"dim_ads_info_full": [DAYS[0]]}
    overwrite_partition(ads.where("ad_id < '2'"), wh.dim("dim_ads_info_full"), DAYS[1])      # replaced
    assert spark.table(f"{db}.dim_ads_info_full").count() == ads.count()                  # not known yet
    assert catalog.add_days(spark, wh, db) == {"dim_ads_info_full": list(DAYS)}
    day = spark.sql(f"SELECT * FROM {db}.dim_ads_info_full WHERE dt = '{DAYS[1]}'")
    assert _rows(day.drop("dt")) == _rows(ads.where("ad_id < '2'"))
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()
    overwrite_partition(ads.where("ad_id >= '2'"), wh.dim("dim_ads_info_full"), DAYS[1])
    catalog.add_days(spark, wh, db)
    assert _rows(spark.sql(f"SELECT * FROM {db}.dim_ads_info_full WHERE dt = '{DAYS[1]}'").drop("dt")) == _rows(ads.where("ad_id >= '2'"))
    spark.sql(f"DROP TABLE {db}.dim_ads_info_full")                                       # external: files stay
    assert catalog.days_of(spark, wh.dim("dim_ads_info_full")) == list(DAYS)


def test_views_of_lines_equal_the_reader(spark):
    wh, db, _ = _made(spark)
    source = td.ads_info(td.read_table(spark, SMOKE, "part")).withColumn("ad_name", F.concat(F.col("ad_name"), F.lit("\t'a\\b\n|")))
    columns = [c for c in schemas.ODS_TABLES["ods_ads_info_full"].names]
    write_text(source.select(*columns), wh.origin("ods_ads_info_full", DAYS[0]), daily.ODS_DELIMITERS["ods_ads_info_full"], escaped=True)
    write_text(td.product_info(td.read_table(spark, SMOKE, "supplier")), wh.origin("ods_product_info_full", DAYS[0]),
               daily.ODS_DELIMITERS["ods_product_info_full"], escaped=True)
    daily.load_ods(spark, wh, DAYS[0])
    catalog.add_days(spark, wh, db)
    for t in ("ods_ads_info_full", "ods_product_info_full"):
        got, want = spark.table(f"{db}.{t}"), daily.read_ods(spark, wh, t)
        assert got.columns == want.columns
        assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
        assert _rows(got) == _rows(want) != []
    assert _rows(spark.table(f"{db}.ods_ads_info_full").select(*columns)) == _rows(source.select(*columns))
