from pyspark.sql import functions as F

from adtrail.functions.types import apply_ingest_types, warehouse_type
from adtrail.operators.upsert import latest_per_key, upsert_replace
from adtrail.sources.jdbc import catalog_columns, catalog_tables, shard_union


def _schema(spark):
    tables = spark.createDataFrame([("ad", "ads"), ("ad", "product"), ("other", "x")], "table_schema string, table_name string")
    cols = spark.createDataFrame([
        ("ad", "ads", "name", "varchar", 2), ("ad", "ads", "id", "bigint", 1), ("ad", "ads", "score", "float", 3),
        ("ad", "product", "price", "decimal", 2), ("ad", "product", "id", "int", 1), ("other", "x", "a", "int", 1),
    ], "table_schema string, table_name string, column_name string, data_type string, ordinal_position int")
    return tables, cols


def test_catalog_tables_all_or_explicit(spark):
    tables, _ = _schema(spark)
    assert sorted(r[0] for r in catalog_tables(tables, "ad").collect()) == ["ads", "product"]
    assert [r[0] for r in catalog_tables(tables, "ad", "product").collect()] == ["product"]


def test_catalog_columns_in_ordinal_order_with_types(spark):
    tables, cols = _schema(spark)
    got = {r["table_name"]: [(c["column_name"], c["target_type"]) for c in r["columns"]]
           for r in catalog_columns(cols, "ad", catalog_tables(tables, "ad")).collect()}
    assert got == {"ads": [("id", "bigint"), ("name", "string"), ("score", "float")],
                   "product": [("id", "bigint"), ("price", "string")]}


def test_type_map(spark):
    df = spark.createDataFrame([("tinyint",), ("SMALLINT",), ("double",), ("datetime",)], "t string")
    assert [r[0] for r in df.select(warehouse_type("t")).collect()] == ["bigint", "bigint", "double", "string"]
    typed = apply_ingest_types(spark.createDataFrame([(1, 2.0, "x")], "a int, b double, c string"))
    assert [f.dataType.simpleString() for f in typed.schema.fields] == ["bigint", "double", "string"]


def test_shard_union_uses_first_shard_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    out = shard_union([a, b])
    assert out.columns == ["id", "v"] and sorted(map(tuple, out.collect())) == [(1, "x"), (2, "y")]


def test_upsert_replace_latest_wins(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    incoming = spark.createDataFrame([(2, "b1", 1), (2, "b2", 5), (3, "c", 1)], "k int, v string, ts int")
    latest = latest_per_key(incoming, ["k"], ["ts"]).drop("ts")
    out = upsert_replace(existing, latest, ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b2"), (3, "c")]
    assert F is not None
