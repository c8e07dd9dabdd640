"""Relational sources: partitioned JDBC import, catalog discovery, shard union.

URL, driver and credentials always come from the caller.  No database is
reachable in this repository's tests, so the JDBC calls themselves are not
exercised here; everything downstream of the read (catalog filtering, column
ordering, type map, shard union) is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail.functions.types import warehouse_type


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None) -> DataFrame:
    """Full-table import; parallel when a numeric partition column and bounds are given."""
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                               numPartitions=num_partitions, properties=props)
    return spark.read.jdbc(url, table, properties=props)


def split_predicates(keys: DataFrame, key: str, parts: int, accuracy: int = 10_000) -> list[str]:
    """Up to ``parts`` predicates on ``key`` of about equal shares, whatever the keys'
    distribution: their bounds are quantiles (a sketch with a relative rank error of
    ``1 / accuracy``, combined map-side; ``parts - 1`` numbers reach the driver).

    Every row satisfies exactly one; NULL keys go with the first.  Only a key that
    is repeated more often than a share makes a larger one.  No rows: one predicate."""
    cuts = F.array(*[F.lit(i / parts) for i in range(1, parts)]) if parts > 1 else None
    found = keys.agg(F.percentile_approx(key, cuts, accuracy)).first()[0] if cuts is not None else None
    bounds = sorted(set(found or []))
    name = f"`{key}`"
    if not bounds:
        return [f"{name} IS NULL OR {name} IS NOT NULL"]
    first = f"{name} IS NULL OR {name} <= {bounds[0]}"
    between = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(bounds, bounds[1:])]
    return [first, *between, f"{name} > {bounds[-1]}"]


def read_jdbc_even(spark: SparkSession, url: str, table: str, key: str, parts: int, properties: dict | None = None,
                   lower: int | None = None, upper: int | None = None, quote: str = "") -> DataFrame:
    """Full-table import in splits of about equal shares: the key column is read first
    (in ranges of equal width, where bounds are given), then the table by its quantiles.
    ``quote``: the database's identifier quote."""
    props = dict(properties or {})
    keys = f"(SELECT {quote}{key}{quote} FROM {table}) k"
    read = read_jdbc(spark, url, keys, props, key, lower, upper, parts) if lower is not None else read_jdbc(spark, url, keys, props)
    predicates = [p.replace("`", quote) for p in split_predicates(read, key, parts)]
    return spark.read.jdbc(url, table, predicates=predicates, properties=props)


def catalog_tables(tables: DataFrame, database: str, explicit: str | None = None) -> DataFrame:
    """Tables to import: an explicit comma list, else every table of ``database``
    (``tables`` has the ``information_schema.tables`` columns)."""
    t = tables.select(F.col("table_schema"), F.col("table_name"))
    t = t.where(F.col("table_schema") == database)
    if explicit:
        names = [n.strip() for n in explicit.split(",") if n.strip()]
        t = t.where(F.col("table_name").isin(names))
    return t.select("table_name")


def catalog_columns(columns: DataFrame, database: str, tables: DataFrame) -> DataFrame:
    """Per table, its columns in ordinal order with source and warehouse types:
    ``(table_name, columns: array<struct<ordinal_position, column_name, data_type, target_type>>)``."""
    c = columns.where(F.col("table_schema") == database).join(tables, "table_name", "left_semi")
    item = F.struct(F.col("ordinal_position").cast("int").alias("ordinal_position"),
                    F.col("column_name"), F.col("data_type"), warehouse_type("data_type").alias("target_type"))
    return c.groupBy("table_name").agg(F.sort_array(F.collect_list(item)).alias("columns"))


def read_information_schema(spark: SparkSession, url: str, properties: dict | None = None) -> tuple[DataFrame, DataFrame]:
    tables = read_jdbc(spark, url, "information_schema.tables", properties)
    columns = read_jdbc(spark, url, "information_schema.columns", properties)
    lower = [F.col(c).alias(c.lower()) for c in ("TABLE_SCHEMA", "TABLE_NAME")]
    return (tables.select(*lower),
            columns.select(*lower, F.col("COLUMN_NAME").alias("column_name"),
                           F.col("DATA_TYPE").alias("data_type"),
                           F.col("ORDINAL_POSITION").alias("ordinal_position")))


def shard_union(shards: list[DataFrame]) -> DataFrame:
    """Tables split into shards of one schema, read as one: every shard is
    projected to the first shard's column list, then bag-unioned."""
    cols = shards[0].columns
    return reduce(DataFrame.unionByName, [s.select(*cols) for s in shards])


def shards_by_key(table: DataFrame, key: str, shards: int) -> list[DataFrame]:
    """A table as its shards: rows by ``key`` modulo ``shards`` and, last, the
    rows without a key.  Every row is in exactly one shard."""
    place = F.pmod(F.col(key), F.lit(shards))
    return [*(table.where(place == i) for i in range(shards)), table.where(F.col(key).isNull())]
