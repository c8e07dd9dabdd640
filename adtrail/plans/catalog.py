"""The warehouse's tables by name, in Spark's catalog.

``create_tables`` declares an external table for every layer, with column comments
and a location: dropping a table leaves its files.  DIM and DWD are ORC tables,
partitioned by ``dt``.  An ODS table holds raw lines, ``<table>_lines``; the view
``<table>`` splits them into typed columns.  ``add_days`` makes days known to
the catalog; only those are read, and a filter on ``dt`` prunes partitions.

Defined results: a table without days is empty.  A day added twice is there once.
A day that was replaced on disk is read anew after ``add_days``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from adtrail import schemas
from adtrail.plans.daily import COLLECTED, DIM_TABLES, DWD_TABLES, ODS_DELIMITERS, Warehouse
from adtrail.sources.text import escapes, regex_quote

CRAWLER = "dim_crawler_user_agent"
ORC_SCHEMAS = {"dim_ads_info_full": schemas.DIM_ADS_INFO, "dim_platform_info_full": schemas.DIM_PLATFORM_INFO,
               "dwd_ads_event_inc": schemas.DWD_ADS_EVENT, CRAWLER: schemas.DIM_CRAWLER_UA}


def _text(s: str) -> str:
    """A SQL string literal."""
    for plain, code in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\u0001", "\\u0001")):
        s = s.replace(plain, code)
    return f"'{s}'"


def _column(f: T.StructField) -> str:
    comment = f.metadata.get("comment")
    return f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_text(comment)}" if comment else "")


def table_ddl(name: str, schema: T.StructType, location: str, fmt: str = "orc", partitioned: bool = True) -> str:
    """``CREATE TABLE`` of an external table, partitioned by ``dt``."""
    columns = [_column(f) for f in schema.fields] + (["`dt` string COMMENT 'business date'"] if partitioned else [])
    options = " OPTIONS (compression 'snappy')" if fmt == "orc" else ""
    return (f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {fmt}{options}"
            + (" PARTITIONED BY (dt)" if partitioned else "") + f" LOCATION {_text(location)}")


def lines_view_ddl(name: str, lines: str, schema: T.StructType, delimiter: str, escaped: bool) -> str:
    """``CREATE VIEW`` that splits raw lines as ``sources.text.split_fields`` does."""
    columns, names = [], []
    for i, f in enumerate(schema.fields):
        x = f"get(parts, {i})"
        for plain, code in reversed(escapes(delimiter)) if escaped else ():
            x = f"replace({x}, {_text(code)}, {_text(plain)})"
        columns.append((x if isinstance(f.dataType, T.StringType) else f"try_cast({x} AS {f.dataType.simpleString()})") + f" AS `{f.name}`")
        comment = f.metadata.get("comment")
        names.append(f"`{f.name}`" + (f" COMMENT {_text(comment)}" if comment else ""))
    return (f"CREATE OR REPLACE VIEW {name} ({', '.join(names)}, `dt`) AS SELECT {', '.join(columns)}, dt "
            f"FROM (SELECT split(value, {_text(regex_quote(delimiter))}, -1) AS parts, dt FROM {lines})")


def create_tables(spark: SparkSession, wh: Warehouse, database: str) -> list[str]:
    """Declare every table of the warehouse; gives their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION {_text(wh.root + '/database')}")
    made = []
    for t, schema in schemas.ODS_TABLES.items():
        lines = T.StructType([T.StructField("value", T.StringType(), True, {"comment": "a line as delivered"})])
        spark.sql(table_ddl(f"`{database}`.`{t}_lines`", lines, wh.ods(t), "text"))
        spark.sql(lines_view_ddl(f"`{database}`.`{t}`", f"`{database}`.`{t}_lines`", schema, ODS_DELIMITERS[t], t not in COLLECTED))
        made.append(t)
    for t, schema in ORC_SCHEMAS.items():
        root = wh.dwd(t) if t in DWD_TABLES else wh.dim(t)
        spark.sql(table_ddl(f"`{database}`.`{t}`", schema, root, partitioned=t != CRAWLER))
        made.append(t)
    return made


def days_of(spark: SparkSession, root: str) -> list[str]:
    """The days a table has on disk (a folder each), in order."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(path(f"{root}/dt=*")) or []
    return sorted(s.getPath().getName()[len("dt="):] for s in found)


def add_days(spark: SparkSession, wh: Warehouse, database: str, days: list[str] | None = None) -> dict[str, list[str]]:
    """Make ``days`` (all on disk, if not given) known to every table that has them; gives them by table."""
    roots = {f"{t}_lines": wh.ods(t) for t in schemas.ODS_TABLES}
    roots |= {t: wh.dim(t) for t in DIM_TABLES} | {t: wh.dwd(t) for t in DWD_TABLES}
    added = {}
    for t, root in roots.items():
        mine = [d for d in days_of(spark, root) if days is None or d in days]
        if mine:
            parts = " ".join(f"PARTITION (dt={_text(d)}) LOCATION {_text(f'{root}/dt={d}')}" for d in mine)
            spark.sql(f"ALTER TABLE `{database}`.`{t}` ADD IF NOT EXISTS {parts}")
            spark.sql(f"REFRESH TABLE `{database}`.`{t}`")
            added[t] = mine
    return added
