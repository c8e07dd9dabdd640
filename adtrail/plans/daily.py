"""Daily layer jobs: sources -> origin text -> ODS -> DIM -> DWD, one business date per run.

``run(spark, layer, tables="all", date=None, ...)`` selects a layer and either
every table of it or a comma list; ``date`` defaults to yesterday.  Every
write replaces exactly one ``dt`` partition (or, for the crawler dimension,
the whole table), so a re-run of a day is idempotent and leaves other days
alone.  A missing origin directory skips that table.

Warehouse layout (``root`` is a folder every executor reaches)::

    <root>/origin/<table>/<date>/...           raw text as delivered
    <root>/ods/<table>/dt=<date>/...           gzip text, same bytes per line
    <root>/dim/<table>/dt=<date>/...           ORC + snappy
    <root>/dim/dim_crawler_user_agent/...      ORC + snappy, unpartitioned
    <root>/dwd/dwd_ads_event_inc/dt=<date>/... ORC + snappy
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtrail import schemas
from adtrail.fixed import LOG_FIELD_DELIMITER, ODS_FIELD_DELIMITER
from adtrail.operators.dims import dim_ads, dim_crawler, dim_platform
from adtrail.operators.flags import RuleParams
from adtrail.operators.parse import parse_log
from adtrail.operators.ua import UA_RULE_ROWS
from adtrail.plans.fact import build_event_fact
from adtrail.sinks.partitions import overwrite_partition, write_text
from adtrail.sources.text import read_crawler_json, read_delimited_text, spread
from adtrail.staging import Staging

ODS_DELIMITERS = {name: (LOG_FIELD_DELIMITER if name == "ods_ad_log_inc" else ODS_FIELD_DELIMITER)
                  for name in schemas.ODS_TABLES}
DIM_TABLES = ("dim_ads_info_full", "dim_platform_info_full")
DWD_TABLES = ("dwd_ads_event_inc",)


@dataclass(frozen=True)
class Warehouse:
    root: str

    def origin(self, table: str, date: str) -> str:
        return f"{self.root}/origin/{table}/{date}"

    def ods(self, table: str) -> str:
        return f"{self.root}/ods/{table}"

    def dim(self, table: str) -> str:
        return f"{self.root}/dim/{table}"

    def dwd(self, table: str) -> str:
        return f"{self.root}/dwd/{table}"


def business_date(date: str | None = None) -> str:
    """The job argument, or yesterday."""
    return date or (_dt.date.today() - _dt.timedelta(days=1)).isoformat()


def _select(tables: str, known) -> list[str]:
    if tables in (None, "", "all"):
        return list(known)
    names = [t.strip() for t in tables.split(",") if t.strip()]
    unknown = [t for t in names if t not in known]
    if unknown:
        raise ValueError(f"unknown tables: {unknown}")
    return names


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# Tables whose text comes from the log collector as it is; the others are
# written by the import, which escapes delimiters and line ends in values.
COLLECTED = ("ods_ad_log_inc",)


# ---------------------------------------------------------------- import
def import_layer(spark: SparkSession, wh: Warehouse, reader: Callable[[str], DataFrame], date: str,
                 tables: str = "all") -> list[str]:
    """First step of the day: every selected source table is copied whole to
    ``origin/<table>/<date>`` as delimited gzip text, replacing what is there.
    ``reader`` gives a table by name (e.g. a partitioned JDBC read)."""
    done = []
    for t in _select(tables, schemas.ODS_TABLES):
        columns = [c for c in schemas.ODS_TABLES[t].names if c != "dt"]
        write_text(reader(t).select(*columns), wh.origin(t, date), ODS_DELIMITERS[t], escaped=t not in COLLECTED)
        done.append(t)
    return done


# ---------------------------------------------------------------- ODS
def load_ods(spark: SparkSession, wh: Warehouse, date: str, tables: str = "all") -> list[str]:
    """Origin text of the day -> ``ods/<table>/dt=<date>`` (gzip text, replaced).
    Lines are copied as they are; absent origin folders are skipped."""
    loaded = []
    for t in _select(tables, schemas.ODS_TABLES):
        src = wh.origin(t, date)
        if not path_exists(spark, src):
            continue
        # Rebalanced as it is written, so later reads find enough files.
        overwrite_partition(spark.read.text(src), wh.ods(t), date, fmt="text", compression="gzip")
        loaded.append(t)
    return loaded


def read_ods(spark: SparkSession, wh: Warehouse, table: str, date: str | None = None) -> DataFrame:
    df = read_delimited_text(spark, wh.ods(table), schemas.ODS_TABLES[table], ODS_DELIMITERS[table], escaped=table not in COLLECTED)
    return df if date is None else df.where(F.col("dt") == date)


# ---------------------------------------------------------------- DIM
def build_dims(spark: SparkSession, wh: Warehouse, date: str, tables: str = "all") -> list[str]:
    built = []
    for t in _select(tables, DIM_TABLES):
        if t == "dim_ads_info_full":
            out = dim_ads(read_ods(spark, wh, "ods_ads_info_full", date),
                          read_ods(spark, wh, "ods_product_info_full", date))
        else:
            out = dim_platform(read_ods(spark, wh, "ods_platform_info_full", date))
        overwrite_partition(out, wh.dim(t), date)
        built.append(t)
    return built


def build_crawler_dim(spark: SparkSession, wh: Warehouse, json_path: str) -> None:
    """Undated: the whole crawler table is replaced from its JSON lines."""
    out = dim_crawler(read_crawler_json(spark, json_path))
    out.write.mode("overwrite").option("compression", "snappy").orc(wh.dim("dim_crawler_user_agent"))


def read_dim(spark: SparkSession, wh: Warehouse, table: str, date: str) -> DataFrame:
    root = wh.dim(table)
    return (spark.read.option("basePath", root).orc(root)
            .withColumn("dt", F.col("dt").cast("string")).where(F.col("dt") == date).drop("dt"))


# ---------------------------------------------------------------- DWD
def build_dwd(spark: SparkSession, wh: Warehouse, date: str, ranges: DataFrame,
              ua_rules=None, params: RuleParams = RuleParams(), crawler_mode: str = "fanout") -> None:
    """The day's fact.  ``crawler_mode`` ``fanout`` or ``flag`` needs the crawler
    dimension (an error if it is missing); ``none`` builds without it.  Staged
    tables belong to this build and go when it ends, well or not."""
    crawler_path = wh.dim("dim_crawler_user_agent")
    if crawler_mode != "none" and not path_exists(spark, crawler_path):
        raise FileNotFoundError(f"no crawler dimension at {crawler_path}: build it, or ask for crawler_mode='none'")
    crawler = None if crawler_mode == "none" else spark.read.orc(crawler_path)
    with Staging(spark) as scope:
        log = parse_log(spread(read_ods(spark, wh, "ods_ad_log_inc", date)))
        fact = build_event_fact(log, read_dim(spark, wh, "dim_ads_info_full", date),
                                read_dim(spark, wh, "dim_platform_info_full", date), ranges,
                                ua_rules if ua_rules is not None else UA_RULE_ROWS, crawler,
                                params, crawler_mode, keep_dt=False, scope=scope)
        overwrite_partition(fact, wh.dwd("dwd_ads_event_inc"), date)


def register_views(spark: SparkSession, wh: Warehouse) -> list[str]:
    """Expose every warehouse table that exists as a temporary view, so that
    reports can be written in SQL (``spark.sql("select ... from dwd_ads_event_inc
    where dt = '...'")``; the ``dt`` filter prunes partitions)."""
    names = []
    for t in schemas.ODS_TABLES:
        if path_exists(spark, wh.ods(t)):
            read_ods(spark, wh, t).createOrReplaceTempView(t)
            names.append(t)
    for t, root in [(t, wh.dim(t)) for t in DIM_TABLES] + [("dim_crawler_user_agent", wh.dim("dim_crawler_user_agent")),
                                                           ("dwd_ads_event_inc", wh.dwd("dwd_ads_event_inc"))]:
        if path_exists(spark, root):
            df = spark.read.option("basePath", root).orc(root)
            if "dt" in df.columns:
                df = df.withColumn("dt", F.col("dt").cast("string"))
            df.createOrReplaceTempView(t)
            names.append(t)
    return names


def run(spark: SparkSession, layer: str, wh: Warehouse, tables: str = "all", date: str | None = None,
        **kw) -> None:
    """Run one layer for one business date: ``import``, ``ods``, ``dim``, ``dwd`` or ``crawler``."""
    d = business_date(date)
    if layer == "import":
        import_layer(spark, wh, kw["reader"], d, tables)
    elif layer == "ods":
        load_ods(spark, wh, d, tables)
    elif layer == "dim":
        build_dims(spark, wh, d, tables)
    elif layer == "dwd":
        _select(tables, DWD_TABLES)
        build_dwd(spark, wh, d, **kw)
    elif layer == "crawler":
        build_crawler_dim(spark, wh, kw["json_path"])
    else:
        raise ValueError(f"unknown layer {layer!r}")
