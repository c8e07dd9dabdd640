"""Delimited text tables (no header, column order is the contract).

Spark's CSV reader turns empty fields into NULL whatever ``nullValue`` says,
while the warehouse distinguishes ``''`` from NULL, so text is read with
``spark.read.text`` and split natively.  Missing trailing fields give NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when the scan gives fewer partitions than
    the cluster has cores (a gzip text file, a single-row-group file); a scan
    that already splits is left alone (no extra shuffle)."""
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # no RDD view of the plan (e.g. a Spark Connect session): leave as is
        return df
    return df.repartition(target) if current < target else df


def escapes(delimiter: str) -> tuple[tuple[str, str], ...]:
    """(plain, code) of the escaped text form, in the order of encoding: the backslash
    first, so that afterwards every backslash starts a code."""
    return (("\\", "\\s"), ("\n", "\\n"), ("\r", "\\r"), (delimiter, "\\d"))


def split_fields(df: DataFrame, schema: T.StructType, delimiter: str, null_token: str | None = None,
                 value_col: str = "value", escaped: bool = False) -> DataFrame:
    parts = F.split(F.col(value_col), regex_quote(delimiter), -1)
    cols = []
    for i, f in enumerate(schema.fields):
        v = F.get(parts, i)
        if null_token is not None:
            v = F.when(v != F.lit(null_token), v)
        for plain, code in reversed(escapes(delimiter)) if escaped else ():
            v = F.replace(v, F.lit(code), F.lit(plain))
        cols.append((v if isinstance(f.dataType, T.StringType) else v.try_cast(f.dataType)).alias(f.name))
    keep = [F.col(c) for c in df.columns if c != value_col]
    return df.select(*cols, *keep)


def regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def read_delimited_text(spark: SparkSession, path: str, schema: T.StructType, delimiter: str,
                        null_token: str | None = None, min_partitions: int | None = None, escaped: bool = False) -> DataFrame:
    """Read a (possibly ``dt=``-partitioned) text table.  gzip files are not
    splittable: pass ``min_partitions`` to spread the rows after the read."""
    raw = spark.read.option("basePath", path).text(path)
    if "dt" in raw.columns:
        raw = raw.withColumn("dt", F.col("dt").cast("string"))
    if min_partitions:
        raw = spread(raw, min_partitions)
    return split_fields(raw, schema, delimiter, null_token, escaped=escaped)


def read_partition(spark: SparkSession, root: str, dt: str, schema: T.StructType, delimiter: str,
                   null_token: str | None = None, escaped: bool = False) -> DataFrame:
    """One day of a text table; the ``dt`` filter prunes directories."""
    return read_delimited_text(spark, root, schema, delimiter, null_token, escaped=escaped).where(F.col("dt") == dt)


def read_crawler_json(spark: SparkSession, path: str) -> DataFrame:
    from adtrail.schemas import CRAWLER_JSON
    return spark.read.schema(CRAWLER_JSON).json(path)
