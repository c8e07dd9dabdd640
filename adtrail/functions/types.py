"""Ingest type map: relational column type -> warehouse column type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: ingest type map (everything else becomes string) --------
INGEST_TYPE_MAP = {
    "bigint": "bigint",
    "int": "bigint",
    "smallint": "bigint",
    "tinyint": "bigint",
    "double": "double",
    "float": "float",
}


def warehouse_type(type_name) -> Column:
    """Column expression mapping a source type name to its warehouse type."""
    c = F.lower(F.col(type_name) if isinstance(type_name, str) else type_name)
    expr = None
    for src, dst in INGEST_TYPE_MAP.items():
        expr = (F.when(c == src, F.lit(dst)) if expr is None
                else expr.when(c == src, F.lit(dst)))
    return expr.otherwise(F.lit("string"))


def warehouse_type_name(type_name: str) -> str:
    return INGEST_TYPE_MAP.get(type_name.lower(), "string")


def apply_ingest_types(df: DataFrame) -> DataFrame:
    """Cast every column of ``df`` to its warehouse type (Spark type names
    ``bigint/int/smallint/tinyint/double/float`` coincide with the relational
    ones).  Column order is kept: it is the contract of the text layer."""
    cols = []
    for f in df.schema.fields:
        dst = warehouse_type_name(f.dataType.simpleString())
        cols.append(F.col(f.name).cast(dst).alias(f.name))
    return df.select(*cols)
