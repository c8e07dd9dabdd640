"""Global order and positions in a group, without a task that holds a whole group.

Rows are range-partitioned by (group, order) and sorted inside the parts, so a
group of any size lies in consecutive parts of about equal size.  The position
of a row in its group is its place among the group's rows of its part plus the
group's rows in earlier parts; the latter come from a table with one row per part.

Ties (rows equal in group and order) get different, arbitrary places.  NULL is
a group and an order value like any other and comes first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adtrail.staging import Staging

# Characters of a string that take part in cutting the ranges (range bounds are
# sampled on the driver, so their size must not depend on the texts).
BOUND_CHARS = 32


def ordered_rows(df: DataFrame, by: list[str], scope: Staging, seq: str = "seq", name: str = "ordered") -> DataFrame:
    """``df`` with ``seq``, a bigint that ascends in the order of ``by``; staged,
    as a second evaluation could cut the ranges elsewhere."""
    short = [F.substring(c, 1, BOUND_CHARS) if df.schema[c].dataType.simpleString() == "string" else F.col(c) for c in by]
    rows = df.repartitionByRange(*short).sortWithinPartitions(*by)
    return scope.table(rows.withColumn(seq, F.monotonically_increasing_id()), name)


def _same(a: str, b: str, group: list[str]) -> Column:
    out = F.lit(True)
    for c in group:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return F.coalesce(out, F.lit(False))


def positions(df: DataFrame, group: list[str], order: list[str], scope: Staging, pos: str = "pos",
              keep: list[str] | None = None) -> DataFrame:
    """``df`` (its columns ``keep``) with ``pos``: 0, 1, 2 ... per group in the given order."""
    rows = ordered_rows(df, [*group, *order], scope, "_seq").select(
        *dict.fromkeys([*group, *(df.columns if keep is None else keep)]), "_seq")
    rows = rows.withColumn("_part", F.shiftright("_seq", 33))
    runs = rows.groupBy("_part", *group).agg(F.min("_seq").alias("_from"), F.count(F.lit(1)).alias("_n"))
    edges = runs.groupBy("_part").agg(
        F.min_by(F.struct(*group), "_from").alias("_first"), F.max_by(F.struct(*group), "_from").alias("_last"),
        F.max_by("_n", "_from").alias("_tail"))
    w = Window.orderBy("_part")                                        # a row per part
    edges = edges.withColumn("_before", F.lag("_last").over(w)).withColumn("_on", _same("_before", "_first", group))
    whole = F.col("_on") & _same("_first", "_last", group)             # the part is a middle piece of one group
    edges = edges.withColumn("_run", F.sum(F.when(whole, 0).otherwise(1)).over(w))
    edges = edges.withColumn("_upto", F.sum("_tail").over(Window.partitionBy("_run").orderBy("_part")))
    carried = (edges.withColumn("_carry", F.lag("_upto").over(w)).where("_on")
               .select("_part", F.struct(*[F.col(f"_first.{c}") for c in group]).alias("_first"), "_carry"))
    local = F.row_number().over(Window.partitionBy("_part", *group).orderBy("_seq")) - 1
    mine = F.lit(True)
    for c in group:
        mine = mine & F.col(c).eqNullSafe(F.col(f"_first.{c}"))
    out = rows.withColumn("_local", local).join(F.broadcast(carried), "_part", "left")
    out = out.withColumn(pos, (F.col("_local") + F.when(mine, F.coalesce("_carry", F.lit(0))).otherwise(F.lit(0))).cast("bigint"))
    return out.drop("_seq", "_part", "_local", "_first", "_carry")
