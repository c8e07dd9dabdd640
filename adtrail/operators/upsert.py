"""Replace-mode export merge (upsert on the primary key)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.plans.broadcast import join_small
from adtrail.staging import Staging, session_scope


def latest_per_key(incoming: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row per key of a batch (greatest ``order_by``), as an aggregate
    (``max_by``) rather than a window, so a hot key is combined map-side."""
    others = [c for c in incoming.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    order = F.struct(*[F.col(c) for c in order_by])
    best = incoming.groupBy(*keys).agg(F.max_by(row, order).alias("_row"))
    return best.select(*keys, *[F.col("_row")[c].alias(c) for c in others])


def upsert_replace(existing: DataFrame, incoming: DataFrame, keys: list[str],
                   max_rows: int | None = None, scope: Staging | None = None) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``incoming``, plus ``incoming``
    (the effect of ``REPLACE INTO`` keyed on ``keys``).  ``incoming`` should
    hold one row per key (see :func:`latest_per_key`).  The incoming batch is
    staged once (its keys and its rows come from that table) and measured; a
    batch within the bound is broadcast, so the large existing table is
    filtered in place rather than shuffled."""
    inc = (scope or session_scope(existing.sparkSession)).table(incoming.select(*existing.columns), "upsert_incoming")
    kept = join_small(existing, inc.select(*keys), keys, "left_anti", max_rows)
    return kept.unionByName(inc)
