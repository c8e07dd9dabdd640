"""Size-checked broadcast joins.

A side is broadcast only after its row count and byte size have been
measured and found under a bound; beyond the bound the join falls back to a
shuffle join (with AQE skew-join splitting enabled in the session).  Derived sides (e.g. the
flagged key sets, which are the product of whole-log shuffles) are first
written as a table in the shared folder, so the count and the join read the
same materialised rows and lineage is cut (executor loss only re-reads files).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtrail.staging import Staging

# Default bounds on a broadcast side (rows, and bytes measured as the JSON
# length of its rows); a session can override them with
# ``adtrail.broadcast.maxRows`` / ``adtrail.broadcast.maxBytes``.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    v = df.sparkSession.conf.get(key, None)
    return int(v) if v else default


def max_broadcast_rows(df: DataFrame, override: int | None = None) -> int:
    if override is not None:
        return override
    return _conf_int(df, "adtrail.broadcast.maxRows", DEFAULT_MAX_BROADCAST_ROWS)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one job; bytes are the JSON length of each
    row, a stand-in for its size once built into a hash relation."""
    row = df.select(F.count(F.lit(1)).alias("n"),
                    F.coalesce(F.sum(F.length(F.to_json(F.struct(*[F.col(c) for c in df.columns])))),
                               F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def bounded(df: DataFrame, max_rows: int | None = None, stage: Staging | None = None,
            known: tuple[int, int] | None = None) -> tuple[DataFrame, bool]:
    """Return ``(side, is_broadcast)``: ``broadcast(df)`` when its measured row
    count is within the bound, else ``df`` unchanged.  ``stage`` is
    the scope that holds a derived side, written to the shared folder first."""
    side = stage.table(df, "side") if stage is not None else df
    limit = max_broadcast_rows(side, max_rows)
    max_bytes = _conf_int(side, "adtrail.broadcast.maxBytes", DEFAULT_MAX_BROADCAST_BYTES)
    # One cheap job over a small side (none when its size is already known);
    # the measured size decides the plan.
    rows, size = known or measure(side)
    if rows <= limit and size <= max_bytes:
        return F.broadcast(side), True
    return side, False


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left",
               max_rows: int | None = None, stage: Staging | None = None,
               known: tuple[int, int] | None = None) -> DataFrame:
    """Join ``small`` onto ``big``.  ``on`` is a column name, a list of names,
    or a ``(big_col, small_col)`` pair of names for an equi-join.  ``known``
    passes an upper bound (rows, bytes) already measured."""
    side, _ = bounded(small, max_rows, stage, known)
    if isinstance(on, tuple):
        left, right = on
        return big.join(side, big[left] == side[right], how)
    return big.join(side, on, how)
