"""Relational sinks: replace-mode export and publishing the fact.

Connection details come from the caller.  No database is reachable in this
repository's tests: the table loop and the order of its steps are tested with
an injected writer, the JDBC calls are not.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

Writer = Callable[[DataFrame, str], None]


def jdbc_writer(url: str, properties: dict | None = None, num_partitions: int = 8) -> Writer:
    """A writer of whole tables (``staging`` tables are replaced)."""
    def write(df: DataFrame, table: str) -> None:
        df.repartition(num_partitions).write.mode("overwrite").option("truncate", "true").jdbc(
            url, table, properties=dict(properties or {}))
    return write


def replace_statement(table: str, columns: list[str]) -> str:
    """What the database runs, in one transaction of its own, after the staging
    table is complete: rows with a new key are added, others replaced."""
    names = ", ".join(columns)
    return f"REPLACE INTO {table} ({names}) SELECT {names} FROM {table}__staging"


def export_replace(incoming: DataFrame, table: str, write: Writer, execute: Callable[[str], None]) -> None:
    """``REPLACE INTO``-style export.  Only the incoming rows travel: they are
    written to ``<table>__staging``, and the target is changed by one statement
    on the server.  A failure before it leaves the target as it was; rows that
    others write to the target meanwhile are kept."""
    write(incoming, f"{table}__staging")
    execute(replace_statement(table, incoming.columns))


def export_tables(spark: SparkSession, read: Callable[[str], DataFrame], tables: Iterable[str], write: Writer,
                  execute: Callable[[str], None]) -> list[str]:
    """Export the selected tables one after the other; the names done."""
    done = []
    for table in tables:
        export_replace(read(table), table, write, execute)
        done.append(table)
    return done


def publish(df: DataFrame, url: str, table: str, properties: dict | None = None, mode: str = "append",
            num_partitions: int = 8) -> None:
    """Publish rows to a serving database through JDBC (driver from the caller)."""
    df.repartition(num_partitions).write.mode(mode).jdbc(url, table, properties=dict(properties or {}))
