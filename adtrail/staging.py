"""Staged tables: intermediate results written once to the shared folder.

Each job owns a :class:`Staging` scope and releases it in ``finally`` (use it
as a context manager); scopes know only their own paths, so jobs that run side
by side in one application cannot delete each other's inputs.  A query that
returns a lazy DataFrame cannot know when its result has been read; its scope
is a :func:`session_scope`, released on demand or when the process ends.
"""

from __future__ import annotations

import atexit
import contextlib
import threading
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from adtrail.session import fresh_dir


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _before, _writing = threading.Lock(), {}, {}


@contextlib.contextmanager
def _shuffles_end_with_their_job(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a staging job go when it ends: its result is read from the
    table only.  (Otherwise they stay until the driver's collector finds the plan
    unreachable, and a chain of staged steps keeps the shuffles of all.)  Jobs side
    by side share the setting; the last one puts the session's own back."""
    key = id(spark)
    with _lock:
        if not _writing.get(key):
            _before[key] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
        _writing[key] = _writing.get(key, 0) + 1
    try:
        yield
    finally:
        with _lock:
            _writing[key] -= 1
            if not _writing[key]:
                spark.conf.set(_CLEANUP, _before.pop(key))


class Staging:
    """The staged tables of one job."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        """A new path in the shared folder, deleted on release."""
        p = fresh_dir(self.spark, "staged", name)
        self.paths.append(p)
        return p

    def table(self, df: DataFrame, name: str = "table", sort_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` once and read it back: one job, lineage cut, and any
        lost executor only re-reads files."""
        p = self.path(name)
        with _shuffles_end_with_their_job(self.spark):
            (df.sortWithinPartitions(*sort_by) if sort_by else df).write.parquet(p)
        return self.spark.read.schema(df.schema).parquet(p)

    def drop(self, *paths: str) -> None:
        """Delete some of this scope's tables ahead of its end (``paths[-1]`` is
        the path of the table written last)."""
        if not paths:
            return
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            self.paths.remove(p)
            hp = jvm.org.apache.hadoop.fs.Path(p)
            hp.getFileSystem(conf).delete(hp, True)

    def release(self) -> int:
        """Delete this scope's tables; DataFrames that read them are invalid afterwards."""
        n = len(self.paths)
        self.drop(*self.paths)
        return n

    def __enter__(self) -> "Staging":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


_SESSION: list[Staging] = []


def session_scope(spark: SparkSession) -> Staging:
    """A scope for a lazily returned result: released by
    :func:`release_session` or at the end of the process."""
    scope = Staging(spark)
    _SESSION.append(scope)
    return scope


def release_session() -> int:
    """Release every session scope of this process."""
    n = 0
    while _SESSION:
        n += _SESSION.pop().release()
    return n


@atexit.register
def _release_at_exit() -> None:
    from pyspark import SparkContext

    if SparkContext._active_spark_context is None:  # the JVM is gone
        _SESSION.clear()
        return
    try:
        release_session()
    except Exception:  # the session ended first: nothing can be deleted any more
        pass
