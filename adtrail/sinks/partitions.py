"""Partitioned table writes.

* ``overwrite_partition`` replaces one day in two steps: the new day is written
  to a hidden sibling folder, then renamed into place.  The old day is what
  readers see until the new one is complete, whatever fails (the source, the
  write, the driver), and a day can be rewritten from itself.  An empty result
  gives an empty day; other days are untouched.  (Dynamic partition overwrite
  would leave the old rows of a day whose new result is empty.)
* ``append_partition`` with a batch token adds a batch once: the token is in the
  names of its files, and a repeated token replaces them.
* ``write_partitioned`` writes every day present in the frame, replacing
  exactly those days (dynamic overwrite).
* Days are written after a ``rebalance``, so a day is neither many small files
  nor one task's work.
* Text writers put NULL out as ``''`` (import layout) or ``\\N`` (export).  With
  ``escaped`` a value may hold the delimiter, line ends, backslashes and the null
  token: they become a backslash and a letter (``sources.text`` reverses it).
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtrail.sources.text import escapes


def _files(df: DataFrame, root: str):
    """(file system, path class) of a folder."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()), path


def _rename(fs, old, new) -> None:
    if not fs.rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def heal_partition(df: DataFrame, root: str, dt: str) -> None:
    """Put a day back that a replacement was interrupted between its two renames."""
    fs, path = _files(df, root)
    day, kept = path(f"{root}/dt={dt}"), path(f"{root}/_old-dt={dt}")
    if fs.exists(kept):
        if fs.exists(day):
            fs.delete(kept, True)
        else:
            _rename(fs, kept, day)


def overwrite_partition(df: DataFrame, root: str, dt: str, fmt: str = "orc",
                        compression: str = "snappy", files: int | None = None) -> None:
    out, root = df.drop("dt") if "dt" in df.columns else df, root.rstrip("/")
    out = out.repartition(files) if files else out.hint("rebalance")
    heal_partition(df, root, dt)
    fs, path = _files(df, root)
    day, kept, new = path(f"{root}/dt={dt}"), path(f"{root}/_old-dt={dt}"), f"{root}/_new-dt={dt}-{uuid.uuid4().hex}"
    try:
        out.write.format(fmt).option("compression", compression).save(new)
        if fs.exists(day):
            _rename(fs, day, kept)
        _rename(fs, path(new), day)
    except BaseException:
        heal_partition(df, root, dt)
        fs.delete(path(new), True)
        raise
    fs.delete(kept, True)


def append_partition(df: DataFrame, root: str, dt: str, fmt: str = "orc", compression: str = "snappy",
                     batch: str | None = None) -> None:
    """Add rows to a day.  With ``batch``, a token of letters, digits, ``_`` and ``.``, the
    same batch can be appended again after a failure or by a retry: its rows are there once."""
    out, root = df.drop("dt") if "dt" in df.columns else df, root.rstrip("/")
    if batch is None:
        out.write.mode("append").format(fmt).option("compression", compression).save(f"{root}/dt={dt}")
        return
    if not re.fullmatch(r"[A-Za-z0-9_.]+", batch):
        raise ValueError(f"not a batch token: {batch!r}")
    fs, path = _files(df, root)
    new, day = path(f"{root}/_new-batch-{uuid.uuid4().hex}"), path(f"{root}/dt={dt}")
    try:
        out.write.format(fmt).option("compression", compression).save(new.toString())
        fs.mkdirs(day)
        for old in fs.globStatus(path(f"{root}/dt={dt}/batch-{batch}-*")):
            fs.delete(old.getPath(), False)
        for made in fs.globStatus(path(new, "part-*")):
            _rename(fs, made.getPath(), path(day, f"batch-{batch}-{made.getPath().getName()}"))
    finally:
        fs.delete(new, True)


def _by_day(df: DataFrame, files_per_day: int | None) -> DataFrame:
    """Cluster rows by ``dt`` into ``files_per_day`` groups per day (a
    deterministic hash of the row picks the group), so a day is written by
    that many tasks rather than one, and each task writes one day.  ``None``
    rebalances: AQE joins small outputs of a day and splits large ones."""
    if not files_per_day:
        return df.hint("rebalance", "dt")
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_day))
    return df.repartition(F.col("dt"), salt)


def write_partitioned(df: DataFrame, root: str, fmt: str = "orc", compression: str = "snappy",
                      files_per_day: int | None = None) -> None:
    """Replace the days present in ``df`` (dynamic partition overwrite)."""
    (_by_day(df, files_per_day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("dt").format(fmt).option("compression", compression).save(root))


def to_text_line(df: DataFrame, delimiter: str, null_as: str = "", escaped: bool = False) -> DataFrame:
    def field(c: str) -> Column:
        x = F.col(c).cast("string")
        for plain, code in escapes(delimiter) if escaped else ():
            x = F.replace(x, F.lit(plain), F.lit(code))
        return F.coalesce(x, F.lit(null_as))

    cols = [field(c) for c in df.columns if c != "dt"]
    keep = [F.col("dt")] if "dt" in df.columns else []
    return df.select(F.concat_ws(delimiter, *cols).alias("value"), *keep)


def write_text_partitions(df: DataFrame, root: str, delimiter: str, null_as: str = "",
                          compression: str = "gzip", files_per_day: int | None = None, escaped: bool = False) -> None:
    """Delimited text, one directory per ``dt`` (days present are replaced)."""
    lines = _by_day(to_text_line(df, delimiter, null_as, escaped), files_per_day)
    (lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", compression).partitionBy("dt").text(root))


def write_text(df: DataFrame, path: str, delimiter: str = "\t", null_as: str = "",
               compression: str = "gzip", escaped: bool = False) -> None:
    """Import layout: gzip text, NULL written as ``''``; the target is replaced."""
    to_text_line(df, delimiter, null_as, escaped).write.mode("overwrite").option("compression", compression).text(path)
