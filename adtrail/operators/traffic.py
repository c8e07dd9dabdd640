"""Invalid-traffic rules: high frequency and fixed period, per key and ad.

Both rules are per (key, ad) sequences of event times.  A bot key is by
definition a heavy group (assume it may hold a third of all rows), so neither
rule ever sorts a whole key in one task:

* **Light groups go before the shuffle.**  A group with at most ``n`` events
  can neither exceed ``n`` in a window nor form an island larger than ``n``.
  Events are counted per slot of a hash of (key, ad) in a fixed array of
  ``SLOTS``; a log row whose slot holds at most ``n`` events belongs to such a
  group.  The heavy slots are bits, at most ``SLOTS / 64`` words, broadcast.
  The filter is one-sided, so it is exact at any load.
* Every rule starts from **events per exact timestamp**, ``(key, ad, t) ->
  m``: a hash aggregate with map-side combine, shuffled on all three columns,
  so one key's timestamps spread over all reducers.  The rules of one key
  column share it.
* **High frequency** (trailing ``RANGE`` window, both ends inclusive): time
  is cut into buckets of the window width; bucket ``b`` is sorted together
  with a copy of bucket ``b-1`` and ``sum(m)`` over ``RANGE BETWEEN w
  PRECEDING AND CURRENT ROW`` is taken for the rows of ``b``.  Exact (a
  frame never reaches further back than ``b-1``) and every sort holds at most
  two windows of one key.
* **Fixed period** (gaps and islands) is a segmented scan.  A segment is the
  part of a (key, ad) inside ``SEGMENT_MS`` of time, so it holds at most as many
  distinct times.  ``lag``, ``lead`` and the running tag sum stay inside the
  segment, which is summed up in one row: its first and last two times, the
  tags between, and the events before the first, after the last and in the
  largest island between two tags.  These summaries are associative; one
  ordered fold over a key's segments (a row per time span, whatever the
  number of events) settles the tags at the edges and joins the open islands.

Semantics kept exactly (see README):

* ``time_diff = t - lag(t, 1, 0)`` (the first row of a group always differs);
* ``tag = 1`` when ``time_diff - lead(time_diff) != 0``; the last row compares
  with ``lead_default`` (0 for the IP rule; NULL, i.e. tag 0, for the device
  rule);
* ``sum_tag`` = running ``sum(tag)`` with the default RANGE frame, so rows
  with equal timestamps (only possible without dedup) share one island;
* with duplicates, tied rows are taken in the order ``t, time_diff desc``;
* times outside the valid domain (``fixed.MAX_EVENT_TIME_MS``) count as NULL;
* events without a time are peers of each other in the frequency window (as
  NULLs of a ``RANGE`` frame are).  In the fixed-period rules they take no part,
  or, with ``null_time``, stand at that time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from adtrail.fixed import (CYCLE_DEVICE_THRESHOLD, CYCLE_IP_THRESHOLD, FREQUENCY_THRESHOLD,
                           FREQUENCY_WINDOW_MS)
from adtrail.functions.url import valid_event_time
from adtrail.staging import Staging, session_scope

# Slots of the counting filter: a fixed array, at most SLOTS / 64 broadcast rows.
SLOTS = 1 << 24
# Width of a segment of the fixed-period scan: bounds a segment's distinct times.
SEGMENT_MS = 600_000
# Rows of the counts per task of a rule's sorts, where the counts are staged (so that their number is known).
TASK_ROWS = 500_000

# Group identity of a (key, ad) pair with NULLs made explicit, so that joins,
# windows and ranges share plain equality keys.
_ID = ["kk", "kn", "aa", "an"]


def _with_id(df: DataFrame) -> DataFrame:
    return df.select(F.coalesce(F.col("key"), F.lit("")).alias("kk"), F.col("key").isNull().alias("kn"),
                     F.coalesce(F.col("ad"), F.lit("")).alias("aa"), F.col("ad").isNull().alias("an"),
                     *[c for c in df.columns if c not in ("key", "ad")])


def _from_id(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c not in _ID]
    return df.select(F.when(~F.col("kn"), F.col("kk")).alias("key"),
                     F.when(~F.col("an"), F.col("aa")).alias("ad"), *rest)


def heavy_slots(log: DataFrame, key: str, ad: str, min_events: int, slots: int = SLOTS) -> DataFrame:
    """``(word, bits)``: the slots of the counting filter that hold at least
    ``min_events`` events, 64 to a row."""
    counted = log.groupBy(_slot(key, ad, slots).alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    return (counted.where(F.col("n") >= min_events)
            .groupBy(F.shiftright("slot", 6).alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("bits")))


def _slot(key: str, ad: str, slots: int) -> Column:
    return F.xxhash64(key, ad).bitwiseAND(slots - 1)


def without_light_groups(log: DataFrame, key: str, ad: str, min_events: int | None, slots: int = SLOTS) -> DataFrame:
    """The log rows that may belong to a (key, ad) with ``min_events`` events or more."""
    if min_events is None:
        return log
    words = F.broadcast(heavy_slots(log, key, ad, min_events, slots))     # at most slots / 64 rows
    slot = _slot(key, ad, slots)
    kept = log.join(words, (F.shiftright(slot, 6) == F.col("word"))
                    & (F.getbit("bits", slot.bitwiseAND(63)) == 1), "left_semi")
    return kept


def timestamp_counts(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
                     exclude_empty: bool = False, min_events: int | None = None) -> DataFrame:
    """``(key, ad, t, m)``: events per exact timestamp (map-side combined); the
    events of a (key, ad) without a valid time are one row with NULL ``t``.
    With ``min_events``, lighter groups may be missing."""
    src = log.select(F.col(key).alias("key"), F.col(ad).alias("ad"), F.col(t).alias("t"))
    src = without_light_groups(src, "key", "ad", min_events)
    if exclude_empty:
        src = src.where(F.col("key") != "")  # also drops NULL keys, like `key != ''`
    return (src.withColumn("t", valid_event_time(F.col("t").cast("bigint")))
            .groupBy("key", "ad", "t").agg(F.count(F.lit(1)).alias("m")))


def count_tasks(counts: DataFrame, rows: int | None = None) -> int:
    """Tasks for the sorts of staged counts, in proportion to their rows: what a task
    sorts does not grow with the log (small shuffled bytes can be very many rows)."""
    return max(1, -(-counts.count() // (rows or TASK_ROWS)))


def _dealt(df: DataFrame, by: list[str], tasks: int | None) -> DataFrame:
    return df.repartition(*by) if tasks is None else df.repartition(tasks, *by)


# ------------------------------------------------------------------ frequency
def frequency_counts(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
                     window_ms: int = FREQUENCY_WINDOW_MS, exclude_empty: bool = False,
                     min_events: int | None = None, counts: DataFrame | None = None,
                     tasks: int | None = None) -> DataFrame:
    """``(key, ad, t, m, cnt)``: for each distinct timestamp, the events of the
    same (key, ad) in ``[t - window_ms, t]`` (NULL ``t``: those without a time).
    ``counts``: the log's :func:`timestamp_counts`, if they are at hand; ``tasks``:
    their :func:`count_tasks`."""
    if counts is None:
        counts = timestamp_counts(log, key, ad, t, exclude_empty, min_events)
    elif exclude_empty:
        counts = counts.where(F.col("key") != "")
    c = _with_id(counts)
    bucket = F.expr(f"t div {window_ms}")        # valid times are not negative
    # Each timestamp goes to its own bucket (cur) and, as context, to the next
    # one; one pass (explode), so the aggregated rows are read once.
    own = F.struct(F.coalesce(bucket, F.lit(-1)).alias("bucket"), F.lit(True).alias("cur"))
    following = F.struct((F.coalesce(bucket, F.lit(-1)) + 1).alias("bucket"), F.lit(False).alias("cur"))
    copies = F.explode(F.when(F.col("t").isNull(), F.array(own)).otherwise(F.array(own, following)))
    both = (c.select(*_ID, "t", "m", copies.alias("_c"))
            .select(*_ID, "t", "m", "_c.bucket", "_c.cur"))
    if tasks is not None:
        both = _dealt(both, [*_ID, "bucket"], 2 * tasks)        # each timestamp twice
    w = Window.partitionBy(*_ID, "bucket").orderBy("t").rangeBetween(-window_ms, 0)
    return _from_id(both.withColumn("cnt", F.sum("m").over(w)).where(F.col("cur"))
                    .select(*_ID, "t", "m", "cnt"))


def _keys(df: DataFrame, key: str, distinct: bool) -> DataFrame:
    out = df.select(F.col("key").alias(key))
    # A caller that de-duplicates a union of rule outputs anyway passes
    # distinct=False and saves an exchange per rule.
    return out.distinct() if distinct else out


def high_frequency_keys(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
                        window_ms: int = FREQUENCY_WINDOW_MS, threshold: int = FREQUENCY_THRESHOLD,
                        exclude_empty: bool = False, distinct: bool = True, prune: bool = True,
                        counts: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Distinct keys that, for some ad, have more than ``threshold`` events in
    a trailing ``window_ms`` window (light groups dropped first, exactly)."""
    fc = frequency_counts(log, key, ad, t, window_ms, exclude_empty, threshold + 1 if prune else None, counts, tasks)
    return _keys(fc.where(F.col("cnt") > threshold), key, distinct)


# ------------------------------------------------------------------ fixed period
_SEGMENT = [*_ID, "segment"]


def _segments(log: DataFrame, key: str, ad: str, t: str, dedup: bool, min_events: int | None,
              null_time: int | None, segment_ms: int, counts: DataFrame | None, tasks: int | None = None) -> DataFrame:
    """``(id, segment, t, m)``: the combined rows, dealt by segment."""
    c = _with_id(timestamp_counts(log, key, ad, t, min_events=min_events) if counts is None else counts)
    if null_time is None:
        c = c.where(F.col("t").isNotNull())
    else:
        c = (c.withColumn("t", F.coalesce("t", F.lit(null_time).cast("bigint")))
             .groupBy(*_ID, "t").agg(F.sum("m").alias("m")))
    if dedup:
        c = c.withColumn("m", F.least(F.col("m"), F.lit(1).cast("bigint")))
    return _dealt(c.withColumn("segment", F.expr(f"t div {segment_ms}")), _SEGMENT, tasks)


def _flag(x: Column) -> Column:
    """if(x != 0, 1, 0); NULL gives 0."""
    return F.when(x != 0, F.lit(1)).otherwise(F.lit(0))


def _tags(m: Column, before: Column, after: Column) -> Column:
    """The tags of the ``m`` rows at one time with these gaps around it."""
    return F.when(m == 1, _flag(before - after)).otherwise(_flag(before) + _flag(after))


def _or_last(gap: Column, lead_default: int | None) -> Column:
    return gap if lead_default is None else F.coalesce(gap, F.lit(lead_default).cast("bigint"))


def _cycle_rows(rows: DataFrame, lead_default: int | None) -> DataFrame:
    # A row per segment: its edges and its neighbours' (the neighbours of a
    # segment's rows, where they lie in another one).
    w = Window.partitionBy(*_ID).orderBy("segment")
    edges = rows.groupBy(*_SEGMENT).agg(F.min("t").alias("first"), F.max("t").alias("last"))
    edges = edges.select(*_SEGMENT, F.lag("last").over(w).alias("before"), F.lead("first").over(w).alias("after"))
    rows = rows.join(edges, _SEGMENT)
    w = Window.partitionBy(*_SEGMENT).orderBy("t")
    prev = F.coalesce(F.lag("t").over(w), F.col("before"), F.lit(0).cast("bigint"))
    gap = _or_last(F.coalesce(F.lead("t").over(w), F.col("after")) - F.col("t"), lead_default)
    out = (rows.withColumn("time_diff", F.col("t") - prev).withColumn("_e", gap)
           .withColumn("tag", _tags(F.col("m"), F.col("time_diff"), F.col("_e")))
           .withColumn("local_sum", F.sum("tag").over(w.rowsBetween(Window.unboundedPreceding, 0))))
    return out.select(*_SEGMENT, "t", "m", "time_diff", "tag", "local_sum")


def cycle_rows(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
               dedup: bool = True, lead_default: int | None = 0, null_time: int | None = None,
               segment_ms: int = SEGMENT_MS) -> DataFrame:
    """Per distinct timestamp: ``(key, ad, segment, t, m, time_diff, tag, local_sum)``.

    ``m`` is the number of events at ``t`` (1 with ``dedup``), ``time_diff``
    that of the first of them, ``tag`` the number of tags the ``m`` rows carry
    and ``local_sum`` the running tag sum inside the segment.
    """
    rows = _segments(log, key, ad, t, dedup, None, null_time, segment_ms, None)
    return _from_id(_cycle_rows(rows, lead_default))


def cycle_islands(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
                  dedup: bool = True, lead_default: int | None = 0, null_time: int | None = None,
                  scope: Staging | None = None, segment_ms: int = SEGMENT_MS) -> DataFrame:
    """``(key, ad, sum_tag, n)``: events per island (the reference's
    ``group by ad, key, sum_tag``)."""
    scope = scope or session_scope(log.sparkSession)
    rows = _cycle_rows(_segments(log, key, ad, t, dedup, None, null_time, segment_ms, None), lead_default)
    # Dealt like the windows, so no new exchange; staged, as it is read twice.
    pieces = scope.table(rows.groupBy(*_SEGMENT, "local_sum").agg(F.sum("m").alias("n")), "pieces")
    w = Window.partitionBy(*_ID).orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (pieces.groupBy(*_SEGMENT).agg(F.max("local_sum").alias("tags"))
               .select(*_SEGMENT, F.coalesce(F.sum("tags").over(w), F.lit(0)).alias("offset")))
    islands = (pieces.join(offsets, _SEGMENT)
               .withColumn("sum_tag", (F.col("local_sum") + F.col("offset")).cast("bigint"))
               .groupBy(*_ID, "sum_tag").agg(F.sum("n").cast("bigint").alias("n")))
    return _from_id(islands)


def _so_far(n: Column, tagged: Column, upto: Column, w: WindowSpec) -> Column:
    """The events of the island at hand, up to the end of this row: those of all rows
    (``upto``) without those before the last row that was ``tagged``."""
    return upto - F.coalesce(F.max(F.when(tagged, upto - n)).over(w), F.lit(0))


def _segment_summaries(rows: DataFrame) -> DataFrame:
    """One row per segment of ``(id, segment, t, m)``.

    ``k`` times, the first ``t1`` (``m1`` events) and the last ``tk`` (``mk``);
    ``t2`` and ``tj`` are their neighbours inside.  The rows between have their
    tags: ``tags`` in all, ``head`` events before the first tag, ``tail`` from
    the last tag on (0 without tags), ``most`` in the largest piece after a tag,
    ``inner`` in all.  All are running values of one sorted pass, as they stand
    at the segment's last row: no aggregate holds the segments beside the sort."""
    w = Window.partitionBy(*_SEGMENT).orderBy("t")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    x = rows.select(*_SEGMENT, "t", "m", F.lag("t").over(w).alias("prev"), F.lead("t").over(w).alias("next"))
    inner = F.col("prev").isNotNull() & F.col("next").isNotNull()
    tag = F.when(inner, _tags(F.col("m"), F.col("t") - F.col("prev"), F.col("next") - F.col("t"))).otherwise(F.lit(0))
    x = x.withColumn("tag", tag).withColumn("n", F.when(inner, F.col("m")).otherwise(F.lit(0)))
    # Expressions of one step share a window pass.
    x = x.select(*_SEGMENT, "t", "m", "prev", "next", "n", (F.col("tag") > 0).alias("tagged"),
                 F.sum("tag").over(run).alias("tags"), F.sum("n").over(run).alias("inner"), F.count(F.lit(1)).over(run).alias("k"),
                 F.first("t").over(run).alias("t1"), F.first("m").over(run).alias("m1"), F.first("next").over(run).alias("t2"))
    x = x.withColumn("tail", F.when(F.col("tags") > 0, _so_far(F.col("n"), F.col("tagged"), F.col("inner"), run)).otherwise(F.lit(0)))
    x = x.select("*", F.max("tail").over(run).alias("most"), F.max(F.when(F.col("tags") == 0, F.col("inner"))).over(run).alias("head"))
    more = F.col("k") > 1
    return x.where(F.col("next").isNull()).select(
        *_SEGMENT, "k", "t1", "m1", F.when(more, F.col("t2")).alias("t2"), F.col("t").alias("tk"), F.col("m").alias("mk"),
        F.col("prev").alias("tj"), "tags", F.coalesce("head", F.lit(0)).alias("head"), "tail", "most", "inner")


def _fold(summaries: DataFrame, lead_default: int | None) -> DataFrame:
    """``(id, n)``: per segment of each (key, ad), in order, the largest size that an island
    has reached by the segment's end, of those that touch it.  (A piece that goes on beyond its
    segment counts with what it has so far, which is no more than its island; the row
    of the segment where an island ends has all of it.)  One sort per (key, ad)."""
    w = Window.partitionBy(*_ID).orderBy("segment")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    s = summaries.withColumn("before", F.coalesce(F.lag("tk").over(w), F.lit(0).cast("bigint"))).withColumn("after", F.lead("t1").over(w))
    more = F.col("k") > 1
    to_next = _or_last(F.col("after") - F.col("tk"), lead_default)
    one = _tags(F.col("m1"), F.col("t1") - F.col("before"), F.when(more, F.col("t2") - F.col("t1")).otherwise(to_next))
    end = F.when(more, _tags(F.col("mk"), F.col("tk") - F.col("tj"), to_next)).otherwise(F.lit(0))
    mk = F.when(more, F.col("mk")).otherwise(F.lit(0))
    s = s.select(*_ID, "segment", "m1", "head", "tags", "tail", "most", one.alias("one"), end.alias("end"), mk.alias("mk"),
                 (F.col("m1") + F.col("inner") + mk).alias("n"))
    # The events from the segment's last tag on (NULL without a tag): what stays open behind it.
    rest = F.when(F.col("end") > 0, F.col("mk")).when(F.col("tags") > 0, F.col("tail") + F.col("mk")).when(F.col("one") > 0, F.col("n"))
    s = s.withColumn("rest", rest).withColumn("upto", F.sum("n").over(run))
    s = s.withColumn("open", _so_far(F.col("rest"), F.col("rest").isNotNull(), F.col("upto"), run))
    entered = F.when(F.col("one") > 0, F.lit(0)).otherwise(F.coalesce(F.lag("open").over(w), F.lit(0)))
    return s.select(*_ID, F.greatest(entered + F.col("m1") + F.col("head"), "most", "open").alias("n"))


def cycle_keys(log: DataFrame, key: str, ad: str = "ad_id", t: str = "event_time",
               threshold: int = CYCLE_IP_THRESHOLD, dedup: bool = True, lead_default: int | None = 0,
               distinct: bool = True, prune: bool = True, null_time: int | None = None,
               segment_ms: int = SEGMENT_MS, counts: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """Distinct keys with an island of equal gaps larger than ``threshold``
    (light groups dropped first, exactly)."""
    rows = _segments(log, key, ad, t, dedup, threshold + 1 if prune else None, null_time, segment_ms, counts, tasks)
    segments = _segment_summaries(rows)
    found = _fold(segments if tasks is None else _dealt(segments, _ID, tasks), lead_default)
    return _keys(_from_id(found.where(F.col("n") > threshold)), key, distinct)


# ------------------------------------------------------------------ the four rules
def high_frequency_ip(log: DataFrame, window_ms: int = FREQUENCY_WINDOW_MS,
                      threshold: int = FREQUENCY_THRESHOLD, **kw) -> DataFrame:
    return high_frequency_keys(log, "client_ip", window_ms=window_ms, threshold=threshold, **kw)


def high_frequency_device(log: DataFrame, window_ms: int = FREQUENCY_WINDOW_MS,
                          threshold: int = FREQUENCY_THRESHOLD, **kw) -> DataFrame:
    return high_frequency_keys(log, "client_device_id", window_ms=window_ms, threshold=threshold,
                               exclude_empty=True, **kw)


def cycle_ip(log: DataFrame, threshold: int = CYCLE_IP_THRESHOLD, **kw) -> DataFrame:
    return cycle_keys(log, "client_ip", threshold=threshold, dedup=True, lead_default=0, **kw)


def cycle_device(log: DataFrame, threshold: int = CYCLE_DEVICE_THRESHOLD, **kw) -> DataFrame:
    return cycle_keys(log, "client_device_id", threshold=threshold, dedup=False, lead_default=None, **kw)
