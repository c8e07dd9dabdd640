import random

import pytest
from pyspark.sql import functions as F

from adtrail.fixed import MAX_EVENT_TIME_MS
from adtrail.operators import traffic
from tools import direct_forms


@pytest.fixture(params=[1, 7])
def parts(spark, request):
    """One range part, and many (the same code runs at any size)."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set(keys[0], str(request.param))
    spark.conf.set(keys[1], "false")
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


def _log(spark, rows, key="client_ip"):
    return spark.createDataFrame(rows, f"{key} string, ad_id string, event_time bigint")


def _islands(df):
    return sorted((r["key"], r["ad"], r["n"]) for r in df.collect())


def test_trailing_window_counts(spark):
    log = _log(spark, [("a", "1", t) for t in (1, 300001, 300001, 300002)])
    got = {r["t"]: r["cnt"] for r in traffic.frequency_counts(log, "client_ip", window_ms=300000).collect()}
    assert got == {1: 1, 300001: 3, 300002: 3}


@pytest.mark.parametrize("gaps", [5, 6, 7])
def test_equal_gap_islands(spark, gaps):
    ts = [5000 + 1000 * i for i in range(gaps + 1)]
    ip = _log(spark, [("a", "1", t) for t in ts])
    dev = _log(spark, [("a", "1", t) for t in ts], "client_device_id")
    ip_isl = sorted(r["n"] for r in traffic.cycle_islands(ip, "client_ip").collect())
    dev_isl = sorted(r["n"] for r in traffic.cycle_islands(dev, "client_device_id", dedup=False,
                                                          lead_default=None).collect())
    assert ip_isl == [1, gaps]
    assert dev_isl == [gaps + 1]
    flagged = traffic.cycle_ip(ip).count()
    assert flagged == (1 if gaps > 5 else 0)


def test_worked_example_runs_do_not_merge(spark):
    ts = [1673032398580, 1673032398590, 1673043397267, 1673043397277]
    isl = traffic.cycle_islands(_log(spark, [("a", "1", t) for t in ts]), "client_ip")
    # equal 10 ms gaps that are not consecutive stay in different islands
    assert max(r["n"] for r in isl.collect()) < 3


def test_duplicates(spark):
    rows = [("a", "1", t) for t in (1000, 1000, 1000, 2000)]
    ip = traffic.cycle_islands(_log(spark, rows), "client_ip")
    dev = traffic.cycle_islands(_log(spark, rows, "client_device_id"), "client_device_id", dedup=False,
                                lead_default=None)
    assert sum(r["n"] for r in ip.collect()) == 2          # dedup on (ad, ip, t)
    assert sum(r["n"] for r in dev.collect()) == 4          # zero gaps kept
    direct = direct_forms.cycle_islands_direct(_log(spark, rows, "client_device_id"), "client_device_id",
                                          dedup=False, lead_default=None)
    assert _islands(dev) == _islands(direct)


def test_empty_device_excluded_from_frequency_only(spark):
    rows = [("", "1", 1000 * i) for i in range(10)]
    log = _log(spark, rows, "client_device_id")
    assert traffic.high_frequency_device(log, window_ms=100000, threshold=3).count() == 0
    assert traffic.cycle_device(log, threshold=5).collect()[0][0] == ""


def _random_rows(seed, n_keys=4, n=400, hot=True):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        k = "hot" if hot and rnd.random() < 0.4 else f"k{rnd.randrange(n_keys)}"
        ad = rnd.choice(["1", "2", None])
        period = rnd.choice([1000, 2500, 7000])
        t = rnd.randrange(0, 60) * period + rnd.choice([0, 0, 0, rnd.randrange(3000)])
        rows.append((k, ad, t))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_parted_cycle_equals_direct(spark, parts, seed):
    rows = _random_rows(seed)
    for key, dedup, lead in (("client_ip", True, 0), ("client_device_id", False, None)):
        log = _log(spark, rows, key)
        fast = traffic.cycle_islands(log, key, dedup=dedup, lead_default=lead)
        direct = direct_forms.cycle_islands_direct(log, key, dedup=dedup, lead_default=lead)
        assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


@pytest.mark.parametrize("seed", [4, 5])
def test_bucketed_frequency_equals_direct(spark, seed):
    log = _log(spark, _random_rows(seed))
    for w, th in ((5000, 3), (20000, 8)):
        fast = traffic.high_frequency_keys(log, "client_ip", window_ms=w, threshold=th)
        direct = direct_forms.high_frequency_keys_direct(log, "client_ip", window_ms=w, threshold=th)
        assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)


def test_naive_python_trailing_count(spark):
    rows = _random_rows(9, hot=False)
    log = _log(spark, rows)
    got = {(r["key"], r["ad"], r["t"]): r["cnt"] for r in
           traffic.frequency_counts(log, "client_ip", window_ms=4000).collect()}
    for (k, a, t), c in got.items():
        assert c == sum(1 for k2, a2, t2 in rows if k2 == k and a2 == a and t - 4000 <= t2 <= t)


def test_null_keys_and_times(spark):
    log = _log(spark, [(None, "1", 1000 * i) for i in range(8)] + [("a", "1", None)] * 3)
    isl = traffic.cycle_islands(log, "client_ip")
    assert {r["key"] for r in isl.collect()} == {None}
    assert F is not None


def _islands_python(rows, dedup, lead_default):
    """Plain-Python statement of the rule: lag(t, 1, 0); tag = d - lead(d) != 0 with
    the given lead default (None: NULL -> tag 0); ties ordered by t, d desc; sum_tag
    over a RANGE frame (rows with equal t share it); count per (key, ad, sum_tag)."""
    from collections import Counter, defaultdict
    groups = defaultdict(list)
    for k, a, t in rows:
        if t is not None:
            groups[(k, a)].append(t)
    out = Counter()
    for (k, a), ts in groups.items():
        ts = sorted(set(ts)) if dedup else sorted(ts)
        d, prev = [], 0
        for i, t in enumerate(ts):
            d.append(t - (ts[i - 1] if i else prev))
        # within a tie the nonzero difference comes first (t, d desc): already the case
        lead = [d[i + 1] if i + 1 < len(d) else lead_default for i in range(len(d))]
        tag = [1 if (ld is not None and di - ld != 0) else 0 for di, ld in zip(d, lead)]
        running, upto = 0, {}
        for t, g in zip(ts, tag):
            running += g
            upto[t] = running            # last write per t: sum over all peers
        for t in ts:
            out[(k, a, upto[t])] += 1
    return sorted(((k, a, s, n) for (k, a, s), n in out.items()), key=repr)


@pytest.mark.parametrize("seed", [11, 12])
def test_islands_match_plain_python(spark, parts, seed):
    rnd = random.Random(seed)
    rows = []
    for _ in range(300):
        k = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(3)}"
        gap = rnd.choice([1000, 3000])
        t = rnd.randrange(0, 40) * gap
        rows.append((k, rnd.choice(["1", None]), t))
        if rnd.random() < 0.2:
            rows.append(rows[-1])          # duplicates
    for key, dedup, lead in (("client_ip", True, 0), ("client_device_id", False, None)):
        log = _log(spark, rows, key)
        got = traffic.cycle_islands(log, key, dedup=dedup, lead_default=lead)
        got = sorted(((r["key"], r["ad"], r["sum_tag"], r["n"]) for r in got.collect()), key=repr)
        assert got == _islands_python(rows, dedup, lead), key


@pytest.mark.parametrize("seed", [21, 22])
def test_pruned_flags_equal_unpruned_and_direct(spark, parts, seed):
    rows = _random_rows(seed, n_keys=12, n=300)
    rows += [(None, "1", 1000 * i) for i in range(9)] + [("k0", None, 5000 * i) for i in range(7)]
    for key, dedup, lead in (("client_ip", True, 0), ("client_device_id", False, None)):
        log = _log(spark, rows, key)
        for th in (4,):
            pruned = traffic.cycle_keys(log, key, threshold=th, dedup=dedup, lead_default=lead)
            full = traffic.cycle_keys(log, key, threshold=th, dedup=dedup, lead_default=lead,
                                      prune=False)
            isl = direct_forms.cycle_islands_direct(log, key, dedup=dedup, lead_default=lead)
            direct = isl.where(F.col("n") > th).select("key").distinct()
            want = sorted((r[0] for r in direct.collect()), key=repr)
            assert sorted((r[0] for r in pruned.collect()), key=repr) == want
            assert sorted((r[0] for r in full.collect()), key=repr) == want
        fast = traffic.high_frequency_keys(log, key, window_ms=8000, threshold=3)
        slow = traffic.high_frequency_keys(log, key, window_ms=8000, threshold=3, prune=False)
        assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, slow.collect()), key=repr)


def test_one_key_with_scattered_times(spark, parts):
    rnd = random.Random(31)
    times = sorted(rnd.sample(range(0, MAX_EVENT_TIME_MS, 7_200_000), 1500))
    times += [times[-1] + 1000 * i for i in range(1, 40)]
    rows = [("hot", "1", t) for t in times] + [("a", "1", 5), ("z", None, 7)]
    for key, dedup, lead in (("client_ip", True, 0), ("client_device_id", False, None)):
        got = traffic.cycle_islands(_log(spark, rows, key), key, dedup=dedup, lead_default=lead)
        got = sorted(((r["key"], r["ad"], r["sum_tag"], r["n"]) for r in got.collect()), key=repr)
        assert got == _islands_python(rows, dedup, lead)


def test_equal_gaps_over_whole_parts(spark, parts):
    """One island over many parts, between two other groups."""
    rows = [("hot", "1", 1000 * i) for i in range(1, 400)] + [("a", "1", 3), ("hot", "0", 9), ("z", "1", 4)]
    got = traffic.cycle_islands(_log(spark, rows), "client_ip")
    got = sorted(((r["key"], r["ad"], r["sum_tag"], r["n"]) for r in got.collect()), key=repr)
    assert got == _islands_python(rows, True, 0)


def test_no_window_holds_a_whole_key(spark):
    log = _log(spark, _random_rows(3))
    for df in (traffic.cycle_keys(log, "client_ip"), traffic.high_frequency_keys(log, "client_ip"),
               traffic.cycle_rows(log, "client_ip")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Window [" in line:
                by = line.split("], [")[1]      # Window [functions], [partition], [order]
                # ... or is the fold over a key's segments: a row per time span.
                assert "segment#" in line or "bucket#" in by or "kk#" not in by, line


@pytest.mark.parametrize("segment_ms", [1, 1500, 9000, 10 ** 7])
def test_segmented_scan_equals_direct(spark, segment_ms):
    rows = _random_rows(41, n_keys=6, n=350) + [("one", "1", 77)] + [("even", "1", 700 * i) for i in range(1, 60)]
    rows += [("even", "2", 5000)] * 3 + [("even", "2", 700 * i) for i in range(20)]
    for key, dedup, lead in (("client_ip", True, 0), ("client_device_id", False, None)):
        log = _log(spark, rows, key)
        direct = direct_forms.cycle_islands_direct(log, key, dedup=dedup, lead_default=lead).cache()
        got = traffic.cycle_islands(log, key, dedup=dedup, lead_default=lead, segment_ms=segment_ms)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, direct.collect()), key=repr)
        # The fold's largest island per key is the direct form's, so every threshold agrees.
        folded = traffic._fold(traffic._segment_summaries(traffic._segments(
            log, key, "ad_id", "event_time", dedup, None, None, segment_ms, None)), lead)
        most = {r[0]: r[1] for r in traffic._from_id(folded).groupBy("key").agg(F.max("n")).collect()}
        assert most == {r[0]: r[1] for r in direct.groupBy("key").agg(F.max("n")).collect()}
        direct.unpersist()


def test_light_groups_go_and_heavy_ones_stay(spark):
    rows = [(f"k{i}", "1", i) for i in range(300)] + [("hot", None, i) for i in range(9)] + [(None, "2", i) for i in range(5)]
    log = _log(spark, rows)
    for slots in (1, 64, 1 << 24):
        kept = traffic.without_light_groups(log, "client_ip", "ad_id", 5, slots)
        assert kept.columns == log.columns
        got = [tuple(r) for r in kept.collect()]
        assert {r for r in rows if r[0] in ("hot", None)} <= set(got) and len(got) == len(set(got))
        assert len(got) == (14 if slots == 1 << 24 else len(rows) if slots == 1 else len(got))
    assert traffic.without_light_groups(log, "client_ip", "ad_id", 400, 1 << 24).count() == 0


def test_rules_of_a_key_share_their_counts(spark):
    from adtrail.operators.flags import RuleParams, rule_set, rule_sets

    rows = [(k, k, a, t) for k, a, t in _random_rows(51, n_keys=8, n=400)] + [("", "", "1", 1000 * i) for i in range(30)]
    log = spark.createDataFrame(rows, "client_ip string, client_device_id string, ad_id string, event_time bigint")
    p = RuleParams(8000, 4, 4, 6)
    for rule, df in rule_sets(log, p).items():
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(map(tuple, rule_set(log, rule, p).collect()), key=repr), rule


HOSTILE = (-2 ** 63, 2 ** 63 - 1, -1, MAX_EVENT_TIME_MS)


def test_hostile_times_count_as_missing(spark, parts):
    rows = [("a", "1", t) for t in (*HOSTILE, 1000, 2000, 3000)] + [("b", "1", t) for t in HOSTILE]
    log = _log(spark, rows)
    got = {(r["key"], r["t"]): r["cnt"] for r in traffic.frequency_counts(log, "client_ip", window_ms=1500).collect()}
    assert got == {("a", None): 4, ("a", 1000): 1, ("a", 2000): 2, ("a", 3000): 2, ("b", None): 4}
    for key, dedup, lead in (("client_ip", True, 0), ("client_device_id", False, None)):
        isl = traffic.cycle_islands(_log(spark, rows, key), key, dedup=dedup, lead_default=lead)
        valid = [(k, a, t if 0 <= t < MAX_EVENT_TIME_MS else None) for k, a, t in rows]
        got = sorted(((r["key"], r["ad"], r["sum_tag"], r["n"]) for r in isl.collect()), key=repr)
        assert got == _islands_python(valid, dedup, lead)


def test_missing_times_are_peers_in_the_frequency_rule(spark):
    rows = [("a", "1", None)] * 150 + [("b", "1", None)] * 100 + [("a", "1", 5)]
    log = _log(spark, rows)
    assert [r[0] for r in traffic.high_frequency_ip(log).collect()] == ["a"]
    direct = direct_forms.high_frequency_keys_direct(log, "client_ip")
    assert [r[0] for r in direct.collect()] == ["a"]


def test_missing_times_in_the_period_rule_by_choice(spark):
    rows = [("a", "1", None), ("a", "1", None), ("a", "1", 1000), ("a", "1", 2000)]
    log = _log(spark, rows)
    nowhere = traffic.cycle_islands(log, "client_ip", dedup=False)
    assert sum(r["n"] for r in nowhere.collect()) == 2
    at_zero = traffic.cycle_islands(log, "client_ip", dedup=False, null_time=0)
    got = sorted(((r["key"], r["ad"], r["sum_tag"], r["n"]) for r in at_zero.collect()), key=repr)
    assert got == _islands_python([(k, a, t or 0) for k, a, t in rows], False, 0)


def test_period_rule_sorts_once_and_keeps_no_aggregate(spark):
    """From the counts to an island's size: one sort per exchange, no rows multiplied, no hash table beside the sort."""
    counts = traffic.timestamp_counts(_log(spark, _random_rows(61)), "client_ip").localCheckpoint()
    found = traffic._fold(traffic._segment_summaries(traffic._segments(counts, "", "", "", True, None, None, 9000, counts)), 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Sort [") == 2, plan
    assert "Aggregate" not in plan and "Generate" not in plan, plan


def test_tasks_of_the_rules_follow_the_counts(spark, monkeypatch):
    from adtrail.operators.flags import RuleParams, key_rules

    rows = [(k, k, a, t) for k, a, t in _random_rows(71, n_keys=8, n=400)]
    log = spark.createDataFrame(rows, "client_ip string, client_device_id string, ad_id string, event_time bigint")
    p = RuleParams(8000, 4, 4, 6)
    want = {rule: sorted(map(tuple, df.collect()), key=repr) for rule, df in key_rules(log, "client_ip", p).items()}
    monkeypatch.setattr(traffic, "TASK_ROWS", 20)
    for rule, df in key_rules(log, "client_ip", p).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan, rule
        assert sorted(map(tuple, df.collect()), key=repr) == want[rule], rule
