from pyspark.sql import functions as F

from adtrail.operators.crawler import crawler_flag, crawler_match, default_patterns
from adtrail.operators.ua import attach_ua_struct, default_rules, parse_agents

CHROME = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36"
GBOT = "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)"
IPHONE = ("Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
          "Version/17.1 Mobile/15E148 Safari/604.1")


def _log(spark, uas):
    return spark.createDataFrame([(i, u) for i, u in enumerate(uas)], "id int, client_ua string")


def test_parse_agents(spark):
    agents = spark.createDataFrame([(CHROME,), (IPHONE,), ("curl/8.0",)], "ua string")
    got = {r["ua"]: r["ua_struct"].asDict() for r in parse_agents(agents, default_rules(spark)).collect()}
    assert got[CHROME]["browser"] == "Chrome" and got[CHROME]["browserVersion"] == "120.0.0.0"
    assert got[CHROME]["os"] == "Windows" and got[CHROME]["osVersion"] == "10.0"
    assert got[CHROME]["isMobile"] is False
    assert got[IPHONE]["browser"] == "Safari" and got[IPHONE]["osVersion"] == "17_1"
    assert got[IPHONE]["isMobile"] is True and got[IPHONE]["platform"] == "iPhone"
    assert got["curl/8.0"]["browser"] == "Unknown" and got["curl/8.0"]["browserVersion"] is None


def test_empty_and_null_agent_get_null_struct(spark):
    out = attach_ua_struct(_log(spark, [CHROME, "", None]), default_rules(spark)).orderBy("id").collect()
    assert out[0]["ua_struct"]["browser"] == "Chrome"
    assert out[1]["ua_struct"] is None and out[2]["ua_struct"] is None


def test_crawler_fanout(spark):
    out = crawler_match(_log(spark, [GBOT, CHROME, None]), default_patterns(spark))
    by_id = {}
    for r in out.collect():
        by_id.setdefault(r["id"], []).append(r["crawler_pattern"])
    assert sorted(by_id[0]) == ["Googlebot", "bot"]       # two patterns -> two rows
    assert by_id[1] == [None] and by_id[2] == [None]      # no match / NULL -> one row


def test_crawler_flag_no_fanout(spark):
    out = crawler_flag(_log(spark, [GBOT, CHROME, None]), default_patterns(spark)).orderBy("id").collect()
    assert [r["is_crawler"] for r in out] == [True, False, False]


def test_regex_join_runs_on_distinct_agents(spark):
    log = _log(spark, [GBOT] * 50 + [CHROME] * 50)
    plan = crawler_match(log, default_patterns(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan      # agents are matched once, then joined back on the string
    assert F is not None
