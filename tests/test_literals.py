import re

import pytest
from pyspark.sql import functions as F

from adtrail.operators.crawler import crawler_match, crawler_match_naive
from adtrail.operators.literals import matches, required_pieces
from adtrail.operators.ua import UA_RULE_ROWS, default_rules, parse_agents

PATTERNS = ["Googlebot", "bot", "[Ss]pider", "curl/", "a+bcd*e", "(foo)?bar-baz", "x(yz)+w123", "ab{2}cdef", "one|two", "(?i)GOOGLE", "[0-9]{4}", "g.ogle", r"google\.com/b", "^Mozilla",
            "Chrome/[0-9.]+$", "", "bot", r"\QA.B\E", r"\x41bcd", "[]x]yzzy", r"Safari\b", "colou?red", "((deep)er)est", "no match here", "é+tude", "ab", r"\[bracket", "nest[a[bc]]ed"]
AGENTS = ["Googlebot/2.1 (+http://www.google.com/bot.html)", "curl/8.0", "Baiduspider", "aabcde", "abcddd", "foobar-baz", "bar-baz", "xyzyzw123", "abbcdef", "two", "google 2024",
          "Mozilla/5.0 Chrome/120.0.1", "A.B", "Abcd", "xyzzy", "]yzzy", "Safari 17", "colored", "coloured", "deeperest", "étude", "", "ab", "a", "[bracket", "nested", "\U0001f642 bot"]


def test_every_match_holds_the_required_pieces(spark):
    rows = [(p,) for p in PATTERNS if p not in ("[]x]yzzy",)]
    df = spark.createDataFrame(rows, "pattern string").withColumn("pieces", required_pieces("pattern"))
    got = {r["pattern"]: r["pieces"] for r in df.collect()}
    pairs = spark.createDataFrame([(a,) for a in AGENTS], "a string").join(df, F.expr("a rlike pattern")).collect()
    assert all(piece in r["a"] for r in pairs for piece in r["pieces"])
    assert got["Googlebot"] == ["Googlebot"] and got["one|two"] == [] and got["(?i)GOOGLE"] == [] and got["[0-9]{4}"] == []
    assert got["x(yz)+w123"] == ["x", "w123"] and got["colou?red"] == ["colo", "red"] and got["(foo)?bar-baz"] == ["bar-baz"]
    assert got["ab{2}cdef"] == ["a", "cdef"] and got["a+bcd*e"] == ["a", "bc", "e"] and got[r"\x41bcd"] == []


def test_matches_against_the_theta_join(spark):
    rows = [p for p in PATTERNS if p != "[]x]yzzy"]
    agents = spark.createDataFrame([(a,) for a in AGENTS], "_agent string")
    patterns = spark.createDataFrame([(p,) for p in [*rows, None]], "pattern string")
    want = sorted(map(tuple, agents.join(patterns.distinct(), F.expr("_agent rlike pattern")).collect()))
    assert sorted(map(tuple, matches(agents, patterns).collect())) == want
    log = spark.createDataFrame([(a, i) for i, a in enumerate([*AGENTS, None, AGENTS[0]])], "client_ua string, id int")
    naive = crawler_match_naive(log, patterns)
    key = lambda r: (r["id"], r["crawler_pattern"] or "")
    assert sorted(map(key, crawler_match(log, patterns).collect())) == sorted(map(key, naive.collect()))


def test_a_long_pattern_table(spark):
    patterns = spark.range(20_000).select(F.concat(F.lit("id-"), F.col("id").cast("string"), F.lit("( |$)")).alias("pattern"))
    agents = spark.range(0, 30_000, 10).select(F.concat(F.lit("agent id-"), F.col("id").cast("string")).alias("_agent"))
    out = matches(agents, patterns)
    assert out.count() == 2000


def test_rule_table_equals_rule_list(spark):
    agents = ["Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.1", "curl/8.0", "Googlebot/2.1",
              "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1", "x"]
    df = spark.createDataFrame([(a,) for a in agents], "ua string")
    by_list = {r["ua"]: r["ua_struct"] for r in parse_agents(df, UA_RULE_ROWS).collect()}
    assert {r["ua"]: r["ua_struct"] for r in parse_agents(df, default_rules(spark)).collect()} == by_list
