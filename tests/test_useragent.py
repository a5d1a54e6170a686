"""User agent rules (P5)."""

import pytest
from pyspark.sql import functions as F

from loglark.functions.useragent import agent_columns, with_agent_columns

AGENTS = {
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 "
    "Safari/537.36": ("Chrome", "120.0.0.0", "Windows", "10.0"),
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.1 "
    "Safari/605.1.15": ("Safari", "17.1", "Mac OS X", "10.15.7"),
    "Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0": ("Firefox", "121.0", "Linux", None),
    "curl/8.4.0": ("Unknown", None, "Unknown", None),
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 "
    "Safari/537.36 Edg/120.0.2210.61": ("Edge", "120.0.2210.61", "Windows", "10.0"),
    "Mozilla/5.0 (Windows NT 6.1; Trident/7.0; rv:11.0) like Gecko": ("IE", "11.0", "Windows", "6.1"),
    "Mozilla/5.0 (Linux; Android 9; CUBOT X19) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/119.0.0.0 "
    "Mobile Safari/537.36": ("Chrome", "119.0.0.0", "Android", "9"),
    "Mozilla/5.0 (iPhone; CPU iPhone OS 16_6 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) "
    "CriOS/118.0.5993.69 Mobile/15E148 Safari/604.1": ("Chrome", "118.0.5993.69", "iOS", "16.6"),
    "Mozilla/5.0 (compatible; Googlebot/2.1; +http://www.google.com/bot.html)": ("Googlebot", "2.1", "Unknown", None),
    "MJ12BOT/1.0": ("MJ12BOT", "1.0", "Unknown", None),
    "Quiet library spider/3.2(+http://spider.example.org/about)": ("Quiet library spider", "3.2", "Unknown", None),
    "examplecrawler": ("examplecrawler", None, "Unknown", None),
}


def test_agent_rules(spark):
    df = spark.createDataFrame([(k,) for k in AGENTS] + [(None,)], "ua string")
    out = df.withColumns(agent_columns("ua")).collect()
    for r in out:
        got = (r["browsername"], r["browserversion"], r["osname"], r["osversion"])
        if r["ua"] is None:
            assert got == ("Unknown", None, "Unknown", None)
        else:
            assert got == AGENTS[r["ua"]], r["ua"]


@pytest.mark.parametrize("ua,name,version", [
    ("ab " * 40_000 + "longbot/2.1", "ab " * 40_000 + "longbot", "2.1"),  # recursed once per word
    ("x" * 120_000 + "bot;", "x" * 120_000 + "bot", None),
    ("Version/1 " * 12_000, "Unknown", None),  # a token many times, its second part never
    ("Trident/ " * 12_000 + "rv:11.0", "IE", "11.0"),
    ("Chrome/" * 15_000, "Chrome", None),
    ("(x;Some web spider/4.0(+a)", "Some web spider", "4.0"),
    ("a1 b-c_2 Thing-bot", "Thing-bot", None),
])
def test_agents_of_any_length(spark, ua, name, version):
    import time

    started = time.time()
    row = with_agent_columns(spark.createDataFrame([(ua,)], "ua string"), "ua").first()
    assert (row.browsername, row.browserversion) == (name, version)
    assert time.time() - started < 20
