import pytest

from daymark.llm.url_filter import bloom_blocks, judge_urls
from pyspark.sql import functions as F

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("b.example.org/es/x", "allow"), ("com", "block"), (None, "block")]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    path = tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]
    fits = []
    for rule, verdict in RULES:
        if rule:
            h, slash, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
                fits.append((len(rule), rule, verdict))
    return (host, path, *(max(fits)[1:] if fits else (None, "allow")))


URLS = [
    None, "", "no scheme", "http://", "http://org", "http://ORG/", "https://a.b.EXAMPLE.org/es/x?q", "http://example.org/es#x",
    "http://badexample.org/es/1", "ftp://x.com", "http://com?x", "http://a.com/p://q/", "http://É.org/ü/?", "http://.org/", "http://org./",
    "http://b.example.org/es/xy", "http://b.example.org/es/y", "http://b.example.org/es/y", "x\n://org/\n1",
]


@pytest.mark.parametrize("max_blocks", [1, 1 << 17])
def test_against_brute_force(spark, max_blocks):
    pages = spark.createDataFrame([(i, u, "taken") for i, u in enumerate(URLS)], "page_id bigint, url string, verdict string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    found = judge_urls(pages, rules, max_blocks=max_blocks).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, found), key=lambda r: r[0]) == [(i, *brute(u)) for i, u in enumerate(URLS)]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    assert judge_urls(pages.limit(0), rules).count() == 0
    row = judge_urls(pages, rules.limit(0)).first()
    assert (row.rule, row.verdict) == (None, "allow")


def test_every_listed_key_passes_the_filter(spark):
    keys = spark.range(2000).select(F.concat(F.lit("h"), F.col("id").cast("string")).alias("key"))
    blocks = bloom_blocks(keys, 512)
    assert blocks.count() <= 512
    assert 0 < blocks.agg(F.sum(F.bit_count("bits"))).first()[0] <= 2000 * 5


def test_no_python_on_the_path(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    plan = judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan
