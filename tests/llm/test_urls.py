import random

import pytest
from pyspark.sql import functions as F

from tallyroom.llm import urls


@pytest.mark.parametrize(("url", "host", "path", "rule"), [
    ("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/"),
    ("http://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    ("http://example.com", "example.com", "", None), ("http://com/", "com", "/", "com/"),
    ("https://a.net/es/x", "a.net", "/es/x", "net/es/"), ("https://anet/es/x", "anet", "/es/x", None),
    ("https://a.net/de/x", "a.net", "/de/x", None), ("nothing", "", "", None), (None, "", "", None), ("", "", "", None),
    ("x://y://z/?", "y:", "//z/", None), ("://Ä.net/fr/\n?", "Ä.net", "/fr/\n", "net/fr/")])
def test_parts_and_rules(one, url, host, path, rule):
    url = F.lit(url).cast("string")
    assert one(urls.host(url)) == host and one(urls.path(url)) == path
    found = one(urls.rule(urls.host(url), urls.path(url)))
    assert (found and found["rule"]) == rule


@pytest.mark.parametrize(("size", "share"), [(3000, 0.3), (3000, 0.01), (500, 0.9), (50, 1.0), (50, 0.0)])
def test_cascade_is_exact(spark, size, share):
    pick = random.Random(size)
    keys = [(f"host{i}.example", pick.random() < share) for i in range(size)]
    frame = spark.createDataFrame([*keys, (None, True)], "key string, listed boolean")
    cascade = urls.build(frame, "key", "listed")
    out = urls.on_list(frame.withColumnRenamed("listed", "truth"), cascade, "key").where("key is not null").collect()
    assert all(r["listed"] == r["truth"] for r in out)
    assert cascade.size <= 64 * 8 + 4 * size


def test_size_bound_is_checked(spark):
    frame = spark.createDataFrame([(str(i), i % 2 == 0) for i in range(2000)], "key string, listed boolean")
    with pytest.raises(ValueError, match="max_bytes"):
        urls.build(frame, "key", "listed", max_bytes=64)


def test_pages(spark):
    rows = [(1, "http://a.net/es/1"), (2, "http://a.net/de/2"), (3, "http://b.org/x"), (4, None), (4, None), (None, "http://a.net/fr/")]
    frame = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 as host", "2 as listed")
    out = [(r["page_id"], r["rule"], r["verdict"]) for r in urls.judged(frame).collect()]
    assert out == [(1, "net/es/", "block"), (2, None, "block"), (3, None, "allow"), (4, None, "allow"), (4, None, "allow"), (None, "net/fr/", "block")]
    assert urls.judged(frame.limit(0)).count() == 0
