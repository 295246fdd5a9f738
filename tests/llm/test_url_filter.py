"""URL rules against brute force and the query's SQL."""

import random

import duckdb

from mercato.llm import queries, url_filter

SF = "/root/testdata/sf0.001"


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut], rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def brute(url, rules):
    host, path = split(url)
    fits = [
        (len(h) + len(p), len(h), h + p, v) for (h, p), v in rules.items()
        if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "old", "x") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_filter.judge(pages, table)
    assert sorted(found.columns) == ["host", "page_id", "path", "rule", "url", "verdict"]
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in found.orderBy("page_id").collect()]


def test_brute_force(spark):
    rng = random.Random(3)
    label = lambda: rng.choice(["a", "b", "net", "org", "É"])
    urls = [None, "", "no scheme", "://", "http://", "http://NET/", "http://net", "x://net?q=/", "http://a.net:80/b", "http://.net/", "http://a..net/b/c"]
    urls += [f"http://{'.'.join(label() for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/', '/a', '/a/b', '/a/bc', '/a?x=http://net/'])}" for _ in range(200)]
    urls += urls[-5:]
    rules = {("net", "/"): "block", ("a.net", "/a"): "allow", ("b.a.net", ""): "block", ("org", "/a/b"): "block", ("a.org", "/a"): "allow", ("b", ""): "block"}
    rows = [(h, p, v) for (h, p), v in rules.items()] + [("net", "/", "allow"), (None, "/", "block"), ("", "/", "block"), ("a", "/", "maybe")]
    assert judged(spark, urls, rows) == [brute(u, rules) for u in urls]


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://a.net/x"], []) == [("a.net", "/x", None, "allow")]
    assert judged(spark, [], [("net", "/", "block")]) == []


def test_query_is_its_sql(spark):
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = sorted(duckdb.sql(queries.all_oracles()["op8_url_filter"]).fetchall(), key=str)
    found = queries.all_queries()["op8_url_filter"](spark, SF)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_columns_of_the_same_names(spark):
    names = ["judged", "won_rule", "won_verdict", "won", "digest", "suffix", "prefix", "rule_host", "rule"]
    pages = spark.createDataFrame([("http://a.net/b", *"abcdefghi")], ", ".join(f"{n} string" for n in ["url", *names]))
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    (row,) = url_filter.judge(pages, rules).collect()
    assert (row["won_rule"], row["judged"], row["rule"], row["verdict"]) == ("b", "a", "net/", "block")
