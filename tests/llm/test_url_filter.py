"""Verdicts against every rule in turn."""

import random

from riskloom.llm.url_filter import judge

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"), ("org", "block"), ("a.org/x", "allow"), ("org/x/y/", "block"), ("EXAMPLE.org/q", "block"), ("twice.com/", "block"), ("twice.com/", "allow")]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for rule, verdict in RULES:
        h, _, p = rule.partition("/")
        h, p = h.lower(), rule[len(h) :]
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0, "", ""), (len(rule), rule, verdict))
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


def test_like_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.com", "www.example.com", "m.www.example.com", "notexample.com", "com", "x.net", "net", "b.a.org", "a.org", "example.org", "twice.com", "WWW.Example.COM", "a..com", "x.com:80", "", "é.com", ".com", "com."]
    paths = ["", "/", "/en/", "/en/1", "/en", "/es/2", "/fr/", "/x", "/x/y/z", "/x?u=/en/", "/q#a", "/EN/", "/é/\x01"]
    urls = [f"{s}://{h}{p}{e}" for h in hosts for p in paths for s in ("http", "https") for e in ("", "?a=b", "#://c")]
    urls += [None, "", "no scheme", "example.com/en/", "http:/x.com", "http://", "a://b://example.com/en/", "http://x.com/\n/en", "http://" + "a." * 300 + "com/en/"] + ["http://www.example.com/en/"] * 50
    rng.shuffle(urls)
    df = spark.createDataFrame([(i, u, "k", 1) for i, u in enumerate(urls)] + [(0, urls[0], "k", 1)], "page_id long, url string, key string, rule int").repartition(5)
    rules = spark.createDataFrame([*RULES, (None, "block"), ("", "block"), ("/x", "block")], "rule string, verdict string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [tuple(r) for r in judge(df, rules, ["page_id"]).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got, key=repr) == sorted([(i, *brute(u)) for i, u in enumerate(urls)] + [(0, *brute(urls[0]))], key=repr)


def test_long_urls(spark):
    long = ["http://b.ai/" + "x" * 1_000_000, "http://example.com/en/" + "/y" * 500_000, "http://" + "a." * 20_000 + "org/x/y/z", "http://" + "b" * 300_000 + ".com/"]
    df = spark.createDataFrame(list(enumerate(long)), "page_id long, url string")
    rules = spark.createDataFrame([*RULES, ("com/" + "q" * 2000, "block")], "rule string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge(df, rules, ["page_id"]).collect()}
    assert got == {i: brute(u) for i, u in enumerate(long)}


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    assert judge(pages.limit(0), rules, ["page_id"]).count() == 0
    assert [tuple(r) for r in judge(pages, rules.limit(0), ["page_id"], default="block").collect()] == [(1, "a.com", "/", None, "block")]
