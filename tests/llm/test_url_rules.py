import pyspark.sql.functions as F

from panelcast.llm import url_rules as U

URLS = [None, "", "no scheme.net/x", "http://", "http://NET/", "https://a.b.Example.NET/en/x?y#z", "http://example.net", "http://example.net?/en/", "http://example.net#/",
        "http://example.net/en", "http://example.net/en/", "http://notexample.net/en/a", "http://example.com/de/", "http://x.example.com/de", "http://a.org/fr/1", "http://org/fr/",
        "http://a.org/FR/", "x://y://z.net/", "http://.net/", "http://net:80/", "http://u@x.net/", "http://É.net/é/ü", "http://a.net/" + "x" * 50000, "http://" + "a." * 3000 + "net/",
        "http://line\nbreak.net/a\nb?c", "http://example.net/en/", "http://example.net/en/"]


def brute(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host):]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for h, p, v in rules if h and p is not None and v and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def test_equals_brute_force(spark):
    more = U.RULES + [("b.example.net", "/en/x", "block"), ("c", "", "block"), ("", "/", "block"), ("a.org", "/fr/", "block"), ("a.org", "/fr/", "allow"), ("a.org", "/fr/", "allow"),
                      ("org", "/fr/1/long/path", "allow"), (None, "/", "block"), ("net", None, "block")]
    rows = [(i if i != 3 else None, u) for i, u in enumerate(URLS)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("x")).withColumn("rule", F.lit(1))
    for rules in (U.RULES, more, []):
        for hot_share in (U.HOT_SHARE, 0.1, 2.0):  # every site, sites of three pages, none are hot
            got = U.apply_rules(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), hot_share=hot_share).collect()
            assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *brute(u, rules))) for i, u in rows)
    assert U.apply_rules(pages.limit(0), spark.createDataFrame(U.RULES, "host string, path string, verdict string")).collect() == []


def test_only_dataframe_functions(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = U.apply_rules(pages, spark.createDataFrame(U.RULES, "host string, path string, verdict string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
