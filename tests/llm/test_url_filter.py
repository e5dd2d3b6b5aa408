from tidemark.llm.url_filter import Rule, build_cascade, judge, under_domains, with_membership

RULES = [Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("a.example.net", "/", "block")]


def test_membership_is_exact_for_every_key(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) AS key", "CASE WHEN id % 11 = 0 THEN true WHEN id % 2 = 0 THEN false END AS listed")
    for shard_bits, shards in ((1 << 23, 1), (1 << 10, 2)):
        cascade = build_cascade(universe, shard_bits)
        assert cascade.shards >= shards and len(cascade.levels) > 1
        rows = universe.selectExpr("key", "coalesce(listed, false) AS wanted")
        assert with_membership(rows, "key", cascade).where("listed <> wanted").isEmpty()


def test_all_or_none_listed(spark):
    keys = spark.range(5).selectExpr("concat('k', id) AS key")
    for listed in ("true", "false"):
        universe = keys.selectExpr("key", f"{listed} AS listed")
        got = with_membership(keys, "key", build_cascade(universe)).collect()
        assert {r["listed"] for r in got} == {listed == "true"}
    assert build_cascade(keys.selectExpr("key", "true AS listed").limit(0)).levels == ()


def test_urls_rules_and_odd_rows(spark):
    urls = {
        1: ("http://WWW.Example.NET/en/x?q=1", "www.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("https://other.net/x", "other.net", "/x", "net/", "block"),
        3: ("https://other.net", "other.net", "", None, "allow"),
        4: ("//no/scheme", "", "", None, "allow"),
        5: (None, "", "", None, "allow"),
        6: ("http://sub.bad.org#f", "sub.bad.org", "", None, "block"),
        7: ("http://notbad.org/", "notbad.org", "/", None, "allow"),
        8: ("x://a.example.net/en/", "a.example.net", "/en/", "example.net/en/", "allow"),
        9: ("ftp://h/a://b/", "h", "/a://b/", None, "allow"),
        10: ("http://É.org?x", "É.org", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u[0]) for i, u in urls.items()] + [(1, urls[1][0]), (None, urls[2][0])], "page_id bigint, url string")
    pages = pages.selectExpr("*", "'z' AS host", "'z' AS listed", "1 AS key", "2 AS path")
    domains = spark.createDataFrame([("bad.org",), ("bad.org",), ("absent.com",)], "domain string")
    got = judge(pages, RULES, domains).collect()
    assert len(got) == 12
    for r in got:
        want = urls[r["page_id"] or 2]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == want[1:]
    assert judge(pages.limit(0), RULES, domains).count() == 0
    assert {r["verdict"] for r in judge(pages, [], domains.limit(0)).collect()} == {"allow"}


def test_parent_domains(spark):
    hosts = spark.createDataFrame([("a.b.c",), ("xb.c",), ("b.c",), ("",)], "key string")
    got = under_domains(hosts, spark.createDataFrame([("b.c",)], "domain string")).collect()
    assert {r["key"]: r["listed"] for r in got} == {"a.b.c": True, "xb.c": False, "b.c": True, "": False}
