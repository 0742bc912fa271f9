import pytest
from pyspark.sql import functions as F

from pubweave.functions import scoring, titles, urls


def values(spark, f, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string").select("i", f(F.col("x")).alias("y")).collect()
    return [r["y"] for r in sorted(rows, key=lambda r: r["i"])]


def test_canonical_url(spark):
    cases = {
        "http://www.Foo.com/a/?utm_source=x&b=2&a=1#top": "https://foo.com/a?a=1&b=2",
        "https://youtube.com/watch?v=abc": "https://youtube.com/watch?v=abc",
        "https://groups.google.com/forum/#!topic/x/y": "https://groups.google.com/forum#!topic/x/y",
        "https://foo.com": "https://foo.com/",
        None: "",
        "http://a_b.com/x|y z;p?q=~*&k": "https://a_b.com/x|y z?k=&q=~%2A",
    }
    got = values(spark, urls.canonical_url, list(cases))
    assert got == list(cases.values())
    again = [x for x in got if x]
    assert values(spark, urls.canonical_url, again) == again


def test_blog_key(spark):
    cases = {
        "https://randomascii.wordpress.com/2014/x": "randomascii.wordpress.com", "https://lcamtuf.substack.com/p/slug": "lcamtuf.substack.com", "https://medium.com/@u/post": "medium.com/@u",
        "https://medium.com/": None, "https://medium.com/tag/x": None, "https://wordpress.com/2014/x": None, "https://www.foo.com:8080/a": "foo.com", "ftp://foo.com": None, None: None,
    }
    got = values(spark, urls.blog_key, list(cases))
    assert [k and k["key"] for k in got] == list(cases.values())


def test_denied(spark):
    assert values(spark, urls.denied, ["en.wikipedia.org", "cs.mit.edu", "status.foo.com", "blog.foo.com", None]) == [True, True, True, False, False]


def test_registrable_domain(spark):
    assert values(spark, urls.registrable_domain, ["a.b.blogspot.com", "x.y.co.uk", "blog.foo.com", "localhost"]) == ["b.blogspot.com", "y.co.uk", "foo.com", "localhost"]


def test_url_join_like_the_standard_library(spark):
    from urllib.parse import urljoin

    base = "https://a.com/b/c?d#e"
    refs = ["f", "/f", "//g.com/h", "../f", "./f", "?x=1", "#z", "https://o.org/", "../../../f", "g/../h/.", ""]
    assert values(spark, lambda r: urls.url_join(F.lit(base), r), refs) == [urljoin(base, r) if r != "" else base for r in refs]


def test_feed_discovery(spark):
    html = '<head><link rel="alternate" type="application/rss+xml" href="/feed.xml"></head>'
    assert values(spark, lambda h: urls.discover_feed_link(h, F.lit("https://a.com/b")), [html, "<p>", None]) == ["https://a.com/feed.xml", None, None]
    assert values(spark, urls.platform_feed, ["https://x.substack.com", "https://medium.com/@u", "https://dev.to/u", "https://a.com"]) == ["https://x.substack.com/feed", "https://medium.com/feed/@u", "https://dev.to/feed/u", None]


def test_titles(spark):
    assert values(spark, titles.norm_title, ["Let's Not Encrypt (2019)", "Let's not encrypt [pdf]", "日本"]) == ["letsnotencrypt", "letsnotencrypt", ""]
    assert values(spark, titles.kind_rule, ["Postmortem: outage", "Foo 1.2 released", "How DNS works", "Why not", "plain"]) == ["incident", "announcement", "deep-dive", "opinion", None]
    assert values(spark, titles.is_reply_title, ["Video • Re: Radeon", "Re: x", "Rewrite", "fix (tags: trunk)", None]) == [True, True, False, True, False]
    assert values(spark, titles.clean_title, [" a\nb ", " \n", None]) == ["a b", None, None]


def test_scores(spark):
    now = 1_700_000_000
    row = spark.range(1).select(
        scoring.post_score(F.lit(3000), F.lit(now), now).alias("a"), scoring.post_score(F.lit(1), F.lit(now - 6 * 31_557_600), now).alias("b"),
        scoring.day_number(F.lit(1136073600 + 86_400)).alias("c"), scoring.topic_mask(F.expr("array(named_struct('slug','systems','weight',0.2D), named_struct('slug','web','weight',0.1D))")).alias("d"),
        scoring.feed_date(F.lit("Tue, 02 Jan 2024 03:04:05 GMT"), F.lit(None).cast("string")).alias("e"), scoring.feed_date(F.lit(None).cast("string"), F.lit("2024-01-02T03:04:05Z")).alias("f"),
        scoring.hn_id(F.lit("x")).alias("g"),
    ).first()
    assert tuple(row) == (255, 28, 1, 1, 1704164645, 1704164645, 0)


@pytest.mark.parametrize("f", [urls.canonical_url, urls.slugs, urls.blog_key, titles.norm_title, titles.clean_summary])
def test_plans_stay_out_of_python(spark, f):
    plan = spark.range(1).select(f(F.lit("https://a.com/b"))).selectExpr("*")._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_post_paths(spark):
    cases = {"https://a.com": "/", "https://a.com/b?c=1#d": "/b?c=1#d", "https://a.com?x=1": "/?x=1", "https://a.com/b\n": "/b"}
    assert values(spark, urls.post_path, list(cases)) == list(cases.values())
    assert values(spark, lambda u: urls.post_path(u, fragment=False), ["https://a.com#f", "https://a.com/b#f"]) == ["/", "/b"]
    assert values(spark, lambda u: urls.post_path(urls.canonical_url(u)), ["http://www.a.com/b/?utm_source=x#top"]) == ["/b"]


def test_dates_without_a_zone_are_utc(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = values(spark, lambda x: scoring.feed_date(x, F.lit(None).cast("string")), ["2024-01-02T03:04:05", "2024-01-02 03:04:05", "2024-01-02", "2024-01-02T03:04:05+01:00", "soon"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [1704164645, 1704164645, 1704153600, 1704161045, None]


def test_looks_like_feed(spark):
    assert values(spark, lambda b: urls.looks_like_feed(F.lit("text/html"), b), ["\n\t <?xml", "<html>", None]) == [True, False, False]
    assert values(spark, lambda k: urls.looks_like_feed(k, F.lit("")), ["application/XML", None]) == [True, False]


def test_suffix_rules(spark):
    rules = spark.createDataFrame([(r,) for r in ["com", "uk", "co.uk", "*.ck", "!www.ck", "blogspot.com"]], "rule string")
    hosts = {"a.b.co.uk": "b.co.uk", "x.com": "x.com", "com": "com", "a.b.c.ck": "b.c.ck", "x.www.ck": "www.ck", "www.ck": "www.ck", "p.blogspot.com": "p.blogspot.com", "blogspot.com": "blogspot.com", "a.b.zz": "b.zz", "localhost": "localhost", "": ""}
    df = spark.createDataFrame([(h,) for h in [*hosts, "x.com", None]], "host string")
    assert {r.host: r.domain for r in urls.registrable_domains(df, rules).collect()} == hosts
