import os
import random

from pyspark.sql import functions as F

from pubweave.operators import batches, blogs, checks, feeds, posts, search, storage, stories
from pubweave.operators.numbering import number_rows, number_sorted
from pubweave.sources import readers, writers
from pubweave.streaming.ingest import ingest_stream, work_stream

STORY = "seq long, objectID string, title string, url string, points int, num_comments int, created_at_i long"


def test_dedupe(spark):
    rows = [(1, "1", "A", "http://www.foo.com/a/?ref=x", 10, 2, 5), (2, "2", "B", "https://foo.com/a", 30, 3, 6), (3, "3", "b", "https://foo.com/z", 5, 1, 7), (4, "4", "b", "https://bar.com/z", 5, 1, 7)]
    once = stories.dedupe_by_url(spark.createDataFrame(rows, STORY))
    assert {(r.seq, r.points, r.num_comments, r.repost_count) for r in once.collect()} == {(2, 30, 5, 1), (3, 5, 1, 0), (4, 5, 1, 0)}
    assert {(r.seq, r.num_comments, r.repost_count) for r in stories.dedupe_by_title(once).collect()} == {(2, 6, 2), (4, 1, 0)}
    assert stories.dedupe_by_url(spark.createDataFrame([], STORY)).count() == 0


def test_median_is_cut(spark):
    rows = [("k", "h", i, "t", "u", p, 0) for i, p in enumerate((1, 2, 5, 10))]
    got = stories.aggregate_blogs(spark.createDataFrame(rows, "key string, home string, seq long, title string, url string, points int, created_at_i long")).first()
    assert got.median_points == 3 and got.n_stories == 4


def sequential(entries, cap):
    taken, out = set(), set()
    for feed in sorted({e[1] for e in entries}):
        n = 0
        for e in sorted((e for e in entries if e[1] == feed), key=lambda e: (-e[4], e[5])):
            if n < cap and e[2] not in taken:
                taken.add(e[2])
                out.add((e[0], e[2]))
                n += 1
    return out


def test_capped_feeds_equal_the_sequential_rule(spark):
    rng = random.Random(3)
    for _ in range(3):
        entries = [(f"k{f}", f, f"u{rng.randrange(12)}", "t", rng.randrange(9), i) for i, f in enumerate(rng.choices(range(5), k=40))]
        df = spark.createDataFrame(entries, "key string, feed_ord long, canonical_url string, title string, ts long, pos long")
        assert {(r.key, r.canonical_url) for r in feeds.cap_feed_entries(df, cap=3).collect()} == sequential(entries, 3)


def test_firehose(spark):
    rows = [("fast", i * 50_000, i) for i in range(12)] + [("slow", i * 60_000, i) for i in range(12)] + [("few", i, i) for i in range(5)]
    assert [r.key for r in feeds.firehose_feeds(spark.createDataFrame(rows, "key string, ts long, pos long")).collect()] == ["fast"]


def test_diversify(spark):
    rows = [(i, 1 if i <= 5 else 2) for i in range(1, 7)]
    page = search.diversify(spark.createDataFrame(rows, "rank int, blog_id int"), "rank", 3, 5).orderBy("page_pos")
    assert [r["rank"] for r in page.collect()] == [1, 2, 3, 6, 4]


def test_matches(spark):
    df = spark.createDataFrame([("Writing a database from scratch",), ("Databse internals",), ("scratch a database",), (None,)], "t string")
    assert [r[0] for r in df.select(search.match_all(F.col("t"), "database scratch")).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(search.match_all(F.col("t"), "database")).collect()] == [True, True, True, False]


def test_numbering(spark):
    got = number_rows(spark.range(100), F.col("id") % 7, F.col("id")).orderBy("n").collect()
    assert [r.n for r in got] == list(range(100)) and [r.id for r in got] == sorted(range(100), key=lambda i: (i % 7, i))


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"objectID":"1","title":"t","url":"u","points":1}\nnot json\n\n')
    assert readers.read_stories(spark, str(tmp_path / "s.jsonl")).count() == 1
    labels = tmp_path / "labels"
    labels.mkdir()
    (labels / "a.jsonl").write_text('{"key":"k","source":"vendor"}\n{"key":"k","source":"trade"}\n{"key":"z","source":"nope"}\n')
    (labels / "b.jsonl").write_text('{"key":"k","source":"personal"}\nbroken\n')
    rows, bad = readers.read_labels(spark, str(labels))
    assert [(r.key, r.source) for r in rows.collect()] == [("k", "personal")] and tuple(bad.first()) == (1, 2)
    out = {r.check: (r.ok, r.n) for r in checks.label_validation(rows, spark.createDataFrame([("k",), ("m",)], "key string"), bad).collect()}
    assert out["malformed"] == (False, 1) and out["missing"] == (False, 1) and out["duplicates"] == (True, 0)
    lines = spark.createDataFrame([(0, 0, "a"), (0, 1, "b"), (1, 0, "c")], "batch long, pos long, text string")
    writers.write_batches(lines, str(tmp_path / "out"))
    assert {r.value for r in writers.batch_texts(lines, "\n\n").collect()} == {"a\n\nb", "c"}


def test_fetch_and_check(spark):
    pages = {
        "https://a.com/rss": (200, "text/xml", "<?xml a"), "https://down.com/rss": (200, "text/xml", "<?xml d"), "https://half.com/atom.xml": (200, "text/html", "\n <?xml h"),
        "https://link.com": (200, "text/html", '<link type="application/rss+xml"><link type="application/atom+xml" href="/own">'), "https://link.com/own": (200, "x", "linked"),
        "https://gone.com": (200, "text/html", '<link type="application/rss+xml" href="/old">'), "https://gone.com/old": (404, "text/html", "not here"), "https://x.substack.com/feed": (200, "x", "sub"),
        "https://none.com": (200, "text/html", "a page"), "https://err.com": (500, "text/html", '<link type="application/rss+xml" href="/own">'),
    }

    def fetcher(url):
        if url not in pages:
            if "down" in url or "half" in url:
                raise ConnectionError(url)
            return 404, "text/html", "", url
        return (*pages[url], url)

    homes = ["https://a.com", "https://down.com", "https://half.com", "https://link.com", "https://gone.com", "https://x.substack.com", "https://none.com", "https://err.com", "https://medium.com"]
    got = feeds.fetch_feeds(spark.createDataFrame([(h, h) for h in homes], "key string, home string"), fetcher, 2).collect()
    assert {(r.key.removeprefix("https://"), (r.feed or "").removeprefix("https://"), r.content, r.error) for r in got} == {
        ("a.com", "a.com/rss", "<?xml a", None), ("down.com", "down.com/rss", "<?xml d", None), ("half.com", "half.com/atom.xml", "\n <?xml h", None), ("link.com", "link.com/own", "linked", None),
        ("gone.com", "gone.com/old", None, "empty"), ("x.substack.com", "x.substack.com/feed", "sub", None), ("none.com", "", None, "no-feed"), ("err.com", "", None, "no-feed"), ("medium.com", "", None, "no-feed"),
    }
    plan = posts.crawl_plan(spark.createDataFrame([(1, "https://a.com/x", 3), (2, "https://a.com/y", 1)], "i long, url string, day int"))
    status = feeds.check_links(plan, lambda method, url: (403, url) if method == "HEAD" else (200, url + "/z"), 0.0, 2).collect()
    assert {(r.i, r.status, r.final) for r in status} == {(1, 200, "https://a.com/x/z"), (2, 200, "https://a.com/y/z")}


def test_failed_links(spark):
    def fetcher(method, url):
        raise {"t": TimeoutError, "s": __import__("ssl").SSLError, "c": ConnectionError, "v": ValueError}[url[-1]]

    plan = posts.crawl_plan(spark.createDataFrame([(i, f"https://h{i}/{c}", 1) for i, c in enumerate("tscv")], "i long, url string, day int"))
    assert {r.i: r.status for r in feeds.check_links(plan, fetcher, 0.0, 2).collect()} == {0: -4, 1: -2, 2: -3, 3: -1}


def test_crawl_limits(spark):
    links = spark.createDataFrame([(i, f"https://{'hot' if i % 3 else 'b'}.com/{i}", 100 - i) for i in range(60)], "i long, url string, day int")
    assert {r.i for r in posts.crawl_plan(links, limit=4).collect()} == {56, 57, 58, 59}
    got = posts.crawl_plan(links, per_host=5).collect()
    assert len(got) == 10 and max(r.start_s for r in got) == 1.0 and {r.i for r in got if r.host == "b.com"} == {57, 54, 51, 48, 45}


def test_parse_feeds(spark):
    rss = "<rss><channel><title>T</title><item><title>a</title><link>https://x/1</link><pubDate>Tue, 02 Jan 2024 03:04:05 GMT</pubDate><description>&lt;b&gt;hi&lt;/b&gt; you</description></item><item><title></title><link>l</link></item></channel></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><title>U</title><entry><title>b</title><link href="https://y/2"/><updated>2024-01-02T03:04:05Z</updated></entry></feed>'
    got = feeds.parse_feed_documents(spark.createDataFrame([("k", rss), ("m", atom), ("bad", "<x"), ("none", None)], "key string, content string")).collect()
    assert {(r.key, r.title, r.url, r.published, r.summary) for r in got} == {("k", "a", "https://x/1", 1704164645, "hi you"), ("m", "b", "https://y/2", 1704164645, "")}


def test_ingest_resumes(spark, tmp_path):
    (tmp_path / "in").mkdir()
    args = [str(tmp_path / x) for x in ("in", "out", "ck")]
    (tmp_path / "in/1.json").write_text('{"objectID":"1","created_at_i":5,"points":1}\n{"objectID":"2"}\n')
    ingest_stream(spark, *args).awaitTermination()
    (tmp_path / "in/2.json").write_text('{"objectID":"1","created_at_i":9,"points":7}\n{"objectID":"3","created_at_i":6}\n')
    ingest_stream(spark, *args).awaitTermination()
    assert {(r.objectID, r.created_at_i) for r in spark.read.parquet(args[1]).collect()} == {("1", 5), ("3", 6)}


def test_ingest_keeps_the_version_that_came_first(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i, (name, points) in enumerate([("z", 1), ("a", 9)]):  # z is the older file
        (tmp_path / f"in/{name}.json").write_text(f'{{"objectID":"1","created_at_i":{9 - i},"points":{points}}}\n{{"objectID":"1","created_at_i":50,"points":50}}\n')
        os.utime(tmp_path / f"in/{name}.json", (1_600_000_000 + 100 * i,) * 2)
    args = [str(tmp_path / x) for x in ("in", "out", "ck")]
    ingest_stream(spark, *args).awaitTermination()
    assert [(r.objectID, r.points) for r in spark.read.parquet(args[1]).collect()] == [("1", 1)]


def test_work_stream_does_each_key_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []

    def work(df):
        seen.append(sorted(r.key for r in df.collect()))
        return df.withColumn("done", F.lit(1))

    run = lambda: work_stream(spark, str(tmp_path / "in"), "key string", "key", str(tmp_path / "done"), str(tmp_path / "ck"), work).awaitTermination()
    (tmp_path / "in/1.json").write_text('{"key":"a"}\n{"key":"b"}\n{"key":"a"}\n')
    run()
    (tmp_path / "in/2.json").write_text('{"key":"b"}\n{"key":"c"}\n')
    run()
    assert seen == [["a", "b"], ["c"]] and {r.key for r in spark.read.parquet(str(tmp_path / "done")).collect()} == {"a", "b", "c"}


def test_ties_go_to_the_first_story_in_order(spark, tmp_path):
    lines = [f'{{"objectID":"{i}","title":"T","url":"https://a.com/x","points":5,"num_comments":1,"created_at_i":7}}' for i in (3, 1, 2)]
    (tmp_path / "s.jsonl").write_text("\n".join([*lines, '{"objectID":"0","title":"t!","url":"https://a.com/y","points":5,"created_at_i":6}']))
    once = stories.dedupe_by_url(readers.read_stories(spark, str(tmp_path / "s.jsonl")))
    assert {(r.objectID, r.repost_count) for r in once.collect()} == {("1", 2), ("0", 0)}
    assert [(r.objectID, r.repost_count) for r in stories.dedupe_by_title(once).collect()] == [("1", 3)]


def test_numbers_of_one_prefix_and_one_quality(spark):
    keys = spark.range(5000).select(F.format_string("d%08d", "id").alias("key"), F.lit(3).cast("long").alias("n_stories"), F.lit(1).alias("median_points"))
    got = batches.assign_batches(keys.orderBy(F.rand(1)), 50).collect()
    assert all(r.batch * 50 + r.pos == int(r.key[1:]) for r in got)
    ranked = blogs.rank_blogs(keys.orderBy(F.rand(2)))
    assert all(r.blog_id == int(r.key[1:]) for r in ranked.collect())
    spread = keys.repartitionByRange(8, "key").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 2000  # a hot prefix or quality is dealt out
    assert [r.n for r in number_sorted(keys.limit(0), "key").collect()] == []


def test_label_files_by_hand(spark):
    expected = spark.createDataFrame([(f"k{i:02d}",) for i in range(40)], "key string")
    files = {"cls_0.jsonl": range(0, 10), "cls_1.jsonl": range(20, 30), "cls_2.jsonl": range(20, 23), "notes.jsonl": range(3), "cls_9.jsonl": range(30, 39)}
    labels = spark.createDataFrame([(f"k{i:02d}", f) for f, ids in files.items() for i in ids], "key string, file string")
    # ten rows make a batch; cls_1 holds batch 2, cls_2 little but all its own, cls_9 is of no batch
    assert [tuple(r) for r in checks.mismatched_files(expected, labels).collect()] == [("cls_1.jsonl", 1, 0, 10)]
    whole = labels.union(expected.select("key", F.lit("all.jsonl")))
    assert checks.mismatched_files(expected, whole, 10).count() == 0  # nothing is missing
    assert [tuple(r) for r in checks.missing_by_batch(expected, labels, 10).collect()] == [(1, 10), (3, 1)]


POST = "post_id long, blog_id int, points int, day int, score int, title string, topic_mask int, kind_source int"


def test_relevance_is_not_capped_but_explicit_orders_are(spark):
    rows = [(i, 1 if i < 6 else i, i, 9 - i, 100 - i, f"rust news {i}", 1 if i % 2 else 2, 0) for i in range(9)] + [(20 + i, 50 + i, 0, 0, 0, "rust news", 4, 0) for i in range(25)]
    df = spark.createDataFrame(rows, POST)
    page = search.search_posts(df, "rust news", limit=5).orderBy("rank").collect()
    assert [r.blog_id for r in page] == [1] * 5 and {r.total for r in page} == {34}
    assert [r.post_id for r in search.search_posts(df, "rust news", "points", limit=5).orderBy("page_pos").collect()] == [8, 7, 6, 5, 4]
    assert [r.post_id for r in search.search_posts(df, "rust", "date", limit=5).orderBy("page_pos").collect()] == [0, 1, 2, 6, 7]
    pinned = search.search_posts(df, "rust", "date", limit=5, facets=posts.passes(blog_id=1), pinned=True).orderBy("page_pos").collect()
    assert [r.post_id for r in pinned] == [0, 1, 2, 3, 4] and pinned[0].total == 6
    # the choice of strict matches is made on all posts, the facet only narrows the page
    narrow = search.search_posts(df, "rust news", facets=posts.passes(topic_mask=1)).collect()
    assert {r.post_id for r in narrow} == {1, 3, 5, 7} and narrow[0].total == 4


def test_fallback_forgives_slips(spark):
    df = spark.createDataFrame([(1, 1, 5, 1, 9, "databse internals", 0, 0), (2, 1, 9, 2, 8, "internals of a database", 0, 0), (3, 1, 1, 3, 7, "something else", 0, 0), (4, 1, 7, 4, 6, "a datbase", 0, 0)], POST)
    page = search.search_posts(df, "database internals").orderBy("rank").collect()
    assert [(r.post_id, r.hits) for r in page] == [(1, 5), (2, 2), (4, 1)] and page[0].total == 3
    assert [r.post_id for r in search.search_posts(df, "database internals", "points").orderBy("page_pos").collect()] == [2, 4, 1]


def test_blog_matches_keep_their_order(spark):
    rows = [(0, "big rust news", "", 9, 2020, 9.0), (1, "rust", "", 1, 2021, 1.0), (2, "trust", "", 5, 2019, 5.0)]
    df = spark.createDataFrame([(*r, 1, 0) for r in rows], "blog_id int, n string, o string, m int, l int, q double, tm int, s int")
    page = search.search_blogs(df, "rust", limit=2).collect()
    assert [r.n for r in page] == ["rust", "big rust news"] and {r.total for r in page} == {3}
    assert [r.blog_id for r in search.search_blogs(df, "rust", mode="points").collect()] == [0, 2, 1]
    assert [r.blog_id for r in search.search_blogs(df, "", limit=1).collect()] == [0]


def test_feeds_that_are_not_well_formed(spark):
    item = lambda t, u: f"<item><title>{t}</title><link>{u}</link></item>"
    docs = {
        "amp": f"<rss><channel><title>Q&A</title>{item('R&D', 'https://x/1?a=1&b=2')}</channel></rss>",
        "html": f"<rss><channel>{item('caf&eacute;&nbsp;x', 'https://x/2')}</channel></rss>",
        "broken": f"<rss><channel><title>B</title>{item('ok', 'https://x/3')}<item><title>bad</link></item>{item('fine', 'https://x/4')}",
        "bomb": '<!DOCTYPE x [<!ENTITY a "aaaa"><!ENTITY b "&a;&a;">]><rss><channel>' + item("&b;", "https://x/5") + "</channel></rss>",
        "ctl": f"<?xml version='1.0' encoding='utf-8'?><rss><channel>{item('a' + chr(1) + 'b', 'https://x/6')}</channel></rss>", "text": "no feed & at all",
    }
    got = feeds.parse_feed_documents(spark.createDataFrame(list(docs.items()), "key string, content string")).collect()
    assert sorted((r.key, r.title, r.url) for r in got) == [
        ("amp", "R&D", "https://x/1?a=1&b=2"), ("bomb", "&b;", "https://x/5"), ("broken", "fine", "https://x/4"), ("broken", "ok", "https://x/3"), ("ctl", "ab", "https://x/6"), ("html", "caf\xe9\xa0x", "https://x/2"),
    ]


def test_feeds_candidates_and_overrides_as_files(spark, tmp_path):
    (tmp_path / "feeds.jsonl").write_text('{"key":"k","home":"https://k","feed":"https://k/rss","feed_title":"K","entries":[{"title":"a","url":"u","published":5,"summary":""},{"title":"b","url":"v"}]}\nbroken\n{"key":"e","entries":[],"error":"empty"}\n')
    rows = readers.read_feeds(spark, str(tmp_path / "feeds.jsonl"))
    assert {(r.key, r.error) for r in rows.collect()} == {("k", None), ("e", "empty")}
    assert [(r.key, r.pos, r.title, r.published) for r in readers.feed_entries(rows).orderBy("pos").collect()] == [("k", 0, "a", 5), ("k", 1, "b", None)]
    (tmp_path / "o.json").write_text('{\n "source": {"a.com": "trade"},\n "deny": ["b.com", "c.com"]\n}')
    source, deny = readers.read_overrides(spark, str(tmp_path / "o.json"))
    assert [tuple(r) for r in source.collect()] == [("a.com", "trade")] and {r.key for r in deny.collect()} == {"b.com", "c.com"}
    table = spark.createDataFrame([("a", 3, 9), ("b", 5, 1), ("c", 5, 7)], "key string, n_stories long, total_points long")
    writers.write_candidates(table, str(tmp_path / "c"))
    assert [r.key for r in spark.read.json(str(tmp_path / "c")).collect()] == ["c", "b", "a"]


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"
        getConf = lambda self: {}
        getCheckpointDir = lambda self: None

    class Session:
        sparkContext = Context()
        conf = {}

    import pytest

    with pytest.raises(ValueError, match="share"):
        storage.shared_folder(Session())
