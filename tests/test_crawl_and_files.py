"""Incremental pulls, crawls, the index's files, and rules of feeds and checks."""

import json

from pyspark.sql import functions as F

from pubweave import constants as K
from pubweave.operators import batches, checks, feeds, posts, search, stories
from pubweave.sources import readers, writers
from pubweave.streaming import ingest


def test_hosts_are_crawled_between_each_other(spark):
    now, delay = [0.0], 1.0

    def fetcher(method, url):
        now[0] += 0.01
        return 200, f"{now[0]:.2f}"

    def sleep(seconds):
        now[0] += seconds

    sizes = {"a": 6, "b": 5, "c": 4, "d": 1}
    links = spark.createDataFrame([(i, f"https://{h}.com/{i}", 100 - i) for h, n in sizes.items() for i in range(n)], "i long, url string, day int")
    plan = posts.crawl_plan(links)
    run = lambda at_once: feeds.check_links(plan, fetcher, delay, 1, lambda: now[0], sleep, at_once).collect()
    asked = {}
    for r in run(10):
        asked.setdefault(r.url[8], []).append((float(r.final), r.i))
    assert {h: len(x) for h, x in asked.items()} == sizes
    assert max(t for x in asked.values() for t, _ in x) < 5 * delay + 0.5  # the longest host's pauses, not the sum of all
    for x in asked.values():
        assert [i for _, i in x] == sorted((i for _, i in x), reverse=True)  # oldest first
        assert all(b - a >= delay for (a, _), (b, _) in zip(x, x[1:], strict=False))
    assert len(run(1)) == 16  # one host at a time


def stories_of(ids):
    return [{"objectID": str(i), "title": "t", "points": 30 if i % 10 else 3, "created_at_i": 1_700_000_000 + i} for i in ids]


def test_pull_stops_at_the_known_head_and_resumes(spark, tmp_path):
    there, asked = list(range(100)), []

    def pager(cursor):
        asked.append(cursor)
        return [s for s in stories_of(sorted(there, reverse=True)) if s["created_at_i"] <= cursor][:10]

    args = (str(tmp_path / "out"), str(tmp_path / "state"), 2_000_000_000)
    pull = lambda p=pager, **kw: ingest.pull_pages(spark, p, *args, **kw)
    assert pull() == 90 and len(asked) > 10  # to the end, without the stories below the bar
    there += range(100, 125)
    asked.clear()
    assert pull(stop_after=2) == 22 and len(asked) < 8
    there += range(125, 160)

    def broken(cursor):
        if len(asked) == 2:
            raise ConnectionError
        return pager(cursor)

    asked.clear()
    try:
        pull(broken)
    except ConnectionError:
        pass
    before = spark.read.parquet(args[0]).count()
    asked.clear()
    assert before > 112 and pull(stop_after=2) == 144 - before and asked[0] < 1_700_000_159  # goes on where it was
    rows = spark.read.parquet(args[0])
    assert rows.count() == rows.select("objectID").distinct().count() == 144


def test_untouched_shelves_are_not_listed(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    assert ingest.append_new(rows, out, "k", ["v"], ["k", "v"], 16) == 400
    again = spark.createDataFrame([("7", 2), ("new", 2), ("new", 1)], "k string, v int")
    touched = [r[0] for r in again.select(ingest.shelf_of("k", 16)).distinct().collect()]
    listed = ingest.known_keys(spark, out, "k", touched).inputFiles()
    assert len(touched) <= 2 and {f.split(f"{ingest.SHELF}=")[1].split("/")[0] for f in listed} <= {str(s) for s in touched}
    assert ingest.append_new(again, out, "k", ["v"], ["k", "v"], 16) == 1
    assert [(r.k, r.v) for r in spark.read.parquet(out).filter("v > 1 or k = 'new'").collect()] == [("new", 1)]
    assert ingest.append_new(again, out, "k", ["v"], ["k", "v"], 16) == 0


POST = "post_id long, blog_id int, points int, day int, score int, title string, topic_mask int, kind_source int, hn_id long"


def test_one_blog_is_read_from_its_shelf(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 40, 30, i % 9, 1, f"t{i}", 1, 0, i) for i in range(800)], POST)
    table = spark.createDataFrame([(b, f"b{b}", f"https://b{b}") for b in range(40)], "blog_id int, n string, h string")
    meta = spark.createDataFrame([(800, 40, K.HIDDEN_MASK)], "n_posts long, n_blogs long, hidden_source_mask int")
    writers.write_index(rows, table, meta, str(tmp_path), shelves=8)
    one = readers.read_blog(spark, str(tmp_path), 13)
    assert {r.post_id for r in one.collect()} == set(range(13, 800, 40)) and one.columns == rows.columns
    assert {r[0].split("shelf=")[1].split("/")[0] for r in one.select(F.input_file_name()).distinct().collect()} == {"5"}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "shelf" in plan.split("PartitionFilters: [")[1].split("]")[0] and "blog_id" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_posts_are_read_once(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 7, i, i, i, f"rust news {i}" if i % 3 else "other", 1, 0, i) for i in range(300)], POST)
    rows.write.parquet(str(tmp_path / "p"))
    table = spark.read.parquet(str(tmp_path / "p"))
    for page in (search.search_posts(table, "rust news"), search.search_posts(table, "rust other"), search.search_posts(table, "rust", "date"), search.search_posts(table, "")):
        assert "parquet" not in page._jdf.queryExecution().optimizedPlan().toString().lower()  # from what one job has written
        assert page.first().total == page.agg(F.max("total")).first()[0] > 100
    blogs = spark.createDataFrame([(b, f"b{b}") for b in range(6)], "blog_id int, n string")
    meta = spark.createDataFrame([(301, 6, 112)], "n_posts long, n_blogs long, hidden_source_mask int")
    report = checks.index_checks(table, blogs, meta, 10, 5, ["b1", "b9"])
    assert report._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1
    got = {r.check: (r.ok, r.value) for r in report.collect()}
    assert got["posts beside meta"] == (False, -1.0) and got["blogs beside meta"] == (True, 0.0)
    assert got["orphan posts"] == (False, 42.0) and got["missing canaries"] == (False, 1.0) and got["posts"] == (True, 300.0)


def test_canonical_url_is_computed_once_a_row(spark, tmp_path):
    from pubweave.functions import urls

    rows = spark.createDataFrame([("k", "1", "t", "https://a.com/x?b=1", 30, 1_600_000_000)], "key string, objectID string, title string, url string, points int, created_at_i long")
    rows.write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    blogs = spark.createDataFrame([("k", 0, "personal", "essay", None, False)], "key string, blog_id int, source string, kind string, topics array<struct<slug:string,weight:double>>, hidden boolean")
    blogs.write.parquet(str(tmp_path / "b"))
    blogs = spark.read.parquet(str(tmp_path / "b"))  # local rows would be joined while planning
    calls = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("concat(https://, regexp_replace(lower(")
    assert calls(posts.story_posts(df, blogs, 1_700_000_000)) == calls(df.select(urls.canonical_url(F.col("url")).alias("u"))) == 1
    assert posts.story_posts(df, blogs, 1_700_000_000).first().path == "/x?b=1"


CANDIDATE = "key string, home string, n_stories long, median_points int, max_points int, first_seen long, last_seen long, sample_titles array<string>, sample_urls array<string>"


def test_feeds_without_entries_say_nothing(spark):
    cands = spark.createDataFrame([(k, f"https://{k}", 5, 1, 2, 0, 0, ["t"], ["https://u/a"]) for k in "abc"], CANDIDATE)
    entry = [("e", "s")]
    rows = [("a", "Old", entry, 1), ("a", "New", entry, 2), ("a", "Empty", [], 3), ("b", "Empty", [], 1), ("c", "None", None, 1), ("z", "Z", entry, 1)]
    df = spark.createDataFrame(rows, "key string, feed_title string, entries array<struct<title:string,summary:string>>, seq long")
    texts = {r.key: r.text for r in batches.evidence_blocks(cands, df).collect()}
    assert len(texts) == 3 and "feed_title: New" in texts["a"] and "feed" not in texts["b"] and "feed" not in texts["c"]
    assert tuple(batches.evidence_stats(cands, df).first()) == (3, 1)


def test_labels_without_keys_or_slugs(spark, tmp_path):
    folder = tmp_path / "labels"
    (folder / "b.jsonl").mkdir(parents=True)
    line = lambda **kw: json.dumps({"source": "vendor", "kind": K.KIND_SLUGS[0], **kw}) + "\n"
    (folder / "a.jsonl").write_text(line(key="") + line(key="k", one_line="first") + line(key="m") + line())
    (folder / "b.jsonl/part-1").write_text(line(key="k", one_line="last"))
    (folder / "b.jsonl/part-0").write_text(line(key="k", one_line="middle"))
    rows, bad = readers.read_labels(spark, str(folder))
    assert {(r.key, r.one_line, r.file) for r in rows.collect()} == {("k", "last", "b.jsonl"), ("m", None, "a.jsonl")} and tuple(bad.first()) == (0, 2)
    labels = spark.createDataFrame([("a", [(None, 1.0)]), ("b", [(K.TOPIC_SLUGS[0], 1.0)]), ("c", [("x", 1.0)]), ("d", [])], "key string, topics array<struct<slug:string,weight:double>>")
    labels = labels.withColumns({"source": F.lit("vendor"), "kind": F.lit(K.KIND_SLUGS[0]), "confidence": F.lit(0.9)})
    report = {r.check: r.n for r in checks.label_validation(labels, labels.select("key")).collect()}
    assert report["topics"] == 3


def test_chained_feeds_write_once_a_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(feeds, "checkpointed", lambda df, real=feeds.checkpointed: written.append(df.columns) or real(df))
    # feed n wants the URL that feed n - 1 takes, and then one that feed n + 1 wants
    rows = [(f"k{n}", n, f"u{n + k}", "t", 9 - k, k) for n in range(6) for k in range(3)]
    df = spark.createDataFrame(rows, "key string, feed_ord long, canonical_url string, title string, ts long, pos long")
    got = {(r.key, r.canonical_url) for r in feeds.cap_feed_entries(df, cap=1).collect()}
    assert got == {(f"k{n}", f"u{n}") for n in range(6)}
    assert len(written) <= 4 and all("title" not in c for c in written[1:])


def test_publishers_by_suffix_rules(spark):
    rules = spark.createDataFrame([(r,) for r in ("com", "*.city", "!own.city", "github.io")], "rule string")
    links = ["https://a.b.c.city/x", "https://me.github.io/p", "https://www.own.city/", "https://x.substack.com/p/1", "https://medium.com/@me/post", "ftp://a.com/x", None]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(links)], "seq int, url string")
    got = {r.seq: r.key for r in stories.with_blog_key(df, rules).collect()}
    plain = {r.seq: r.key for r in stories.with_blog_key(df).collect()}
    assert got == plain and got[0] == "a.b.c.city" and got[3] == "x.substack.com" and got[4] == "medium.com/@me" and not {5, 6} & set(got)
