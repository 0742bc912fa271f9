"""Search for many queries at once against the same queries one by one."""

import random
import re
from collections import Counter

from pubweave.operators import manysearch, search

POST = "post_id long, score int, title string"


def words(text):
    return {w for w in re.split("[^a-z0-9]+", (text or "").lower()) if len(w) > 2}


def by_counting(posts, queries, limit):
    out = set()
    for q, text in queries:
        need = 2 if len(words(text)) >= 3 else 1
        hits = [(-len(words(text) & words(t)), -s, p) for p, s, t in posts]
        out |= {(q, p, -h) for h, s, p in sorted(x for x in hits if -x[0] >= need)[:limit]}
    return out


def test_no_word_is_dropped(spark):
    posts = [(i, i, f"the quick post number{i}") for i in range(30)] + [(99, 5, None)]
    queries = [(1, "the quick post"), (2, "the"), (3, "number3 the quick"), (4, "nothing"), (5, ""), (6, None)]
    got = search.search_many(spark.createDataFrame(posts, POST), spark.createDataFrame(queries, "query_id long, text string"), limit=100).collect()
    assert {tuple(r) for r in got} == by_counting(posts, queries, 100) and sum(r.query_id == 1 for r in got) == 30


def test_whole_words_by_counting(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}xx" for k in range(12)]
    posts = [(i, rng.randrange(9), " ".join(rng.choices(vocabulary, weights=[2 ** -k for k in range(12)], k=6))) for i in range(200)]
    queries = [(i, " ".join(rng.sample(vocabulary, rng.randint(1, 6)))) for i in range(40)]
    got = search.search_many(spark.createDataFrame(posts, POST), spark.createDataFrame(queries, "query_id long, text string"), limit=7).collect()
    assert {tuple(r) for r in got} == by_counting(posts, queries, 7)


TITLES = [
    "Writing a database from scratch", "Databse internals", "data base of a kind", "databаse in Cyrillic", "rust and trust", "A RUST data-base", "r ust", "rusty\ttools", "rus tools", "ruſt",
    "the end", "thee nd", "then", "hten", "İstanbul café", "cafe CAFÉ", "the  database", "", None, "a b c", "x" * 50, "日本語" * 20_000 + "database", "100% [regex] (yes).*", "r.st", "scratch database", "Kelvin kelvin", "data base",
]
QUERIES = ["database", "rust", "database scratch", "the", "then", "café", "data base kind", "a", "a b", "regex yes", ".*", "100%", "kelvin", "rust rust tools", "ust", "", "  ", "internals", "İstanbul", "the the end", "from SCRATCH", "tools", "zz"]


def test_slips_as_one_by_one(spark):
    df = spark.createDataFrame([(i, i % 5, t) for i, t in enumerate(TITLES)], POST)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id int, text string")
    got = Counter((r.query_id, r.post_id, r.hits) for r in manysearch.match_many(df, queries).collect())
    want = Counter((k, r.post_id, r.hits) for k, q in enumerate(QUERIES) if q.strip() for r in search.match_any(df, q).collect())
    assert got == want and len(want) > 60


def test_random_slips_as_one_by_one(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("ab", k=rng.randint(1, 7)))
    df = spark.createDataFrame([(i, rng.randrange(50), " ".join(word() for _ in range(rng.randint(1, 5)))) for i in range(60)], POST)
    queries = [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(8)]
    table = spark.createDataFrame(list(enumerate(queries)), "query_id int, text string")
    got = {(r.query_id, r.post_id, r.hits) for r in manysearch.match_many(df, table).collect()}
    assert got == {(k, r.post_id, r.hits) for k, q in enumerate(queries) for r in search.match_any(df, q).collect()}


def test_pages_as_one_by_one(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(256), " ".join(rng.choices(["rust", "database", "databse", "news", "trusty", "internals", "of", "a"], k=rng.randint(2, 6)))) for i in range(400)]
    df = spark.createDataFrame(rows, POST)
    queries = ["rust", "rust news", "database internals of", "internals database rust news a", "news", "zzz rust"]
    table = spark.createDataFrame(list(enumerate(queries)), "query_id int, text string")
    got = {(r.query_id, r["rank"], r.post_id, r.total, r.tier) for r in manysearch.search_pages(df, table, limit=300).collect()}
    want = set()
    for k, q in enumerate(queries):
        page = search.search_posts(df, q, limit=300)
        tier = "tier" in page.columns
        want |= {(k, r["rank"], r.post_id, r.total, r.tier if tier else None) for r in page.collect()}
    assert got == want and {t for *_, t in want} == {None, 0, 1}


def test_nothing_to_search(spark):
    none, queries = spark.createDataFrame([], POST), spark.createDataFrame([(1, "rust")], "query_id int, text string")
    assert manysearch.search_pages(none, queries).count() == 0 and manysearch.search_pages(none, queries.limit(0)).count() == 0
