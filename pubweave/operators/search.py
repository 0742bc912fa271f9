"""Search and browse over posts and blogs."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from pubweave.operators.storage import checkpointed

ORDERS = {"points": ("points", True), "date": ("day", True), "oldest": ("day", False), "relevance": ("score", True)}


def terms_of(query: str) -> list[str]:
    return [t for t in re.split(r"\s+", query.strip().lower()) if t]


def term_pattern(term: str) -> str:
    """A term, or, from four characters on, the term with one character left out, put in,
    replaced or swapped with the next after its first."""
    e = [re.escape(c) for c in term]
    forms = ["".join(e)]
    if len(term) >= 4:
        for i in range(1, len(e)):
            forms += ["".join(e[:i] + e[i + 1 :]), "".join(e[:i]) + "." + "".join(e[i + 1 :]), "".join(e[:i]) + "." + "".join(e[i:])]
            if i + 1 < len(e):
                forms.append("".join(e[:i] + [e[i + 1], e[i]] + e[i + 2 :]))
    return "(?:" + "|".join(dict.fromkeys(forms)) + ")"


def match_all(title: Column, query: str) -> Column:
    """All terms, in order, whatever stands between.

    Each term is looked for alone first: the ordered pattern tries the rest of a title again
    for every place of its first term, so it only runs where nothing but the order is open.
    """
    patterns = list(map(term_pattern, terms_of(query)))
    found = title.rlike("(?iu)" + ".*".join(patterns))
    if len(patterns) > 1:
        found = reduce(Column.__and__, [title.rlike("(?iu)" + p) for p in dict.fromkeys(patterns)] + [found])
    return F.coalesce(found, F.lit(False))


def hit_count(title: Column, query: str) -> Column:
    """Terms of three letters or more that the title matches, each on its own and with the same
    slips, and one more than all terms if it matches strictly."""
    terms = [t for t in terms_of(query) if len(t) > 2]
    found = sum((match_all(title, t).cast("int") for t in terms), F.lit(0))
    return found + F.when(match_all(title, query), len(terms) + 1).otherwise(0)


def match_any(posts: DataFrame, query: str, title: str = "title") -> DataFrame:
    """Posts that hit enough terms (two of three or more, else one), with their hits."""
    need = 2 if len([t for t in terms_of(query) if len(t) > 2]) >= 3 else 1
    return posts.withColumn("hits", hit_count(F.col(title), query)).filter(F.col("hits") >= need)


def top_n(df: DataFrame, key: str, n: int, pos: str = "post_id", descending: bool = True) -> DataFrame:
    return df.orderBy(F.col(key).desc() if descending else F.col(key).asc(), F.col(pos)).limit(n)


def order_posts(df: DataFrame, mode: str, n: int) -> DataFrame:
    key, down = ORDERS[mode]
    return top_n(df, key, n, descending=down)


def order_blogs(df: DataFrame, mode: str, n: int) -> DataFrame:
    """By median points, latest or earliest last year, or quality."""
    key = {"points": F.desc("m"), "date": F.desc("l"), "oldest": F.asc("l"), "relevance": F.desc("q")}[mode]
    return df.orderBy(key, "blog_id").limit(n)


def diversify(ranked: DataFrame, rank: str, cap: int = 3, limit: int = 40, key: str = "blog_id") -> DataFrame:
    """The first ``limit`` rows when each blog's rows beyond ``cap`` go to the end; adds
    page_pos from 1. For ranked pages of bounded length, not for all posts."""
    over = F.row_number().over(Window.partitionBy(key).orderBy(rank)) > cap
    page = ranked.withColumn("_over", over).orderBy("_over", rank).limit(limit)
    return page.withColumn("page_pos", F.row_number().over(Window.orderBy("_over", rank))).drop("_over")


def _ranked(df: DataFrame, *order: Column) -> DataFrame:
    """Numbers the rows of a page that a limit has bounded."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def browse(posts: DataFrame, mode: str = "relevance", limit: int = 40, cap: int = 3, pinned: bool = False, ties: tuple[Column, ...] = ()) -> DataFrame:
    """A page of posts (already filtered by facets): the best 5 * limit in order, then no more
    than ``cap`` of a blog before the overflow. A pinned blog has no cap."""
    key, down = ORDERS[mode]
    order = (F.col(key).desc() if down else F.col(key).asc(), *ties, F.col("post_id"))
    wide = _ranked(posts.orderBy(*order).limit(5 * limit), *order)
    return diversify(wide, "rank", limit if pinned else cap, limit)


def total_matches(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count(F.lit(1)).alias("total"))


def match_quality(title: Column, query: str) -> list[Column]:
    """Order of matches: whole words hit, fewer other characters, earlier start, title."""
    words = sum((F.coalesce(title.rlike(rf"(?iu)(?<!\w){re.escape(t)}(?!\w)"), F.lit(False)).cast("int") for t in terms_of(query)), F.lit(0))
    extra = F.length(title) - sum(map(len, terms_of(query)))
    start = F.length(F.regexp_extract(title, "(?iu)^(.*?)" + ".*".join(map(term_pattern, terms_of(query))), 1))
    return [words.desc(), extra.asc(), start.asc(), title.asc()]


def rank_strict(matches: DataFrame, query: str, wide: int = 3000) -> DataFrame:
    """The best ``wide`` matches by score, tiered by match quality (first 200, to 1000, rest),
    then by score; adds tier and rank."""
    top = matches.orderBy(F.desc("score"), "post_id").limit(wide)
    place = F.row_number().over(Window.orderBy(*match_quality(F.col("title"), query), F.col("post_id")))
    tiered = top.withColumn("_p", place).withColumn("tier", F.when(F.col("_p") <= 200, 0).when(F.col("_p") <= 1000, 1).otherwise(2)).drop("_p")
    return _ranked(tiered, F.col("tier"), F.desc("score"), F.col("post_id"))


def rank_fallback(matches: DataFrame, n: int, wide: int = 3000) -> DataFrame:
    """Of the best ``wide`` matches by score, the first n by hits, score and number; no cap on blogs."""
    order = (F.desc("hits"), F.desc("score"), F.col("post_id"))
    top = matches.orderBy(F.desc("score"), "post_id").limit(wide)
    return _ranked(top.orderBy(*order).limit(n), *order)


def search_posts(posts: DataFrame, query: str, mode: str = "relevance", limit: int = 40, few: int = 25, facets: Column | None = None, pinned: bool = False, cap: int = 3) -> DataFrame:
    """A page of posts for a query, with their rank and the total of matches: strict matches, or,
    where there are fewer than ``few`` of all posts and the query has several terms, whatever
    hits enough of them.

    ``facets`` (see ``posts.passes``) narrows the page after that decision. Relevance knows no
    cap on blogs; browsing without a query and explicit orders do, unless a blog is
    ``pinned``. Explicit orders keep the members and sort by their key, fallback ties by hits.

    The posts are gone through once: that job writes the matches (or, without a query, the
    rows that a page can be made of) and counts them as it goes; the page is made from what it wrote.
    """
    passing = F.lit(True) if facets is None else facets
    if not terms_of(query):
        rows = posts.filter(passing)
        key, down = ORDERS[mode]
        wide, n = _observed(rows, {"total": F.count(F.lit(1))}, lambda df: top_n(df, key, 5 * limit, descending=down))
        return browse(wide, mode, limit, cap, pinned).withColumn("total", F.lit(n["total"]))
    several = len([t for t in terms_of(query) if len(t) > 2]) > 1
    need = 2 if len([t for t in terms_of(query) if len(t) > 2]) >= 3 else 1
    rows = posts.withColumn("_passes", F.coalesce(passing, F.lit(False)))
    if several:
        rows = rows.withColumn("_strict", match_all(F.col("title"), query)).withColumn("hits", hit_count(F.col("title"), query))
        rows = rows.filter(F.col("_strict") | (F.col("hits") >= need))
    else:
        rows = rows.filter(match_all(F.col("title"), query)).withColumns({"_strict": F.lit(True), "hits": F.lit(0)})
    counts = {"strict": F.count_if("_strict"), "strict_passing": F.count_if(F.col("_strict") & F.col("_passes")), "passing": F.count_if(F.col("_passes") & (F.col("hits") >= need))}
    found, n = _observed(rows, counts)
    loose = several and n["strict"] < few
    pool = found.filter(F.col("_passes") & ((F.col("hits") >= need) if loose else F.col("_strict"))).drop("_passes", "_strict", *([] if loose else ["hits"]))
    total = F.lit(n["passing" if loose else "strict_passing"])
    if mode != "relevance":
        return browse(pool, mode, limit, cap, pinned, (F.desc("hits"),) if loose else ()).withColumn("total", total)
    page = rank_fallback(pool, limit) if loose else rank_strict(pool, query).orderBy("rank").limit(limit)
    return page.withColumn("page_pos", F.col("rank")).withColumn("total", total)


def _observed(df: DataFrame, metrics: dict[str, Column], then=lambda df: df) -> tuple[DataFrame, dict]:
    """The frame, after ``then``, written to the shared folder, and the metrics of its rows, both by one job."""
    seen = Observation()
    out = checkpointed(then(df.observe(seen, *[c.alias(n) for n, c in metrics.items()])))
    return out, {n: (seen.get or {}).get(n) or 0 for n in metrics}


def with_total(page: DataFrame, pool: DataFrame) -> DataFrame:
    """A page's rows with the number of all rows that it is the beginning of."""
    return page.crossJoin(total_matches(pool))  # a single row


def search_many(posts: DataFrame, queries: DataFrame, limit: int = 40) -> DataFrame:
    """(query_id, post_id, hits): for each of many queries (query_id, text) its page of
    ``limit`` posts (post_id, title, score), by whole-word hits, score and number.

    Words are distinct, of three letters or more; two hits are asked for where a query has three
    words or more. A post that hits ``need`` of n words has one of the n - need + 1 that are in
    the fewest posts, so both sides meet on those; the commonest word is only counted for the
    posts that have met.
    """
    words = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda w: F.length(w) > 2))
    p = posts.select("post_id", F.explode(words(F.col("title"))).alias("w"))
    common = p.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    q = queries.select("query_id", words(F.col("text")).alias("ws")).select("query_id", F.size("ws").alias("n"), F.explode("ws").alias("w"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.coalesce("df", F.lit(0)), "w"))
    q = q.join(common, "w", "left").withColumn("need", F.when(F.col("n") >= 3, 2).otherwise(1)).withColumn("first", place <= F.col("n") - F.col("need") + 1)
    met = q.filter("first").join(p, "w").groupBy("query_id", "post_id", "need").agg(F.count(F.lit(1)).alias("hits"))
    rest = met.join(q.filter("not first").select("query_id", "w"), "query_id").join(p, ["post_id", "w"]).groupBy("query_id", "post_id").agg(F.count(F.lit(1)).alias("more"))
    hits = (F.col("hits") + F.coalesce("more", F.lit(0))).alias("hits")
    found = met.join(rest, ["query_id", "post_id"], "left").select("query_id", "post_id", "need", hits).filter(F.col("hits") >= F.col("need"))
    best = Window.partitionBy("query_id").orderBy(F.desc("hits"), F.desc("score"), "post_id")
    scored = found.join(posts.select("post_id", "score"), "post_id").withColumn("_rn", F.row_number().over(best))
    return scored.filter(F.col("_rn") <= limit).select("query_id", "post_id", "hits")


def search_blogs(blogs: DataFrame, query: str, topic_mask: int = 0, hide: bool = True, hidden_mask: int = 112, mode: str = "relevance", limit: int = 40) -> DataFrame:
    """A page of blogs with the total of matches. With a query, relevance is the order of the
    matches, and without one quality; explicit orders sort by their key."""
    rows = blogs
    if topic_mask:
        rows = rows.filter(F.col("tm").bitwiseAND(topic_mask) != 0)
    if hide:
        rows = rows.filter(F.lit(hidden_mask).bitwiseAND(F.expr("shiftleft(1, s)")) == 0)
    if not terms_of(query):
        return with_total(order_blogs(rows, mode, limit), rows)
    text = F.concat_ws(" ", "n", "o")
    rows = rows.filter(match_all(text, query))
    if mode != "relevance":
        return with_total(order_blogs(rows, mode, limit), rows)
    return with_total(rows.orderBy(*match_quality(text, query), "blog_id").limit(limit), rows)


def blog_posts(posts: DataFrame, blog_id: int, mode: str = "relevance", limit: int = 40) -> DataFrame:
    return browse(posts.filter(F.col("blog_id") == blog_id), mode, limit, pinned=True)
