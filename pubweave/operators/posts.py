"""Posts: story posts, feed posts, the index and its links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubweave import constants as K
from pubweave.functions import scoring, titles, urls
from pubweave.operators.numbering import number_sorted


def attach_blog(stories: DataFrame, blogs: DataFrame) -> DataFrame:
    """Stories of included blogs. Adaptive execution broadcasts the blogs while they are few
    and splits the stories of a hot key otherwise."""
    return stories.join(blogs, "key")


def drop_routine_hidden(df: DataFrame, points: int = 150) -> DataFrame:
    return df.filter(~(F.col("hidden") & (F.coalesce("points", F.lit(0)) < points)))


def once(value: Column) -> Column:
    """The value as the output of a generator: the columns made of it don't repeat its expression."""
    return F.explode(F.array(value))


def story_posts(stories: DataFrame, blogs: DataFrame, as_of: int) -> DataFrame:
    """Packed rows of stories (key, objectID, title, url, points, created_at_i) of ranked
    blogs (key, blog_id, source, kind, topics, hidden). No shuffle while blogs are broadcast."""
    rows = attach_blog(stories, blogs).withColumn("title", titles.clean_title(F.col("title"))).filter("title is not null")
    rows = drop_routine_hidden(rows).withColumn("rule", once(titles.kind_rule(F.col("title")))).withColumn("canonical_url", once(urls.canonical_url(F.col("url"))))
    kind = scoring.index_of(titles.kind_or_fallback(F.col("rule"), F.col("source"), F.col("kind")), K.KIND_SLUGS)
    return rows.select(
        "blog_id", scoring.clip_points(F.col("points")).alias("points"), scoring.day_number(F.col("created_at_i")).alias("day"),
        scoring.pack_topic_mask(scoring.topic_mask(F.col("topics")), F.col("rule").isNotNull()).alias("topic_mask"),
        scoring.pack_kind_source(kind, scoring.index_of(F.col("source"), K.SOURCE_SLUGS)).alias("kind_source"),
        scoring.post_score(scoring.clip_points(F.col("points")), F.col("created_at_i"), as_of).alias("score"),
        scoring.hn_id(F.col("objectID")).alias("hn_id"), "title", urls.post_path(F.col("canonical_url")).alias("path"), "canonical_url",
    )


def feed_posts(entries: DataFrame, blogs: DataFrame, as_of: int) -> DataFrame:
    """Packed rows of accepted feed entries (key, title, url, ts)."""
    rows = attach_blog(entries, blogs).withColumn("title", titles.clean_title(F.col("title"))).filter("title is not null")
    rows = rows.withColumn("rule", once(titles.kind_rule(F.col("title"))))
    kind = scoring.index_of(titles.kind_or_fallback(F.col("rule"), F.col("source"), F.col("kind")), K.KIND_SLUGS)
    return rows.select(
        "blog_id", F.lit(0).alias("points"), scoring.day_number(F.col("ts")).alias("day"),
        scoring.pack_topic_mask(scoring.topic_mask(F.col("topics")), F.col("rule").isNotNull(), feed=True).alias("topic_mask"),
        scoring.pack_kind_source(kind, scoring.index_of(F.col("source"), K.SOURCE_SLUGS)).alias("kind_source"),
        scoring.feed_score(F.col("ts"), as_of).alias("score"), F.lit(0).cast("long").alias("hn_id"), "title",
        urls.post_path(F.col("url"), fragment=False).alias("path"), urls.canonical_url(F.col("url")).alias("canonical_url"),
    )


def build_posts(story: DataFrame, feed: DataFrame) -> DataFrame:
    """Stories, then feed entries, numbered from 0 by day, newest first. Both are written once,
    in ranges of the whole order, and numbered range by range, so a day of many posts is
    dealt out like any other."""
    rows = story.withColumn("_part", F.lit(0)).unionByName(feed.withColumn("_part", F.lit(1)))
    return number_sorted(rows, F.col("_part"), F.desc("day"), "hn_id", "canonical_url", "title", "blog_id", name="post_id").drop("_part")


def index_meta(posts: DataFrame, blogs: DataFrame, n_scanned: DataFrame, built: int) -> DataFrame:
    """One row: counts, the hidden mask and the dimension lists."""
    p, b = posts.agg(F.count(F.lit(1)).alias("n_posts")), blogs.agg(F.count(F.lit(1)).alias("n_blogs"))
    dim = lambda rows, *names: F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r, strict=True)]) for r in rows])
    return p.crossJoin(b).crossJoin(n_scanned).withColumns({
        "built": F.lit(built).cast("long"), "hidden_source_mask": F.lit(K.HIDDEN_MASK), "topics": dim(K.TOPICS, "slug", "name"),
        "sources": dim(K.SOURCES, "slug", "name", "hidden_by_default"), "kinds": dim(K.KINDS, "slug", "name"),
    })


def unpack_posts(df: DataFrame) -> DataFrame:
    flag = lambda bit: F.col("topic_mask").bitwiseAND(bit) != 0
    return df.withColumns({
        "epoch_ms": (F.lit(K.DAY0).cast("long") + F.col("day").cast("long") * 86_400) * 1000, "kind": F.col("kind_source").bitwiseAND(7), "source": F.shiftright("kind_source", 3),
        "topics": F.col("topic_mask").bitwiseAND(K.TOPIC_BITS), "from_feed": flag(K.FLAG_FEED), "rule_fired": flag(K.FLAG_KIND_RULE), "dead": flag(K.FLAG_DEAD),
    })


def post_links(df: DataFrame) -> DataFrame:
    """The address of a post (archived where dead), and that of its discussion."""
    live = F.concat(F.rtrim(F.col("h"), F.lit("/")), F.col("path"))
    dead = F.col("topic_mask").bitwiseAND(K.FLAG_DEAD) != 0
    return df.withColumns({
        "url": F.when(dead, F.concat(F.lit("https://web.archive.org/web/"), live)).otherwise(live),
        "discussion": F.when(F.col("hn_id") > 0, F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("hn_id").cast("string"))),
    })


def mark_dead(posts: DataFrame, status: DataFrame) -> DataFrame:
    """Posts with the dead flag set where a link check (i, status) failed."""
    dead = status.filter(scoring.is_dead(F.col("status"))).select(F.col("i").alias("post_id")).distinct().withColumn("_dead", F.lit(K.FLAG_DEAD))
    return posts.join(dead, "post_id", "left").withColumn("topic_mask", F.col("topic_mask").bitwiseOR(F.coalesce("_dead", F.lit(0)))).drop("_dead")


def passes(blog_id: int | None = None, topic_mask: int = 0, kind_mask: int = 0, hide: bool = True, hidden_mask: int = K.HIDDEN_MASK) -> Column:
    """Facets over packed posts: one blog, any of the topics, any of the kinds, and no hidden
    source unless a blog is pinned. A mask of 0 admits all."""
    ok = F.lit(True)
    if blog_id is not None:
        ok = ok & (F.col("blog_id") == blog_id)
    elif hide:
        ok = ok & (F.lit(hidden_mask).bitwiseAND(F.expr("shiftleft(1, shiftright(kind_source, 3))")) == 0)
    if topic_mask:
        ok = ok & (F.col("topic_mask").bitwiseAND(topic_mask & K.TOPIC_BITS) != 0)
    if kind_mask:
        ok = ok & (F.lit(kind_mask).bitwiseAND(F.expr("shiftleft(1, kind_source & 7)")) != 0)
    return ok


def crawl_plan(posts: DataFrame, limit: int | None = None, delay: float = 0.25, per_host: int | None = None) -> DataFrame:
    """(i, url, day, host, queue_pos, start_s): the oldest links first, each host's in line
    behind each other by ``delay`` seconds. Input (i, url, day).

    A host takes one link per ``delay`` whatever the cluster, so a run of a given time asks for
    ``per_host`` links at most, and leaves the rest to the next run; each task then keeps no
    more than that of a host."""
    rows = posts if limit is None else posts.orderBy("day", "i").limit(limit)
    rows = rows.withColumn("host", F.lower(F.regexp_extract("url", r"^[^:]+://([^/?#]*)", 1)))
    pos = F.row_number().over(Window.partitionBy("host").orderBy("day", "i")) - 1
    rows = rows.withColumn("queue_pos", pos)
    rows = rows if per_host is None else rows.filter(F.col("queue_pos") < per_host)
    return rows.withColumn("start_s", F.col("queue_pos") * delay)


def link_summary(status: DataFrame) -> DataFrame:
    dead = scoring.is_dead(F.col("status"))
    return status.agg(F.count(F.lit(1)).alias("checked"), F.count_if(dead).alias("dead")).withColumn("dead_pct", F.when(F.col("checked") > 0, F.round(100.0 * F.col("dead") / F.col("checked"), 3)).otherwise(0.0))
