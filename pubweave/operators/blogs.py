"""Blogs: labels, overrides, inclusion and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubweave import constants as K
from pubweave.functions import scoring
from pubweave.operators.numbering import number_sorted


def apply_overrides(labels: DataFrame, overrides: DataFrame) -> DataFrame:
    """Labels with the source set by hand, where that is a known one."""
    own = overrides.filter(F.col("source").isin(K.SOURCE_SLUGS)).select(F.col("key"), F.col("source").alias("_s"))
    return labels.join(own, "key", "left").withColumn("source", F.coalesce("_s", "source")).drop("_s")


def include_blogs(labels: DataFrame, candidates: DataFrame, deny: DataFrame | None = None) -> DataFrame:
    """Candidates whose label admits them, with their label and the hidden mark.

    Engineering, project and trade blogs need the programming flag; personal and vendor
    blogs a software topic besides; newsrooms twenty stories; institutions never enter.
    """
    rows = labels.join(candidates, "key")
    if deny is not None:
        rows = rows.join(deny.select("key").distinct(), "key", "left_anti")
    flag = F.coalesce("is_programming_blog", F.lit(False))
    technical = F.coalesce(F.arrays_overlap(F.transform("topics", lambda t: t["slug"]), F.array(*map(F.lit, K.SOFTWARE_TOPICS))), F.lit(False))
    source = F.col("source")
    admitted = (source.isin("engineering", "project", "trade") & flag) | (source.isin("personal", "vendor") & flag & technical) | ((source == "newsroom") & (F.col("n_stories") >= 20))
    return rows.filter(admitted).withColumn("hidden", scoring.is_hidden(source))


def rank_blogs(blogs: DataFrame) -> DataFrame:
    """Adds quality and blog_id, 0 for the best; ties by key. Publishers are numbered inside
    ranges of quality and key, so no window sees them all, nor all of one quality."""
    rows = blogs.withColumn("quality", scoring.blog_quality(F.col("median_points"), F.col("n_stories")))
    numbered = number_sorted(rows, F.desc("quality"), "key", name="blog_id")
    return numbered.withColumn("blog_id", F.col("blog_id").cast("int"))


def blog_rows(ranked: DataFrame) -> DataFrame:
    """The index's blog table."""
    return ranked.select(
        "blog_id", F.col("key").alias("n"), F.col("home").alias("h"), scoring.index_of(F.col("source"), K.SOURCE_SLUGS).alias("s"),
        scoring.topic_mask(F.col("topics")).alias("tm"), F.left(F.coalesce("one_line", F.lit("")), F.lit(110)).alias("o"),
        F.col("n_stories").alias("c"), F.col("median_points").alias("m"), scoring.utc_year(F.col("last_seen")).alias("l"), F.round("quality", 3).alias("q"),
    )


def select_for_feeds(candidates: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidates worth a fetch: programming blogs, newsrooms and the trade press."""
    keep = labels.filter(F.coalesce("is_programming_blog", F.lit(False)) | F.col("source").isin("newsroom", "trade")).select("key")
    return candidates.join(keep, "key", "left_semi")


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows that aren't done yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")
