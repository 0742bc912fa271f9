"""Stories: filters, de-duplication, and publishers aggregated from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubweave.functions import titles, urls


def usable_stories(df: DataFrame) -> DataFrame:
    """Stories that have a url and a title."""
    return df.filter((F.col("url") != "") & (F.col("title") != ""))


def above_bar(df: DataFrame, points: int = 25, since: int | None = None) -> DataFrame:
    kept = df.filter(F.col("points") >= points)
    return kept if since is None else kept.filter(F.col("created_at_i") >= since)


def dedupe_by_url(df: DataFrame) -> DataFrame:
    """One story per canonical URL: that of most points, the first on a tie, with the sum of
    all comments and the number of the others. Partial aggregates take up hot URLs."""
    own = [c for c in df.columns if c not in ("canonical_url", "repost_count")]
    rank = F.struct((-F.coalesce("points", F.lit(0))).alias("p"), "seq")
    rows = df.withColumn("canonical_url", urls.canonical_url(F.col("url")))
    best = rows.groupBy("canonical_url").agg(F.min_by(F.struct(*own), rank).alias("_b"), (F.count(F.lit(1)) - 1).alias("repost_count"), F.sum(F.coalesce("num_comments", F.lit(0))).alias("_c"), F.min("seq").alias("_first"))
    return best.select(*[F.col("_c").cast("long").alias(c) if c == "num_comments" else F.col(f"_b.{c}").alias(c) for c in own], "canonical_url", "repost_count", F.col("_first").alias("first_seq"))


def _title_keys() -> list[Column]:
    return [F.regexp_extract("canonical_url", r"^https://([^/?#]*)", 1).alias("_host"), titles.norm_title(F.col("title")).alias("_title")]


def dedupe_by_title(df: DataFrame, keep_empty_titles: bool = False) -> DataFrame:
    """One story per host and normalised title, after ``dedupe_by_url``. The number of the
    others is added to the kept row's own count only. Titles without ASCII letters or digits
    normalise alike and merge within their host; ``keep_empty_titles`` exempts them."""
    own = [c for c in df.columns if c != "first_seq"]
    rows = df.select("*", *_title_keys())
    keys = ["_host", "_title"]
    if keep_empty_titles:
        rows = rows.withColumn("_own", F.when(F.col("_title") == "", F.col("canonical_url")).otherwise(""))
        keys.append("_own")
    rank = F.struct((-F.coalesce("points", F.lit(0))).alias("p"), "first_seq")
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*own), rank).alias("_b"), (F.count(F.lit(1)) - 1).alias("_more"), F.sum("num_comments").alias("_c"))
    new = {"num_comments": F.col("_c"), "repost_count": F.col("_b.repost_count") + F.col("_more")}
    return best.select(*[new.get(c, F.col(f"_b.{c}")).alias(c) for c in own])


def dedupe_stats(df: DataFrame) -> DataFrame:
    """Rows before, after URLs, after titles, and the percentages that each pass removed. One pass over
    the stories: a row per URL knows how many it stands for, and those are summed by title."""
    once = dedupe_by_url(df).select((F.col("repost_count") + 1).alias("_n"), *_title_keys())
    titles_ = once.groupBy("_host", "_title").agg(F.sum("_n").alias("_n0"), F.count(F.lit(1)).alias("_n1"))
    sums = titles_.agg(F.coalesce(F.sum("_n0"), F.lit(0)).alias("n0"), F.coalesce(F.sum("_n1"), F.lit(0)).alias("n1"), F.count(F.lit(1)).alias("n2"))
    pct = lambda a, b: F.round(F.when(F.col(a) > 0, 100.0 * (F.col(a) - F.col(b)) / F.col(a)).otherwise(0.0), 3)
    return sums.select("n0", "n1", "n2", pct("n0", "n1").alias("url_pct"), pct("n1", "n2").alias("title_pct"), pct("n0", "n2").alias("total_pct"))


def with_blog_key(df: DataFrame, rules: DataFrame | None = None, keep: bool = False) -> DataFrame:
    """Stories with key and home of their publisher; those without one, or denied, go, or, with
    ``keep``, stay with both null.

    With a table of public-suffix rules (see ``urls.registrable_domains``) each different host is
    resolved once and joined back; stories without a host meet nothing and go as before.
    Without one, the expression's short list of suffixes is used.
    """
    rows, domain = df, None
    if rules is not None:
        hosts = urls.registrable_domains(df.select(urls.host_of(F.col("url")).alias("host")), rules).select(F.col("host").alias("_host"), F.col("domain").alias("_domain"))
        rows, domain = df.withColumn("_host", urls.host_of(F.col("url"))).join(hosts, "_host", "left"), F.col("_domain")
    keys = F.filter(F.array(urls.blog_key(F.col("url"), domain)), lambda k: k.isNotNull() & ~urls.denied(k["key"], domain))
    each = F.explode_outer(keys) if keep else F.explode(keys)
    return rows.withColumn("_k", each).withColumns({"key": F.col("_k.key"), "home": F.col("_k.home")}).drop("_k", "_host", "_domain")


def top_samples(stories: DataFrame, n: int = 5) -> DataFrame:
    """(key, sample_titles, sample_urls): each publisher's n stories of most points."""
    w = Window.partitionBy("key").orderBy(F.coalesce("points", F.lit(0)).desc(), F.col("seq"))
    top = stories.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    ordered = F.sort_array(F.collect_list(F.struct("_rn", "title", "url")))
    return top.groupBy("key").agg(ordered.alias("_s")).select("key", F.transform("_s", lambda x: x["title"]).alias("sample_titles"), F.transform("_s", lambda x: x["url"]).alias("sample_urls"))


def aggregate_blogs(stories: DataFrame, min_stories: int = 3) -> DataFrame:
    """Candidate publishers of at least ``min_stories`` stories, from rows with a key."""
    points = F.coalesce("points", F.lit(0))
    agg = stories.groupBy("key").agg(
        F.any_value("home").alias("home"), F.count(F.lit(1)).alias("n_stories"), F.sum(points).cast("long").alias("total_points"),
        F.percentile(points, 0.5).cast("int").alias("median_points"), F.max(points).cast("int").alias("max_points"),
        F.min("created_at_i").alias("first_seen"), F.max("created_at_i").alias("last_seen"),
    )
    return min_stories_filter(agg, min_stories).join(top_samples(stories), "key")


def min_stories_filter(df: DataFrame, n: int) -> DataFrame:
    return df.filter(F.col("n_stories") >= n)


def aggregate_stats(stories: DataFrame, min_stories: int = 3, rules: DataFrame | None = None) -> DataFrame:
    """Stories read, those skipped or denied, distinct keys, candidates: one count per key, summed up."""
    counts = with_blog_key(stories, rules, keep=True).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    there, total = F.col("key").isNotNull(), lambda c: F.coalesce(F.sum(c), F.lit(0))
    return counts.agg(
        total(F.col("n")).alias("n_read"), total(F.when(~there, F.col("n"))).alias("n_skipped"), F.count_if(there).alias("n_keys"), F.count_if(there & (F.col("n") >= min_stories)).alias("n_candidates"),
    )
