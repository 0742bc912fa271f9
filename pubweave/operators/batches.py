"""Evidence texts and batches for labelling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubweave.functions import scoring, titles, urls
from pubweave.operators.numbering import number_sorted


def assign_batches(df: DataFrame, size: int, key: str = "key") -> DataFrame:
    """Adds batch and pos (both from 0) in order of the key, which must be unique."""
    rows = number_sorted(df, key, name="_n")
    return rows.withColumn("batch", F.floor(F.col("_n") / size).cast("long")).withColumn("pos", (F.col("_n") % size).cast("long")).drop("_n")


def compact_lines(candidates: DataFrame, per_batch: int = 150) -> DataFrame:
    """(batch, pos, key, text): identity, counts and up to four titles of each candidate."""
    shown = F.array_join(F.transform(F.slice("sample_titles", 1, 4), lambda t: F.left(t, F.lit(110))), " :: ")
    text = F.format_string("%d. key=%s | home=%s | hn_stories=%d median_pts=%d max_pts=%d\n   top_titles: %s\n", F.col("pos") + 1, "key", "home", "n_stories", "median_points", "max_points", shown)
    return assign_batches(candidates, per_batch).select("batch", "pos", "key", text.alias("text"))


def feeds_with_entries(feeds: DataFrame) -> DataFrame:
    """One row per key, of feeds (key, feed_title, entries) that have entries: the last one in order
    of seq, where the table has it (``read_feeds``), else the greatest."""
    order = F.struct(F.col("seq") if "seq" in feeds.columns else F.lit(0).alias("seq"), "feed_title", "entries")
    return feeds.filter(F.size("entries") > 0).groupBy("key").agg(F.max(order).alias("_f")).select("key", "_f.feed_title", "_f.entries")


def evidence_blocks(candidates: DataFrame, feeds: DataFrame, min_n: int = 5, per_batch: int = 150) -> DataFrame:
    """(batch, pos, key, text): header, titles, URL slugs, and what the feed (key, feed_title,
    entries) says, of candidates with ``min_n`` stories or more. A feed without entries says
    nothing; of several records of a key the last with entries counts."""
    rows = assign_batches(candidates.filter(F.col("n_stories") >= min_n), per_batch).join(feeds_with_entries(feeds), "key", "left")
    two = lambda c: F.format_string("%.2f", c)
    head = F.concat(
        F.lit("### "), (F.col("pos") + 1).cast("string"), F.lit(". "), F.col("key"), F.lit("\nhome="), F.col("home"), F.lit(" stories="), F.col("n_stories").cast("string"),
        F.lit(" median_pts="), F.col("median_points").cast("string"), F.lit(" max_pts="), F.col("max_points").cast("string"),
        F.lit(" per_month="), two(scoring.cadence(F.col("n_stories"), F.col("first_seen"), F.col("last_seen"))), F.lit(" active="), scoring.utc_year(F.col("first_seen")).cast("string"),
        F.lit("-"), scoring.utc_year(F.col("last_seen")).cast("string"), F.lit(" craft_rate="), two(titles.title_rate(F.col("sample_titles"), titles.is_craft)),
        F.lit(" event_rate="), two(titles.title_rate(F.col("sample_titles"), titles.is_event)),
    )
    shown = F.concat(F.lit("top_hn_titles: "), F.array_join(F.transform(F.slice("sample_titles", 1, 8), lambda t: F.left(t, F.lit(95))), " | "))
    parts = F.filter(F.transform(F.slice("sample_urls", 1, 4), lambda u: urls.slugs(u)), lambda s: s != "")
    slugs = F.when(F.size(parts) > 0, F.concat(F.lit("url_slugs: "), F.array_join(parts, " | ")))
    title = F.when(F.col("feed_title") != "", F.concat(F.lit("feed_title: "), F.left("feed_title", F.lit(90))))
    entry = lambda e: F.concat(F.lit("  feed: "), F.left(e["title"], F.lit(85)), F.when(F.coalesce(e["summary"], F.lit("")) != "", F.concat(F.lit(" -- "), F.left(e["summary"], F.lit(130)))).otherwise(""))
    entries = F.when(F.size("entries") > 0, F.array_join(F.transform(F.slice("entries", 1, 4), entry), "\n"))
    return rows.select("batch", "pos", "key", F.concat_ws("\n", head, shown, slugs, title, entries).alias("text"))


def evidence_stats(candidates: DataFrame, feeds: DataFrame, min_n: int = 5) -> DataFrame:
    """Candidates with ``min_n`` stories or more, and those of them whose feed has entries."""
    with_feed = feeds.filter(F.size("entries") > 0).select("key").distinct().withColumn("_f", F.lit(True))
    return candidates.filter(F.col("n_stories") >= min_n).join(with_feed, "key", "left").agg(F.count(F.lit(1)).alias("n_blogs"), F.count_if(F.coalesce("_f", F.lit(False))).alias("n_with_feed"))
