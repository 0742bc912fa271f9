"""Tables from files. Every table has a fixed schema; order of input is a column (seq)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubweave import constants as K

STORY = "objectID string, title string, url string, points int, num_comments int, author string, created_at_i long"
LABEL = "key string, source string, is_programming_blog boolean, topics array<struct<slug:string,weight:double>>, kind string, tech array<string>, one_line string, confidence double"
CANDIDATE = "key string, home string, n_stories long, total_points long, median_points int, max_points int, first_seen long, last_seen long, sample_titles array<string>, sample_urls array<string>"
FEED = CANDIDATE + ", feed string, feed_title string, entries array<struct<title:string,url:string,published:long,summary:string>>, error string"
OVERRIDES = "source map<string,string>, deny array<string>"


def _json_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Parsed lines; a line that is no JSON object goes."""
    ok = F.col("value").isNotNull() & F.try_parse_json("value").isNotNull() & F.ltrim("value").startswith("{")
    return lines.filter(ok).withColumn("_r", F.from_json("value", schema))


def read_stories(spark: SparkSession, path: str) -> DataFrame:
    """Stories from JSON lines, with seq: newest first, as pulled, ids breaking ties.

    Malformed lines are skipped. seq is a dense rank-free order key, (-created, id order),
    kept as two columns' worth in one struct so that no global sort is needed.
    """
    rows = _json_lines(spark.read.text(path), STORY).select("_r.*")
    return rows.withColumn("seq", F.struct((-F.coalesce("created_at_i", F.lit(0))).alias("age"), F.coalesce("objectID", F.lit("")).alias("id")))


def read_labels(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(labels, bad): the last row of each key in order of file name and line, and one row
    with the numbers of malformed lines, and of malformed or out-of-range ones, which lack a
    key (null or empty) or a known source. Blank lines don't count.

    Files are read in blocks, so a large one is many tasks; ``line`` grows with a line's place
    in its file (the block it starts in, then its place there). A folder of that name, as
    Spark writes, counts as one file, its parts in order of their names.
    """
    where = F.col("_metadata.file_path")
    at = F.struct(where.alias("part"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    name = F.regexp_extract(where, r"([^/]+\.jsonl)(?:/[^/]*)?$", 1)
    lines = spark.read.text(f"{path}/*.jsonl").select(name.alias("file"), at.alias("line"), "value").filter(F.trim("value") != "")
    parsed = lines.withColumn("_r", F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", LABEL)))
    good = F.coalesce((F.col("_r.key") != "") & F.col("_r.source").isin(K.SOURCE_SLUGS), F.lit(False))
    own = F.struct("_r", F.struct("file", "line").alias("at"))
    last = parsed.filter(good).groupBy("_r.key").agg(F.max_by(own, F.struct("file", "line")).alias("_l"))
    labels = last.select("_l._r.*", "_l.at.file", "_l.at.line")
    return labels, parsed.agg(F.count_if(F.col("_r").isNull()).alias("n_malformed"), F.count_if(~good).alias("n_bad"))


def last_labels(labels: DataFrame, key: str, *order: str) -> DataFrame:
    """The last row of each key in the given order."""
    own = [c for c in labels.columns if c != key]
    return labels.groupBy(key).agg(F.max_by(F.struct(*own), F.struct(*order)).alias("_r")).select(key, "_r.*")


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Feed records, with seq, their order: by file, and by line."""
    lines = spark.read.text(path).select("value", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")).alias("seq"))
    return _json_lines(lines, FEED).select("_r.*", "seq")


def feed_entries(feeds: DataFrame) -> DataFrame:
    """One row per entry, with its place in the feed."""
    return feeds.select("key", "home", "feed", "feed_title", F.posexplode("entries").alias("pos", "_e")).select("key", "home", "feed", "feed_title", "pos", "_e.*")


def read_overrides(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(key, source) and (key) tables of the overrides document."""
    doc = spark.read.schema(OVERRIDES).option("multiLine", True).json(path)
    return doc.select(F.explode("source").alias("key", "source")), doc.select(F.explode("deny").alias("key"))


def load_index(spark: SparkSession, path: str) -> DataFrame:
    """(i, url, day) of every post of a written index."""
    posts, blogs = spark.read.parquet(f"{path}/posts"), spark.read.parquet(f"{path}/blogs")
    return posts.join(blogs, "blog_id").select(F.col("post_id").alias("i"), F.concat(F.rtrim(F.col("h"), F.lit("/")), F.col("path")).alias("url"), "day")


def read_blog(spark: SparkSession, path: str, blog_id: int) -> DataFrame:
    """The posts of one blog of a written index: of the posts only its shelf is listed and read."""
    shelves = spark.read.parquet(f"{path}/meta").first()["shelves"]
    rows = spark.read.parquet(f"{path}/posts")
    return rows.filter((F.col("shelf") == blog_id % shelves) & (F.col("blog_id") == blog_id)).drop("shelf")
