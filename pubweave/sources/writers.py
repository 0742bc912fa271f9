"""Files from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_stories(df: DataFrame, path: str) -> None:
    df.orderBy(F.desc("points")).write.mode("overwrite").json(path)


def write_candidates(df: DataFrame, path: str) -> None:
    df.orderBy(F.desc("n_stories"), F.desc("total_points")).write.mode("overwrite").json(path)


#: Folders that an index's posts are dealt to by blog.
SHELVES = 64


def shelf_of(blog_id: Column, shelves: int = SHELVES) -> Column:
    return F.pmod(blog_id, F.lit(shelves)).cast("int")


def write_index(posts: DataFrame, blogs: DataFrame, meta: DataFrame, path: str, shelves: int = SHELVES) -> None:
    """Posts, blogs and meta, as Parquet. Posts lie in a folder per shelf of blogs, and inside it by
    blog and day: what reads one blog (``read_blog``) opens one folder and, by the statistics
    of its row groups, little of that; a span of days skips row groups likewise. A blog of
    very many posts is dealt to several files."""
    rows = posts.withColumn("shelf", shelf_of(F.col("blog_id"), shelves))
    rows.repartitionByRange("shelf", "blog_id", "day", "post_id").sortWithinPartitions("shelf", "blog_id", "day", "post_id").write.mode("overwrite").partitionBy("shelf").parquet(f"{path}/posts")
    blogs.write.mode("overwrite").parquet(f"{path}/blogs")
    meta.withColumn("shelves", F.lit(shelves)).write.mode("overwrite").parquet(f"{path}/meta")


def batch_texts(lines: DataFrame, between: str) -> DataFrame:
    """(batch, value): the texts of each batch, in order, as one document."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "text")))
    return lines.groupBy("batch").agg(F.array_join(F.transform(ordered, lambda x: x["text"]), between).alias("value"))


def write_batches(lines: DataFrame, path: str, between: str = "\n\n") -> None:
    """A folder per batch with one text file."""
    batch_texts(lines, between).repartition("batch").write.mode("overwrite").partitionBy("batch").text(path)


def batch_manifest(lines: DataFrame, per_batch: int) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_blogs"), F.coalesce(F.max("batch") + 1, F.lit(0)).cast("long").alias("n_batches")).withColumn("per_batch", F.lit(per_batch))
