"""The pipeline's roles played by the given tables, as frames and as SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubweave import constants as K

AS_OF = 1_706_745_600
TITLE = r"(?is)<title[^>]*>(.*?)</title>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(names: list[str], n):
    return F.element_at(F.array(*map(F.lit, names)), (n % len(names) + 1).cast("int"))


def _pick_sql(names: list[str], n: str) -> str:
    return "[" + ", ".join(f"'{x}'" for x in names) + f"][{n} % {len(names)} + 1]"


def page_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        i.alias("seq"), i.cast("string").alias("objectID"), F.regexp_extract("html", TITLE, 1).alias("title"), "url", (25 + (i * 37) % 500).cast("int").alias("points"),
        (i % 20).cast("int").alias("num_comments"), (K.DAY0 + i * 86_400).alias("created_at_i"),
    )


PAGE_STORIES = f"""SELECT page_id AS seq, CAST(page_id AS VARCHAR) AS "objectID", regexp_extract(html, '{TITLE}', 1) AS title, url,
  CAST(25 + (page_id * 37) % 500 AS INTEGER) AS points, CAST(page_id % 20 AS INTEGER) AS num_comments, {K.DAY0} + page_id * 86400 AS created_at_i FROM pages"""


def doc_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        i.alias("seq"), i.cast("string").alias("objectID"), F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.lit("https://www."), F.col("source"), F.lit(".example/p/"), (i % 700).cast("string")).alias("url"),
        F.concat(F.col("source"), F.lit(".example")).alias("key"), F.concat(F.lit("https://"), F.col("source"), F.lit(".example")).alias("home"),
        (F.col("n_chars") % 1000).cast("int").alias("points"), (i % 20).cast("int").alias("num_comments"), (K.DAY0 + i * 3600).alias("created_at_i"),
    )


DOC_STORIES = f"""SELECT doc_id AS seq, CAST(doc_id AS VARCHAR) AS "objectID", string_split(text, chr(10))[1] AS title,
  'https://www.' || source || '.example/p/' || (doc_id % 700) AS url, source || '.example' AS key, 'https://' || source || '.example' AS home,
  CAST(n_chars % 1000 AS INTEGER) AS points, CAST(doc_id % 20 AS INTEGER) AS num_comments, {K.DAY0} + doc_id * 3600 AS created_at_i FROM documents"""


def line_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.concat(F.lit("p"), F.col("l_partkey").cast("string"), F.lit(".example"))
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"), F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("title"),
        F.concat(F.lit("https://"), host, F.lit("/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string")).alias("url"),
        host.alias("key"), F.concat(F.lit("https://"), host).alias("home"), F.col("l_quantity").cast("int").alias("points"), F.unix_timestamp("l_shipdate").alias("created_at_i"),
    )


LINE_STORIES = """SELECT l_orderkey * 10 + l_linenumber AS seq, 'Order ' || l_orderkey AS title, 'https://p' || l_partkey || '.example/' || l_orderkey || '/' || l_linenumber AS url,
  'p' || l_partkey || '.example' AS key, 'https://p' || l_partkey || '.example' AS home, CAST(trunc(l_quantity) AS INTEGER) AS points, CAST(epoch(l_shipdate) AS BIGINT) AS created_at_i FROM lineitem"""

LANG_TOPIC = {"en": "systems", "fr": "web", "de": "ai", "es": "science"}


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label per labelled document, for the document's source, in order of doc_id."""
    i = F.col("doc_id")
    topic = F.element_at(F.create_map(*[F.lit(x) for kv in LANG_TOPIC.items() for x in kv]), F.col("lang"))
    pair = lambda slug, w: F.struct(slug.alias("slug"), w.cast("double").alias("weight"))
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang", F.col("source").alias("host")), "doc_id").select(
        F.concat("host", F.lit(".example")).alias("key"), _pick(K.SOURCE_SLUGS, i).alias("source"), (F.col("quality") == 1).alias("is_programming_blog"),
        F.array(pair(topic, (i % 5) / 5.0), pair(_pick(K.TOPIC_SLUGS, i), F.lit(0.5))).alias("topics"), _pick(K.KIND_SLUGS, i).alias("kind"),
        F.concat(F.lit("line "), i.cast("string")).alias("one_line"), ((i % 100) / 100.0).alias("confidence"), i.alias("ord"), "toxic",
    )


LABEL_ROWS = f"""SELECT d.source || '.example' AS key, {_pick_sql(K.SOURCE_SLUGS, 'doc_id')} AS source, l.quality = 1 AS is_programming_blog,
  map {LANG_TOPIC}[d.lang] AS topic1, (doc_id % 5) / CAST(5 AS DOUBLE) AS weight1, {_pick_sql(K.TOPIC_SLUGS, 'doc_id')} AS topic2,
  {_pick_sql(K.KIND_SLUGS, 'doc_id')} AS kind, 'line ' || doc_id AS one_line, (doc_id % 100) / CAST(100 AS DOUBLE) AS confidence, doc_id AS ord, toxic
  FROM labels AS l JOIN documents AS d USING (doc_id)"""


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    u = F.col("user_id") * 2 + e % 2  # two feeds for each user
    return table(spark, sf_dir, "events").select(
        F.concat(F.when(u % 10 == 0, "forum.").otherwise("blog."), u.cast("string"), F.lit(".example")).alias("key"), u.alias("feed_ord"),
        F.concat(F.when(e % 50 == 7, "Re: ").otherwise(""), F.col("event_type"), F.lit(" "), e.cast("string")).alias("title"),
        F.concat(F.lit("https://blog."), (F.col("user_id") % 40).cast("string"), F.lit(".example/e/"), (e % 400).cast("string")).alias("url"),
        F.when(e % 97 == 3, 0).otherwise(F.unix_timestamp("ts")).cast("long").alias("ts"), e.alias("pos"),
    )


FEED_ENTRIES = """SELECT CASE WHEN (user_id * 2 + event_id % 2) % 10 = 0 THEN 'forum.' ELSE 'blog.' END || (user_id * 2 + event_id % 2) || '.example' AS key, user_id * 2 + event_id % 2 AS feed_ord,
  CASE WHEN event_id % 50 = 7 THEN 'Re: ' ELSE '' END || event_type || ' ' || event_id AS title,
  'https://blog.' || (user_id % 40) || '.example/e/' || (event_id % 400) AS url, CASE WHEN event_id % 97 = 3 THEN 0 ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS ts, event_id AS pos FROM events"""


def pager_of(table: DataFrame, folder: str, size: int) -> Callable[[int], list[dict]]:
    """Requests to a table as a source of pages: at most ``size`` of the rows not younger than a cursor, newest first, then by objectID.

    The rows are dealt to files of ``folder`` by that order once, about five pages to a file; a request opens the files that its page lies in.
    """
    spark, order = table.sparkSession, [("created_at_i", "descending"), ("objectID", "ascending")]
    rows = table.filter("created_at_i is not null")
    parts = rows.repartitionByRange(max(1, -(-rows.count() // (5 * size))), F.desc("created_at_i"), F.asc("objectID"))
    parts.withColumn("part", F.spark_partition_id()).write.partitionBy("part").parquet(folder)
    oldest = sorted(spark.read.schema(rows.withColumn("part", F.lit(0)).schema).parquet(folder).groupBy("part").agg(F.min("created_at_i")).collect())

    @lru_cache(2)
    def part(n: int):
        return spark.read.schema(rows.schema).parquet(f"{folder}/part={n}").toArrow().sort_by(order)

    def request(cursor: int) -> list[dict]:
        page: list[dict] = []
        for n, last in oldest:
            if last <= cursor and len(page) < size:
                found = part(n)
                page += found.filter(pc.field("created_at_i") <= cursor).slice(0, size - len(page)).to_pylist()
        return page

    return request
