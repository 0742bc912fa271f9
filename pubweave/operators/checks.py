"""Data-quality jobs: checks of label runs and of the finished index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubweave import constants as K
from pubweave.operators.numbering import number_sorted


def duplicate_keys(labels: DataFrame) -> DataFrame:
    return labels.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unexpected_keys(labels: DataFrame, expected: DataFrame) -> DataFrame:
    return labels.select("key").distinct().join(expected.select("key"), "key", "left_anti")


def missing_keys(labels: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.select("key").distinct().join(labels.select("key"), "key", "left_anti")


def batch_size(labels: DataFrame, default: int = 200) -> int:
    """Rows of the largest label file: the number of keys that went into a batch."""
    most = labels.groupBy("file").count().agg(F.max("count")).first()[0]
    return most or default


def expected_batches(expected: DataFrame, size: int) -> DataFrame:
    """(key, batch): keys in order, ``size`` to a batch."""
    numbered = number_sorted(expected.select("key").distinct(), "key", name="_n")
    return numbered.select("key", F.floor(F.col("_n") / size).cast("long").alias("batch"))


def missing_by_batch(expected: DataFrame, labels: DataFrame, size: int | None = None, top: int = 3) -> DataFrame:
    """The batches that lack most keys. Without a size, labels (key, file) tell it."""
    lost = expected_batches(expected, size or batch_size(labels)).join(labels.select("key"), "key", "left_anti")
    return lost.groupBy("batch").agg(F.count(F.lit(1)).alias("missing")).orderBy(F.desc("missing"), "batch").limit(top)


def mismatched_files(expected: DataFrame, labels: DataFrame, size: int | None = None) -> DataFrame:
    """(file, batch, n_found, n_keys): label files (key, file) of whose own rows less than half
    are keys of the batch that the first number in the file's name stands for. Files without
    a number, or of a batch that isn't expected, can't be told; while no key is missing
    nothing is wrong."""
    batches = expected_batches(expected, size or batch_size(labels))
    number = F.nullif(F.regexp_extract("file", r"(\d+)", 1), F.lit("")).cast("long")
    files = labels.groupBy("file").agg(F.count(F.lit(1)).alias("n_keys")).withColumn("batch", number)
    known = files.join(batches.select("batch").distinct(), "batch", "left_semi")
    own = labels.select("file", "key").distinct().join(batches, "key")
    found = known.join(own, ["file", "batch"], "left").groupBy("file", "batch", "n_keys").agg(F.count("key").alias("n_found"))
    wrong = found.filter(F.col("n_found") * 2 < F.col("n_keys")).select("file", "batch", "n_found", "n_keys")
    return wrong.crossJoin(missing_keys(labels, expected).limit(1).select())  # one row or none


def low_confidence(labels: DataFrame, below: float = 0.55) -> DataFrame:
    low = F.coalesce("confidence", F.lit(0.0)) < below
    return labels.agg(F.count_if(low).alias("n_low"), F.avg(low.cast("int")).alias("share_low"))


def _one(df: DataFrame, check: str, bad: Column) -> DataFrame:
    return df.agg(F.count_if(bad).alias("n")).select(F.lit(check).alias("check"), (F.col("n") == 0).alias("ok"), "n")


def label_validation(labels: DataFrame, expected: DataFrame, bad: DataFrame | None = None) -> DataFrame:
    """(check, ok, n): malformed lines (from the row that ``read_labels`` gives with the labels),
    duplicates, unexpected and missing keys, unknown sources, kinds and topics, no topics,
    low confidence. n counts rows in breach; low confidence never fails."""
    true = F.lit(True)
    slugs = F.array(*map(F.lit, K.TOPIC_SLUGS))
    malformed = labels.limit(0).agg(F.count(F.lit(1)).alias("n")) if bad is None else bad.select(F.col("n_malformed").alias("n"))
    parts = [
        malformed.select(F.lit("malformed").alias("check"), (F.col("n") == 0).alias("ok"), "n"),
        _one(duplicate_keys(labels), "duplicates", true), _one(unexpected_keys(labels, expected), "unexpected", true), _one(missing_keys(labels, expected), "missing", true),
        _one(labels, "source", ~F.coalesce(F.col("source").isin(K.SOURCE_SLUGS), F.lit(False))), _one(labels, "kind", ~F.coalesce(F.col("kind").isin(K.KIND_SLUGS), F.lit(False))),
        _one(labels, "topics", F.coalesce(F.size("topics") <= 0, true) | F.exists("topics", lambda t: ~F.coalesce(F.array_contains(slugs, t["slug"]), F.lit(False)))),
        _one(labels, "low confidence", F.coalesce("confidence", F.lit(0.0)) < 0.55).withColumn("ok", true),
    ]
    return reduce(DataFrame.unionByName, parts)


def index_checks(posts: DataFrame, blogs: DataFrame, meta: DataFrame, least_posts: int = 10_000, least_blogs: int = 500, canaries: list[str] | None = None) -> DataFrame:
    """(check, ok, value) of a built index: sizes, also against its meta row (n_posts, n_blogs,
    hidden_source_mask), keys, ranges and shares. The posts are gone through once: they meet
    the blogs' ids by an outer join, and all their values are one aggregate."""
    feed = F.col("topic_mask").bitwiseAND(K.FLAG_FEED) != 0
    share = lambda cond: F.coalesce(F.avg(cond.cast("int")), F.lit(0.0))
    number = lambda c: c.cast("double")
    source = F.expr("shiftright(kind_source, 3)")
    known = blogs.select("blog_id").distinct().withColumn("_known", F.lit(True))
    hidden = meta.select(F.col("hidden_source_mask").alias("_mask"))  # one row
    rows = posts.select("blog_id", "title", "points", "topic_mask", "kind_source", "hn_id").join(known, "blog_id", "left").crossJoin(F.broadcast(hidden))
    p = rows.agg(
        number(F.count(F.lit(1))).alias("posts"), number(F.count_if(F.coalesce(F.trim("title"), F.lit("")) == "")).alias("blank titles"),
        number(F.min(F.when(~feed, F.col("points")))).alias("least story points"), number(F.count_if(feed)).alias("feed posts"),
        number(F.coalesce(F.max(F.when(feed, F.col("points"))), F.lit(0))).alias("feed points"), number(F.max(source)).alias("largest source"),
        number(F.max(F.col("kind_source").bitwiseAND(7))).alias("largest kind"), share(F.col("topic_mask").bitwiseAND(K.FLAG_KIND_RULE) != 0).alias("rule share"),
        share(F.col("topic_mask").bitwiseAND(K.TOPIC_BITS) == 0).alias("no topic share"), share((F.col("hn_id") == 0) & ~feed).alias("no id share"),
        share(F.col("_mask").bitwiseAND(F.expr("shiftleft(1, shiftright(kind_source, 3))")) != 0).alias("hidden share"), number(F.count_if(F.col("_known").isNull())).alias("orphan posts"),
    )
    wanted = K.CANARIES if canaries is None else canaries
    b = blogs.agg(number(F.count(F.lit(1))).alias("blogs"), number(F.lit(len(set(wanted))) - F.countDistinct(F.when(F.col("n").isin(wanted), F.col("n")))).alias("missing canaries"))
    all_of = p.crossJoin(b).crossJoin(meta.select("n_posts", "n_blogs"))  # three single rows
    all_of = all_of.withColumns({"posts beside meta": number(F.col("posts") - F.col("n_posts")), "blogs beside meta": number(F.col("blogs") - F.col("n_blogs"))}).drop("n_posts", "n_blogs")
    value = F.col("value")
    rules = {
        "posts": value > least_posts, "blank titles": value == 0, "least story points": value >= 25, "feed posts": value > 0,
        "feed points": value == 0, "largest source": value < len(K.SOURCES), "largest kind": value < len(K.KINDS),
        "rule share": (value > 0.10) & (value < 0.60), "no topic share": value < 0.05, "no id share": value < 0.01, "hidden share": (value > 0.10) & (value < 0.85),
        "blogs": value > least_blogs, "orphan posts": value == 0, "missing canaries": value == 0, "posts beside meta": value == 0, "blogs beside meta": value == 0,
    }
    long = all_of.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.col(f"`{c}`").alias("value")) for c in all_of.columns])).alias("x")).select("x.*")
    ok = reduce(lambda acc, kv: F.when(F.col("check") == kv[0], kv[1]).otherwise(acc), rules.items(), F.lit(False))
    return long.select("check", F.coalesce(ok, F.lit(False)).alias("ok"), F.round("value", 6).alias("value"))
