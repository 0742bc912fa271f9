"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a
    local session gets a temporary folder; on a cluster it is an error, as executors would
    write to disks of their own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-checkpoint-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The frame, written to the shared folder as Parquet and read back, and its path: later reads
    take only the columns they need, and its size on disk tells Spark whether it may be broadcast."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def written(df: DataFrame, name: str) -> DataFrame:
    return stored(df, name)[0]


def remove(spark: SparkSession, path: str) -> None:
    """Deletes what a run has written and doesn't need any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder, so that a lost executor costs a read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_REMEMBERED: dict[str, Callable[[], None]] = {}


@contextmanager
def turn(operator: str, forget: Callable[[], None] = lambda: None) -> Iterator[None]:
    """Around the work of a Python worker for an operator. Workers go on from operator to operator, and idle ones count
    with their executor's memory: what one has remembered from task to task for others is forgotten now (``forget``
    does that), which costs time and changes nothing, and in the end what is free goes back to the system."""
    others = [x for x in _REMEMBERED if x != operator]
    for x in others:
        _REMEMBERED.pop(x)()
    _REMEMBERED[operator] = forget
    if others:
        gc.collect()
    try:
        yield
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library's alone
        if trim:
            trim(0)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, without a copy. An Arrow batch is bounded by Spark in
    bytes; its Python objects take more, so only a slice at a time is turned into them."""
    for batch in batches:
        for k in range(0, max(1, len(batch)), rows):
            yield batch.slice(k, rows)


def runs(texts: list, most: int = 1 << 20) -> Iterator[list]:
    """Consecutive texts of about a million characters together, or a longer one alone."""
    run, size = [], 0
    for t in texts:
        if run and size + len(t or "") > most:
            yield run
            run, size = [], 0
        run.append(t)
        size += len(t or "")
    if run:
        yield run


def let(value: Column, use) -> Column:
    """use(value), with the value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_count(text: Column) -> Column:
    """The number of words. Each is replaced by a letter; ``regexp_count`` would first hold them all as strings."""
    letters = F.regexp_replace(text, F.lit(WORD + r"[\x20\x09-\x0D]*+"), F.lit("w"))
    return F.length(F.ltrim(letters, F.lit(SPACES))).cast("long")


def text_key(text_col: str) -> Column:
    """A 64-bit hash by which equal texts meet; null counts as empty. Different texts may share it."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def text_digest(text_col: str) -> Column:
    """128 bits of the text's SHA-256, which stand for it; null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256)), 1, 16)


def without_repeats(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One of the rows that have both id and text in common, null ids too. The tie between
    rows that differ in other columns is broken by a hash of the row, so not by order.

    Only rows repeated by count are numbered, and all but the first go before the shuffle.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    keyed = df.select(row, F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    again = checkpointed(keyed.groupBy("id", "key").count().filter("count > 1").select(F.col("id").alias("again"), F.col("key").alias("again_key")))
    if again.isEmpty():
        return df
    same = F.col("id").eqNullSafe(F.col("again")) & (F.col("key") == F.col("again_key"))
    order = Window.partitionBy("id", F.coalesce(F.col("row")[text_col], F.lit(""))).orderBy(F.xxhash64(F.to_json("row")))
    one = keyed.join(again, same, "left_semi").withColumn("at", F.row_number().over(order)).filter("at = 1")
    return keyed.join(again, same, "left_anti").select("row.*").union(one.select("row.*"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (node, root), root
    being the smallest node reachable. Nodes without edges have no row.

    Alternating large-star and small-star steps, each written to the shared folder;
    the number of rounds grows with the logarithm of the longest path. A hub's edges
    meet its minimum by a join, whose hot keys adaptive execution splits.
    """
    state = lambda df: df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    e, path = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = state(e)
    while seen["n"]:
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least, "a").filter("b > a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b").distinct()
        )
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        met = down.join(least, "a")
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        before = path
        e, path = stored(small.filter("a <> b").distinct(), "edges")
        remove(edges.sparkSession, before)
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
