"""Incremental jobs: ingest of stories, paged or from files, and re-runs over what isn't done yet."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pubweave.sources.readers import STORY

#: Folders that a table of keyed rows is dealt to. Its column in the table.
SHELVES, SHELF = 64, "shelf"
#: Bytes of pages that a pull holds at most before it stores them; a page more may come on top.
HELD = 32 << 20
ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _there(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.exists(p)


def removed(spark: SparkSession, path: str) -> bool:
    fs, p = _files(spark, path)
    return fs.delete(p, True)


def shelf_of(key: str, shelves: int = SHELVES) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shelves)).cast("int")


def known_keys(spark: SparkSession, out: str, key: str, shelves: list[int]) -> DataFrame | None:
    """The keys of a table's given shelves; other shelves are not even listed. None where none is there."""
    paths = [f"{out}/{SHELF}={s}" for s in shelves if _there(spark, f"{out}/{SHELF}={s}")]
    return spark.read.option("basePath", out).parquet(*paths).select(key) if paths else None


@contextmanager
def _new_rows(batch: DataFrame, out: str, key: str, order: list, columns: list[str], shelves: int = SHELVES) -> Iterator[DataFrame]:
    """The rows with a key not in the table yet, the first of each key in the batch, and their shelves."""
    first = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    rows = batch.withColumn("_rn", first).filter("_rn = 1").drop("_rn").select(*columns, shelf_of(key, shelves).alias(SHELF)).persist()
    try:
        touched = [r[0] for r in rows.select(SHELF).distinct().collect()]  # as many as there are shelves
        known = known_keys(batch.sparkSession, out, key, touched)
        yield rows if known is None else rows.join(known, key, "left_anti")
    finally:
        rows.unpersist()


def append_new(batch: DataFrame, out: str, key: str, order: list, columns: list[str], shelves: int = SHELVES) -> int:
    """Appends the rows with a key not in the table yet, the first of each key in the batch, and
    says how many.

    The table lies in a folder per shelf of keys, so a batch meets the keys of the shelves that it
    touches, and a small batch few of them; the rows of a shelf are written as one file. A batch
    that is repeated after a failure finds its own rows there.
    """
    seen = Observation()
    with _new_rows(batch, out, key, order, columns, shelves) as new:
        new.repartition(SHELF).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").partitionBy(SHELF).parquet(out)
    return (seen.get or {}).get("n") or 0


def ingest_stream(spark: SparkSession, in_dir: str, out: str, checkpoint: str, max_files: int = 1000) -> StreamingQuery:
    """Appends the stories of new JSON files, each id once, first version first; rows without
    a time are skipped. Runs until no new file is left; the checkpoint resumes it, and a
    batch that is repeated after a failure finds its own rows in the table."""
    names = [x.split()[0] for x in STORY.split(", ")]
    stories = spark.readStream.schema(STORY).option("maxFilesPerTrigger", max_files).json(in_dir).filter("objectID is not null and created_at_i is not null")
    stories = stories.select(*names, F.col("_metadata.file_modification_time").alias("_time"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))

    def step(batch: DataFrame, _: int) -> None:
        # in order of arrival: of the files, and of the lines of a file
        append_new(batch.withColumn("_line", F.monotonically_increasing_id()), out, "objectID", ["_time", "_file", "_block", "_line"], names)

    return stories.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _offset(spark: SparkSession, path: str) -> dict | None:
    rows = spark.read.text(path).collect() if _there(spark, path) else []  # one line
    return json.loads(rows[0][0]) if rows else None


def _keep_offset(spark: SparkSession, path: str, **at) -> None:
    spark.createDataFrame([(json.dumps(at),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _append_pages(spark: SparkSession, pages: list[pa.Table], out: str, names: list[str]) -> list[int]:
    """Appends the new stories of pages, up to the first that has none, and says how many each page up to it has."""
    held = [p.append_column("_page", pa.array([k] * len(p), pa.int32())).append_column("_at", pa.array(range(len(p)), pa.int32())) for k, p in enumerate(pages) if len(p)]
    if not held:
        return [0]
    with _new_rows(spark.createDataFrame(pa.concat_tables(held)), out, "objectID", ["_page", "_at"], [*names, "_page"]) as rows:
        new = rows.persist()
        try:
            found = dict(new.groupBy("_page").count().collect())
            counts = [found.get(k, 0) for k in range(len(pages))]
            counts = counts[: counts.index(0) + 1] if 0 in counts else counts
            if any(counts):
                new.filter(F.col("_page") < len(counts)).drop("_page").repartition(SHELF).write.mode("append").partitionBy(SHELF).parquet(out)
        finally:
            new.unpersist()
    return counts


def pull_pages(spark: SparkSession, pager: Callable[[int], list[dict]], out: str, state: str, start: int, stop_after: int = 0, bar: int = 25, oldest: int = 1_160_000_000) -> int:
    """Takes in the stories of a source that gives them by pages, newest first: ``pager(cursor)`` has
    some of those not younger than the cursor. Returns how many were new.

    From ``start`` on, each page's last time is the next cursor (one less where the page had
    nothing new), until a page is empty, ``oldest`` is reached or, with ``stop_after``, so
    many pages one after the other had no new id: the head is known. Only stories of ``bar``
    points are taken. The place is kept in ``state`` after each time that pages are stored; a run
    that was broken off goes on there, a run that ended begins at ``start``; pages that it may have been
    storing then don't count as known. A page is one request's rows, so it may go through the driver.

    Pages are stored several at a time, as the table's keys are gone through for it: twice as many
    as the time before where those had no known id, ``HELD`` bytes at most, else one. They are asked for as if
    each had something new. Those behind a page that hadn't are dropped and asked for again from
    the right cursor, so there are less than twice the requests.
    """
    names = [x.split()[0] for x in STORY.split(", ")]
    schema = pa.schema([(n, ARROW[kind]) for n, kind in map(str.split, STORY.split(", "))])
    at = _offset(spark, state) or {"cursor": start, "dry": 0, "done": True}
    cursor, dry, total = (start, 0, 0) if at["done"] else (at["cursor"], at["dry"], 0)
    storing = at.get("storing")  # a run was broken off while it stored the pages to this time
    ahead, done, before = 1, False, set()
    while not done:
        pages, lasts, unseen, broken, ended, size, ask = [], [], [], None, False, 0, cursor
        while len(pages) < ahead and size < HELD:
            try:
                page = [s for s in pager(ask) if s.get("created_at_i") is not None and s.get("objectID") is not None]
            except Exception as e:  # what came before it is stored first
                broken = e
                break
            if not page:
                ended = True
                break
            kept = [s for s in page if (s.get("points") or 0) >= bar]
            pages.append(pa.Table.from_pylist(kept, schema))
            size += pages[-1].nbytes
            ask = min(ask, *(s["created_at_i"] for s in page), ask)
            lasts.append(ask)
            ids = {s["objectID"] for s in kept}
            unseen.append(len(ids - before))
            before = ids
            if not unseen[-1] or ask <= oldest:
                break
        if len(pages) > 1:
            _keep_offset(spark, state, cursor=cursor, dry=dry, done=False, storing=lasts[-1] if storing is None else min(storing, lasts[-1]))
        counts = _append_pages(spark, pages, out, names) if pages else []
        for new, last in zip(counts, lasts, strict=False):
            was_new = new or storing is not None and storing <= last < cursor
            dry = 0 if was_new else dry + 1
            cursor = last if was_new else last - 1
            done = last <= oldest or bool(stop_after and dry >= stop_after)
        total += sum(counts)
        whole = len(counts) == len(pages) and not (counts and not counts[-1])
        done = done or (ended and whole)
        ahead, before = (2 * len(pages) if counts == unseen else 1, before) if whole else (1, set())
        if counts or done:
            _keep_offset(spark, state, cursor=cursor, dry=dry, done=done, **({"storing": storing} if storing is not None and storing < cursor else {}))
        if broken and whole:
            raise broken
    return total


def work_stream(spark: SparkSession, in_dir: str, schema: str, key: str, done: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], shelves: int = SHELVES) -> StreamingQuery:
    """Applies feed or link work to rows of new files whose key isn't in the table of results. Of that
    table only the shelves of the batch's keys are read."""

    def step(batch: DataFrame, _: int) -> None:
        todo = batch.dropDuplicates([key]).withColumn(SHELF, shelf_of(key, shelves)).persist()
        try:
            known = known_keys(spark, done, key, [r[0] for r in todo.select(SHELF).distinct().collect()])
            new = todo if known is None else todo.join(known, key, "left_anti")
            work(new.drop(SHELF)).withColumn(SHELF, shelf_of(key, shelves)).repartition(SHELF).write.mode("append").partitionBy(SHELF).parquet(done)
        finally:
            todo.unpersist()

    return spark.readStream.schema(schema).json(in_dir).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
