"""License scans: MinHash bands retrieve templates, shingle containment verifies them. DataFrame functions only."""

from __future__ import annotations

import math
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pubweave.llm.common import let, written
from pubweave.llm.license_texts import TEMPLATES

WIDTH = 5
#: Bytes of shingles, as text, of the templates that a pass over the texts broadcasts, or of one
#: template, if that has more. A band's row takes some 30 bytes, and a template has one per band.
PASS_BYTES = 16 << 20


def template_shingles(notice: str) -> list[str]:
    words = re.findall("[a-z0-9]+", notice.lower())
    return list(dict.fromkeys(" ".join(words[i : i + WIDTH]) for i in range(len(words) - WIDTH + 1)))


def window_class(n: int) -> int:
    """The least power of two from n on: a template of n shingles is looked for in windows of
    twice as many shingles, each starting half a window after the one before. Such a
    template, over half the class, lies within some window whole."""
    return 1 << (n - 1).bit_length()


def n_bands(containment: float, miss: float = 1e-6) -> int:
    """Bands of one row, so many that a window that holds the share ``containment`` of a template
    is missed with a probability of at most ``miss``. Its resemblance r is least where the
    window of 2c shingles is largest beside the template, at c < 2n: the share x of n shingles
    in common, and n + 4n - xn in both, so r > x / (5 - x). A band differs with 1 - r."""
    return math.ceil(math.log(miss) / math.log(1 - containment / (5 - containment)))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")


def _places(words: Column) -> Column:
    return F.when(F.size(words) >= WIDTH, F.sequence(F.lit(0), F.size(words) - WIDTH)).otherwise(F.array().cast("array<int>"))


def _shingles(words: Column) -> Column:
    return F.transform(_places(words), lambda i: F.array_join(F.slice(words, i + 1, F.lit(WIDTH)), " "))


def _hashed(words: Column) -> Column:
    """struct(w, h): the words, and a hash of each shingle, made from those of its words."""
    shingles = lambda own: F.transform(_places(own), lambda i: F.xxhash64(*[F.get(own, i + k) for k in range(WIDTH)]))
    return let(words, lambda w: let(F.transform(w, lambda x: F.xxhash64(x)), lambda own: F.struct(w.alias("w"), shingles(own).alias("h"))))


def _least(hashes: Column, band: Column) -> Column:
    """The MinHash of a band."""
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, band)))


def template_table(spark: SparkSession, templates: dict[str, list[str]] | DataFrame | None = None) -> DataFrame:
    """(tid, license, words, shingles, c, n_bytes) of templates: a table (license, text), texts by license, or the built-in ones."""
    if not isinstance(templates, DataFrame):
        listed = [F.struct(F.lit(name).alias("license"), F.lit(t).alias("text")) for name, ts in (TEMPLATES if templates is None else templates).items() for t in ts]
        templates = spark.range(1).select(F.inline(F.array(*listed)))
    rows = templates.select("license", "text").distinct().select(F.xxhash64("license", "text").alias("tid"), "license", F.explode(F.array(_words(F.col("text")))).alias("words"))
    rows = rows.withColumn("shingles", F.explode(F.array(F.array_distinct(_shingles(F.col("words"))))))
    # the least power of two from the number of shingles on: see window_class
    c = F.lit(2).cast("double") ** F.ceil(F.log2(F.size("shingles").cast("double")) - 1e-9)
    n_bytes = F.aggregate("shingles", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x) + 8)
    return written(rows.select("tid", "license", "words", "shingles", c.cast("int").alias("c"), n_bytes.alias("n_bytes")), "license-templates")


def passes_of(table: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(tid, pass): templates in passes of ``pass_bytes``, to which the last one of a pass may add
    its own size, in order of their numbers. Only numbers and sizes meet in the window."""
    before = F.sum("n_bytes").over(Window.orderBy("tid").rowsBetween(Window.unboundedPreceding, -1))
    return table.select("tid", F.floor(F.coalesce(before, F.lit(0)) / pass_bytes).cast("long").alias("pass"))


def template_bands(table: DataFrame, bands: int) -> DataFrame:
    """The bands of templates by the shingle that is least in them: (shingle, tid, c, bands of (band, key))."""
    texts = table.select("tid", "c", F.explode(F.array(_hashed(F.col("words")))).alias("x"))
    least = lambda b: F.array_min(F.transform(F.col("x.h"), lambda h: F.struct(F.xxhash64(h, b).alias("key"), h.alias("shingle"))))
    every = texts.select("tid", "c", F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.struct(b.alias("band"), least(b).alias("least")))).alias("b"))
    return every.groupBy(F.col("b.least.shingle").alias("shingle"), "tid", "c").agg(F.sort_array(F.collect_list(F.struct(F.col("b.band").alias("band"), F.col("b.least.key").alias("key")))).alias("bands"))


def retrieved_windows(df: DataFrame, bands: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, tid, at, w): the windows of all texts, by first shingle and with their words, that
    have the key of some band in common with a template.

    A window can only have a template's key in a band if it holds the shingle that is least in
    the template there. So texts meet the bands by their shingles, and the windows around
    such a shingle are hashed in its bands; one that holds a lesser shingle differs.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.explode(F.array(_hashed(_words(F.col(text_col))))).alias("_x")).select("_id", "_x.w", "_x.h")
    met = rows.select("_id", "w", "h", F.posexplode("h").alias("at", "shingle")).join(F.broadcast(bands), "shingle")
    c, half = F.col("c"), F.floor(F.col("at") / F.col("c")).cast("int")
    window = lambda k: F.struct((k * c).alias("at"), F.slice("h", k * c + 1, c * 2).alias("h"), F.slice("w", k * c + 1, c * 2 + WIDTH - 1).alias("w"))
    around = F.transform(F.filter(F.array(half - 1, half), lambda k: k >= 0), window)
    alike = F.filter(around, lambda x: F.exists("bands", lambda b: _least(x["h"], b["band"]) == b["key"]))
    return met.select("_id", "tid", F.explode(alike).alias("x")).select("_id", "tid", "x.at", "x.w")


def license_notices(
    df: DataFrame, templates: dict[str, list[str]] | DataFrame | None = None, containment: float = 0.8, id_col: str = "doc_id", text_col: str = "text", pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """Rows (id, license, containment, first_word): the licences that a whole text states.

    A template counts as stated where one window holds ``containment`` or more of its
    distinct shingles of five words (runs of a-z and 0-9 after lower-casing); the best
    window's share and the place of the first such window's first word are given. Windows
    are retrieved by MinHash bands, whose number follows from ``containment`` (see
    ``n_bands``), and verified shingle by shingle. Null and short texts state nothing, long
    ones are read whole. Rows repeated under one id are taken together. An empty table gives
    no rows; further columns, whatever their names, are ignored.

    Templates may be a table (license, text) of any size, as notices and as whole licences.
    Everything up to the verified notice stays in the text's row; nothing of the texts is
    shuffled. Templates are broadcast in parts of ``pass_bytes`` by their measured size, with a
    pass over the texts for each.
    """
    table = template_table(df.sparkSession, templates)
    if not table.filter(F.size("shingles") == 0).isEmpty():
        raise ValueError(f"a template needs {WIDTH} words at least")
    dealt = written(table.join(passes_of(table, pass_bytes), "tid"), "license-passes")
    last = dealt.agg(F.max("pass")).first()[0]
    parts = []
    for k in range(0 if last is None else last + 1):
        own = dealt.filter(F.col("pass") == k)
        bands = written(template_bands(own, n_bands(containment)), "license-bands")
        found = retrieved_windows(df, bands, id_col, text_col).join(F.broadcast(own.select("tid", "license", "shingles")), "tid")
        share = F.size(F.array_intersect(_shingles(F.col("w")), F.col("shingles"))) / F.size("shingles")
        parts.append(found.select("_id", "license", share.alias("share"), F.col("at").cast("long").alias("at")).filter(F.col("share") >= containment))
    if not parts:
        return df.limit(0).select(F.col(id_col), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("first_word"))
    stated = reduce(DataFrame.union, parts)
    return stated.groupBy("_id", "license").agg(F.max("share").alias("containment"), F.min("at").alias("first_word")).withColumnRenamed("_id", id_col)


def oracle(templates: dict[str, list[str]] | None = None, containment: float = 0.8) -> str:
    """The same rows in SQL, by counting instead of retrieval."""
    rows = []
    for i, (name, notice) in enumerate((n, t) for n, ts in (templates or TEMPLATES).items() for t in ts):
        own, words = template_shingles(notice), " ".join(re.findall("[a-z0-9]+", notice.lower()))
        rows.append(f"({i}, '{name}', {window_class(len(own))}, {len(own)}, '{words}')")
    shingles = lambda w: f"array_to_string({w}[p + 1 : p + {WIDTH}], ' ')"
    return f"""
WITH v(tid, license, c, n, words) AS (VALUES {', '.join(rows)}),
u AS (SELECT tid, license, c, n, string_split(words, ' ') AS w FROM v),
t AS (SELECT DISTINCT tid, license, c, n, {shingles('w')} AS shingle FROM (SELECT *, unnest(range(len(w) - {WIDTH - 1})) AS p FROM u)),
w AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, p, {shingles('w')} AS shingle FROM (SELECT doc_id, w, unnest(range(len(w) - {WIDTH - 1})) AS p FROM w WHERE len(w) >= {WIDTH})),
h AS (SELECT doc_id, tid, license, c, n, shingle, p, unnest([p // c, p // c - 1]) AS win FROM s JOIN t USING (shingle)),
f AS (SELECT doc_id, tid, license, win * c AS starts, count(DISTINCT shingle) / CAST(n AS DOUBLE) AS share FROM h WHERE win >= 0 GROUP BY doc_id, tid, license, c, n, win)
SELECT doc_id, license, max(share) AS containment, CAST(min(starts) AS BIGINT) AS first_word FROM f WHERE share >= {containment} GROUP BY doc_id, license"""
