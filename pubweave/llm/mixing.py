"""Mixing sources to target weights, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubweave.llm.common import word_count, written

#: Key ranges per source. The keys are uniform, so a range holds as many rows as any other.
KEY_DIGITS = 3


def _weight(rank, weights: tuple[int, ...]):
    cases = F.lit(weights[0])
    for i, w in enumerate(weights[1:], 1):
        cases = F.when(F.pmod(rank, F.lit(len(weights))) == i, F.lit(w)).otherwise(cases)
    return cases


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """From (_mx_src, _mx_name, _mx_total), one row per source, adds target and _mx_budget.

    The sources share ``share`` times all sizes by weight; a target stops at ``cap``
    times its source's size and the excess goes to the others by weight. Sources are
    taken in the order in which they reach their caps; while the level that the ones
    before leave lies above a source's own, that source is capped too. The window has a
    row per source, never one per document.
    """
    ranked = sizes.withColumn("_mx_w", _weight(F.row_number().over(Window.orderBy(F.col("_mx_name").asc_nulls_last())) - 1, weights))
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    limit = ranked.withColumn("_mx_cap", F.col("_mx_total") * cap).withColumn("_mx_r", F.col("_mx_cap") / F.col("_mx_w"))
    before = Window.orderBy("_mx_r", F.col("_mx_name").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    limit = (
        limit.withColumn("_mx_all", F.sum("_mx_total").over(all_rows) * F.lit(share))
        .withColumn("_mx_wall", F.sum("_mx_w").over(all_rows))
        .withColumn("_mx_level", (F.col("_mx_all") - F.coalesce(F.sum("_mx_cap").over(before), F.lit(0))) / (F.col("_mx_wall") - F.coalesce(F.sum("_mx_w").over(before), F.lit(0))))
        .withColumn("_mx_full", F.col("_mx_level") > F.col("_mx_r"))
    )
    full = lambda c: F.sum(F.when(F.col("_mx_full"), F.col(c)).otherwise(0)).over(all_rows)
    open_w = F.col("_mx_wall") - full("_mx_w")
    level = F.when(open_w > 0, (F.col("_mx_all") - full("_mx_cap")) / F.nullif(open_w, F.lit(0)))
    target = F.when(F.col("_mx_full"), F.col("_mx_cap").cast("double")).otherwise(F.col("_mx_w") * level)
    return limit.withColumn("target", target).select("_mx_src", F.col("_mx_total"), "target", F.floor(F.col("target") + 0.5).alias("_mx_budget"))


def _measured(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(row, id, name, src, key, size): each row as a whole, and what the mix goes by."""
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("name"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("src"), F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("key"),
        word_count(F.coalesce(F.col(text_col), F.lit(""))).alias("size"),
    )


def _cuts(narrow: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """One row per source: total, target, epochs taken whole, and the place (key, id, size) in
    its order where the rest of its budget ends, with the number of rows that stand at this
    place (tied) and the words that are left for them (rest).

    A source's order is cut into key ranges: these are summed, and their sums added up
    along the source. Only the one range in which the budget ends is put in order row by row.
    """
    code = F.substring("key", 1, KEY_DIGITS)
    ranges = written(narrow.groupBy("src", code.alias("range")).agg(F.sum("size").alias("sum"), F.max("name").alias("name")), "mix-ranges")
    sources = ranges.groupBy(F.col("src").alias("_mx_src")).agg(F.sum("sum").alias("_mx_total"), F.max("name").alias("_mx_name"))
    targets = source_targets(sources, weights, share, cap).withColumnsRenamed({"_mx_src": "src", "_mx_total": "total", "_mx_budget": "budget"})
    targets = targets.withColumn("epochs", F.when(F.col("total") > 0, F.floor(F.col("budget") / F.nullif(F.col("total"), F.lit(0)))).otherwise(0).cast("long"))
    targets = written(targets.withColumn("left", F.col("budget") - F.col("epochs") * F.col("total")), "mix-targets")
    earlier = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).join(targets, "src")
    ends = written(offsets.filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("sum"))).select("src", "range", (F.col("left") - F.col("before")).alias("left")), "mix-ends")
    order = Window.partitionBy("src").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = narrow.withColumn("range", code).join(ends, ["src", "range"]).withColumn("inside", F.coalesce(F.sum("size").over(order), F.lit(0)))
    alike = Window.partitionBy("src", "key", "id", "size")
    inside = inside.withColumns({"tied": F.count(F.lit(1)).over(alike), "rest": F.col("left") - F.min("inside").over(alike)})
    place = inside.filter((F.col("inside") <= F.col("left")) & (F.col("left") < F.col("inside") + F.col("size")))
    place = place.select("src", F.struct("key", "id", "size").alias("place"), "rest", "tied")
    return written(targets.join(place, "src", "left").select("src", "total", "target", "epochs", "place", "rest", "tied"), "mix-cuts")


def _with_taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds total, target and taken. Each row is compared with the place where its source's
    budget ends; only rows that are tied at that place are numbered."""
    met = rows.join(cuts, "src")
    own = F.struct("key", "id", "size")
    at = F.coalesce(own == F.col("place"), F.lit(False))
    rest = lambda j: F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - j * F.col("size")))
    partial = F.when(at, rest(F.lit(0))).when(own < F.col("place"), F.col("size")).otherwise(0)
    taken = lambda part: (F.col("epochs") * F.col("size") + part).cast("long")
    if cuts.filter("tied > 1").isEmpty():
        return met.withColumn("taken", taken(partial))
    several = at & (F.col("tied") > 1)
    number = F.row_number().over(Window.partitionBy("src").orderBy("key")) - 1
    return met.filter(~F.coalesce(several, F.lit(False))).withColumn("taken", taken(partial)).union(met.filter(several).withColumn("taken", taken(rest(number))))


def mix_sizes(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2,
) -> DataFrame:
    """One row per input row: id, size, source_size, target and taken, as ``mix_sources`` has
    them, from one pass over the texts, whose sizes are written to a narrow table."""
    narrow = written(_measured(df, id_col, text_col, source_col).drop("row"), "mix-sizes")
    rows = _with_taken(narrow, _cuts(narrow, weights, share, cap))
    return rows.select(F.col("id").alias(id_col), "size", F.col("total").alias("source_size"), "target", "taken")


def mix_sources(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: int = 2,
) -> DataFrame:
    """All rows with all columns, plus size, source_size, target and taken.

    size is the number of words of the text (null: none). Rows are ordered within their
    source by the MD5 of the id, ids and sizes breaking ties; the mix takes a source's words
    in this order up to its exact budget, from the start again when the source ends, so
    ``taken`` counts repeats. Rows equal in id and size may stand in either order.

    Sizes are written to a narrow table, in which each source's budget is followed to the row
    where it ends; texts meet only that place, so they are read twice and not shuffled, and
    a source with a third of all rows is no heavier than others. Null is a source of its
    own, last in order. Columns of the input named like an added one are replaced, others may
    have any name. An empty table gives no rows; a null id sorts as an empty string. Rows of one
    id have one key, so they lie in one range and are put in order by one task.
    """
    narrow = written(_measured(df, id_col, text_col, source_col).drop("row"), "mix-sizes")
    rows = _with_taken(_measured(df, id_col, text_col, source_col), _cuts(narrow, weights, share, cap))
    new = {"size": F.col("size"), "source_size": F.col("total"), "target": F.col("target"), "taken": F.col("taken")}
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in df.columns if c not in new], *[v.alias(c) for c, v in new.items()])


def mixed_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", n_chars_col: str = "n_chars", **options) -> DataFrame:
    """The mix itself, in the columns of the input: a row for every time a text is taken.

    The text that a budget ends in is cut after its last word taken. Texts without words, null
    ones among them, have nothing to take and are in no mix; repeated rows are taken like
    others, in an order of their own; an empty table gives no rows.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (text_col, n_chars_col)]  # the text goes beside them, once
    row = (F.struct(*kept) if kept else F.lit(None)).alias("row")
    mixed = mix_sources(df.select(row, F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(source_col).alias("source")), "id", "text", "source", **options)
    times = F.floor(F.col("taken") / F.nullif(F.col("size"), F.lit(0))).cast("int")
    rest = F.col("taken") - times * F.col("size")
    lengths = F.filter(F.concat(F.array_repeat(F.col("size"), F.coalesce(times, F.lit(0))), F.array(rest)), lambda n: n > 0)
    rows = mixed.select("row", "text", "size", F.explode(lengths).alias("words"))
    lead = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    cut = F.when(F.col("words") == F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(lead, F.lit(1), F.col("words").cast("int")), ""))
    rows = rows.select("row", cut.alias("text"))
    own = {text_col: F.col("text"), n_chars_col: F.length("text").cast("long")}
    return rows.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in df.columns])
