"""Dense numbers over a global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubweave.operators.storage import checkpointed


def number_rows(df: DataFrame, bucket: Column, *order: Column | str, name: str = "n") -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... over (bucket, order). Rows are numbered inside their bucket
    and shifted by the rows of the buckets before it; only the buckets' counts meet in a
    window. Buckets must follow the order, and be many where rows are many.
    """
    cols = df.columns
    rows = df.withColumn("_nr_b", bucket)
    counts = rows.groupBy("_nr_b").agg(F.count(F.lit(1)).alias("_nr_c"))
    before = counts.select(F.col("_nr_b").alias("_nr_k"), F.coalesce(F.sum("_nr_c").over(Window.orderBy(F.col("_nr_b").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_nr_o"))
    inside = F.row_number().over(Window.partitionBy("_nr_b").orderBy(*order)) - 1
    return rows.withColumn("_nr_i", inside).join(before, F.col("_nr_b").eqNullSafe(F.col("_nr_k"))).select(*cols, (F.col("_nr_i") + F.col("_nr_o")).cast("long").alias(name))


def number_sorted(df: DataFrame, *order: Column | str, name: str = "n") -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... over the order. Rows are dealt into ranges that follow the
    data (sampled by Spark), so a common prefix or value is no heavier than others as long
    as the whole order tells its rows apart; each range is numbered on its own."""
    ranged = checkpointed(df.repartitionByRange(*order).withColumn("_nr_range", F.spark_partition_id()))
    return number_rows(ranged, F.col("_nr_range"), *order, name=name).drop("_nr_range")
