"""Batch names for partitioned output."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkloom.functions import ids


def by_volume(df: DataFrame) -> DataFrame:
    """With batch_name ``Vol{v}`` and batch_no v; no volume is volume 1."""
    v = ids.chapter_of(F.col("id"))["volume"]
    return df.withColumn("batch_no", v).withColumn("batch_name", F.concat(F.lit("Vol"), v))


def by_aligned_range(df: DataFrame, size: int = 100) -> DataFrame:
    """With batch_name ``Ch001-100`` and so on, aligned at chapter 1, volumes aside. Chapter 0 falls before."""
    k = F.floor((ids.chapter_of(F.col("id"))["chapter"] - 1) / size).cast("int")
    return df.withColumn("batch_no", k).withColumn("batch_name", F.format_string("Ch%03d-%03d", k * size + 1, (k + 1) * size))


def by_range_from_first(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """With batch_name ``{first}_{last}.yaml``: ranges begin at the first chapter of the key and end at the last."""
    c = df.withColumn("_c", ids.anchored_chapter(F.col("id"))).where("_c is not null")
    # the bounds by an aggregate and a join: a window over the key would sort nothing but hold the whole key in one task
    b = c.groupBy(*keys).agg(F.min("_c").alias("_lo"), F.max("_c").alias("_hi"))
    k = F.floor((F.col("_c") - F.col("_lo")) / size).cast("int")
    out = c.join(b, keys).withColumn("batch_no", k)
    start = F.col("_lo") + F.col("batch_no") * size
    return out.withColumn("batch_name", F.concat(start, F.lit("_"), F.least(start + size - 1, F.col("_hi")), F.lit(".yaml"))).drop("_c", "_lo", "_hi")


def write_batches(df: DataFrame, folder: str) -> DataFrame:
    """Writes the rows in a folder for each batch_name and reads them back."""
    df.write.partitionBy("batch_name").mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def batch_totals(df: DataFrame, ok: str = "ok") -> DataFrame:
    """batch_name, n_rows, n_ok, n_failed, and the running total of rows in batch order."""
    g = df.groupBy("batch_no", "batch_name").agg(F.count("*").alias("n_rows"), F.count_if(F.coalesce(ok, F.lit(False))).alias("n_ok")).withColumn("n_failed", F.col("n_rows") - F.col("n_ok"))
    return g.withColumn("rows_so_far", F.sum("n_rows").over(Window.orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0)))  # one row for each batch
