"""Joins of results with their sources: order restoration, patches, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_of(df: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """One row for each key: that of the highest order. Aggregated before the shuffle, so a key of any size is cheap."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*keys, "_v.*")


def first_of(df: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_v")).select(*keys, "_v.*")


def restore_order(source: DataFrame, done: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Every source row with the last result for its key, whole, or itself where there is none; other results are dropped."""
    d = done.groupBy(*keys).agg(F.max_by(F.struct("title", "content"), F.struct(*order)).alias("_d"))
    j = source.join(d, keys, "left")
    pick = lambda c: F.when(F.col("_d").isNotNull(), F.col(f"_d.{c}")).otherwise(F.col(c))
    return j.select(*[pick(c).alias(c) if c in ("title", "content") else c for c in source.columns], F.col("_d").isNotNull().alias("translated"))


def merge_titles(df: DataFrame, titles: DataFrame, key: Column, keys: list[str]) -> DataFrame:
    """``df`` with the title of its chapter where ``titles`` (keys, chapter_key, title) has one."""
    t = titles.select(*keys, "chapter_key", F.col("title").alias("_t"))
    return df.withColumn("chapter_key", key).join(t, [*keys, "chapter_key"], "left").withColumn("title", F.coalesce("_t", "title")).drop("_t", "chapter_key")


def patch(df: DataFrame, fixes: DataFrame, keys: list[str], order: list[str], clean=lambda c: c) -> DataFrame:
    """``df`` with title and (cleaned) content of the last fix for its key; ``patched`` says where."""
    f = fixes.groupBy(*keys).agg(F.max_by(F.struct("title", "content"), F.struct(*order)).alias("_f"))
    j = df.join(f, keys, "left").withColumn("patched", F.col("_f").isNotNull())
    return j.withColumn("title", F.when(F.col("patched"), F.col("_f.title")).otherwise(F.col("title"))).withColumn("content", F.when(F.col("patched"), clean(F.col("_f.content"))).otherwise(F.col("content"))).drop("_f")


# How a log line says that a segment failed or succeeded.
FAILED, DONE = ": THẤT BẠI", ": THÀNH CÔNG"


def failed_ids(log: DataFrame) -> DataFrame:
    """log_id, id of the lines that report a failure, but for title requests."""
    text = F.regexp_extract("line", r"^[^\]]*\] (.*?): THẤT BẠI", 1)
    return log.where(F.col("line").contains(FAILED)).select("log_id", "log_file", text.alias("id")).where("id <> '' and not startswith(id, 'Title_')")


def failed_sources(failed: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """For each failure the first segment of its key; a segment that failed twice comes twice."""
    return failed.join(first_of(segments, keys, ["row_id", "title", "content"], ["ord", "row_id"]), keys)


def difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks, each once. Null keys are equal to each other."""
    return left.select(*keys).subtract(right.select(*keys))


def coverage(truth: DataFrame, site: DataFrame, keys: list[str]) -> DataFrame:
    """keys, status (missing from the site, or extra on it) of what only one side has."""
    return difference(truth, site, keys).withColumn("status", F.lit("missing")).unionByName(difference(site, truth, keys).withColumn("status", F.lit("extra")))


def lookup(catalog: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """``wanted`` with the address of the last catalog entry of its key, null without one."""
    return wanted.join(last_of(catalog, keys, ["url"], ["cat_id"]), keys, "left")


def patch_titles(target: DataFrame, source: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``target`` with the titles of the last source row of its key; contents stay."""
    t = source.where("title is not null").groupBy(*keys).agg(F.max_by("title", F.struct(*order)).alias("_t"))
    return target.join(t, keys, "left").withColumn("title", F.coalesce("_t", "title")).drop("_t")
