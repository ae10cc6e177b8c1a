"""Counters and summaries of runs, logs and crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.operators.ranks import beside, positions
from inkloom.runtime import broadcast_if


def parse_log(log: DataFrame) -> DataFrame:
    """log_id, log_file, ts, id, status (ok, failed or null), in_tokens, out_tokens, error of each line."""
    line = F.col("line")
    num = lambda p: F.nullif(F.regexp_extract(line, p, 1), F.lit("")).try_cast("bigint")
    return log.select(
        "log_id", "log_file",
        F.nullif(F.regexp_extract(line, r"^\[(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)\]", 1), F.lit("")).alias("ts"),
        F.nullif(F.regexp_extract(line, r"^\[[^\]]*\] (.*?): (?:THÀNH CÔNG|THẤT BẠI)", 1), F.lit("")).alias("id"),
        F.when(line.contains(": THÀNH CÔNG"), "ok").when(line.contains(": THẤT BẠI"), "failed").alias("status"),
        num(r"In=(\d+)").alias("in_tokens"), num(r"Out=(\d+)").alias("out_tokens"),
        F.nullif(F.regexp_extract(line, r"Lỗi: (.*)$", 1), F.lit("")).alias("error"),
    )


def token_summary(parsed: DataFrame, keys: list[str]) -> DataFrame:
    """keys, requests, content requests, sums and averages of tokens, successes and failures."""
    content = F.col("id").isNotNull() & ~F.coalesce(F.col("id").startswith("Title_"), F.lit(False))
    return parsed.groupBy(*keys).agg(
        F.count("*").alias("requests"), F.count_if(content).alias("content_requests"), F.coalesce(F.sum("in_tokens"), F.lit(0)).alias("in_tokens"), F.coalesce(F.sum("out_tokens"), F.lit(0)).alias("out_tokens"),
        F.coalesce(F.sum(F.coalesce("in_tokens", F.lit(0)) + F.coalesce("out_tokens", F.lit(0))), F.lit(0)).alias("total_tokens"),
        F.round(F.avg("in_tokens"), 4).alias("avg_in"), F.round(F.avg("out_tokens"), 4).alias("avg_out"), F.count_if(F.col("status") == "ok").alias("n_ok"), F.count_if(F.col("status") == "failed").alias("n_failed"),
    )


def crawl_summary(pages: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pages, distinct addresses, retries, successes, success rate in percent over the addresses."""
    one = pages.groupBy(*keys, "url").agg(F.count("*").alias("n"), F.max(F.coalesce("success", F.lit(False))).alias("ok"))
    return one.groupBy(*keys).agg(F.sum("n").alias("fetches"), F.count("*").alias("n_pages"), F.sum(F.col("n") - 1).alias("retries"), F.count_if("ok").alias("n_ok"), F.round(100.0 * F.count_if("ok") / F.count("*"), 4).alias("success_rate"))


def status_summary(df: DataFrame, kind: str, status: str) -> DataFrame:
    """Rows by status for each kind and, where kind is null and is_total, for all."""
    return df.rollup(kind).agg(F.grouping(kind).cast("boolean").alias("is_total"), F.count("*").alias("n_rows"), F.count_if(F.col(status) == "success").alias("n_success"), F.count_if(F.col(status) == "skip").alias("n_skip"), F.count_if(F.col(status) == "error").alias("n_error"))


def folder_tree(plan: DataFrame) -> DataFrame:
    """content_type, folder, files, operations and new operations of a plan (rel_path, content_type, needed)."""
    folder = F.regexp_extract("rel_path", r"^(.*)/[^/]*$", 1)
    return plan.groupBy("content_type", folder.alias("folder")).agg(F.countDistinct("rel_path").alias("files"), F.count("*").alias("operations"), F.count_if("needed").alias("new_operations"))


def outcome(df: DataFrame, keys: list[str], ok: str) -> DataFrame:
    """keys, successes and failures; null counts as failed."""
    good = F.coalesce(ok, F.lit(False))
    return df.groupBy(*keys).agg(F.count_if(good).alias("n_ok"), F.count_if(~good).alias("n_failed"))


def failures(df: DataFrame, keys: list[str], name: str, ok: str) -> DataFrame:
    """keys, name of each failure: rows, as a key may have any number of them."""
    return df.where(~F.coalesce(ok, F.lit(False))).select(*keys, name)


def progress(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """With done_percent: how much of its key's work is done with each row, in order."""
    total = df.groupBy(*keys).agg(F.count("*").alias("_total"))
    return beside(positions(df, keys, order, "_n"), broadcast_if(total), keys).withColumn("done_percent", F.round(100.0 * F.col("_n") / F.col("_total"), 4)).drop("_n", "_total")
