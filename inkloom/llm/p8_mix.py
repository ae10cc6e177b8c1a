"""Mixing sources to target shares by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.scans import running, unit_hash


def mix(sizes: DataFrame, targets: DataFrame, budget: int | None = None, seed: int = 11, rows_each: int = 50_000) -> DataFrame:
    """The selection from ``sizes`` (doc_id, source, n_tokens) whose shares meet ``targets``.

    Columns: source, doc_id, copy_no, n_tokens, finish. Each source sends its
    documents in shuffled order, the whole source once before any is repeated,
    up to ``max_repeat`` times. The virtual finish time of a document is its
    source's tokens up to and including it, divided by the target share; the
    documents with the lowest finish times are taken, up to the total budget.
    Up to finish time t each source sends share * t tokens, so the default
    budget is the largest t at which no source has run out: the smallest
    (tokens * max_repeat / share).

    Sources without a target, with a share or repeat below 1, null sources and
    documents of 0 tokens are not used. The order is by range of the shuffled
    hash, never one task for a source.
    """
    goal = (
        targets.where("source is not null and target_share > 0 and max_repeat >= 1")
        .groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeat").alias("times"))
    )
    docs = sizes.where("n_tokens > 0").select("doc_id", "source", F.col("n_tokens").cast("long").alias("n_tokens"))
    held = docs.groupBy("source").agg(F.sum("n_tokens").alias("held"))
    by_source = goal.join(held, "source").collect()  # one row for each source with a target
    if not by_source:
        return sizes.sparkSession.createDataFrame([], "source string, doc_id long, copy_no int, n_tokens long, finish double")
    buckets = max(16, sizes.count() // rows_each)
    whole = sum(r.share for r in by_source)
    reach = min(r.held * r.times * whole / r.share for r in by_source)
    end = float(min(budget, reach) if budget is not None else reach)
    rates = sizes.sparkSession.createDataFrame([(r.source, r.share / whole, int(r.times), int(r.held)) for r in by_source], "source string, share double, times int, held long")
    sent = running(docs.join(F.broadcast(rates), "source").withColumn("u", unit_hash("doc_id", F.lit(seed))), ["source"], "u", "n_tokens", "before", buckets)
    copies = sent.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.least(F.col("times"), (F.floor(F.lit(end) * F.col("share") / F.col("held")) + 1).cast("int")))))
    finish = ((F.col("copy_no") - 1) * F.col("held") + F.col("before") + F.col("n_tokens")) / F.col("share")
    return copies.withColumn("finish", finish).where(F.col("finish") <= end * (1 + 1e-12)).select("source", "doc_id", "copy_no", "n_tokens", "finish")


def in_order(mixed: DataFrame) -> DataFrame:
    """The selection range-sorted by finish time, as it would be written for training."""
    return mixed.orderBy("finish", "source", "doc_id", "copy_no")


def share_report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source with a target: documents, copies, tokens, share reached and target."""
    per = mixed.groupBy("source").agg(F.count("*").alias("copies"), F.countDistinct("doc_id").alias("docs"), F.max("copy_no").alias("most_copies"), F.sum("n_tokens").alias("tokens"))
    total = per.agg(F.sum("tokens").alias("total"))
    return (
        targets.select("source", "target_share", "max_repeat").join(per, "source", "left").crossJoin(total)
        .select("source", "target_share", "max_repeat", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("copies", "docs", "most_copies", "tokens")], F.round(F.coalesce(F.col("tokens") / F.col("total"), F.lit(0.0)), 6).alias("share"))
    )
