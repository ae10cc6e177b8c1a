"""Incremental processing: history of files, what still needs work, checkpoints of crawls."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hashed(files: DataFrame, content: str) -> DataFrame:
    """With file_hash, the MD5 of the content; null stays null."""
    return files.withColumn("file_hash", F.md5(F.col(content).cast("binary")))


def plan(files: DataFrame, modes: DataFrame, history: DataFrame, outputs: DataFrame, force: bool = False) -> DataFrame:
    """rel_path, mode, needed, reason for each file (rel_path, file_hash) and mode.

    In this order: forced, no output, never seen, mode not done, changed, else
    up to date. history: rel_path, mode, file_hash; outputs: rel_path, mode.
    """
    every = files.select("rel_path", "file_hash").crossJoin(F.broadcast(modes.select("mode").distinct()))  # a few modes
    seen = history.groupBy("rel_path").agg(F.max_by("file_hash", F.col("processed_date")).alias("old_hash"), F.collect_set("mode").alias("done"))
    made = outputs.select("rel_path", "mode").distinct().withColumn("made", F.lit(True))
    j = every.join(seen, "rel_path", "left").join(made, ["rel_path", "mode"], "left")
    reason = (
        F.when(F.lit(force), "forced").when(F.col("made").isNull(), "no output").when(F.col("done").isNull(), "untracked")
        .when(~F.array_contains("done", F.col("mode")), "mode missing").when(~F.col("old_hash").eqNullSafe(F.col("file_hash")), "changed").otherwise("up to date")
    )
    return j.select("rel_path", "mode", (reason != "up to date").alias("needed"), reason.alias("reason"))


def missing_operations(planned: DataFrame) -> DataFrame:
    return planned.where("needed").select("rel_path", "mode", "reason")


def updated_history(history: DataFrame, done: DataFrame) -> DataFrame:
    """The history with the latest row for each file and mode."""
    cols = ["rel_path", "mode", "file_hash", "processed_date", "output_file"]
    both = history.select(*cols).unionByName(done.select(*cols))
    return both.groupBy("rel_path", "mode").agg(F.max_by(F.struct(*cols[2:]), F.struct("processed_date", "output_file")).alias("v")).select("rel_path", "mode", "v.*")


def save_checkpoint(checkpoints: DataFrame, new: DataFrame) -> DataFrame:
    """Checkpoints with those of ``new`` in place of older ones of the same series."""
    return new.unionByName(checkpoints.join(new.select("series_name"), "series_name", "left_anti"))


def load_checkpoint(checkpoints: DataFrame, series: str) -> DataFrame:
    """The checkpoint of a series: one row or none."""
    return checkpoints.where(F.col("series_name") == series)


def has_checkpoint(checkpoints: DataFrame, series: DataFrame) -> DataFrame:
    """series_name, found for each row of ``series``."""
    have = checkpoints.select("series_name").distinct().withColumn("found", F.lit(True))
    return series.join(have, "series_name", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def resumed(done: DataFrame, new: DataFrame, start: int) -> DataFrame:
    """What is there after a run: the new rows after those already done if it began above 1, else the new rows alone."""
    return done.unionByName(new) if start > 1 else new


def write_resumed(new: DataFrame, path: str, start: int) -> None:
    """Writes a run's rows: appended if it began above 1, else in place of what is there."""
    new.write.mode("append" if start > 1 else "overwrite").parquet(path)


def delete_checkpoint(checkpoints: DataFrame, series: str) -> DataFrame:
    return checkpoints.where(F.col("series_name") != series)
