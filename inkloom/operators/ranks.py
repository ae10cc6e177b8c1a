"""Positions and neighbours in the order of a key, whatever the key's share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkloom.runtime import materialize

MOST = 1_000_000  # rows of a key up to which one task sorts it


def _named(order: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def beside(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined with ``right`` on ``keys``, of which nulls are equal to each other."""
    named = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    out = left.join(named, same, how)
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"_r_{k}" for k in keys])


def hot(df: DataFrame, keys: list[str], most: int) -> bool:
    """Whether a key has more than ``most`` rows: one pre-aggregated count."""
    return not df.groupBy(*keys).count().where(F.col("count") > most).isEmpty()


def positions(df: DataFrame, keys: list[str], order: list[str | Column], out: str = "position", most: int = MOST) -> DataFrame:
    """``df`` with ``out``: each row's number, from 1, in the order of its key. Nulls come first unless the order says otherwise.

    Give slim rows, and join the rest to them. With a key above ``most`` rows
    all rows are cut into ranges of (keys, order) first: a range is numbered in
    one task, then the counts of the ranges before it are added. The rows are
    written once, since ranges are sampled and must not change between two uses.
    """
    if not hot(df, keys, most):
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*_named(order))))
    parts = max(16, 4 * df.sparkSession.sparkContext.defaultParallelism)
    cut = materialize(df.repartitionByRange(parts, *keys, *_named(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = cut.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # at most ``parts`` rows a key
    local = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*_named(order)))
    base = sizes.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"), before.alias("_before"))
    same = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return cut.withColumn("_local", local).join(base, same).withColumn(out, (F.col("_local") + F.col("_before")).cast("int")).select(*df.columns, out)


def previous(df: DataFrame, keys: list[str], order: list[str | Column], value: str, out: str, most: int = MOST) -> DataFrame:
    """``df`` with ``out``: ``value`` of the row before, in the order of the key; null for the first row."""
    if not hot(df, keys, most):
        return df.withColumn(out, F.lag(value).over(Window.partitionBy(*keys).orderBy(*_named(order))))
    at = materialize(positions(df, keys, order, "_at", most), "positions")
    before = at.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.col("_at") + 1).alias("_next"), F.col(value).alias(out))
    same = F.col("_at") == F.col("_next")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return at.join(before, same, "left").select(*df.columns, out)
