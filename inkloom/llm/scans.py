"""Running sums over keys of any size, without putting a key into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, group: list[str], order: str, value: str, out: str, buckets: int) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` before each row, by ``order`` within ``group``.

    ``order`` is a double in [0, 1) that spreads evenly, such as a hash. It is
    cut into ``buckets`` ranges: their sums are prefix-summed (a table of
    groups x buckets rows), and only a range is sorted in one task. Ties of
    ``order`` are broken by the row's other columns.
    """
    cut = df.withColumn("_b", F.least(F.floor(F.col(order) * buckets), F.lit(buckets - 1)).cast("int"))
    sums = cut.groupBy(*group, "_b").agg(F.sum(value).alias("_s"))
    w = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*group, "_b", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_base"))
    ties = [c for c in df.columns if c not in (*group, order) and df.schema[c].dataType.typeName() != "map"]
    inner = Window.partitionBy(*group, "_b").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(base, [*group, "_b"])
        .withColumn(out, F.col("_base") + F.col("_in"))
        .drop("_b", "_base", "_in")
    )


def unit_hash(*columns):
    """Column: an even double in [0, 1) from a 64-bit hash of the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 52)).cast("double") / float(1 << 52)
