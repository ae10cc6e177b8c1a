"""Range filters over segment ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.functions import ids
from inkloom.operators.ranks import positions


def chapter_range(df: DataFrame, enabled: bool = True, volumes: tuple[int, int] = (1, 999), chapters: tuple[int, int] = (1, 999)) -> DataFrame:
    """Rows whose volume and chapter are each inside their bounds, which don't depend on each other."""
    if not enabled:
        return df
    c = ids.chapter_of(F.col("id"))
    return df.where(c["volume"].between(*volumes) & c["chapter"].between(*chapters))


def segment_range(df: DataFrame, enabled: bool = True, segments: tuple[int, int] = (1, 999)) -> DataFrame:
    return df.where(ids.segment_of(F.col("id")).between(*segments)) if enabled else df


def segments_filter(df: DataFrame, config: dict) -> DataFrame:
    """The filter that a configuration names: ``chapter`` (the default), ``segment``, or none."""
    mode = config.get("filter_mode", "chapter")
    part = config.get(f"{mode}_filter", {})
    if mode == "segment":
        return segment_range(df, part.get("enabled", False), (part.get("start_segment", 1), part.get("end_segment", 999)))
    if mode == "chapter":
        return chapter_range(df, part.get("enabled", False), (part.get("start_volume", 1), part.get("end_volume", 999)), (part.get("start_chapter", 1), part.get("end_chapter", 999)))
    return df


def bounds(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, first and last chapter of the ids that begin with one."""
    return df.withColumn("_c", ids.anchored_chapter(F.col("id"))).where("_c is not null").groupBy(*keys).agg(F.min("_c").alias("first_chapter"), F.max("_c").alias("last_chapter"))


def checked_range(df: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of chapters ``first`` to ``last``. Fails when these lie outside the chapters there are."""
    have = bounds(df, []).first()
    if have is None or have.first_chapter is None or first < have.first_chapter or last > have.last_chapter or first > last:
        raise ValueError(f"chapters {first} to {last} are outside those of the table")
    return df.where(ids.anchored_chapter(F.col("id")).between(first, last))


def catalog_slice(df: DataFrame, keys: list[str], order: list[str], start: int = 1, end: int | None = None) -> DataFrame:
    """The catalog entries at positions ``start`` to ``end`` (a position, not a count)."""
    n = positions(df, keys, order)
    return n.where((F.col("position") >= start) & (F.lit(True) if end is None else F.col("position") <= end))


def enabled(df: DataFrame, flag: str = "enabled") -> DataFrame:
    """Rows whose flag is true or null."""
    return df.where(F.coalesce(flag, F.lit(True)))
