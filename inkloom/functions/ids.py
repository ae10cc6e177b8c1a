"""Readers of segment ids. They disagree on ids without a volume on purpose; never share one for another."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _int(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("int")


def chapter_of(c: Column) -> Column:
    """(volume, chapter) for filters: no volume is volume 1, no chapter gives (1, 0)."""
    chapter = _int(c, r"(?:Volume_(\d+)_)?Chapter_(\d+)", 2)
    volume = _int(c, r"(?:Volume_(\d+)_)?Chapter_(\d+)", 1)
    return F.struct(F.when(chapter.isNotNull(), F.coalesce(volume, F.lit(1))).otherwise(1).alias("volume"), F.coalesce(chapter, F.lit(0)).alias("chapter"))


def segment_of(c: Column) -> Column:
    """The segment's number, 0 without one."""
    return F.coalesce(_int(c, r"Segment_(\d+)", 1), F.lit(0))


def chapter_key(c: Column) -> Column:
    """The part that names the chapter, null without one."""
    return F.nullif(F.regexp_extract(c, r"((?:Volume_\d+_)?Chapter_\d+)", 1), F.lit(""))


def anchored_chapter(c: Column) -> Column:
    """The chapter of ids that begin with it and have a segment; ids with a volume give null."""
    return _int(c, r"^Chapter_(\d+)_Segment_\d+", 1)


def volume_blind_chapter(c: Column) -> Column:
    """The chapter, whatever the volume; null without one."""
    return _int(c, r"Chapter_(\d+)", 1)


def parts_of(c: Column) -> Column:
    """(volume, chapter, segment) in any case of letters, null where absent: most specific form first."""
    vcs, vc, cs, ch = r"(?i)Volume_(\d+)_Chapter_(\d+)_Segment_(\d+)", r"(?i)Volume_(\d+)_Chapter_(\d+)", r"(?i)Chapter_(\d+)_Segment_(\d+)", r"(?i)Chapter_(\d+)"
    volume = F.coalesce(_int(c, vcs, 1), _int(c, vc, 1))
    chapter = F.coalesce(_int(c, vcs, 2), _int(c, vc, 2), _int(c, cs, 1), _int(c, ch, 1))
    segment = F.when(c.rlike(vcs), _int(c, vcs, 3)).when(c.rlike(vc), F.lit(None).cast("int")).otherwise(_int(c, cs, 2))
    return F.struct(volume.alias("volume"), chapter.alias("chapter"), segment.alias("segment"))


def upload_key(c: Column) -> Column:
    """The chapter key of ids that have a segment, found anywhere in the id; null without one."""
    return F.nullif(F.regexp_extract(c, r"(Chapter_\d+)_Segment_\d+", 1), F.lit(""))


def digits_key(c: Column) -> Column:
    """Sort key by the first two runs of digits: none gives (0, 0), one (0, n)."""
    d = F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1))
    at = lambda i: F.try_element_at(d, F.lit(i)).try_cast("int")
    return F.struct(F.when(F.size(d) >= 2, at(1)).otherwise(0).alias("major"), F.when(F.size(d) >= 2, at(2)).when(F.size(d) == 1, at(1)).otherwise(0).alias("minor"))
