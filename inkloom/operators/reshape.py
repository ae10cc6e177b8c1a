"""Grouping, merging and re-keying of segments."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions import ids
from inkloom.functions.text import WS, strip_u
from inkloom.operators.ranks import beside, positions, previous
from inkloom.runtime import broadcast_if, materialize


def joined(value: str, order: list[str], sep: str) -> Column:
    """Aggregate: the non-null values in order, joined. A hot group is first collected in parts by the map side."""
    items = F.array_sort(F.collect_list(F.when(F.col(value).isNotNull(), F.struct(*order, F.col(value).alias("_v")))))
    return F.array_join(F.transform(items, lambda x: x["_v"]), sep)


def merge_chapters(segments: DataFrame, keys: list[str]) -> DataFrame:
    """keys, chapter, id, title, content, n_segments: the segments of a chapter in input order.

    Ids with a volume or without a segment are left out. The first segment's
    title counts, ``Chapter n`` where it is null.
    """
    s = segments.withColumn("chapter", ids.anchored_chapter(F.col("id"))).where("chapter is not null")
    return s.groupBy(*keys, "chapter").agg(F.count("*").alias("n_segments"), F.min_by("title", F.struct("ord", "row_id")).alias("_t"), joined("content", ["ord", "row_id"], "\n\n").alias("content")).select(
        *keys, "chapter", F.concat(F.lit("Chapter_"), F.col("chapter")).alias("id"), F.coalesce("_t", F.concat(F.lit("Chapter "), F.col("chapter"))).alias("title"), "content", "n_segments"
    )


def chapter_nested(segments: DataFrame, keys: list[str]) -> DataFrame:
    """keys, chapter_number, chapter_title, total_segments, segments (id, title, content in input order), volumes aside."""
    s = segments.withColumn("chapter_number", ids.volume_blind_chapter(F.col("id"))).where("chapter_number is not null")
    nested = F.transform(F.array_sort(F.collect_list(F.struct("ord", "row_id", "id", "title", "content"))), lambda x: F.struct(x["id"].alias("id"), x["title"].alias("title"), x["content"].alias("content")))
    return s.groupBy(*keys, "chapter_number").agg(F.min_by("title", F.struct("ord", "row_id")).alias("chapter_title"), F.count("*").alias("total_segments"), nested.alias("segments"))


def chapter_index(nested: DataFrame, keys: list[str]) -> DataFrame:
    """keys, total_chapters, total_segments, chapters (number, file name, count, title in order)."""
    one = F.struct("chapter_number", F.format_string("chapter_%03d.json", "chapter_number").alias("filename"), F.col("total_segments").alias("segments_count"), F.col("chapter_title").alias("title"))
    return nested.groupBy(*keys).agg(F.count("*").alias("total_chapters"), F.sum("total_segments").alias("total_segments"), F.array_sort(F.collect_list(one)).alias("chapters"))


def book_chapters(segments: DataFrame, keys: list[str]) -> DataFrame:
    """keys, chapter_key, title, content, position: chapters with text in the order of a book, those without a volume first.

    Positions are counted over the chapters' keys alone; contents move once, to their chapter.
    """
    s = segments.withColumn("chapter_key", ids.chapter_key(F.col("id"))).where("chapter_key is not null")
    s = s.withColumn("content", F.when(strip_u(F.col("content")) != "", F.col("content")))
    g = s.groupBy(*keys, "chapter_key").agg(F.min_by("title", F.struct("ord", "row_id")).alias("title"), joined("content", ["ord", "row_id"], "\n\n").alias("content")).where(strip_u(F.col("content")) != "")
    k = ids.digits_key(F.col("chapter_key"))
    have = positions(s.where("content is not null").select(*keys, "chapter_key").distinct(), keys, [k["major"], k["minor"], "chapter_key"])
    return beside(g, have, [*keys, "chapter_key"])


def text_chapters(segments: DataFrame, keys: list[str]) -> DataFrame:
    """keys, volume, chapter, header, text, position: chapters as text files, those without a volume last.

    Segments in order of their number (none counts as 0), then input order;
    each content ends in a blank line. Positions are counted over the chapters'
    keys alone; contents move once, to their chapter.
    """
    p = ids.parts_of(F.col("id"))
    s = segments.select("*", p["volume"].alias("volume"), p["chapter"].alias("chapter"), F.coalesce(p["segment"], F.lit(0)).alias("_g")).where("chapter is not null")
    s = s.withColumn("_v", F.coalesce("volume", F.lit(-1)))  # volumes aren't negative
    g = s.groupBy(*keys, "_v", "chapter").agg(F.min_by("title", F.struct("ord", "row_id")).alias("title"), joined("content", ["_g", "ord", "row_id"], "\n\n").alias("text"))
    at = positions(s.select(*keys, "_v", "chapter").distinct(), keys, [F.nullif("_v", F.lit(-1)).asc_nulls_last(), "chapter"])
    volume = F.nullif("_v", F.lit(-1))
    head = F.concat(F.when(volume.isNotNull(), F.concat(F.lit("Quyển "), volume, F.lit(" - "))).otherwise(""), F.lit("Chương "), F.col("chapter"), F.lit(": "), F.coalesce("title", F.lit("")))
    return beside(g, at, [*keys, "_v", "chapter"]).select(*keys, volume.alias("volume"), "chapter", head.alias("header"), "text", "position")


def upload_plan(segments: DataFrame, keys: list[str], prefix: str, first: int = 0) -> DataFrame:
    """keys, chapter_key, chapter, title, content: the chapters of one volume (``Volume_n``), the first ``first`` if above 0."""
    s = segments.withColumn("chapter_key", F.nullif(F.regexp_extract("id", f"({re.escape(prefix)}_Chapter_\\d+)_", 1), F.lit(""))).where("chapter_key is not null")
    s = s.withColumn("chapter", F.regexp_extract("chapter_key", r"Chapter_(\d+)", 1).try_cast("int")).withColumn("_g", ids.segment_of(F.col("id")))
    if first > 0:
        some = positions(s.select(*keys, "chapter").distinct(), keys, ["chapter"], "_r").where(F.col("_r") <= first).drop("_r")
        s = beside(s, broadcast_if(some), [*keys, "chapter"], "left_semi")
    return s.groupBy(*keys, "chapter_key", "chapter").agg(F.min_by("title", F.struct("_g", "ord", "row_id")).alias("title"), joined("content", ["_g", "ord", "row_id"], "\n\n").alias("content"))


def together(*lists: DataFrame) -> DataFrame:
    """The rows of all lists, columns by their names."""
    out = lists[0]
    for other in lists[1:]:
        out = out.unionByName(other)
    return out


def upload_files(segments: DataFrame, keys: list[str]) -> DataFrame:
    """As upload_plan, for every chapter by its key anywhere in the id, volumes aside."""
    s = segments.withColumn("chapter_key", ids.upload_key(F.col("id"))).where("chapter_key is not null").withColumn("_g", ids.segment_of(F.col("id")))
    s = s.withColumn("chapter", ids.volume_blind_chapter(F.col("chapter_key")))
    return s.groupBy(*keys, "chapter_key", "chapter").agg(F.min_by("title", F.struct("_g", "ord", "row_id")).alias("title"), joined("content", ["_g", "ord", "row_id"], "\n\n").alias("content"))


def with_segment_ids(segments: DataFrame) -> DataFrame:
    """Rows whose id is only ``Chapter_n`` get ``_Segment_n`` and a blank line between their lines; others pass."""
    only = F.col("id").rlike(r"^Chapter_\d+$")
    return segments.withColumn("content", F.when(only, F.array_join(F.split(strip_u(F.col("content")), "\n"), "\n\n")).otherwise(F.col("content"))).withColumn("id", F.when(only, F.concat("id", F.lit("_Segment_"), F.regexp_extract("id", r"(\d+)", 1))).otherwise(F.col("id")))


def unique_chapters(segments: DataFrame, keys: list[str]) -> DataFrame:
    """keys, chapter_key, title: the first title of each chapter that isn't blank, in input order."""
    s = segments.withColumn("chapter_key", ids.chapter_key(F.col("id"))).where(F.col("chapter_key").isNotNull() & (strip_u(F.coalesce("title", F.lit(""))) != ""))
    return s.groupBy(*keys, "chapter_key").agg(F.min_by("title", F.struct("ord", "row_id")).alias("title"))


def _lines(c: Column) -> Column:
    return F.split(F.coalesce(c, F.lit("")), "\n")


def _filled(line: Column) -> Column:
    return F.length(F.regexp_replace(line, f"[{WS}]+", "")) > 0


def title_of_content(c: Column) -> Column:
    """The first line that isn't blank, without an apostrophe in front; null without one."""
    first = F.try_element_at(F.filter(_lines(c), _filled), F.lit(1))
    return F.nullif(strip_u(F.regexp_replace(strip_u(first), "^'", "")), F.lit(""))


def retitled(segments: DataFrame, remove: bool = False) -> DataFrame:
    """Titles from the first line of the content where it has one; with ``remove`` that line and the blank ones after it go."""
    found = title_of_content(F.col("content"))
    out = segments.withColumn("_new", found)
    if remove:
        at = F.array_position(F.transform(_lines(F.col("content")), _filled), True)
        rest = F.array_join(F.slice(_lines(F.col("content")), (at + 1).cast("int"), F.greatest(F.size(_lines(F.col("content"))) - at, F.lit(0)).cast("int")), "\n")
        rest = F.regexp_replace(rest, f"^(?:[{WS}]*\n)+", "")
        out = out.withColumn("content", F.when(F.col("_new").isNotNull(), rest).otherwise(F.col("content")))
    return out.withColumn("title", F.coalesce("_new", "title")).drop("_new")


def numbered_catalog(df: DataFrame, key: str, order: str, per_volume: int = 100) -> DataFrame:
    """The rows of a catalog with id (from 1 in each key) and volume (``per_volume`` chapters each)."""
    return positions(df, [key], [order], "id").withColumn("volume", (F.floor((F.col("id") - 1) / per_volume) + 1).cast("int"))


def volume_totals(numbered: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_volumes (distinct), n_chapters, first and last volume of a numbered catalog."""
    per = numbered.groupBy(*keys, "volume").agg(F.count("*").alias("n"))
    return per.groupBy(*keys).agg(F.count("*").alias("n_volumes"), F.sum("n").alias("n_chapters"), F.min("volume").alias("first_volume"), F.max("volume").alias("last_volume"))


def merge_pages(catalog: DataFrame, pages: DataFrame) -> DataFrame:
    """book, chapter_num, title, volume, content of chapters spread over several addresses.

    Title and volume are those of the first address alone; later pages add
    ``title`` and content. Pages that failed are skipped, chapters without any
    content left out. Of repeated catalog entries and pages the last counts.
    """
    cat = catalog.groupBy("book", "chapter_num").agg(F.max_by(F.struct("urls", "url"), F.col("cat_id")).alias("c"))
    links = cat.select("book", "chapter_num", F.posexplode(F.coalesce("c.urls", F.array("c.url"))).alias("at", "url"))
    got = pages.where("success and content is not null and content <> ''").groupBy("url").agg(F.max_by(F.struct("title", "volume", "content"), F.col("page_id")).alias("p"))
    both = links.join(got, "url").select("book", "chapter_num", "at", "p.title", "p.volume", "p.content")
    text = F.when((F.col("at") > 0) & (F.coalesce("title", F.lit("")) != ""), F.concat("title", F.lit("\n\n"), "content")).otherwise(F.col("content"))
    both = both.withColumn("text", text)
    return both.groupBy("book", "chapter_num").agg(
        F.coalesce(F.max(F.when(F.col("at") == 0, F.col("title"))), F.lit("")).alias("title"), F.coalesce(F.max(F.when(F.col("at") == 0, F.col("volume"))), F.lit("")).alias("volume"), F.count("*").alias("n_pages"), joined("text", ["at"], "\n\n").alias("content")
    )


def volume_changes(pages: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows at which a volume that isn't blank differs from the last one that wasn't."""
    filled = pages.where(strip_u(F.coalesce("volume", F.lit(""))) != "")
    return previous(filled, [key], order, "volume", "_last").where(~F.col("volume").eqNullSafe(F.col("_last"))).drop("_last")


def chain(pages: DataFrame, start: str, most: int | None = None, key: str = "url", link: str = "next_url") -> DataFrame:
    """step, key of the pages reached from ``start`` by following links, until none, a failed page, a repeated one, or ``most``.

    Links are composed with themselves: after k joins each page knows the page
    2^k links on, and all pages up to 2^k steps are numbered, so a chain of n
    pages takes log2(n) joins of the links (addresses alone), however long it is.
    """
    one = pages.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(link, F.struct(F.coalesce("success", F.lit(False)), F.col("page_id"))).alias("to"), F.max(F.coalesce("success", F.lit(False))).alias("ok")).where("ok")
    good = materialize(one.select(F.col(key).alias("at"), "to"), "links")
    # a link to a page that isn't there, or failed, ends the chain
    hop = materialize(good.join(good.select(F.col("at").alias("to")), "to", "left_semi").select("at", "to"), "hops")
    found = materialize(good.where(F.col("at") == start).select(F.lit(1).cast("long").alias("step"), "at"), "walk")
    reach, known = 1, found.count()
    while known and (most is None or reach < most):
        ahead = found.join(hop, "at").select((F.col("step") + reach).alias("step"), F.col("to").alias("at"))
        # on a circle a page comes again: its first step counts
        both = materialize(found.unionByName(ahead).groupBy("at").agg(F.min("step").alias("step")).select("step", "at"), "walk")
        now = both.count()
        if now == known:
            break
        found, known, reach = both, now, 2 * reach
        hop = materialize(hop.join(hop.select(F.col("at").alias("to"), F.col("to").alias("_to")), "to").select("at", F.col("_to").alias("to")), "hops")
    out = found if most is None else found.where(F.col("step") <= most)
    return out.select(F.col("step").cast("int").alias("step"), F.col("at").alias(key))


def split_languages(paragraphs: DataFrame, keys: list[str], items: str) -> DataFrame:
    """keys, lang, title, lines of interleaved paragraphs (text, style): two rows for each, by the style.

    The first two paragraphs are titles, the last of a language counts;
    fewer than two give no row.
    """
    from inkloom.operators.classify import language_of_style

    tagged = paragraphs.where(F.size(items) >= 2).withColumn("_p", F.transform(F.col(items), lambda p: F.struct(p["text"].alias("text"), language_of_style(p["style"]).alias("lang"))))
    both = tagged.withColumn("lang", F.explode(F.array(F.lit("JP"), F.lit("ZH"))))
    own = lambda c: F.transform(F.filter(c, lambda p: p["lang"] == F.col("lang")), lambda p: p["text"])
    return both.select(*keys, "lang", F.try_element_at(own(F.slice("_p", 1, 2)), F.lit(-1)).alias("title"), own(F.slice(F.col("_p"), F.lit(3), F.greatest(F.size("_p") - 2, F.lit(0)))).alias("lines"))
