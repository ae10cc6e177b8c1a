"""Greedy packing of lines into segments of bounded size, inside the row that holds the lines."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.arrays import bind
from inkloom.functions.text import nonspace_len


def starts(sizes: list[int], most: int) -> list[int]:
    """The indices (from 0) of the lines that open a segment, from the lines' sizes.

    A segment closes when the next line would exceed ``most``; a line that
    alone exceeds it stays whole.
    """
    total = np.fromiter(accumulate(sizes), dtype=np.int64, count=len(sizes))
    out, at, before = [], 0, 0
    while at < len(total):
        out.append(at)
        at = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
        before = int(total[at - 1])
    return out


def _packer(most: int):
    @F.arrow_udf("array<array<int>>")
    def packed(sizes: pa.Array) -> pa.Array:
        return pa.array([None if row is None else [starts(x or [], most) for x in row] for row in sizes.to_pylist()], pa.list_(pa.list_(pa.int32())))

    return packed.asNondeterministic()  # it is deterministic, but must not be moved into a lambda


def segment_starts(texts: Column, most: int) -> Column:
    """For each array of lines in ``texts`` the indices (from 0) of those that open a segment of ``most`` characters that aren't white space.

    Only the lines' sizes go through Arrow: greedy packing is a fold, whose
    state Spark's own folds copy at each step. The time is linear in the lines.
    """
    return _packer(most)(F.transform(texts, lambda ls: F.transform(ls, nonspace_len)))


def contents(lines: Column, at: Column) -> Column:
    """The segments of an array of lines that open at the indices ``at``, each joined by blank lines."""
    return F.transform(at, lambda a, k: F.array_join(F.slice(lines, a + 1, F.coalesce(F.get(at, k + 1), F.size(lines)) - a), "\n\n"))


def pack_lines(df: DataFrame, keys: list[str], lines: str | Column, most: int) -> DataFrame:
    """keys, segment (from 0), content (lines joined by a blank line), n_chars. Empty or null lines give no row."""
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.col(lines) if isinstance(lines, str) else lines).alias("_lines"))
    rows = rows.withColumn("_at", segment_starts(F.array("_lines"), most))
    found = F.posexplode(contents(F.col("_lines"), F.get("_at", F.lit(0)))).alias("segment", "content")
    return rows.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], found).withColumn("n_chars", nonspace_len(F.col("content")))


def _rest(a: Column, k: int = 1) -> Column:
    return F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))


def _body(lines: Column, title: Column) -> Column:
    """The lines below the heading, the first left out if it repeats the title."""
    return F.when(F.get(lines, F.lit(1)) == title, _rest(lines, 2)).otherwise(_rest(lines))


def _numbered(structured: DataFrame, key: str, found: Column, prefix: Column) -> DataFrame:
    """key, ord, id, title, content of an array of segments; ids count over the whole text."""
    one = structured.select(key, F.posexplode(found).alias("_i", "_s"))
    return one.select(key, (F.col("_i") + 1).alias("ord"), F.concat(prefix, F.col("_i") + 1).alias("id"), F.col("_s.title").alias("title"), F.col("_s.content").alias("content"))


def _titled(title: Column, content: Column) -> Column:
    return F.concat(F.lit("'"), title, F.lit("\n\n"), content)


def _packed(structured: DataFrame, key: str, sections: Column, body, most: int) -> DataFrame:
    """key, _s (the sections), _b (the lines of each), _at (where its segments open)."""
    rows = structured.select(F.col(key).alias("_key"), sections.alias("_s")).select("*", F.transform("_s", lambda s: body(s["lines"])).alias("_b"))
    return rows.withColumn("_at", segment_starts(F.col("_b"), most)).withColumnRenamed("_key", key)


def _segments(structured: DataFrame, key: str, sections: Column, body, prefix, content, most: int) -> DataFrame:
    rows = _packed(structured, key, sections, body, most)
    title = lambda s: F.get(s["lines"], F.lit(0))
    one = lambda s, k: F.transform(contents(F.get("_b", k), F.get("_at", k)), lambda c: F.struct(prefix(s).alias("prefix"), title(s).alias("title"), content(title(s), c).alias("content")))
    return _numbered(rows, key, F.flatten(F.transform("_s", one)), F.col("_s.prefix"))


def segments_of_sections(structured: DataFrame, key: str, most: int) -> DataFrame:
    """key, ord, id, title, content of all segments of sections.structure, volumes in order (none last), chapters in order.

    The first line of a section is its title; a line right below that repeats
    it is dropped. Ids count over the whole text.
    """
    placed = F.array_sort(F.transform("sections", lambda s: F.struct(s["volume"].isNull().alias("none"), s["volume"].alias("volume"), s["chapter"].alias("chapter"), s["section"].alias("section"), s["lines"].alias("lines"))))
    prefix = lambda s: F.concat(F.when(s["volume"].isNotNull(), F.concat(F.lit("Volume_"), s["volume"], F.lit("_"))).otherwise(""), F.lit("Chapter_"), s["chapter"], F.lit("_Segment_"))
    return _segments(structured, key, placed, lambda ls: _body(ls, F.get(ls, F.lit(0))), prefix, _titled, most)


def _plain_prefix(s: Column) -> Column:
    return F.concat(F.lit("Chapter_"), s["chapter"], F.lit("_Segment_"))


def plain_segments(structured: DataFrame, key: str, most: int) -> DataFrame:
    """As segments_of_sections for text output: sections in their own order, ids without a volume, repeated titles kept, contents without one."""
    return _segments(structured, key, F.col("sections"), _rest, _plain_prefix, lambda _, c: c, most)


def simple_segments(structured: DataFrame, key: str) -> DataFrame:
    """One segment for each section that holds text besides its title: key, ord, id ``Segment_n``, title, content after the title."""
    made = F.transform("sections", lambda s: F.struct(s["title"].alias("title"), F.array_join(_body(s["lines"], s["title"]), "\n\n").alias("body")))
    found = F.transform(F.filter(made, lambda s: s["body"] != ""), lambda s: F.struct(s["title"].alias("title"), _titled(s["title"], s["body"]).alias("content")))
    return _numbered(structured, key, found, F.lit("Segment_"))


def simple_text_segments(structured: DataFrame, key: str) -> DataFrame:
    """As simple_segments for text output: the lines below the first as they are, without the title."""
    return _numbered(structured, key, F.transform("sections", lambda s: F.struct(s["title"].alias("title"), F.array_join(_rest(s["lines"]), "\n\n").alias("content"))), F.lit("Segment_"))


def render(structured: DataFrame, key: str, fmt: str = "yaml", mode: int = 1, most: int = 5000) -> DataFrame:
    """The segments of a format (yaml or txt) and a mode: 2 gives one segment for each section, any other packs."""
    if fmt not in ("yaml", "txt"):
        raise ValueError(f"no format {fmt}")
    if mode == 2:
        return simple_segments(structured, key) if fmt == "yaml" else simple_text_segments(structured, key)
    return segments_of_sections(structured, key, most) if fmt == "yaml" else plain_segments(structured, key, most)


def segments_of_chapters(chapters: DataFrame, keys: list[str], lines: str, most: int) -> DataFrame:
    """keys (with chapter and title), segment (from 1 in each chapter), id, content: the lines packed, each segment below ``'title``."""
    packed = pack_lines(chapters, keys, lines, most)
    return packed.select(*keys, (F.col("segment") + 1).alias("segment"), F.concat(F.lit("Chapter_"), F.col("chapter"), F.lit("_Segment_"), F.col("segment") + 1).alias("id"), _titled(F.coalesce("title", F.lit("")), F.col("content")).alias("content"))


def text_layout(structured: DataFrame, key: str, mode: int = 1, most: int = 2000) -> DataFrame:
    """key, text: the text segments of sections.structure as a file holds them.

    Each segment is its id, its title, its lines with a blank line after each,
    and one more line break. The file is built inside the text's row.
    """
    rows = _packed(structured, key, F.col("sections"), _rest, most if mode != 2 else 2**62)

    def of(s: Column, k: Column) -> Column:
        title, head = (s["title"], F.lit("Segment_")) if mode == 2 else (F.get(s["lines"], F.lit(0)), _plain_prefix(s))
        return F.transform(contents(F.get("_b", k), F.get("_at", k)), lambda c: F.struct(head.alias("head"), F.concat(F.lit("\n"), title, F.lit("\n"), c, F.lit("\n\n\n")).alias("rest")))

    blocks = F.transform(F.flatten(F.transform("_s", of)), lambda b, i: F.concat(b["head"], i + 1, b["rest"]))
    return rows.select(key, F.array_join(blocks, "").alias("text")).where("text <> ''")
