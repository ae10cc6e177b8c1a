"""Splitting oversized texts at natural boundaries by recursive bisection."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.runtime import broadcast_if

# The characters with Unicode's White_Space property.
WHITE_SPACE = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Boundaries from the strongest to the weakest; a cut falls at the end of a match.
BOUNDARIES = (
    regex.compile(r"(?:\r\n|[\n\r\x85\u2028\u2029])[^\S\n\r]*(?:(?:\r\n|[\n\r\x85\u2028\u2029])\s*)+"),
    regex.compile(r"\r\n|[\n\r\x0b\x0c\x85\u2028\u2029]"),
    regex.compile(r"(?:[。！？…]+|[.!?]+(?=[\s”’\"')\]])|[.!?]+$)[”’」』》）\"')\]]*\s*"),
    regex.compile(r"[，、；：,;:—][”’」』\"']*\s*"),
    regex.compile(r"\s+"),
)


def size(content):
    """Column: code points without White_Space."""
    return F.length(F.translate(content, WHITE_SPACE, ""))


def _grapheme_safe(text: str, at: int) -> int:
    """The nearest position at or before ``at`` that does not part a character from its marks."""
    back = at
    while back > 0 and at - back < 64:
        c = text[back] if back < len(text) else " "
        joined = text[back - 1] == "\u200d" or c == "\u200d" or unicodedata.combining(c) or 0xFE00 <= ord(c) <= 0xFE0F or 0x1F3FB <= ord(c) <= 0x1F3FF or (c == "\n" and text[back - 1] == "\r")
        if not joined:
            return back
        back -= 1
    return at


def cut_points(text: str, limit: int, overlap: int) -> tuple[list[int], np.ndarray, list[list[int]]]:
    """Positions at which ``text`` is cut so that no core exceeds ``limit - overlap``.

    Each step cuts at the strongest boundary in the middle half of the piece,
    the nearest to the midpoint among equals, and recurses on halves that are
    still too large. Without any boundary it cuts between characters.
    """
    white = np.isin(np.array([ord(c) for c in text], dtype=np.int64), [ord(c) for c in WHITE_SPACE])
    before = np.concatenate([[0], np.cumsum(~white)])  # non-white characters before a position
    marks = [[m.end() for m in b.finditer(text)] for b in BOUNDARIES]
    core = max(1, limit - max(0, min(overlap, limit - 1)))
    cuts: list[int] = []
    todo = [(0, len(text))]
    while todo:
        lo, hi = todo.pop()
        n = int(before[hi] - before[lo])
        if n <= core:
            continue
        at_count = lambda k: int(np.searchsorted(before, before[lo] + k, side="left"))
        mid, left, right = at_count(n // 2), at_count(max(1, n // 4)), at_count(n - max(1, n // 4))
        cut = None
        for positions in marks:
            i = bisect_left(positions, mid)
            near = [p for p in positions[max(0, i - 1) : i + 1] if left <= p <= right and lo < p < hi and 0 < before[p] - before[lo] < n]
            if near:
                cut = min(near, key=lambda p: (abs(int(before[p]) - int(before[mid])), p))
                break
        if cut is None:
            cut = _grapheme_safe(text, mid)
            if not 0 < before[cut] - before[lo] < n:
                cut = mid
        cuts.append(cut)
        todo += [(lo, cut), (cut, hi)]
    return sorted(cuts), before, marks


def split_text(text: str, limit: int, overlap: int) -> list[tuple[str, str]]:
    """(overlap, core) of each piece; the cores concatenated are ``text``.

    A piece is its overlap followed by its core and holds at most ``limit``
    non-white characters. The overlap is the end of the piece before it, from
    its first sentence, clause or word boundary inside the last ``overlap``
    characters on.
    """
    if limit <= 0:
        return [("", text)]
    overlap = max(0, min(overlap, limit - 1))
    cuts, before, marks = cut_points(text, limit, overlap)
    edges = [0, *cuts, len(text)]
    out = []
    for k in range(len(edges) - 1):
        lo, hi = edges[k], edges[k + 1]
        lead = ""
        if k and overlap:
            start = max(edges[k - 1], int(np.searchsorted(before, before[lo] - overlap, side="left")))
            for positions in marks[1:]:
                i = bisect_left(positions, start)
                if i < len(positions) and positions[i] < lo and before[lo] > before[positions[i]]:
                    start = positions[i]
                    break
            lead = text[start:lo]
        out.append((lead, text[lo:hi]))
    return out


def split_oversized(segments: DataFrame, books: DataFrame, limits: DataFrame) -> DataFrame:
    """Pieces of every segment larger than the limit of its book.

    Columns: row_id, book, id, piece_no (from 1), piece_id, title, overlap,
    core, content (overlap + core), n_chars. Rows whose content is null, whose
    book is unknown or has no split mode, or that fit, give no row. Repeated
    deliveries are split on their own. A null id gives ids that begin with
    ``Segment``. Extra columns are ignored.
    """
    caps = (
        books.select("book", "split_mode").join(limits.select("split_mode", "max_chars", "overlap_chars"), "split_mode")
        .groupBy("book").agg(F.min("max_chars").alias("max_chars"), F.min("overlap_chars").alias("overlap_chars"))
    )
    large = (
        segments.select("row_id", "book", "id", "title", "content")
        .join(broadcast_if(caps), "book")
        .where(F.length("content") > F.col("max_chars"))
        .where(size(F.col("content")) > F.col("max_chars"))
    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for r in (x for at in range(0, batch.num_rows, 64) for x in batch.slice(at, 64).to_pylist()):
                for k, (lead, core) in enumerate(split_text(r["content"], r["max_chars"], r["overlap_chars"] or 0), 1):
                    text = lead + core
                    rows.append({"row_id": r["row_id"], "book": r["book"], "id": r["id"], "piece_no": k, "piece_id": f"{(r['id'] or 'Segment').strip()}_Part_{k}", "title": r["title"], "overlap": lead, "core": core, "content": text, "n_chars": sum(c not in WHITE_SPACE for c in text)})
                if len(rows) >= 512:
                    yield pa.RecordBatch.from_pylist(rows, schema=_PIECES)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_PIECES)

    return large.mapInArrow(split, "row_id long, book string, id string, piece_no int, piece_id string, title string, overlap string, core string, content string, n_chars int")


_PIECES = pa.schema([("row_id", pa.int64()), ("book", pa.string()), ("id", pa.string()), ("piece_no", pa.int32()), ("piece_id", pa.string()), ("title", pa.string()), ("overlap", pa.string()), ("core", pa.string()), ("content", pa.string()), ("n_chars", pa.int32())])
