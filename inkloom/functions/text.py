"""Text functions as columns. All treat null as the docstring says and keep Unicode white space apart from ASCII."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of Unicode-aware regular expressions, and line ends.
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
HAN_NUMERALS = "零一二三四五六七八九十百千"


def strip_u(c: Column) -> Column:
    """Without white space at both ends; null stays null."""
    return F.regexp_replace(c, f"^[{WS}]+|[{WS}]+$", "")


def split_lines(c: Column) -> Column:
    """The physical lines of a text, at any line end."""
    return F.split(c, LINE_END)


def nonspace_len(c: Column) -> Column:
    """Code points that aren't white space."""
    return F.length(F.regexp_replace(c, f"[{WS}]+", ""))


def squeeze(c: Column) -> Column:
    """Runs of white space become one space, none at the ends."""
    return strip_u(F.regexp_replace(c, f"[{WS}]+", " "))


def _kept_lines(lines: Column) -> Column:
    """Lines outside thinking blocks. A line that opens or closes one goes with it; an open block swallows the rest."""
    start = F.struct(F.lit(False).alias("open"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, line: Column) -> Column:
        opens, closes = line.startswith("<think>"), line.startswith("</think>")
        inside = F.when(opens, True).when(closes, False).otherwise(acc["open"])
        keep = ~acc["open"] & ~opens & ~closes & (line != "")
        return F.struct(inside.alias("open"), F.when(keep, F.concat(acc["out"], F.array(line))).otherwise(acc["out"]).alias("out"))

    return F.aggregate(lines, start, step, lambda acc: acc["out"])


def clean_text(c: Column) -> Column:
    """Thinking blocks and blank lines removed, white space squeezed, one blank line between lines. Null gives ''."""
    stripped = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), squeeze)
    # without a block there is nothing to carry along; the fold is for the others
    plain = F.filter(stripped, lambda x: x != "")
    return F.array_join(F.when(F.coalesce(c, F.lit("")).contains("think>"), _kept_lines(stripped)).otherwise(plain), "\n\n")


def unescape(c: Column) -> Column:
    """Escaped line breaks, quotes and backslashes of an answer as what they stand for."""
    out = F.replace(F.replace(F.replace(c, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\"))
    return F.replace(out, F.lit("\\\n\\"), F.lit("\n"))


def clean_answer(c: Column) -> Column:
    """A model's answer: unescaped, then cleaned. Null gives ''."""
    return clean_text(unescape(c))


def base_clean(c: Column) -> Column:
    """Without zero-width characters, runs of blank lines as one, none at the ends. Null stays null."""
    c = F.regexp_replace(c, r"[\x{200b}\x{200c}\x{200d}\x{feff}]", "")
    return strip_u(F.regexp_replace(c, f"\n[{WS}]*\n[{WS}]*\n+", "\n\n"))


def title_answer(c: Column) -> Column:
    """A title as answered: stripped, without double quotes, escaped line breaks as line breaks."""
    return F.replace(F.replace(strip_u(c), F.lit('"'), F.lit("")), F.lit("\\n"), F.lit("\n"))


def xml_clean(c: Column) -> Column:
    """Only characters that XML 1.0 allows."""
    return F.regexp_replace(c, r"[^\x{9}\x{A}\x{D}\x{20}-\x{D7FF}\x{E000}-\x{FFFD}\x{10000}-\x{10FFFF}]", "")


def paragraphs_html(c: Column) -> Column:
    """Paragraphs at blank lines as p elements, line breaks inside as br, markup characters escaped."""
    escaped = F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    parts = F.filter(F.transform(F.split(escaped, "\n\n"), strip_u), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.lit("<p>"), F.replace(p, F.lit("\n"), F.lit("<br/>")), F.lit("</p>"))), "\n")


def sentence_paragraphs(c: Column) -> Column:
    """A paragraph break between sentence ends or closing quotes and what follows them; lines stripped, one blank line at most between them.

    An apostrophe stands before the first line unless that is blank. Null stays null.
    """
    for mark in ("[。！？]", '["」]'):
        c = F.regexp_replace(c, f"({mark})([^{WS}])", "$1\n\n$2")
    for mark in ("[。！？]", '["」]'):
        c = F.regexp_replace(c, f"({mark})[{WS}]+([^{WS}])", "$1\n\n$2")
    lines = F.transform(F.split(F.regexp_replace(c, "\n{3,}", "\n\n"), "\n"), lambda x, i: F.when((i == 0) & (strip_u(x) != ""), F.concat(F.lit("'"), strip_u(x))).otherwise(strip_u(x)))
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.array_join(lines, "\n"), "\n{3,}", "\n\n"), r"^\n+", ""), r"\n+\z", "\n")


def name_key(c: Column) -> Column:
    """A name in lower case without a number at its end."""
    return F.regexp_replace(F.lower(c), r"_?\d+$", "")


def output_name(folder: Column, stem: Column, suffix: str, fmt: str) -> Column:
    """The stem, after its folder unless it begins with it, with suffix and format."""
    named = F.when((F.coalesce(folder, F.lit("")) == "") | name_key(stem).startswith(name_key(folder)), stem).otherwise(F.concat_ws("_", folder, stem))
    return F.concat(named, F.lit(f"_{suffix}.{fmt}"))


def split_name(stem: Column, fmt: str) -> Column:
    """The stem with ``_split``, unless it says already that it is split."""
    done = stem.rlike("(_split|_seg|_segment|_chapter|_divided)$")
    return F.concat(F.when(done, stem).otherwise(F.concat(stem, F.lit("_split"))), F.lit(f".{fmt}"))


def stamped_name(ts: Column, sdk: Column, base: Column, mode: Column | None = None, fmt: str = "yaml") -> Column:
    """``ddMMyy_HHmm_sdk_base[_mode].fmt`` for a given time."""
    return F.concat(F.concat_ws("_", F.date_format(ts, "ddMMyy_HHmm"), sdk, base, *([mode] if mode is not None else [])), F.lit(f".{fmt}"))


def safe_name(c: Column) -> Column:
    """Characters other than letters, digits, ``-``, ``_`` and ``.`` as ``_``."""
    return F.regexp_replace(c, r"(?U)[^\w\-.]", "_")


def title_similarity(a: Column, b: Column) -> Column:
    """1 for equal titles, else shared distinct characters over the longer length; 0 when one is empty or null."""
    x, y = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    chars = lambda c: F.array_distinct(F.split(c, ""))
    shared = F.size(F.array_intersect(chars(x), chars(y)))
    return F.when((x == "") | (y == ""), 0.0).when(x == y, 1.0).otherwise(shared / F.greatest(F.length(x), F.length(y)))


def similarity_band(s: Column) -> Column:
    return F.when(s >= 0.9, "match").when(s >= 0.7, "partial").otherwise("mismatch")


def shorten(c: Column, most: int = 50) -> Column:
    """Texts longer than ``most`` end in three dots at that length."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most - 3), F.lit("..."))).otherwise(c)


def mask(c: Column) -> Column:
    """The first 10 and last 4 characters of a secret longer than 14; shorter ones are hidden whole."""
    return F.when(F.length(c) > 14, F.concat(F.substring(c, 1, 10), F.lit("..."), F.right(c, F.lit(4)))).otherwise(F.lit("***"))


# Fixed value: the parts of an address.
ADDRESS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?"


def join_url(page: Column, base: Column) -> Column:
    """``page`` as an address seen from ``base``: other sites, roots, folders, dot segments, queries and fragments.

    An empty page is the base; null in either gives null.
    """
    part = lambda c, i: F.regexp_extract(c, ADDRESS, i)

    def resolved(path: Column) -> Column:
        """Without dot segments and empty ones inside."""
        segments = F.split(path, "/")
        inner = F.filter(segments, lambda x, i: (x != "") | (i == 0) | (i == F.size(segments) - 1))
        step = lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(acc)).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))
        done = F.array_join(F.aggregate(inner, F.array().cast("array<string>"), step), "/")
        return F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(done, F.lit("/"))).otherwise(done)

    root = F.concat(part(base, 1), F.lit("://"), part(base, 2))
    path = part(page, 3)
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(F.regexp_replace(part(base, 3), "[^/]*$", ""), path))
    whole = F.when(whole.startswith("/"), whole).otherwise(F.concat(F.lit("/"), whole))
    return (
        F.when(page.isNull() | base.isNull(), F.lit(None).cast("string"))
        .when(page == "", base)
        .when((part(page, 1) != "") & (part(page, 1) != part(base, 1)), page)
        .when(part(page, 2) != "", F.concat(part(base, 1), F.lit("://"), part(page, 2), F.when(path == "", "").otherwise(resolved(path)), part(page, 4), part(page, 5)))
        .when(path == "", F.concat(root, part(base, 3), F.when(part(page, 4) != "", part(page, 4)).otherwise(part(base, 4)), part(page, 5)))
        .otherwise(F.concat(root, resolved(whole), part(page, 4), part(page, 5)))
    )


def thinks(model: Column) -> Column:
    """Whether a model's name says it can think."""
    return model.rlike("2[.-]5")


DIGITS = [c for c in map(chr, range(128, 0x110000)) if unicodedata.category(c) == "Nd"]


def arabic(c: Column) -> Column:
    """Decimal digits of any script as ASCII digits."""
    return F.translate(c, "".join(DIGITS), "".join(str(unicodedata.digit(d)) for d in DIGITS))


def han_to_int(c: Column) -> Column:
    """The value of a plain Chinese numeral below 10000, such as 三百零五; null for anything else.

    A ten at the start counts as one ten; digits in a row (一二三) are read by place.
    """
    digits = F.translate(c, HAN_NUMERALS[:10], "0123456789").try_cast("int")
    unit = F.create_map(*[F.lit(x) for p in (("十", 10), ("百", 100), ("千", 1000)) for x in p])
    value = F.create_map(*[F.lit(x) for i, d in enumerate(HAN_NUMERALS[:10]) for x in (d, i)])
    start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("digit"), F.lit(False).alias("some"))

    def step(acc: Column, ch: Column) -> Column:
        u = F.try_element_at(unit, ch)
        d = F.try_element_at(value, ch)
        with_unit = F.struct((acc["total"] + F.when(acc["some"] & (acc["digit"] > 0), acc["digit"]).otherwise(1) * u).alias("total"), F.lit(0).alias("digit"), F.lit(False).alias("some"))
        with_digit = F.struct(acc["total"].alias("total"), d.alias("digit"), F.lit(True).alias("some"))
        return F.when(u.isNotNull(), with_unit).otherwise(with_digit)

    spoken = F.aggregate(F.split(c, ""), start, step, lambda acc: acc["total"] + acc["digit"])
    return F.when(c.rlike(f"^[{HAN_NUMERALS[:10]}]+$"), digits).when(c.rlike(f"^[{HAN_NUMERALS}]+$"), spoken)
