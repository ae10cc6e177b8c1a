"""Row classifiers: what a line, page, path or file name is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.arrays import bind
from inkloom.functions.text import HAN_NUMERALS, WS, arabic, han_to_int, strip_u

# Section words in the order in which they are tried, and heading patterns.
SPECIAL = (
    ("prologue", "^序幕／"),
    ("final_chapter", "^終幕／"),
    ("interlude", "^(?:里幕|幕间|幕間|特典|短篇|解說|断章|闲谈)"),
    ("prologue", rf"(?iu)^prologue(?:\z|[:{WS}])"),
    ("epilogue", rf"(?iu)^epilogue(?:\z|[:{WS}])"),
    ("interlude", rf"(?iu)^interlude(?:\z|[:{WS}])"),
    ("prologue", "^序章"),
    ("epilogue", "^(?:后记|後記)"),
    ("foreword", "^(?:前言|绪言|引言|序言)"),
    ("final_chapter", "^(?:终章|終章|尾声)"),
)
CHAPTERS = (rf"(?iu)^chương[{WS}]*(\p{{Nd}}+)", f"^第([{HAN_NUMERALS}]+)章", r"^第(\p{Nd}+)章", rf"(?iu)^chap[{WS}]*(\p{{Nd}}+)", f"^第([{HAN_NUMERALS}]+)话", r"^第(\p{Nd}+)话", f"^第([{HAN_NUMERALS}]+)幕", r"^第(\p{Nd}+)幕")
HAN_VOLUMES = (f"^第([{HAN_NUMERALS}]+)卷", r"^第(\p{Nd}+)卷")
VOLUMES = (("Quyển", rf"^[Qq]uyển[{WS}]*(\p{{Nd}}+)"), ("Tập", rf"^[Tt]ập[{WS}]*(\p{{Nd}}+)"), ("Volume", rf"^[Vv]olume[{WS}]*(\p{{Nd}}+)"), ("Vol", rf"^[Vv]ol[{WS}]*\.?[{WS}]*(\p{{Nd}}+)"), ("Book", rf"^[Bb]ook[{WS}]*(\p{{Nd}}+)"))
# What every heading begins with: a cheap test, as most lines are none.
MAYBE = r"(?iu)^\x{feff}?(?:第|序|终|終|里幕|幕|特典|短篇|解說|断章|闲谈|后记|後記|前言|绪言|引言|尾声|prologue|epilogue|interlude|quyển|tập|vol|book|chương|chap)"


def strip_bom(c: Column) -> Column:
    """Without one byte-order mark at the start."""
    return F.regexp_replace(c, r"^\x{feff}", "")


def _line(c: Column) -> Column:
    return strip_bom(strip_u(c))


def _special_kind(line: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(SPECIAL):
        out = F.when(line.rlike(pattern), kind).otherwise(out)
    return out


def special_kind(c: Column) -> Column:
    """prologue, epilogue, final_chapter, interlude or foreword; null for other lines."""
    return bind(_line(c), _special_kind)


def _special_title(line: Column, kind: Column) -> Column:
    def named(word: str) -> Column:
        inner = F.regexp_extract(line, f"{word}[「『](.+?)[」』]", 1)
        return F.when(inner != "", F.concat(F.lit(f"{word}: "), inner)).otherwise(word)

    return F.when(line.startswith("序章"), named("序章")).when((kind == "final_chapter") & ~line.startswith("終幕"), named("终章")).otherwise(strip_u(line))


def special_title(c: Column) -> Column:
    """A special line's title: 序章 and 终章 with what stands in corner brackets right after the word, others as the line itself."""
    return bind(_line(c), lambda line: bind(_special_kind(line), lambda kind: F.when(kind.isNotNull(), _special_title(line, kind))))


def _numbered(line: Column, patterns: tuple[str, ...]) -> Column:
    parts = []
    for p in patterns:
        s = F.nullif(F.regexp_extract(line, p, 1), F.lit(""))
        parts.append(han_to_int(s) if HAN_NUMERALS in p else arabic(s).try_cast("int"))
    return F.coalesce(*parts)


def _volume_number(line: Column) -> Column:
    return _numbered(line, (*HAN_VOLUMES, *(p for _, p in VOLUMES)))


def volume_number(c: Column) -> Column:
    """The number of a volume heading; null for other lines and for numbers beyond 32 bits."""
    return bind(_line(c), _volume_number)


def _volume_title(line: Column) -> Column:
    out = F.lit(None).cast("string")
    for label, p in reversed(VOLUMES):
        rest = strip_u(F.regexp_replace(line, f"{p}[.:]?", ""))
        head = F.concat(F.lit(f"{label} "), arabic(F.regexp_extract(line, p, 1)).try_cast("int").cast("string"))
        out = F.when(line.rlike(p), F.when(rest == "", head).otherwise(F.concat(head, F.lit(": "), rest))).otherwise(out)
    for p in reversed(HAN_VOLUMES):
        rest = strip_u(F.regexp_replace(line, p, ""))
        head = F.concat(F.lit("第"), F.regexp_extract(line, p, 1), F.lit("卷"))
        out = F.when(line.rlike(p), F.when(rest == "", head).otherwise(F.concat(head, F.lit(" "), rest))).otherwise(out)
    return out


def volume_title(c: Column) -> Column:
    """A volume heading in one form: ``Label n: rest``, in Chinese ``第n卷 rest``."""
    return bind(_line(c), _volume_title)


def _chapter_number(line: Column, most: int) -> Column:
    n = _numbered(line, CHAPTERS)
    return F.when(n.between(0, most), n)


def chapter_number(c: Column, most: int = 5000) -> Column:
    """The number of a chapter heading from 0 to ``most``; null for other lines."""
    return bind(bind(_line(c), lambda line: _numbered(line, CHAPTERS)), lambda n: F.when(n.between(0, most), n))


HEADING = "struct<kind:string,number:int,title:string>"


def heading(c: Column, most: int = 5000) -> Column:
    """(kind, number, title) of a heading line; null for body lines and null.

    A line is special before it is a volume, and a volume before it is a
    chapter. Number 0 makes no heading.
    """
    none = F.lit(None).cast(HEADING)
    made = lambda kind, number, title: F.struct(kind.alias("kind"), number.cast("int").alias("number"), title.alias("title")).cast(HEADING)
    chapter = lambda line: bind(_chapter_number(line, most), lambda n: F.when(n > 0, made(F.lit("chapter"), n, strip_u(line))).otherwise(none))
    volume = lambda line: bind(_volume_number(line), lambda n: F.when(n > 0, made(F.lit("volume"), n, _volume_title(line))).otherwise(chapter(line)))
    special = lambda line: bind(_special_kind(line), lambda k: F.when(k.isNotNull(), made(k, F.lit(None), _special_title(line, k))).otherwise(volume(line)))
    return F.when(strip_u(c).rlike(MAYBE), bind(_line(c), special)).otherwise(none)


def chapter_class(c: Column) -> Column:
    """(type, number, title, is_special): a chapter by 第…章 with at most three digits, else an interlude."""
    line = F.coalesce(_line(c), F.lit(""))
    han, digits = f"^第([{HAN_NUMERALS}]+)章", r"^第(\p{Nd}{1,3})章"
    is_chapter = line.rlike(han) | line.rlike(digits)
    number = F.coalesce(han_to_int(F.nullif(F.regexp_extract(line, han, 1), F.lit(""))), arabic(F.nullif(F.regexp_extract(line, digits, 1), F.lit(""))).try_cast("int"))
    return F.struct(F.when(is_chapter, "chapter").otherwise("interlude").alias("type"), number.alias("number"), line.alias("title"), (~is_chapter).alias("is_special"))


def content_type(path: Column, subfolders: dict[str, str], default: str = "LightNovel") -> Column:
    """The content type whose folder is the first of the path."""
    first = F.element_at(F.split(path, "/"), 1)
    out = F.lit(default)
    for kind, folder in reversed(list(subfolders.items())):
        out = F.when(first == folder, kind).otherwise(out)
    return out


# Hosts that an address may hold and the parser of that site, in order; names of parsers.
ROUTES = (
    ("hjwzw.com", "hjwzw"), ("linovelib.com", "tw"), ("zhswx.com", "zhswx"), ("dxmwx.org", "dxmwx"), ("dxmwx.com", "dxmwx"), ("czbooks.net", "czbooks"), ("piaotia.com", "piaotia"), ("quanben.io", "quanben"),
    ("sto55.com", "sto55"), ("69shuba.com", "shuba"), ("69shu.com", "shuba"), ("69xinshu.com", "shuba"), ("69shu.pro", "shuba"), ("69shuba.pro", "shuba"),
)
ALIASES = {"hjwzw": "hjwzw", "tw": "tw", "linovelib": "tw", "zhswx": "zhswx", "dxmwx": "dxmwx", "czbooks": "czbooks", "piaotia": "piaotia", "quanben": "quanben", "shuba": "shuba", "69shuba": "shuba", "sto55": "sto55"}


def route(url: Column, routes: tuple[tuple[str, str], ...] = ROUTES) -> Column:
    """The parser of the first host that the address holds; null for others."""
    out = F.lit(None).cast("string")
    for part, parser in reversed(routes):
        out = F.when(url.contains(part), parser).otherwise(out)
    return out


def parser_by_name(name: Column, aliases: dict[str, str] = ALIASES) -> Column:
    """The parser of an alias in any case; null for unknown names."""
    return F.try_element_at(F.create_map(*[F.lit(x.lower() if i == 0 else x) for kv in aliases.items() for i, x in enumerate(kv)]), F.lower(name))


def language_of_style(style: Column) -> Column:
    """JP for paragraphs faded to 0.4, else ZH."""
    return F.when(F.lower(F.coalesce(style, F.lit(""))).contains("opacity") & F.coalesce(style, F.lit("")).contains("0.4"), "JP").otherwise("ZH")


def chapter_of_file(stem: Column, position: Column) -> Column:
    """The first number of a file name less 2; without one, its position."""
    return F.coalesce(F.nullif(F.regexp_extract(stem, r"(\d+)", 1), F.lit("")).try_cast("int") - 2, position)


def book_title_of_file(stem: Column) -> Column:
    """The words of a file name: six digits (a date) go with the word after them, so do numbers, ``context`` and ``titles``."""
    parts = F.split(stem, "_")
    kept = F.filter(parts, lambda p, i: ~p.rlike(r"^\d{6}$") & ~F.coalesce(F.try_element_at(parts, F.when(i > 0, i).otherwise(F.size(parts) + 1)).rlike(r"^\d{6}$"), F.lit(False)) & ~p.rlike(r"^\d+$") & ~F.lower(p).isin("context", "titles") & (p != ""))
    cap = lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.right(p, F.length(p) - 1)))
    return F.when(F.size(kept) > 0, F.array_join(F.transform(kept, cap), " ")).otherwise(F.initcap(F.replace(stem, F.lit("_"), F.lit(" "))))
