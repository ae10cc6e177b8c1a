"""Volume and chapter structure of raw texts, found inside the row that holds the text."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkloom.functions.arrays import bind
from inkloom.functions.text import split_lines, strip_u
from inkloom.operators import classify as C
from inkloom.operators.ranks import previous

SECTION = "struct<section:int,section_id:string,volume:int,chapter:int,title:string,lines:array<string>>"
EDGE = pa.struct([("i", pa.int32()), ("head", pa.int32()), ("named", pa.bool_()), ("section", pa.int32()), ("section_id", pa.string()), ("volume", pa.int32()), ("chapter", pa.int32())])
EDGES = "array<struct<i:int,head:int,named:boolean,section:int,section_id:string,volume:int,chapter:int>>"


def lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, line_no (from 1), line (stripped) of all physical lines. Null texts have none."""
    return df.select(key, F.posexplode(split_lines(F.col(text))).alias("i", "l")).select(key, (F.col("i") + 1).alias("line_no"), strip_u(F.col("l")).alias("line"))


def _found(ls: Column, most: int) -> Column:
    """(i, kind, number, title) of the headings among stripped lines, i from 0."""
    some = F.filter(F.transform(ls, lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(C.MAYBE))
    seen = F.transform(some, lambda s: bind(C.heading(s["x"], most), lambda h: F.struct(s["i"].alias("i"), h["kind"].alias("kind"), h["number"].alias("number"), h["title"].alias("title"))))
    return F.filter(seen, lambda h: h["kind"].isNotNull())


def headings(df: DataFrame, key: str, text: str, most: int = 5000) -> DataFrame:
    """key, line_no (from 1), kind (special kinds, volume or chapter), number, title of each heading."""
    found = bind(F.transform(split_lines(F.col(text)), strip_u), lambda ls: _found(ls, most))
    return df.select(key, F.explode(found).alias("h")).select(key, (F.col("h.i") + 1).alias("line_no"), "h.kind", "h.number", "h.title")


def place(heads: list[dict], strict_compat: bool) -> list[dict]:
    """The pieces of text between the headings of one text (i, kind, number, filled), each with its section.

    ``filled``: the line above holds text. ``head`` is the heading that names a
    piece, ``named`` says that the piece begins with it; a piece with the
    section of the one before continues it.
    """
    out = [{"i": -1, "head": -1, "named": False, "section": 0, "section_id": "none", "volume": None, "chapter": 0}]
    volume: int | None = None
    run: set[int] = set()  # chapters since the last volume heading
    tallies: dict[int, list[int]] = {}  # for each volume its highest chapter, final chapters, interludes
    dropped = -2
    for k, h in enumerate(heads):
        last, kind, number = out[-1], h["kind"], h["number"]
        if kind == "chapter" and number in run:
            tight = strict_compat and h["filled"] and dropped != h["i"] - 1
            out.append(last | {"i": h["i"], "named": False, "section": last["section"] + tight})
            dropped = h["i"]
            continue
        if kind == "volume":
            volume = number
            run = set()
        tally = tallies.setdefault(volume or 0, [0, 0, 0])
        chapter = last["chapter"]
        if kind == "chapter":
            run.add(number)
            tally[0] = max(tally[0], number)
            chapter = number
        elif kind in ("volume", "prologue"):
            chapter = 0
        elif kind in ("final_chapter", "epilogue"):
            chapter = tally[0] + 1 + tally[1]
            tally[1] += kind == "final_chapter"
        elif kind == "interlude":
            chapter = 901 + tally[2]
            tally[2] += 1
        name = None if kind == "volume" else "foreword" if kind == "foreword" else f"Chapter_{chapter}"
        parts = [f"Volume_{volume}"] * (volume is not None) + [name] * (name is not None)
        out.append({"i": h["i"], "head": k, "named": True, "section": last["section"] + 1, "section_id": "_".join(parts), "volume": volume, "chapter": chapter})
    return out


def _placer(strict_compat: bool):
    @F.arrow_udf(EDGES)
    def placed(heads: pa.Array) -> pa.Array:
        return pa.array([None if h is None else place(h, strict_compat) for h in heads.to_pylist()], pa.list_(EDGE))

    return placed.asNondeterministic()  # it is deterministic, but must not be moved into a lambda


def _cut(ls: Column, found: Column, edges: Column) -> Column:
    """The sections that the pieces of a text make up."""
    end = lambda k: F.coalesce(F.get(edges, k + 1)["i"], F.size(ls))
    pieces = F.transform(edges, lambda e, k: F.struct(e.alias("e"), F.filter(F.slice(ls, e["i"] + 2, F.greatest(end(k) - e["i"] - 1, F.lit(0))), lambda x: x != "").alias("text")))
    opens = lambda k: (k == 0) | (F.get(edges, k)["section"] != F.get(edges, F.greatest(k - 1, F.lit(0)))["section"])
    starts = F.filter(F.sequence(F.lit(0), F.size(edges) - 1), opens)

    def one(ps: Column, a: Column, b: Column) -> Column:
        def made(e: Column) -> Column:
            title = F.coalesce(F.get(found, e["head"])["title"], F.lit(""))
            own = F.flatten(F.transform(F.slice(ps, a + 1, b - a), lambda p: p["text"]))
            return F.struct(e["section"].alias("section"), e["section_id"].alias("section_id"), e["volume"].alias("volume"), e["chapter"].alias("chapter"), title.alias("title"), F.concat(F.when(e["named"], F.array(title)).otherwise(F.array().cast("array<string>")), own).alias("lines")).cast(SECTION)

        return bind(F.get(ps, a)["e"], made)

    whole = bind(pieces, lambda ps: bind(starts, lambda at: F.transform(at, lambda a, j: one(ps, a, F.coalesce(F.get(at, j + 1), F.size(ps))))))
    return F.filter(whole, lambda s: F.size(s["lines"]) > 1)


def structure(df: DataFrame, key: str, text: str, most: int = 5000, strict_compat: bool = False) -> DataFrame:
    """key, sections: the sections of each text in order; a null or empty text has none.

    Headings open sections; text before the first is section ``none`` of
    chapter 0, whose first line stands for its title. A chapter repeated since
    the last volume heading is dropped. A prologue is chapter 0, a final chapter
    follows the highest chapter of its volume, an epilogue too, interludes count
    from 901, a foreword keeps the number before it. Sections with a heading and
    nothing else are left out; ``lines[0]`` is the heading's title. With
    ``strict_compat`` a dropped heading right below text opens a section of its
    own, whose first line then stands for its title.

    A text is one row from end to end: no line of it is shuffled, and only its
    headings (line number, kind, number) go through Arrow, where they are
    numbered in turn. The time is linear in the text.
    """
    ls = F.transform(split_lines(F.col(text)), strip_u)
    rows = df.select(F.col(key).alias("_key"), ls.alias("_ls")).select("*", _found(F.col("_ls"), most).alias("_found"))
    filled = lambda i: F.coalesce(F.get("_ls", i - 1) != "", F.lit(False)) if strict_compat else F.lit(False)
    heads = F.transform("_found", lambda h: F.struct(h["i"].alias("i"), h["kind"].alias("kind"), h["number"].alias("number"), filled(h["i"]).alias("filled")))
    rows = rows.withColumn("_edges", _placer(strict_compat)(heads))
    return rows.select(F.col("_key").alias(key), _cut(F.col("_ls"), F.col("_found"), F.col("_edges")).alias("sections"))


def sections(structured: DataFrame, key: str) -> DataFrame:
    """key, section, section_id, volume, chapter, title, lines: a row for each section."""
    return structured.select(key, F.explode("sections").alias("s")).select(key, "s.*")


def order_warnings(df: DataFrame, key: str) -> DataFrame:
    """Chapter headings whose number is neither 1 nor one more than the heading before: key, line_no, previous, number."""
    chapters = previous(df.where("kind = 'chapter'").select(key, "line_no", "number"), [key], ["line_no"], "number", "previous")
    return chapters.where("previous is not null and number <> previous + 1 and number <> 1").select(key, "line_no", "previous", "number")
