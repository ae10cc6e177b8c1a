"""Classifiers, sections and packing; sections against a sequential reading of their rules."""

import random
import time

from pyspark.sql import functions as F

from inkloom.operators import classify as C
from inkloom.operators import pack, sections


# Lines and what they are, written down by hand.
LINES = [
    ("第三卷 开端", ("volume", 3, "第三卷 开端")), ("第一卷风起", ("volume", 1, "第一卷 风起")), ("第12卷", ("volume", 12, "第12卷")), ("Quyển 6:", ("volume", 6, "Quyển 6")), ("Quyển 01: A", ("volume", 1, "Quyển 1: A")),
    ("Quyển 1 - A", ("volume", 1, "Quyển 1: - A")), ("tập 2. A", ("volume", 2, "Tập 2: A")), ("Vol . 3 A", ("volume", 3, "Vol 3: A")), ("Vol. 3", ("volume", 3, "Vol 3")), ("Volume 4:x", ("volume", 4, "Volume 4: x")), ("Book 4 x", ("volume", 4, "Book 4: x")),
    ("BOOK 4", None), ("Quyển 0", None), ("Chương 12: A", ("chapter", 12, "Chương 12: A")), ("Chương5", ("chapter", 5, "Chương5")), ("CHƯƠNG 5", ("chapter", 5, "CHƯƠNG 5")), ("Chap5", ("chapter", 5, "Chap5")), ("Chương\xa05", ("chapter", 5, "Chương\xa05")),
    ("第１２章", ("chapter", 12, "第１２章")), ("第十二话 A", ("chapter", 12, "第十二话 A")), ("第三幕", ("chapter", 3, "第三幕")), ("第6001章", None), ("第0章 A", None), ("\ufeff第1章", ("chapter", 1, "第1章")), (" \ufeff第1章 ", ("chapter", 1, "第1章")),
    ("序幕拉开了", None), ("终幕", None), ("序幕／夜", ("prologue", None, "序幕／夜")), ("終幕／夜", ("final_chapter", None, "終幕／夜")), ("序章", ("prologue", None, "序章")), ("序章「夜」", ("prologue", None, "序章: 夜")), ("序章 他说（笑）", ("prologue", None, "序章")),
    ("终章『x』", ("final_chapter", None, "终章: x")), ("終章「x」", ("final_chapter", None, "终章")), ("尾声 a", ("final_chapter", None, "终章")), ("幕间 a", ("interlude", None, "幕间 a")), ("后记", ("epilogue", None, "后记")), ("前言", ("foreword", None, "前言")),
    ("Prologue: x", ("prologue", None, "Prologue: x")), ("Prologue\tX", ("prologue", None, "Prologue\tX")), ("EPILOGUE", ("epilogue", None, "EPILOGUE")), ("Prologues", None), ("text", None), ("", None), (None, None),
]


def test_headings(column):
    got = [None if x is None or x.kind is None else tuple(x) for x in column(C.heading, [line for line, _ in LINES])]
    assert got == [want for _, want in LINES]
    assert column(C.volume_number, ["第三卷", "x"]) == [3, None] and column(C.volume_title, ["Quyển 6:"]) == ["Quyển 6"] and column(C.chapter_number, ["第0章 A", "第6001章"]) == [0, None]
    assert column(C.special_kind, ["终章「x」", "Prologues", None]) == ["final_chapter", None, None] and column(C.special_title, ["终章「x」", "x"]) == ["终章: x", None]
    assert [tuple(x)[:2] for x in column(C.chapter_class, ["第12章 A", "第一百章", "第1234章", "", None])] == [("chapter", 12), ("chapter", 100), ("interlude", None), ("interlude", None), ("interlude", None)]


def test_files_and_sites(column):
    assert column(C.route, ["https://www.piaotia.com/1", "https://www.69xinshu.com/1", "https://x.69shu.me/1", "https://quanben5.com/1", "https://o.org/?u=piaotia", None]) == ["piaotia", "shuba", None, None, None, None]
    assert column(C.parser_by_name, ["69Shuba", "LINOVELIB", "x"]) == ["shuba", "tw", None]
    assert column(lambda c: C.parser_by_name(c, {"Shuba": "shuba", "69": "shuba"}), ["SHUBA", "69", "q", None]) == ["shuba", "shuba", None, None]
    assert column(C.language_of_style, ["OPACITY:0.4", "opacity:1", None]) == ["JP", "ZH", "ZH"]
    assert column(lambda c: C.chapter_of_file(c, F.lit(7)), ["p-012", "cover"]) == [10, 7]
    assert column(C.book_title_of_file, ["251105_1548_gmn_my_book_context", "plain"]) == ["Gmn My Book", "Plain"]
    assert column(lambda c: C.content_type(c, {"Web": "web"}), ["web/a.txt", "x/a.txt"]) == ["Web", "LightNovel"]


def run(spark, texts, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    out = sections.sections(sections.structure(df, "k", "t", **kw), "k").orderBy("k", "section").collect()
    return [[(r.section_id, r.volume, r.chapter, r.title, list(r.lines)) for r in out if r.k == k] for k in range(len(texts))]


def test_section_rules(spark):
    got = run(spark, [
        "第1章 A\nx\n第2章 B\ny\n终章\nz\n终章\nw\n后记\nv", "幕间\na\n幕间\nb", "Quyển 1:\nChương 1: A\nbody", "pre\nface", "第1章 A\nx\n\n第1章 A\ny", "", None, "第0章 A\nx", "前言\na\n第3章\nb\n前言\nc",
    ])
    assert [s[2] for s in got[0]] == [1, 2, 3, 4, 5]
    assert [s[2] for s in got[1]] == [901, 902]
    assert got[2] == [("Volume_1_Chapter_1", 1, 1, "Chương 1: A", ["Chương 1: A", "body"])]
    assert got[3] == [("none", None, 0, "", ["pre", "face"])]
    assert got[4] == [("Chapter_1", None, 1, "第1章 A", ["第1章 A", "x", "y"])]
    assert got[5] == got[6] == []
    assert got[7] == [("none", None, 0, "", ["第0章 A", "x"])]
    assert [(s[0], s[2]) for s in got[8]] == [("foreword", 0), ("Chapter_3", 3), ("foreword", 3)]
    tight = run(spark, ["第1章 A\nx\n第1章 A\ny\nz", "第1章 A\nx\n\n第1章 A\ny", "第1章 A\n第1章 A\ny\nz"], strict_compat=True)
    assert [(s[0], s[3], s[4]) for s in tight[0]] == [("Chapter_1", "第1章 A", ["第1章 A", "x"]), ("Chapter_1", "第1章 A", ["y", "z"])]
    assert [s[4] for s in tight[1]] == [["第1章 A", "x", "y"]] and [s[4] for s in tight[2]] == [["y", "z"]]
    named = run(spark, ["第一卷风起\na\n前言\nb\n序章『夜』\nc\n终章\nd"])
    assert [(s[0], s[4][0]) for s in named[0]] == [("Volume_1", "第一卷 风起"), ("Volume_1_foreword", "前言"), ("Volume_1_Chapter_0", "序章: 夜"), ("Volume_1_Chapter_1", "终章")]


KINDS = [("第{}章 t", "chapter"), ("第{}卷", "volume"), ("终章", "final_chapter"), ("后记", "epilogue"), ("幕间", "interlude"), ("序章", "prologue"), ("前言", "foreword"), ("text {}", "body"), ("text {}", "body"), ("", "blank")]


def sequential(lines):
    """The rules read one line after another."""
    volume, seen, top, finals, inters, chapter, out, current = None, set(), {}, {}, {}, 0, [], ["none", None, 0, "", []]
    for text, kind, n in lines:
        if kind == "blank":
            continue
        if kind == "body":
            current[4].append(text)
            continue
        if kind == "volume":
            volume, seen, chapter, sid = n, set(), 0, f"Volume_{n}"
            text = f"第{n}卷"
        elif kind == "chapter":
            if n in seen:
                continue
            seen.add(n)
            chapter = n
            sid = f"Volume_{volume}_Chapter_{n}" if volume else f"Chapter_{n}"
        else:
            vk = volume or 0
            if kind == "prologue":
                chapter = 0
            elif kind == "final_chapter":
                chapter = top.get(vk, 0) + 1 + finals.get(vk, 0)
                finals[vk] = finals.get(vk, 0) + 1
            elif kind == "epilogue":
                chapter = top.get(vk, 0) + 1 + finals.get(vk, 0)
            elif kind == "interlude":
                chapter = 901 + inters.get(vk, 0)
                inters[vk] = inters.get(vk, 0) + 1
            sid = (f"Volume_{volume}_" if volume else "") + ("foreword" if kind == "foreword" else f"Chapter_{chapter}")
        if kind == "chapter":
            top[volume or 0] = max(top.get(volume or 0, 0), n)
        out.append(current)
        current = [sid, volume, chapter, text, [text]]
    out.append(current)
    return [tuple(s) for s in out if len(s[4]) > 1]


def test_sections_against_a_loop(spark):
    rnd = random.Random(4)
    texts = []
    for _ in range(150):
        lines = []
        for _ in range(rnd.randint(0, 25)):
            form, kind = rnd.choice(KINDS)
            n = rnd.randint(1, 4)
            lines.append((form.format(n), kind, n))
        texts.append(lines)
    got = run(spark, ["\n".join(x[0] for x in t) for t in texts])
    for t, g in zip(texts, got):
        assert g == sequential(t)


def test_order_warnings(spark):
    df = spark.createDataFrame([("a", i, n, "chapter") for i, n in enumerate([1, 2, 4, 5, 1, 2])], "k string, line_no int, number int, kind string")
    assert [tuple(r) for r in sections.order_warnings(df, "k").collect()] == [("a", 2, 2, 4)]


def packed_by_hand(sizes, most):
    out, cur = [], 0
    for i, n in enumerate(sizes):
        if not out or cur + n > most:
            out.append(i)
            cur = 0
        cur += n
    return out


def test_greedy_packing(spark):
    lines = ["x" * n for n in (4, 4, 4, 9, 1, 1)]
    df = spark.createDataFrame([(1, lines), (2, []), (3, None), (4, ["　 "])], "k int, l array<string>")
    got = pack.pack_lines(df, ["k"], "l", 8).orderBy("k", "segment").collect()
    assert [(r.k, r.segment, r.n_chars) for r in got] == [(1, 0, 8), (1, 1, 4), (1, 2, 9), (1, 3, 2), (4, 0, 0)]
    assert "\n\n".join(r.content for r in got if r.k == 1) == "\n\n".join(lines)
    rnd = random.Random(2)
    for most in (1, 5, 30, 1000):
        for n in (0, 1, 50):
            sizes = [rnd.choice([0, 1, 3, 8, 40]) for _ in range(n)]
            assert pack.starts(sizes, most) == packed_by_hand(sizes, most)


def test_packing_is_linear(spark):
    """One text of 20,000 and one of 80,000 lines: four times the lines may not take much more than four times as long."""
    took = []
    for n in (20_000, 80_000):
        df = spark.createDataFrame([(1, "\n".join(["第1章 a"] + ["x" * 50] * n))], "k int, t string").cache()
        df.count()
        began = time.time()
        assert pack.segments_of_sections(sections.structure(df, "k", "t"), "k", 500).count() == n / 10
        took.append(time.time() - began)
    assert took[1] < 8 * took[0] + 1


def test_no_text_is_shuffled(spark, data):
    from inkloom.operators import sections as S

    df = S.structure(spark.read.parquet(f"{data}/documents.parquet"), "doc_id", "text")
    for out in (S.sections(df, "doc_id"), pack.segments_of_sections(df, "doc_id", 500), pack.text_layout(df, "doc_id")):
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


def test_segments_of_sections(spark):
    df = spark.createDataFrame([(1, "pre\nface\nQuyển 1:\nChương 1: A\nx\nQuyển 2: B\nw\nChương 1: B\nChương 1: B\ny")], "k long, t string")
    s = sections.structure(df, "k", "t")
    got = pack.segments_of_sections(s, "k", 100).orderBy("ord").collect()
    assert [r.id for r in got] == ["Volume_1_Chapter_1_Segment_1", "Volume_2_Chapter_0_Segment_2", "Volume_2_Chapter_1_Segment_3", "Chapter_0_Segment_4"]
    assert got[0].content == "'Chương 1: A\n\nx" and got[1].title == "Quyển 2: B" and got[3].title == "pre"
    assert [r.id for r in pack.render(s, "k", "yaml", 2).orderBy("ord").collect()] == ["Segment_1", "Segment_2", "Segment_3", "Segment_4"]
    text = pack.text_layout(s, "k", 1, 100).first().text
    assert text == "Chapter_0_Segment_1\npre\nface\n\n\nChapter_1_Segment_2\nChương 1: A\nx\n\n\nChapter_0_Segment_3\nQuyển 2: B\nw\n\n\nChapter_1_Segment_4\nChương 1: B\ny\n\n\n"
    assert pack.text_layout(s, "k", 2).first().text.startswith("Segment_1\n\nface\n\n\nSegment_2\nChương 1: A\nx\n\n\n")
    assert [(r.title, r.content) for r in pack.render(s, "k", "txt", 2).orderBy("ord").collect()][:2] == [("", "face"), ("Chương 1: A", "x")]
    chapters = spark.createDataFrame([(3, "T", ["a" * 6, "b" * 6])], "chapter int, title string, l array<string>")
    assert [(r.id, r.content) for r in pack.segments_of_chapters(chapters, ["chapter", "title"], "l", 8).orderBy("segment").collect()] == [("Chapter_3_Segment_1", "'T\n\naaaaaa"), ("Chapter_3_Segment_2", "'T\n\nbbbbbb")]
