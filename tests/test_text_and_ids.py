import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkloom.functions import ids
from inkloom.functions import text as T


def test_white_space_is_unicode(column):
    assert column(T.nonspace_len, ["a　b \xa0c\x1cd", "", None, "𝕊 x"]) == [4, 0, None, 2]
    assert column(T.strip_u, ["　\xa0x y ", None, "　"]) == ["x y", None, ""]


def test_split_lines_at_any_line_end(column):
    assert column(T.split_lines, ["a\r\nb\x0bc d\n\ne"]) == [["a", "b", "c", "d", "", "e"]]


def test_thinking_blocks_go_line_by_line(column):
    got = column(T.clean_answer, ["A\n<think>x</think>\nB", "A\n<think>\nx\n</think>\nB", "A\\n\\n  b   c ", None, 'say \\"x\\"', "<think>"])
    assert got == ["A", "A\n\nB", "A\n\nb c", "", 'say "x"', ""]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", " b  c", "", "<think>", "</think>", "<think>x", "　d", "e\x1cf"]), max_size=9))
def test_clean_text_against_a_loop(column, lines):
    out, inside = [], False
    for line in lines:
        line = re.sub(r"[\s\x1c-\x1f]+", " ", line).strip()
        if line.startswith("<think>"):
            inside = True
        elif line.startswith("</think>"):
            inside = False
        elif line and not inside:
            out.append(line)
    assert column(T.clean_text, ["\n".join(lines)]) == ["\n\n".join(out)]


def test_han_numerals(column):
    cases = {"三": 3, "十": 10, "十二": 12, "二十": 20, "一百零五": 105, "三百": 300, "一千二百三十四": 1234, "一二三": 123, "零": 0, "x": None, "": None, None: None}
    assert column(T.han_to_int, list(cases)) == list(cases.values())


@pytest.mark.parametrize("a, b, want", [("第1章 ab", "第1章 ac", 5 / 6), ("x", "x", 1.0), ("", "x", 0.0), (None, None, 0.0)])
def test_title_similarity(spark, a, b, want):
    r = spark.createDataFrame([(a, b)], "a string, b string").select(T.title_similarity(F.col("a"), F.col("b")).alias("s"), T.similarity_band(T.title_similarity(F.col("a"), F.col("b"))).alias("k")).first()
    assert r.s == pytest.approx(want)
    assert r.k == ("match" if want >= 0.9 else "partial" if want >= 0.7 else "mismatch")


def test_names_and_addresses(spark, column):
    assert column(T.safe_name, ["Tên truyện: 1/2", "a-b_c.d"]) == ["Tên_truyện__1_2", "a-b_c.d"]
    assert column(T.name_key, ["Book_12", "Book12", "Book"]) == ["book", "book", "book"]
    assert column(lambda c: T.split_name(c, "yaml"), ["a", "a_seg"]) == ["a_split.yaml", "a_seg.yaml"]
    from urllib.parse import urljoin

    for base in ("https://h.x/a/b.html", "https://h.x/a/b/", "https://h.x", "http://h.x/a/b?q#f"):
        pages = ["2.html", "/2.html", "http://o.y/3", "//o.y/3", "../2", "../../../2", "./x/../y", "..", ".", "?q=1", "#f", "", "a/./b/../c?x=../y#z", "mailto:x"]
        assert column(lambda c: T.join_url(c, F.lit(base)), pages) == [urljoin(base, p) for p in pages]
    assert column(lambda c: T.join_url(c, F.lit("https://h.x/a/b.html")), ["2.html", "/2.html", "http://o.y/3", "//o.y/3"]) == ["https://h.x/a/2.html", "https://h.x/2.html", "http://o.y/3", "https://o.y/3"]
    assert column(T.shorten, ["x" * 50, "x" * 51]) == ["x" * 50, "x" * 47 + "..."]
    assert column(T.mask, ["short", "0123456789abcdefgh"]) == ["***", "0123456789...efgh"]
    assert column(T.thinks, ["gemini-2.5-pro", "x-2-5", "y-3"]) == [True, True, False]
    assert column(T.xml_clean, ["a\x00b\x0bc\td"]) == ["abc\td"]
    assert column(T.paragraphs_html, ["a<b\nc\n\n\n\nd & e"]) == ["<p>a&lt;b<br/>c</p>\n<p>d &amp; e</p>"]
    assert column(T.base_clean, ["​a\n \n \n\nb ", None]) == ["a\n\nb", None]
    assert column(T.title_answer, [' "A"\\nB ']) == ["A\nB"]
    r = spark.sql("select timestamp'2025-11-05 09:07:00' t").select(T.stamped_name(F.col("t"), F.lit("gmn"), F.lit("book"))).first()
    assert r[0] == "051125_0907_gmn_book.yaml"
    assert spark.range(1).select(T.output_name(F.lit("Novel"), F.lit("novel_2"), "ctx", "yaml"), T.output_name(F.lit("Novel"), F.lit("x"), "ctx", "yaml")).first()[:] == ("novel_2_ctx.yaml", "Novel_x_ctx.yaml")


def test_id_readers_disagree_as_they_should(column):
    v = ["Volume_2_Chapter_3_Segment_4", "Chapter_5_Segment_2", "chapter_7_segment_1", "Segment_9", "foo", "Chapter_5", None]
    assert [(x.volume, x.chapter) for x in column(ids.chapter_of, v)[:6]] == [(2, 3), (1, 5), (1, 0), (1, 0), (1, 0), (1, 5)]
    assert column(ids.segment_of, v) == [4, 2, 0, 9, 0, 0, 0]
    assert column(ids.chapter_key, v) == ["Volume_2_Chapter_3", "Chapter_5", None, None, None, "Chapter_5", None]
    assert column(ids.anchored_chapter, v) == [None, 5, None, None, None, None, None]
    assert column(ids.volume_blind_chapter, v) == [3, 5, None, None, None, 5, None]
    assert [tuple(x) for x in column(ids.parts_of, v)[:6]] == [(2, 3, 4), (None, 5, 2), (None, 7, 1), (None, None, None), (None, None, None), (None, 5, None)]
    assert column(ids.upload_key, v) == ["Chapter_3", "Chapter_5", None, None, None, None, None]
    assert [tuple(x) for x in column(ids.digits_key, v)[:6]] == [(2, 3), (5, 2), (7, 1), (0, 9), (0, 0), (0, 5)]


def test_sentence_paragraphs(column):
    assert column(T.sentence_paragraphs, ["一。二！”三」 四\n\n\n\n五", " \n甲。", "", None, "a。  \n"]) == ["'一。\n\n二！\n\n”三」\n\n四\n\n五", "甲。", "", None, "'a。\n"]
    assert column(T.arabic, ["１２", "٣", "4a", None]) == ["12", "3", "4a", None]
