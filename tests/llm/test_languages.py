"""A text's language is that of its lines as a whole, whatever it opens with."""

from inkloom.llm import p4_pairs as p4, p6_align as p6

NOTE = "The translator wants to thank all of you for the help with this chapter."
ZH = "他在雨夜里走进了山谷，看见一盏灯。"


def test_opening_lines_in_another_language():
    assert p6.guess([NOTE] * 12 + [ZH] * 40, "en") == "zh"
    source = "\n".join([NOTE] * 40 + [f"{ZH}他又走了{'一二三四五六七八九'[i % 9]}里路。" for i in range(60)])
    assert p4.defect("content", "\n".join(source.splitlines()[40:]), source, "en") == "copied"
