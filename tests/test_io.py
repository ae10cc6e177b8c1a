"""Sources, sinks and streaming on small files."""

import io
import json
import os
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkloom.operators import reshape
from inkloom.sources import blocks, readers, writers
from inkloom.streaming import files as stream


def test_encodings():
    text = "第一章 Chương"
    for e in ("utf-8", "utf-16", "utf-8-sig"):
        assert readers.decode(text.encode(e))[0].lstrip("﻿") == text
    assert readers.decode("第一章".encode("gbk")) == ("第一章", "gbk")
    assert readers.decode(None) == (None, None)
    assert readers.decode(b"\xff\x00\xff") == (None, None)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.fixed_dictionaries({"id": st.text(max_size=12), "title": st.none() | st.text(max_size=12), "content": st.text(alphabet=st.sampled_from(list("ab 　\n\t'\":#-|\\第")), max_size=40)}), max_size=4))
def test_segment_files_round_trip(rows):
    assert blocks.parse_segments(blocks.dump_segments(rows)) == rows


def test_plain_parser_reads_what_is_written():
    rows = [{"id": "a", "title": "x: y", "content": "l1\n\n  l2\nl3"}, {"id": "b", "title": None, "content": "l\n"}]
    assert blocks._parse_plain(blocks.dump_segments(rows)) == rows
    for bad in ("a: 1", "- x", "just text"):
        with pytest.raises(ValueError):
            blocks.parse_segments(bad)


def test_text_and_segment_files(spark, tmp_path):
    (tmp_path / "in" / "skip").mkdir(parents=True)
    (tmp_path / "in" / "a.txt").write_bytes("第1章".encode("gbk"))
    (tmp_path / "in" / "skip" / "b.txt").write_text("x")
    found = readers.pruned(readers.files(spark, str(tmp_path / "in"), "*.txt"), str(tmp_path / "in"), ("skip",))
    assert [(r.rel_path) for r in found.collect()] == ["a.txt"]
    assert [(r.text, r.encoding) for r in readers.texts(found).collect()] == [("第1章", "gbk")]
    df = spark.createDataFrame([("b", 2, "i2", None, "x\ny"), ("b", 1, "i1", "T", None)], "book string, ord long, id string, title string, content string")
    assert [r.status for r in writers.write_segments(df, ["book"], str(tmp_path / "out")).collect()] == ["success"]
    back = readers.segments(readers.files(spark, str(tmp_path / "out"), "*.yaml")).orderBy("ord").collect()
    assert [(r.id, r.title, r.content) for r in back] == [("i1", "T", None), ("i2", None, "x\ny")]
    (tmp_path / "out" / "bad.yaml").write_text("- id: 1\n")
    with pytest.raises(Exception, match="has no title"):
        readers.segments(readers.files(spark, str(tmp_path / "out"), "*.yaml")).collect()
    assert readers.latest(readers.files(spark, str(tmp_path / "out")), "x.log").first().path == "x.log"
    assert readers.latest(readers.files(spark, str(tmp_path / "out")), "LATEST").first().path.endswith(".yaml")


def test_books(spark, tmp_path):
    df = spark.createDataFrame([("b", "Book & Co", "T<1>", "p1\n\np2 & \x00x", 1), ("b", "Book & Co", None, "q", 2), ("e", "Empty", "t", " ", 1)], "book string, book_title string, title string, content string, position int")
    got = {r.file.rsplit("/", 1)[-1]: (r.status, r.reason) for r in writers.write_epub(df, "book", str(tmp_path)).collect()}
    assert got == {"b.epub": ("success", None), "e.epub": ("error", "no chapter has text")}
    z = zipfile.ZipFile(tmp_path / "b.epub")
    assert z.namelist()[0] == "mimetype" and "<p>p2 &amp; x</p>" in z.read("OEBPS/c00001.xhtml").decode()
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as w:
        w.writestr("x/p-002.xhtml", '<div class="main"><p style="opacity:0.4">甲</p><p>A</p><p></p></div><p>out</p>')
        w.writestr("x/toc.xhtml", "")
        w.writestr("x/p-001.xhtml", "")
    (tmp_path / "src.epub").write_bytes(buf.getvalue())
    ch = readers.epub_chapters(readers.files(spark, str(tmp_path), "src.epub")).collect()
    assert [(r.entry, [(p.text, p.style) for p in r.paragraphs]) for r in ch] == [("x/p-002.xhtml", [("甲", "opacity:0.4"), ("A", "")])]


def test_chapter_files_and_layouts(spark, tmp_path):
    s = spark.createDataFrame([("b", 1, 1, "Chapter_1_Segment_1", "T", "x"), ("b", 2, 2, "Chapter_1_Segment_2", "T", "y")], "book string, ord long, row_id long, id string, title string, content string")
    writers.write_json_files(reshape.chapter_nested(s, ["book"]), ["book"], str(tmp_path / "j")).collect()
    assert json.load(open(tmp_path / "j" / "b_chapter_001.json"))["total_segments"] == 2
    writers.write_chapter_texts(reshape.text_chapters(s, ["book"]), ["book"], str(tmp_path / "t")).collect()
    assert open(tmp_path / "t" / "b_00001.txt").read() == "Chương 1: T\n\nx\n\ny\n\n"
    crawl = spark.createDataFrame([("b", 1, "V1", "A", "x"), ("b", 2, "V1", None, ""), ("b", 3, "V2", "C", "z")], "book string, chapter_num int, volume string, title string, content string")
    blocks = writers.crawl_blocks(crawl, "book", ["chapter_num"])
    whole = "=== b ===\n\n\nV1:\n\nChương 1: A\nx\n\nChương 2:\nV2:\n\nChương 3: C\nz\n"
    assert writers.text_of_blocks(blocks, ["book"]).first().text == whole
    assert writers.text_of_blocks(writers.crawl_blocks(crawl.where("chapter_num > 2"), "book", ["chapter_num"], start=3), ["book"]).first().text == "\nV2:\n\nChương 3: C\nz\n"
    writers.write_blocks(blocks, ["book"], str(tmp_path / "crawl"))
    parts = sorted((tmp_path / "crawl" / "book=b").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == whole.replace("Chương 2:", "Chương 2:\n")
    assert writers.text_of_blocks(writers.sequential_blocks(crawl, "book", ["chapter_num"]), ["book"]).first().text.startswith("Chapter 1: A\nx\n\nChapter 2: \n(Không có nội dung)\n\n")
    log = spark.createDataFrame([(1, "l1", True, 2, 3), (2, "l2", False, None, None)], "n int, line string, ok boolean, in_tokens long, out_tokens long")
    assert "".join(r.block for r in writers.log_blocks("h", log, ["n"]).orderBy("part", "at").collect()) == "h\nl1\nl2\n\nRequests: 2, failed: 1, tokens in: 2, out: 3\n"
    assert spark.sql("select timestamp'2025-01-02 10:00:00' t").select(writers.backup_name(F.lit("a.yaml"), F.col("t"))).first()[0] == "020125_1000_backup_a.yaml"
    line = spark.sql("select timestamp'2025-01-01 10:00:00' t").select(writers.log_line(F.col("t"), F.lit("a"), F.lit(True), F.lit(1), F.lit(2), F.lit(None).cast("string"))).first()[0]
    assert line == "[2025-01-01 10:00:00] a: THÀNH CÔNG | Tokens: In=1, Out=2"


def test_catalogs(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"index": 2, "title": "a", "url": "u"}, {"index": 2, "title": "b", "url": "v"}, {"index": 1, "title": "c", "url": "w"}]))
    assert sorted(map(tuple, readers.catalog(readers.json_files(spark, str(tmp_path / "c.json"))).drop("path").collect())) == [(1, "c", "w"), (2, "b", "v")]
    assert [tuple(r)[1:] for r in readers.ground_truth(readers.json_files(spark, str(tmp_path / "c.json"))).orderBy("position").collect()] == [(1, "a"), (2, "b"), (3, "c")]
    df = spark.createDataFrame([("b", 1, "第3章 x", "u", ["u", "v"]), ("b", 2, "第3章 y", "w", None), ("b", 3, None, "", [])], "book string, cat_id long, title string, url string, urls array<string>")
    assert [(r.at, r.link) for r in readers.catalog_links(df, ["cat_id"], []).orderBy("cat_id", "at").collect()] == [(0, "u"), (1, "v"), (0, "w")]
    assert [(r.number, r.title) for r in readers.catalog_by_title(df, ["book"], "cat_id").collect()] == [(3, "第3章 y")]


def test_streaming(spark, tmp_path, data):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("l1\n\nl2\n")
    (tmp_path / "in" / "g.txt").write_bytes("第一章 风起云涌，少年出山。".encode("gbk"))
    (tmp_path / "in" / "u.txt").write_bytes("Chương một".encode("utf-16"))
    got = []
    q = stream.write_batches(stream.packed_stream(stream.text_stream(spark, str(tmp_path / "in")), 12), str(tmp_path / "ck"), lambda df, n: got.extend((r.segment, r.content) for r in df.collect()))
    q.awaitTermination(60)
    assert sorted(got) == [(0, "Chương một"), (0, "l1\n\nl2"), (0, "第一章 风起云涌，少年出山。")]
    os.makedirs(tmp_path / "ev")
    spark.read.parquet(f"{data}/events.parquet").write.mode("overwrite").parquet(str(tmp_path / "ev"))
    ev = stream.event_counts(spark.readStream.schema(spark.read.parquet(str(tmp_path / "ev")).schema).parquet(str(tmp_path / "ev")))
    q = ev.writeStream.outputMode("complete").format("memory").queryName("ev_counts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.sql("select sum(n) from ev_counts").first()[0] == spark.read.parquet(f"{data}/events.parquet").count()
