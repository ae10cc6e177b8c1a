"""Operators on tables: reshaping, filters, buckets, joins, HTML, counters, transform, history."""

import pytest
from pyspark.sql import functions as F

from inkloom.functions import ids
from inkloom.operators import buckets, filters, html, incremental, quality, ranks, reconcile, reshape, transform


def seg(spark, rows):
    return spark.createDataFrame([("b", i, i, *r) for i, r in enumerate(rows)], "book string, ord long, row_id long, id string, title string, content string")


def test_merging_and_grouping(spark):
    s = seg(spark, [("Chapter_2_Segment_2", "T2", "b"), ("Chapter_2_Segment_1", "T1", "a"), ("Volume_1_Chapter_2_Segment_3", "V", "v"), ("foo", "x", "y"), ("Chapter_3_Segment_1", None, None), (None, None, None)])
    got = {r.chapter: (r.id, r.title, r.content, r.n_segments) for r in reshape.merge_chapters(s, ["book"]).collect()}
    assert got == {2: ("Chapter_2", "T2", "b\n\na", 2), 3: ("Chapter_3", "Chapter 3", "", 1)}
    n = reshape.chapter_nested(s, ["book"])
    assert {r.chapter_number: r.total_segments for r in n.collect()} == {2: 3, 3: 1}
    assert reshape.chapter_index(n, ["book"]).first().chapters[0].filename == "chapter_002.json"
    assert [(r.chapter_key, r.position) for r in reshape.book_chapters(s, ["book"]).orderBy("position").collect()] == [("Chapter_2", 1), ("Volume_1_Chapter_2", 2)]
    assert [(r.volume, r.header, r.text) for r in reshape.text_chapters(s, ["book"]).where("chapter = 2").orderBy("position").collect()] == [(1, "Quyển 1 - Chương 2: V", "v"), (None, "Chương 2: T2", "a\n\nb")]
    assert [r.content for r in reshape.upload_files(s, ["book"]).where("chapter = 2").collect()] == ["a\n\nb\n\nv"]
    v = seg(spark, [(f"Volume_{v}_Chapter_{c}_Segment_1", "t", f"{v}.{c}") for v in (1, 11) for c in (2, 1, 3)])
    assert sorted(r.content for r in reshape.upload_plan(v, ["book"], "Volume_1", 2).collect()) == ["1.1", "1.2"]
    one = reshape.with_segment_ids(spark.createDataFrame([("Chapter_4", " a\nb "), ("x", "a\nb"), (None, None)], "id string, content string")).collect()
    assert [tuple(r) for r in one] == [("Chapter_4_Segment_4", "a\n\nb"), ("x", "a\nb"), (None, None)]
    assert [tuple(r) for r in reshape.unique_chapters(seg(spark, [("Chapter_1_Segment_1", " ", ""), ("Chapter_1_Segment_2", "B", ""), ("Chapter_1_Segment_3", "C", "")]), ["book"]).collect()] == [("b", "Chapter_1", "B")]


def test_titles_from_content(spark):
    s = seg(spark, [("i", "old", "\n\n'Tên\n\nbody\n"), ("i", "old", " \n"), ("i", "old", None), ("i", "old", "only")])
    assert [r.title for r in reshape.retitled(s).orderBy("ord").collect()] == ["Tên", "old", "old", "only"]
    assert [r.content for r in reshape.retitled(s, remove=True).orderBy("ord").collect()] == ["body\n", " \n", None, ""]


def test_pages_and_chains(spark):
    cat = spark.createDataFrame([("b", 1, 1, "u1", ["u1", "u2", "u3"]), ("b", 2, 2, "u4", None), ("b", 3, 3, "u9", None)], "book string, chapter_num int, cat_id long, url string, urls array<string>")
    pages = spark.createDataFrame([(1, "u1", None, "V", "", "u2", False), (2, "u2", "T2", "V", "c2", "u3", True), (3, "u3", "", None, "c3", "u2", True), (4, "u4", "T4", "W", "c4", None, True)], "page_id long, url string, title string, volume string, content string, next_url string, success boolean")
    got = {r.chapter_num: (r.title, r.volume, r.content) for r in reshape.merge_pages(cat, pages).collect()}
    assert got == {1: ("", "", "T2\n\nc2\n\nc3"), 2: ("T4", "W", "c4")}
    assert [(r.step, r.url) for r in reshape.chain(pages, "u2").orderBy("step").collect()] == [(1, "u2"), (2, "u3")]
    assert reshape.chain(pages, "nowhere").count() == 0
    vol = spark.createDataFrame([("b", i, v) for i, v in enumerate([None, "A", "A", " ", "A", "B", "A"])], "book string, n int, volume string")
    assert sorted(r.n for r in reshape.volume_changes(vol, "book", ["n"]).collect()) == [1, 5, 6]


def test_bilingual(spark):
    p = [("t1", "opacity:0.4"), ("t2", ""), ("a", "opacity:0.4"), ("b", ""), ("c", None)]
    df = spark.createDataFrame([(1, p), (2, [("x", "")]), (3, None)], "k int, p array<struct<text: string, style: string>>")
    assert sorted((r.k, r.lang, r.title, list(r.lines)) for r in reshape.split_languages(df, ["k"], "p").collect()) == [(1, "JP", "t1", ["a"]), (1, "ZH", "t2", ["b", "c"])]


def test_filters_and_buckets(spark):
    s = seg(spark, [(i, "", "") for i in ("Volume_2_Chapter_3_Segment_7", "Volume_2_Chapter_5_Segment_1", "Chapter_0_Segment_1", "Chapter_100_Segment_2", "Chapter_101_Segment_2", "foo")])
    pick = lambda df: [r.ord for r in df.orderBy("ord").collect()]
    assert pick(filters.chapter_range(s, volumes=(1, 2), chapters=(5, 100))) == [1, 3]
    assert pick(filters.chapter_range(s, enabled=False)) == [0, 1, 2, 3, 4, 5]
    assert pick(filters.segment_range(s, segments=(2, 7))) == [0, 3, 4]
    assert pick(filters.segments_filter(s, {"filter_mode": "segment", "segment_filter": {"enabled": True, "start_segment": 7}})) == [0]
    assert pick(filters.segments_filter(s, {"filter_mode": "none"})) == [0, 1, 2, 3, 4, 5]
    assert tuple(filters.bounds(s, ["book"]).first()) == ("b", 0, 101)
    with pytest.raises(ValueError):
        filters.checked_range(s, 0, 500)
    assert pick(filters.checked_range(s, 1, 101)) == [3, 4]
    assert [r.batch_name for r in buckets.by_volume(s).orderBy("ord").collect()] == ["Vol2", "Vol2", "Vol1", "Vol1", "Vol1", "Vol1"]
    assert [r.batch_name for r in buckets.by_aligned_range(s).orderBy("ord").collect()][2:5] == ["Ch-99-000", "Ch001-100", "Ch101-200"]
    t = seg(spark, [(f"Chapter_{c}_Segment_1", "", "") for c in range(3, 13)])
    assert sorted({r.batch_name for r in buckets.by_range_from_first(t, ["book"], 4).collect()}) == ["11_12.yaml", "3_6.yaml", "7_10.yaml"]
    assert [r.rows_so_far for r in buckets.batch_totals(buckets.by_aligned_range(t, 5).withColumn("ok", F.lit(True))).orderBy("batch_no").collect()] == [3, 8, 10]


def test_reconciling(spark):
    src = seg(spark, [("a", "sa", "a"), ("b", "sb", "b"), ("c", "sc", "c"), ("a", "sa", "a")])
    done = spark.createDataFrame([("b", "c", 1, None, None), ("b", "a", 2, "v1", "1"), ("b", "a", 3, "v2", "2"), ("b", "z", 4, "x", "x")], "book string, id string, tr_id long, title string, content string")
    got = reconcile.restore_order(src, done, ["book", "id"], ["tr_id"]).orderBy("ord").collect()
    assert [(r.id, r.title, r.content, r.translated) for r in got] == [("a", "v2", "2", True), ("b", "sb", "b", False), ("c", None, None, True), ("a", "v2", "2", True)]
    assert [r.patched for r in reconcile.patch(src, done, ["book", "id"], ["tr_id"]).orderBy("ord").collect()] == [True, False, True, True]
    log = spark.createDataFrame([(1, "f", "[t] a: THÀNH CÔNG | x"), (2, "f", "[t] b: THẤT BẠI - Lỗi: timeout"), (3, "f", "[t] Title_Chapter_1: THẤT BẠI"), (4, "f", None), (5, "f", "[t")], "log_id long, log_file string, line string")
    failed = reconcile.failed_ids(log)
    assert [r.id for r in failed.collect()] == ["b"]
    assert [r.row_id for r in reconcile.failed_sources(failed, src, ["id"]).collect()] == [1]
    assert sorted(r.id for r in reconcile.difference(src, done, ["id"]).collect()) == ["b"]
    assert sorted(map(tuple, reconcile.coverage(src.select("id"), done.select("id"), ["id"]).collect())) == [("b", "missing"), ("z", "extra")]
    titles = spark.createDataFrame([("b", "Chapter_1", "new")], "book string, chapter_key string, title string")
    assert [r.title for r in reconcile.merge_titles(seg(spark, [("Chapter_1_Segment_1", "o", ""), ("x", "o", "")]), titles, ids.chapter_key(F.col("id")), ["book"]).orderBy("ord").collect()] == ["new", "o"]


def test_html_by_site():
    page = "<html><head><script>var b = {chaptername: 'T', next_page: 'p2.html'}</script></head><h1 class=\"hide720\">T</h1><div class=\"txtnav\"><h1 class=\"hide720\">T</h1><div class=\"txtinfo x\"><div>i</div></div>T<br>one<br/><script>\"</p>\"</script>two<div class='keep'>in</div></div>FOOTER"
    r = html.parse_page(page, "https://h/a/p1.html", "shuba")
    assert r == {"title": "T", "volume": "", "content": "'one\n\ntwoin", "next_url": "https://h/a/p2.html", "success": True}
    cz = "<div class='name'>N</div><div class=\"content\">a<div>x</div>b<br>c</div>FOOTER<a class=\"next-chapter\" href=\"//h/2\">n</a>"
    assert html.parse_page(cz, "https://h/1", "czbooks") == {"title": "N", "volume": "", "content": "axb\nc", "next_url": "https://h/2", "success": True}
    assert html.parse_page("<p>x</p>", "u", "czbooks")["success"] is False and html.parse_page("<p>x</p>", "u", "no") is None and html.parse_page(None, None, "tw") is None
    pt = "<h1>书名 第1章</h1><a href='2.html'>下一章</a><div id='content'>a<br>　　正文<br><br>上一章<br>第2章<br>末<center><script>x</script></center>y<div class=\"bottomlink\">z</div></div>FOOTER"
    assert html.parse_page(pt, "https://h/b/1.html", "piaotia") == {"title": "第1章", "volume": "", "content": "正文\n\n第2章\n\n末y", "next_url": "https://h/b/2.html", "success": True}
    assert html.parse_page("<h1>书名 第1章</h1><div id='content'>a</div>", "u", "piaotia")["content"] == ""
    dx = "<div id=\"ChapterTitle\">C</div><div id='Lab_Contents'><p id=\"txt_1\">He paid 2024</p><p id=\"txt_2\"> </p><p>AD</p></div><p id='txt_9'>FOOTER</p>"
    assert [html.parse_page(dx, "u", "dxmwx", strict)["content"] for strict in (False, True)] == ["He paid 2024", "He paid"]
    assert html.parse_page('<script>var ChapterTitle = "J";</script>', "u", "dxmwx")["title"] == "J"
    li = "<h3>第1卷</h3><div id='atitle'>A</div><div id=\"acontent\"><p>x</p><p> </p><p>y&amp;</p></div><p>FOOTER</p>"
    assert html.parse_page(li, "u", "tw") == {"title": "A", "volume": "第1卷", "content": "x\n\ny&", "next_url": None, "success": True}
    hj = '<h1>T</h1><div style="color:red"><p>no</p></div><div style="font-size: 20px; line-height: 30px; width: 750px"><p>黃金屋</p><p><a href="/">l</a></p><p>我的超能力每周刷新 1</p><p>黃金屋 again</p></div><p>FOOTER</p>'
    assert html.parse_page(hj, "u", "hjwzw")["content"] == "黃金屋 again"
    assert html.parse_page("<h1 class='headline'>T</h1><div id='content'><p>no</p></div><div class='articlebody'><div id='content'><p>a</p></div><p>FOOTER</p></div>", "u", "quanben")["content"] == "a"
    st = "<h1 class='pt10'>T</h1><div class='readcotent'>a<ins class='adsbygoogle'>AD</ins><br>STO55.COM<br>b&nbsp;c</div><a id='linkNext' href='/book/57037/'>n</a>"
    assert html.parse_page(st, "https://sto55.com/book/57037/1.html", "sto55") == {"title": "T", "volume": "", "content": "'a\n\nb c", "next_url": "https://sto55.com/book/57037/", "success": True}
    for site in html.PARSERS:
        assert html.parse_page("", "u", site)["content"] == ""


def test_neighbours_of_hot_keys(spark):
    """Positions and previous values are the same whether a key is sorted in one task or in ranges."""
    rows = spark.createDataFrame([("a" if i % 3 else None, (i * 7) % 50, i) for i in range(60)], "k string, o int, id int")
    for f in (lambda most: ranks.positions(rows, ["k"], ["o", "id"], "n", most), lambda most: ranks.previous(rows, ["k"], ["o", "id"], "id", "n", most)):
        assert sorted(map(str, f(5).collect())) == sorted(map(str, f(1000).collect()))


def test_null_keys_keep_their_rows(spark):
    """Rows without a book, number or title are ordered and written like others, and clashing column names stay apart."""
    from inkloom.sources import writers

    pages = spark.createDataFrame([(1, None, None, None, None, None), (2, None, 1, "V", "T", "x"), (3, "b", None, " ", None, "y"), (4, "b", None, None, "U", "")], "page_id long, book string, chapter_num int, volume string, title string, content string").withColumn("position", F.lit(9)).withColumn("block", F.lit("z"))
    got = writers.crawl_blocks(pages.drop("position", "block"), "book", ["chapter_num", "page_id"])
    assert sorted((r.book or "", r.position, r.block) for r in got.collect()) == [("", 0, "===  ===\n\n"), ("", 1, "\nChương :"), ("", 2, "\nV:\n\nChương 1: T\nx\n"), ("b", 0, "=== b ===\n\n"), ("b", 1, "\nChương :\ny\n"), ("b", 2, "\nChương : U")]
    assert writers.crawl_order(pages.drop("position"), "book", ["page_id"]).count() == 4
    assert writers.sequential_blocks(pages.drop("position", "block"), "book", ["page_id"]).count() == 4
    s = spark.createDataFrame([(None, 1, 1, "Chapter_1_Segment_1", None, "x"), (None, 2, 2, "Volume_1_Chapter_1_Segment_1", "T", "y"), (None, 3, 3, None, "T", "y")], "book string, ord long, row_id long, id string, title string, content string")
    assert [r.position for r in reshape.text_chapters(s, ["book"]).orderBy("position").collect()] == [1, 2]
    assert reshape.book_chapters(s, ["book"]).count() == 2 and reshape.upload_plan(s, ["book"], "Volume_1", 1).count() == 1
    assert quality.progress(s.select("book", "row_id"), ["book"], ["row_id"]).count() == 3
    empty = s.where("false")
    assert reshape.text_chapters(empty, ["book"]).count() == 0 and ranks.positions(empty, ["book"], ["ord"]).count() == 0


def test_counters(spark):
    log = spark.createDataFrame([(1, "f", "[2025-01-01 10:00:00] a: THÀNH CÔNG | Tokens: In=3, Out=5"), (2, "f", "[2025-01-01 10:00:00] Title_1: THẤT BẠI - Lỗi: x"), (3, "f", None)], "log_id long, log_file string, line string")
    r = quality.token_summary(quality.parse_log(log), ["log_file"]).first()
    assert (r.requests, r.content_requests, r.total_tokens, r.n_ok, r.n_failed) == (3, 1, 8, 1, 1)
    pages = spark.createDataFrame([("s", "u", True), ("s", "u", False), ("s", "v", None)], "site string, url string, success boolean")
    r = quality.crawl_summary(pages, ["site"]).first()
    assert (r.fetches, r.n_pages, r.retries, r.n_ok, r.success_rate) == (3, 2, 1, 1, 50.0)
    st = spark.createDataFrame([("a", "success"), ("a", "error"), ("b", "skip")], "k string, status string")
    assert [r.n_rows for r in quality.status_summary(st, "k", "status").where("is_total").collect()] == [3]
    marked = st.withColumn("ok", F.col("status") == "success")
    assert tuple(quality.outcome(marked, ["k"], "ok").where("k = 'a'").first()) == ("a", 1, 1)
    assert sorted(map(tuple, quality.failures(marked, ["k"], "status", "ok").collect())) == [("a", "error"), ("b", "skip")]


def test_transform_keeps_or_drops_failures(spark):
    df = spark.createDataFrame([(1, "x"), (2, "bad"), (3, None)], "k int, content string")
    got = transform.transform(df, transform.Stub(fail_on="bad"), retries=1).orderBy("k").collect()
    assert [(r.content, r.ok, r.attempts) for r in got] == [("[stub] x", True, 1), ("bad", False, 2), ("[stub] ", True, 1)]
    assert transform.transform(df, transform.Stub(fail_on="bad"), keep_failed=False).count() == 2
    assert df.where("k = 1").select(transform.stub_answer(F.col("content"))).first()[0] == "[stub] x"
    with pytest.raises(ValueError):
        transform.provider("none")
    rr = transform.round_robin(spark.createDataFrame([(i, "g") for i in range(5)], "i int, g string"), 3, ["g"], ["i"])
    assert [r.worker for r in rr.orderBy("i").collect()] == [0, 1, 2, 0, 1]


def test_history(spark):
    files = incremental.hashed(spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3"), ("d", "4"), ("e", "5")], "rel_path string, text string"), "text")
    old = files.where("rel_path in ('b', 'c', 'd')").select("rel_path", F.lit("m").alias("mode"), F.when(F.col("rel_path") == "c", "x").otherwise(F.col("file_hash")).alias("file_hash"), F.lit(1).alias("processed_date"), F.lit("o").alias("output_file"))
    old = old.withColumn("mode", F.when(F.col("rel_path") == "d", "other").otherwise(F.col("mode")))
    modes, outputs = spark.createDataFrame([("m",)], "mode string"), spark.createDataFrame([(x, "m") for x in "bcde"], "rel_path string, mode string")
    p = incremental.plan(files, modes, old, outputs)
    assert {r.rel_path: r.reason for r in p.collect()} == {"a": "no output", "b": "up to date", "c": "changed", "d": "mode missing", "e": "untracked"}
    assert incremental.missing_operations(p).count() == 4
    assert {r.reason for r in incremental.plan(files, modes, old, outputs, force=True).collect()} == {"forced"}
    new = old.where("rel_path = 'b'").withColumn("processed_date", F.lit(2)).withColumn("file_hash", F.lit("new"))
    assert {(r.rel_path, r.file_hash) for r in incremental.updated_history(old, new).where("rel_path = 'b'").collect()} == {("b", "new")}
    ck = spark.createDataFrame([("s", 1), ("t", 1)], "series_name string, chapter_count int")
    saved = incremental.save_checkpoint(ck, spark.createDataFrame([("s", 5)], "series_name string, chapter_count int"))
    assert {tuple(r) for r in saved.collect()} == {("s", 5), ("t", 1)}
    assert incremental.delete_checkpoint(saved, "s").count() == 1


def test_book_pages(spark):
    p = "<div class=\"booknav2\"><h1><a>Tên</a></h1><p><a href='/author/x'>A</a></p><p><a href=\"/class/1\">Huyền</a></p></div><div class='bookimg2'><img src=\"/c.jpg\"></div><script>tags: 'a|b |'</script><div class=\"navtxt\">x<br>y&amp;</div>"
    r = spark.range(1).select(html.novel_info(F.lit(p), F.lit("https://h/b/1.html")).alias("r"), html.novel_info(F.lit(""), F.lit("u")).alias("e")).first()
    assert (r.r.title, r.r.cover, r.r.author, list(r.r.tags), r.r.synopsis) == ("Tên", "https://h/c.jpg", "A", ["a", "b", "Huyền"], "x\ny&")
    assert (r.e.title, r.e.cover, r.e.author, list(r.e.tags)) == (None, None, None, [])
    assert html._info(p.replace("</p></div>", "</p><p><a href='/top/1'>Top</a></p></div>"), "u")["tags"] == ["Top"]
    c = "<div id=\"catalog\"><div><ul><li><a href='1.html'>第1章</a></li><li><a href='2.html'>第2章</a></li></ul></div></div><ul><li><a href='f'>FOOTER</a></li></ul>"
    got = spark.range(1).select(html.novel_chapters(F.lit(c), F.lit("https://h/b/"), 1).alias("r")).first().r
    assert [tuple(x) for x in got] == [(1, 1, "第1章", "https://h/b/1.html"), (2, 2, "第2章", "https://h/b/2.html")]
    q = "<div class='newbox'><ul><li><a href='/b/1'>i</a><h3><a imgbox='1'>i</a><a>the book</a></h3><div class='zxzj'><p>第9章</p></div></li></ul></div>"
    assert [tuple(x) for x in spark.range(1).select(html.search_results(F.lit(q), F.lit("https://h/s")).alias("r")).first().r] == [("The Book", "https://h/b/1", "Latest: 第9章")]


def test_titles_and_progress(spark):
    s = seg(spark, [("Chapter_1_Segment_1", "A", ""), ("Chapter_1_Segment_2", "A", ""), ("Chapter_2_Segment_1", "bad", "")])
    got = {r.chapter_key: (r.title, r.ok) for r in transform.transform_titles(s, transform.Stub(fail_on="bad"), ["book"]).collect()}
    assert got == {"Chapter_1": ("[stub] A", True), "Chapter_2": ("bad", False)}
    assert [r.done_percent for r in quality.progress(s, ["book"], ["ord"]).orderBy("ord").collect()] == [33.3333, 66.6667, 100.0]
