"""The registered queries of the core: operators over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions import ids
from inkloom.functions import text as T
from inkloom.operators import buckets, classify, filters, html, incremental, pack, quality, ranks, reconcile, reshape, sections, transform
from inkloom.plans.inputs import ADDRESSES, FOOT, FORMS, NAV, PAGES
from inkloom.plans.oracles import SQL
from inkloom.plans.oracles_io import SQL as SQL_IO
from inkloom.runtime import shared_dir, spread, table
from inkloom.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
FOUND: dict[str, Query] = {}


def query(f: Query) -> Query:
    FOUND[f.__name__] = f
    return f


def segments(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "segments").select("row_id", "book", "ord", "id", "title", "content")


# texts and ids


@query
def split_lines(spark, d):
    return sections.lines(table(spark, d, "documents"), "doc_id", "text").where("line <> ''")


@query
def nonspace_len(spark, d):
    return table(spark, d, "documents").select("doc_id", T.nonspace_len(F.col("text")).alias("n"))


@query
def clean_text(spark, d):
    return segments(spark, d).select("row_id", T.clean_text(F.col("content")).alias("content"))


@query
def clean_answer(spark, d):
    return table(spark, d, "translations").select("tr_id", T.clean_answer(F.col("content")).alias("content"))


@query
def base_clean(spark, d):
    return table(spark, d, "crawl_pages").select("page_id", T.base_clean(F.col("content")).alias("content"))


@query
def xml_clean(spark, d):
    return table(spark, d, "crawl_pages").select("page_id", T.xml_clean(F.col("content")).alias("content"))


@query
def para_html(spark, d):
    return segments(spark, d).select("row_id", T.paragraphs_html(F.col("content")).alias("html"))


@query
def sentence_paragraphs(spark, d):
    return segments(spark, d).select("row_id", T.sentence_paragraphs(F.col("content")).alias("content"))


@query
def id_parse_all(spark, d):
    c, p, k = ids.chapter_of(F.col("id")), ids.parts_of(F.col("id")), ids.digits_key(F.col("id"))
    return segments(spark, d).select(
        "row_id", c["volume"].alias("r1_volume"), c["chapter"].alias("r1_chapter"), ids.segment_of(F.col("id")).alias("r2_segment"), ids.chapter_key(F.col("id")).alias("r3_key"),
        ids.anchored_chapter(F.col("id")).alias("r4_chapter"), ids.volume_blind_chapter(F.col("id")).alias("r5_chapter"), p["volume"].alias("r6_volume"), p["chapter"].alias("r6_chapter"), p["segment"].alias("r6_segment"),
        ids.upload_key(F.col("id")).alias("r7_key"), k["major"].alias("r8_major"), k["minor"].alias("r8_minor"),
    )


@query
def output_names(spark, d):
    b = table(spark, d, "books")
    stem = F.regexp_replace("book", "^b", "")
    return b.select(
        "book", T.name_key(F.col("book")).alias("name_key"), T.safe_name(F.col("book_title")).alias("safe_name"), T.output_name(F.col("content_type"), stem, "context", "yaml").alias("output_name"), T.split_name(F.concat(F.col("book"), F.lit("_"), F.col("split_mode")), "yaml").alias("split_name"),
        T.stamped_name(F.col("added_at"), F.lit("oai"), F.col("book"), F.col("split_mode")).alias("stamped_name"), T.shorten(F.concat("book_title", F.lit(" / "), "book_title", F.lit(" / "), "book_title")).alias("shortened"), T.mask(F.concat("book", F.lit("_secret_"), "book")).alias("masked"),
    )


# classifiers and sections


def raw_docs(spark, d) -> DataFrame:
    return spread(table(spark, d, "documents").select("doc_id", "text"))


def structured(spark, d, **kw) -> DataFrame:
    return sections.structure(raw_docs(spark, d), "doc_id", "text", **kw)


def section_rows(structured: DataFrame) -> DataFrame:
    return sections.sections(structured, "doc_id").select("doc_id", "section", "section_id", "volume", "chapter", "title", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("text"))


@query
def detect_headings(spark, d):
    return sections.headings(raw_docs(spark, d), "doc_id", "text")


@query
def sections_from_lines(spark, d):
    return section_rows(structured(spark, d))


@query
def sections_strict(spark, d):
    """Sections where a repeated heading right below text opens one of its own."""
    return section_rows(structured(spark, d, strict_compat=True))


@query
def heading_forms(spark, d):
    """Every form of a heading with the number and title of each catalog entry."""
    c = table(spark, d, "chapter_catalog").select("cat_id", F.coalesce("chapter_num", F.lit(1)).cast("string").alias("n"), F.coalesce("title", F.lit("")).alias("t"))
    wide = F.translate("n", "0123456789", "０１２３４５６７８９")
    forms = F.array(*[F.replace(F.replace(F.replace(F.lit(f), F.lit("{n}"), F.col("n")), F.lit("{t}"), F.col("t")), F.lit("{w}"), wide) for f in FORMS])
    rows = c.select("cat_id", F.posexplode(forms).alias("form", "line"))
    return rows.select("cat_id", "form", classify.heading(F.col("line")).alias("h")).select("cat_id", "form", "h.kind", "h.number", "h.title")


@query
def out_of_order_chapters(spark, d):
    """Chapter numbers of crawled headings out of sequence, by book."""
    pages = table(spark, d, "crawl_pages")
    rows = pages.select("book", F.col("page_id").alias("line_no"), classify.chapter_number(F.col("title")).alias("number")).where("number is not null").withColumn("kind", F.lit("chapter"))
    return sections.order_warnings(rows, "book")


@query
def chapter_classes(spark, d):
    c = classify.chapter_class(F.col("title"))
    return table(spark, d, "chapter_catalog").select("cat_id", c["type"].alias("type"), c["number"].alias("number"), c["title"].alias("title"), c["is_special"].alias("is_special"))


@query
def route_real(spark, d):
    """Addresses of the sites, of their mirrors and of others, for each page."""
    urls = F.array(*[F.replace(F.lit(a), F.lit("{}"), F.col("page_id").cast("string")) for a in ADDRESSES])
    return table(spark, d, "crawl_pages").select("page_id", F.explode(urls).alias("url")).select("page_id", "url", classify.route(F.col("url")).alias("parser"))


@query
def route_url(spark, d):
    """The pages' own addresses: no site of the list, so by the first part of their host."""
    sites = (("slowreader", "site_a"), ("canxue", "site_b"), (".example", "site_c"), (".invalid", "site_d"))
    u = F.col("url")
    return table(spark, d, "crawl_pages").select("page_id", classify.route(u).alias("parser"), classify.route(u, sites).alias("site"))


@query
def parsers_by_name(spark, d):
    """Parsers by type name in any case, for the names of all aliases, sources and providers."""
    names = spark.createDataFrame([(x,) for a in classify.ALIASES for x in (a, a.upper(), a.title())], "name string")
    names = names.unionByName(table(spark, d, "documents").select(F.col("source").alias("name"))).unionByName(table(spark, d, "translations").select(F.col("provider").alias("name"))).distinct()
    return names.select("name", classify.parser_by_name(F.col("name")).alias("parser"), transform.provider_of(F.col("name")).alias("provider"), T.thinks(F.concat("name", F.lit("-2.5-pro"))).alias("thinks"), T.thinks(F.col("name")).alias("plain_thinks"))


@query
def content_types(spark, d):
    kinds = {"WebNovel": "yunji_raw", "Urban": "moque_raw", "Forum": "oldforum_raw"}
    return table(spark, d, "documents").select("doc_id", classify.content_type(F.col("path"), kinds).alias("content_type"))


@query
def file_titles(spark, d):
    stem = F.regexp_replace(F.regexp_replace("log_file", r"\.log$", ""), "-", "")
    return table(spark, d, "request_log").select("log_id", classify.chapter_of_file(F.col("log_file"), F.col("log_id").cast("int")).alias("chapter"), classify.book_title_of_file(F.regexp_replace(stem, r"^\d\d", "")).alias("title"))


# packing


def packed(spark, d, most: int = 2000) -> DataFrame:
    lines = F.filter(F.transform(T.split_lines(F.col("text")), T.strip_u), lambda x: x != "")
    return pack.pack_lines(spread(table(spark, d, "documents").select("doc_id", "lang", "text")), ["doc_id", "lang"], lines, most)


@query
def pack_segments(spark, d):
    return packed(spark, d).select("doc_id", "segment", "n_chars", "content")


@query
def pack_stats_by_lang(spark, d):
    return packed(spark, d).groupBy("lang").agg(F.count("*").alias("n_segments"), F.countDistinct("doc_id").alias("n_docs"), F.sum("n_chars").alias("n_chars"), F.max("n_chars").alias("largest"))


@query
def section_segments(spark, d):
    """Sections packed into segments with ids over the whole text."""
    return pack.segments_of_sections(structured(spark, d), "doc_id", 500)


@query
def section_simple_segments(spark, d):
    return pack.render(structured(spark, d), "doc_id", "yaml", 2)


@query
def section_plain_segments(spark, d):
    return pack.render(structured(spark, d), "doc_id", "txt", 1, 800)


@query
def section_text_segments(spark, d):
    return pack.render(structured(spark, d), "doc_id", "txt", 2)


@query
def section_text_layout(spark, d):
    """Each text as its segments are written to a text file."""
    return pack.text_layout(structured(spark, d), "doc_id", 1, 800)


@query
def section_simple_layout(spark, d):
    """Each text as its sections are written to a text file."""
    return pack.text_layout(structured(spark, d), "doc_id", 2)


@query
def chapter_segments(spark, d):
    """Bilingual chapters packed, each segment below its title."""
    lines = F.filter(F.transform(F.split("content", "\n"), T.strip_u), lambda x: x != "")
    chapters = table(spark, d, "bilingual").select("bil_id", F.coalesce("ord", F.lit(0)).alias("chapter"), "title", lines.alias("lines"))
    return pack.segments_of_chapters(chapters, ["bil_id", "chapter", "title"], "lines", 300)


# reshaping


@query
def merge_chapters(spark, d):
    return reshape.merge_chapters(segments(spark, d), ["book"])


@query
def chapter_json(spark, d):
    n = reshape.chapter_nested(segments(spark, d), ["book"])
    return n.select("book", "chapter_number", "chapter_title", "total_segments", F.array_join(F.transform("segments", lambda x: x["id"]), "|").alias("ids"), F.array_join(F.transform("segments", lambda x: F.length(F.coalesce(x["content"], F.lit(""))).cast("string")), "|").alias("lengths"))


@query
def chapter_index(spark, d):
    i = reshape.chapter_index(reshape.chapter_nested(segments(spark, d), ["book"]), ["book"])
    return i.select("book", "total_chapters", "total_segments", F.array_join(F.transform("chapters", lambda x: F.concat(x["filename"], F.lit(":"), x["segments_count"])), "|").alias("files"))


@query
def epub_order(spark, d):
    return reshape.book_chapters(segments(spark, d), ["book"])


@query
def txt_order(spark, d):
    return reshape.text_chapters(segments(spark, d), ["book"])


@query
def upload_plan_topn(spark, d):
    return reshape.upload_plan(segments(spark, d), ["book"], "Volume_1", 3)


@query
def upload_files(spark, d):
    return reshape.upload_files(segments(spark, d), ["book"])


@query
def add_segment_suffix(spark, d):
    return reshape.with_segment_ids(reshape.merge_chapters(segments(spark, d), ["book"]).select("book", "id", "content"))


@query
def unique_chapter_titles(spark, d):
    return reshape.unique_chapters(segments(spark, d), ["book"])


@query
def first_line_title(spark, d):
    return reshape.retitled(segments(spark, d)).select("row_id", "title")


@query
def first_line_title_removed(spark, d):
    return reshape.retitled(segments(spark, d), remove=True).select("row_id", "title", "content")


@query
def catalog_numbering(spark, d):
    return reshape.numbered_catalog(table(spark, d, "chapter_catalog").select("cat_id", "book"), "book", "cat_id")


@query
def multi_url_merge(spark, d):
    return reshape.merge_pages(table(spark, d, "chapter_catalog"), table(spark, d, "crawl_pages"))


@query
def volume_change_marker(spark, d):
    return reshape.volume_changes(table(spark, d, "crawl_pages").select("page_id", "book", "chapter_num", "volume"), "book", ["chapter_num", "page_id"])


@query
def next_chain(spark, d):
    """The chain of pages from the first address of the catalog's first entry."""
    start = table(spark, d, "chapter_catalog").where("url <> ''").agg(F.min_by("url", "cat_id").alias("u")).first().u
    return reshape.chain(table(spark, d, "crawl_pages"), start)


@query
def long_chain(spark, d):
    """The chain through all pages in the order of their numbers: as long as the table."""
    p = table(spark, d, "crawl_pages").select("page_id").distinct()
    at = ranks.positions(p.withColumn("k", F.lit(1)), ["k"], ["page_id"], "at").select(F.concat(F.lit("p"), F.col("at")).alias("url"), F.concat(F.lit("p"), F.col("at") + 1).alias("next_url"), F.lit(True).alias("success"), F.col("at").alias("page_id"))
    return reshape.chain(at, "p1")


@query
def catalog_volumes(spark, d):
    return reshape.volume_totals(reshape.numbered_catalog(table(spark, d, "chapter_catalog").select("cat_id", "book"), "book", "cat_id"), ["book"])


@query
def bilingual_split(spark, d):
    """Chapters interleaved line by line, Chinese faded as in the source books, and split again."""
    b = table(spark, d, "bilingual").where("content is not null")
    style = F.when(F.col("lang") == "zh", "opacity:0.4").otherwise("")
    lines = b.select("book", "id", "bil_id", style.alias("style"), F.posexplode(F.filter(F.transform(F.split("content", "\n"), T.strip_u), lambda x: x != "")).alias("i", "text"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("i", "bil_id", "text", "style"))), lambda x: F.struct(x["text"].alias("text"), x["style"].alias("style")))
    out = reshape.split_languages(lines.groupBy("book", "id").agg(items.alias("p")), ["book", "id"], "p")
    return out.select("book", "id", "lang", "title", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("text"))


# filters and buckets


@query
def chapter_range(spark, d):
    return filters.chapter_range(segments(spark, d), volumes=(1, 2), chapters=(3, 40)).select("row_id", "id")


@query
def segment_range(spark, d):
    return filters.segment_range(segments(spark, d), segments=(5, 25)).select("row_id", "id")


@query
def chapter_bounds(spark, d):
    return filters.bounds(segments(spark, d), ["book"])


@query
def catalog_slice(spark, d):
    return filters.catalog_slice(table(spark, d, "chapter_catalog").select("book", "cat_id", "chapter_num"), ["book"], ["chapter_num", "cat_id"], 2, 6)


@query
def bucket_volume(spark, d):
    return buckets.by_volume(segments(spark, d)).select("row_id", "batch_no", "batch_name")


@query
def bucket_aligned(spark, d):
    return buckets.by_aligned_range(segments(spark, d), 20).select("row_id", "batch_no", "batch_name")


@query
def bucket_from_min(spark, d):
    return buckets.by_range_from_first(segments(spark, d), ["book"], 15).select("row_id", "batch_no", "batch_name")


@query
def batch_totals(spark, d):
    ok = F.col("content").isNotNull()
    return buckets.batch_totals(buckets.by_aligned_range(table(spark, d, "translations").select("id", ok.alias("ok")), 20))


# reconciling


def done(spark, d) -> DataFrame:
    return table(spark, d, "translations").select("tr_id", "book", "id", "title", "content")


@query
def restore_order_fallback(spark, d):
    return reconcile.restore_order(segments(spark, d), done(spark, d), ["book", "id"], ["tr_id"])


@query
def patch_failed(spark, d):
    s = table(spark, d, "bilingual").select("bil_id", "book", "id", "title", "content")
    return reconcile.patch(s, done(spark, d), ["book", "id"], ["tr_id"], T.clean_text)


@query
def merge_titles(spark, d):
    titles = reshape.unique_chapters(done(spark, d).withColumn("ord", F.col("tr_id")).withColumn("row_id", F.col("tr_id")), ["book"])
    return reconcile.merge_titles(segments(spark, d), titles, ids.chapter_key(F.col("id")), ["book"]).select("row_id", "title")


@query
def failed_ids(spark, d):
    return reconcile.failed_ids(table(spark, d, "request_log"))


@query
def failed_sources(spark, d):
    failed = reconcile.failed_ids(table(spark, d, "request_log")).withColumn("book", F.regexp_extract("log_file", r"_[a-z]+_(b\d+_[a-z]+)\.log$", 1))
    return reconcile.failed_sources(failed.select("log_id", "book", "id"), segments(spark, d), ["book", "id"])


@query
def untranslated(spark, d):
    return reconcile.difference(segments(spark, d), done(spark, d), ["book", "id"])


@query
def catalog_coverage(spark, d):
    return reconcile.coverage(table(spark, d, "crawl_pages"), table(spark, d, "chapter_catalog"), ["book", "chapter_num"])


@query
def catalog_lookup(spark, d):
    pages = table(spark, d, "crawl_pages").select("page_id", "book", "chapter_num")
    return reconcile.lookup(table(spark, d, "chapter_catalog"), pages, ["book", "chapter_num"])


@query
def catalog_by_number(spark, d):
    return readers.catalog_by_title(table(spark, d, "chapter_catalog"), ["book"], "cat_id")


@query
def catalog_links(spark, d):
    return readers.catalog_links(table(spark, d, "chapter_catalog"), ["cat_id", "book"], ["chapter_num"])


@query
def patch_titles(spark, d):
    return reconcile.patch_titles(done(spark, d), segments(spark, d), ["book", "id"], ["ord", "row_id"]).select("tr_id", "title")


# quality


def compared(spark, d) -> DataFrame:
    cat = reconcile.last_of(table(spark, d, "chapter_catalog"), ["book", "chapter_num"], ["title"], ["cat_id"]).withColumnRenamed("title", "listed")
    return table(spark, d, "crawl_pages").select("page_id", "book", "chapter_num", "title").join(cat, ["book", "chapter_num"])


@query
def title_similarity(spark, d):
    s = F.round(T.title_similarity(F.col("listed"), F.col("title")), 6)
    return compared(spark, d).select("page_id", s.alias("similarity"), T.similarity_band(T.title_similarity(F.col("listed"), F.col("title"))).alias("band"))


@query
def similarity_bands(spark, d):
    return compared(spark, d).groupBy(T.similarity_band(T.title_similarity(F.col("listed"), F.col("title"))).alias("band")).agg(F.count("*").alias("n_pages"))


@query
def parsed_log(spark, d):
    return quality.parse_log(table(spark, d, "request_log"))


@query
def token_summary(spark, d):
    return quality.token_summary(quality.parse_log(table(spark, d, "request_log")), ["log_file"])


@query
def crawl_summary(spark, d):
    return quality.crawl_summary(table(spark, d, "crawl_pages"), ["site"])


@query
def status_by_type(spark, d):
    tr = table(spark, d, "translations").join(table(spark, d, "books").select("book", "content_type"), "book")
    status = F.when(F.col("content").isNull(), "error").when(F.trim("content") == "", "skip").otherwise("success")
    return quality.status_summary(tr.select(F.coalesce("content_type", F.lit("none")).alias("content_type"), status.alias("status")), "content_type", "status")


@query
def round_robin(spark, d):
    return transform.round_robin(table(spark, d, "request_log").select("log_id", "log_file"), 3, ["log_file"], ["log_id"])


# html


@query
def html_text(spark, d):
    p = table(spark, d, "crawl_pages")
    made = F.concat(F.lit('<html><head><title>x</title><style>p{color:red}</style></head><body><h1>'), F.coalesce("title", F.lit("")), F.lit('</h1><script>var s = "</p>";</script><p>'), F.replace(F.coalesce("content", F.lit("")), F.lit("\n"), F.lit("<br/>")), F.lit("</p>&nbsp;&amp;</body></html>"))
    return p.select("page_id", html.strip_u(html.strip_tags(html.element(made, "h1"))).alias("title"), html.text_of(html.element(made, "body")).alias("text"))


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


@query
def html_sites(spark, d):
    """Each page as one of the sites prints it, and what its parser gets out of it."""
    p = spread(table(spark, d, "crawl_pages").select("page_id", "title", "content", "next_url"))
    lines = F.split(escaped(F.col("content")), "\n")
    tagged = lambda a, b: F.array_join(F.transform(lines, lambda x: F.concat(F.lit(a), x, F.lit(b))), "")
    parts = {"{t}": escaped(F.col("title")), "{p}": tagged("<p>", "</p>"), "{b}": tagged("", "<br>"), "{f}": tagged("<font>", "</font>"), "{i}": tagged("<p id='txt_1'>", "</p>"), "{n}": F.coalesce("next_url", F.lit("index.html"))}
    parser = F.element_at(F.array(*map(F.lit, PAGES)), (F.pmod("page_id", F.lit(len(PAGES))) + 1).cast("int"))
    made = F.element_at(F.create_map(*[F.lit(x) for kv in PAGES.items() for x in kv]), parser)
    for k in ("{n}", "{t}", "{p}", "{b}", "{f}", "{i}"):
        made = F.replace(made, F.lit(k), parts[k])
    rows = p.select("page_id", parser.alias("parser"), made.alias("html"))
    return rows.select("page_id", "parser", html.extract(F.col("html"), F.lit("https://site.example/a/b.html"), F.col("parser")).alias("r")).select("page_id", "parser", "r.*")


@query
def book_pages(spark, d):
    """Each book's page: title, cover, author, tags, synopsis."""
    b = table(spark, d, "books")
    made = F.concat(F.lit('<div class="booknav2"><h1><a href="/">'), escaped(F.col("book_title")), F.lit('</a></h1><p><a href="/author/1">'), F.col("book"), F.lit('</a></p><p><a href="/class/2">'), F.coalesce("content_type", F.lit("none")), F.lit('</a></p></div><div class="bookimg2"><img src="../'), F.col("book"), F.lit(".jpg\"></div><script>tags: '"), F.col("lang"), F.lit("| "), F.col("split_mode"), F.lit(' |\'</script><div class="navtxt"><p>'), escaped(F.col("book_title")), F.lit("<br>x</p><p>y</p></div>"))
    r = b.select("book", html.novel_info(made, F.lit("https://h.example/txt/1/a.html")).alias("r")).select("book", "r.*")
    return r.withColumn("tags", F.array_join("tags", "|"))


def catalog_pages(spark, d) -> DataFrame:
    """A catalog page for each book and hundred entries of the table."""
    c = table(spark, d, "chapter_catalog").select("book", "cat_id", F.expr("cat_id div 100").alias("page"), F.concat(F.lit('<li><a href="../c/'), F.col("cat_id"), F.lit('.html">'), escaped(F.col("title")), F.lit("</a></li>")).alias("li"))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cat_id", "li"))), lambda x: x["li"]), "")
    return c.groupBy("book", "page").agg(F.concat(F.lit(NAV + '<div id="catalog"><ul>'), items, F.lit("</ul></div>" + FOOT)).alias("html"))


@query
def catalog_page_links(spark, d):
    r = catalog_pages(spark, d).select("book", "page", html.novel_chapters(F.col("html"), F.lit("https://h.example/a/b/"), 10).alias("r"))
    return r.select("book", "page", F.explode("r").alias("c")).select("book", "page", "c.id", "c.volume", "c.title", "c.url")


@query
def search_pages(spark, d):
    """A search page for each book, its title in another case, and the body of a chapter's page."""
    b = table(spark, d, "books")
    made = F.concat(F.lit('<div class="newbox"><ul><li><a href="/b/'), F.col("book"), F.lit('.htm"></a><h3><a imgbox="1">i</a><a>'), escaped(F.col("book")), F.lit('</a></h3><div class="zxzj"><p>'), escaped(F.col("book_title")), F.lit("</p></div></li></ul></div>"))
    body = F.concat(F.lit('<div class="txtnav"><h1>T</h1><div class="txtinfo"><div>i</div></div>'), escaped(F.col("book_title")), F.lit('<br>x &amp; y<div id="txtright">r</div></div>'), F.lit(FOOT))
    r = b.select("book", html.search_results(made, F.lit("https://h.example/s")).alias("r"), html.chapter_body(body).alias("body"))
    return r.select("book", "body", F.explode("r").alias("x")).select("book", "body", "x.title", "x.url", "x.info")


@query
def url_join(spark, d):
    """The next page's address, written in several ways as seen from a page of its host."""
    u = table(spark, d, "crawl_pages").where("next_url is not null").select("page_id", F.col("next_url").alias("n"))
    tail = F.regexp_replace("n", "^[a-z]+://[^/]+", "")
    host = F.regexp_extract("n", "^([a-z]+://[^/]+)", 1)
    name = F.regexp_extract("n", "([^/]*)$", 1)
    folder = F.regexp_replace("n", "[^/]*$", "")
    pairs = F.array(
        F.struct(F.col("n").alias("page"), F.lit("https://other.example/x").alias("base")), F.struct(tail.alias("page"), F.concat(host, F.lit("/q/r.html")).alias("base")), F.struct(name.alias("page"), F.concat(folder, F.lit("z.html")).alias("base")),
        F.struct(F.concat(F.lit("../"), name).alias("page"), F.concat(folder, F.lit("sub/z.html")).alias("base")), F.struct(F.concat(F.lit("./a/../"), name).alias("page"), folder.alias("base")), F.struct(F.regexp_replace("n", "^[a-z]+:", "").alias("page"), F.concat(F.regexp_extract("n", "^([a-z]+)", 1), F.lit("://o.example/x")).alias("base")),
        F.struct(F.lit("").alias("page"), F.col("n").alias("base")), F.struct(F.lit("?q=1#f").alias("page"), F.concat("n", F.lit("?old#g")).alias("base")),
    )
    return u.select("page_id", F.posexplode(pairs).alias("form", "p")).select("page_id", "form", T.join_url(F.col("p.page"), F.col("p.base")).alias("url"))


# transform and incremental


@query
def stub_translate(spark, d):
    return transform.transform(segments(spark, d).select("row_id", "content"), transform.Stub())


@query
def title_map(spark, d):
    """One answer for each chapter title."""
    return transform.transform_titles(segments(spark, d), transform.Stub(), ["book"])


@query
def run_progress(spark, d):
    return quality.progress(table(spark, d, "request_log").select("log_id", "log_file"), ["log_file"], ["log_id"])


def planned(spark, d) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("path").alias("rel_path"), "text", "lang", "source", "crawled_at")
    files = incremental.hashed(docs, "text")
    modes = spark.createDataFrame([("context",), ("web",)], "mode string")
    history = files.where("lang is not null").select("rel_path", F.when(F.col("source") == "yunji_raw", "web").otherwise("context").alias("mode"), F.when(F.col("lang") == "zh", F.col("file_hash")).otherwise(F.md5(F.col("lang"))).alias("file_hash"), F.col("crawled_at").alias("processed_date"))
    outputs = files.where("source <> 'scanroom'").select("rel_path").crossJoin(F.broadcast(modes))  # two modes
    return incremental.plan(files, modes, history, outputs)


@query
def needs_processing(spark, d):
    return planned(spark, d)


@query
def missing_operations(spark, d):
    return incremental.missing_operations(planned(spark, d))


@query
def operation_tree(spark, d):
    """The plan's operations by content type (the source) and folder."""
    p = planned(spark, d).withColumn("content_type", F.element_at(F.split("rel_path", "/"), 1))
    return quality.folder_tree(p)


@query
def retried(spark, d):
    """Segments answered with a client that fails on a word: two attempts each, failures left out."""
    word = "的"
    got = transform.transform(segments(spark, d).select("row_id", "content"), transform.Stub(fail_on=word), retries=1, keep_failed=False)
    return got.select("row_id", "content", "ok", "attempts")


@query
def history_upsert(spark, d):
    """The history of files by path and mode, brought up to date with the documents crawled since."""
    files = incremental.hashed(table(spark, d, "documents").select(F.col("path").alias("rel_path"), "text", "source", "crawled_at", "doc_id"), "text")
    rows = files.select("rel_path", F.when(F.col("source") == "yunji_raw", "web").otherwise("context").alias("mode"), "file_hash", F.col("crawled_at").alias("processed_date"), F.col("doc_id").cast("string").alias("output_file"))
    late = F.col("processed_date") >= F.timestamp_micros(F.lit(0))
    return incremental.updated_history(rows.where(late), rows.where(late).withColumn("output_file", F.concat("output_file", F.lit("b")))).drop("processed_date")


def checkpoints(spark, d) -> DataFrame:
    last = F.max_by(F.struct(F.col("chapter_num").alias("chapter_count"), F.col("url").alias("last_url"), F.col("title").alias("last_title")), F.struct("fetched_at", "page_id"))
    return table(spark, d, "crawl_pages").where("success").groupBy(F.col("book").alias("series_name")).agg(last.alias("c")).select("series_name", "c.*")


@query
def checkpoint_states(spark, d):
    """For each book: whether a checkpoint is there after saving those of the crawl over those of the catalog and deleting one."""
    old = table(spark, d, "chapter_catalog").groupBy(F.col("book").alias("series_name")).agg(F.max("chapter_num").alias("chapter_count")).select("series_name", "chapter_count", F.lit(None).cast("string").alias("last_url"), F.lit(None).cast("string").alias("last_title"))
    saved = incremental.save_checkpoint(old, checkpoints(spark, d))
    gone = table(spark, d, "books").agg(F.min("book")).first()[0]
    left = incremental.delete_checkpoint(saved, gone)
    have = incremental.has_checkpoint(left, table(spark, d, "books").select(F.col("book").alias("series_name")))
    return have.join(left, "series_name", "left")


@query
def loaded_checkpoint(spark, d):
    return incremental.load_checkpoint(checkpoints(spark, d), table(spark, d, "crawl_pages").agg(F.max("book")).first()[0])


@query
def resumed_crawl(spark, d):
    """Pages up to chapter 10, then a run that begins at 11; and a run that begins at 1."""
    p = table(spark, d, "crawl_pages").select("page_id", "book", "chapter_num")
    done, new = p.where("chapter_num <= 10"), p.where("chapter_num > 10")
    return incremental.resumed(done, new, 11).withColumn("run", F.lit("append")).unionByName(incremental.resumed(done, new, 1).withColumn("run", F.lit("overwrite")))


# filters by configuration, sinks and sources


@query
def filter_modes(spark, d):
    """Rows that each filter of a configuration keeps."""
    s = segments(spark, d).select("row_id", "id")
    configs = {
        "segment": {"filter_mode": "segment", "segment_filter": {"enabled": True, "start_segment": 2, "end_segment": 9}}, "chapter": {"chapter_filter": {"enabled": True, "start_chapter": 2, "end_chapter": 30}},
        "off": {"filter_mode": "segment", "segment_filter": {"enabled": False}}, "none": {"filter_mode": "all"},
    }
    out = [filters.segments_filter(s, c).select("row_id", F.lit(name).alias("mode")) for name, c in configs.items()]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query
def checked_chapters(spark, d):
    """The first four chapters, inside those there are."""
    rows = segments(spark, d)
    have = filters.bounds(rows, []).first()
    return filters.checked_range(rows, have.first_chapter, min(have.first_chapter + 3, have.last_chapter)).select("row_id", "id")


@query
def enabled_pages(spark, d):
    return filters.enabled(table(spark, d, "crawl_pages").select("page_id", "success"), "success")


@query
def crawl_outcome(spark, d):
    return quality.outcome(table(spark, d, "crawl_pages"), ["site"], "success")


@query
def crawl_failures(spark, d):
    return quality.failures(table(spark, d, "crawl_pages"), ["site"], "page_id", "success")


@query
def batch_files(spark, d):
    """Segments written in a folder for each batch and read back: rows of each."""
    s = buckets.by_aligned_range(segments(spark, d).select("row_id", "id"), 20)
    back = buckets.write_batches(s, f"{shared_dir(spark)}/inkloom-batches-{uuid.uuid4().hex}")
    return back.groupBy("batch_name").agg(F.count("*").alias("n_rows"), F.min("row_id").alias("first_row"))


def segment_files(spark, d) -> DataFrame:
    """path, content of the YAML files of each book's chapters, one of a leading ``---`` for every other, and files that are none."""
    s = segments(spark, d).withColumn("chapter", ids.anchored_chapter(F.col("id"))).where("chapter is not null")
    s = s.select("book", "chapter", "ord", "row_id", writers.segment_yaml("id", "title", "content").alias("entry"))
    whole = s.groupBy("book", "chapter").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "row_id", "entry"))), lambda x: x["entry"]), "").alias("text"))
    text = F.concat(F.when(F.col("chapter") % 2 == 0, "---\n").otherwise(""), F.col("text"))
    good = whole.select(F.concat("book", F.lit("/"), "chapter", F.lit(".yaml")).alias("path"), F.encode(text, "UTF-8").alias("content"))
    return good.unionByName(table(spark, d, "books").select(F.concat("book", F.lit("/bad.yaml")).alias("path"), F.encode(F.lit("no list\n of maps"), "UTF-8").alias("content")))


@query
def segment_files_read(spark, d):
    """Segments as files of their chapters and read again; files that aren't lists of segments are skipped."""
    return readers.segments(segment_files(spark, d), strict=False)


@query
def segment_files_strict(spark, d):
    return readers.segments(segment_files(spark, d).where("not endswith(path, 'bad.yaml')"), strict=True).groupBy("path").agg(F.count("*").alias("n_rows"), F.max("ord").alias("last"))


@query
def raw_texts(spark, d):
    """Documents as files in four encodings and read again."""
    docs = table(spark, d, "documents").where("text is not null").select("doc_id", "text")
    code = F.element_at(F.array(*map(F.lit, ("utf-16", "gbk", "utf-8-sig", "utf-8"))), (F.pmod("doc_id", F.lit(4)) + 1).cast("int"))
    raw = writers.encoded(F.col("text"), code)
    r = readers.texts(docs.select(F.col("doc_id").cast("string").alias("path"), raw.alias("content")))
    return r.select(F.col("path").cast("long").alias("doc_id"), F.length(F.regexp_replace("text", "^\ufeff+", "")).alias("n"), F.md5(F.regexp_replace("text", "^\ufeff+", "")).alias("hash"))


@query
def scanned_files(spark, d):
    """Documents' paths as a scanned folder: without a folder, a name, short files and those of no pattern; with content type."""
    f = table(spark, d, "documents").select(F.concat(F.lit("file:/data/a.b/"), "path").alias("path"), F.col("n_chars").alias("length"))
    return readers.pruned(f, "/data/a.b", ("scanroom",), ("1.txt",), 200, ("*.txt", "*.md"), {"WebNovel": "yunji_raw"}).select("rel_path", "length", "content_type")


@query
def latest_file(spark, d):
    """The newest document of all, and one that is named."""
    f = table(spark, d, "documents").select("path", F.col("crawled_at").alias("modificationTime"))
    return readers.latest(f).unionByName(readers.latest(f, "named.log"))


def catalog_files(spark, d) -> DataFrame:
    """path, text of JSON catalogs: each book's entries by hundreds, and malformed ones."""
    c = table(spark, d, "chapter_catalog").select("book", "cat_id", F.expr("cat_id div 100").alias("page"), "chapter_num", "title", "url")
    items = F.transform(F.array_sort(F.collect_list(F.struct("cat_id", "chapter_num", "title", "url"))), lambda x: F.struct(x["chapter_num"].alias("index"), x["title"].alias("title"), x["url"].alias("url")))
    good = c.groupBy("book", "page").agg(F.to_json(items).alias("text")).select(F.concat("book", F.lit("/"), "page", F.lit(".json")).alias("path"), "text")
    return good.unionByName(table(spark, d, "books").select(F.concat("book", F.lit("/bad.json")).alias("path"), F.lit('[{"index": ').alias("text")))


@query
def catalog_files_read(spark, d):
    return readers.catalog(catalog_files(spark, d))


@query
def catalog_titles(spark, d):
    return readers.ground_truth(catalog_files(spark, d))


@query
def log_files_read(spark, d):
    """Log lines as the text of each file and hundred lines, and read again."""
    g = table(spark, d, "request_log").where("line is not null").select("log_file", F.expr("log_id div 100").alias("part"), "log_id", "line")
    text = g.groupBy("log_file", "part").agg(F.concat(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("log_id", "line"))), lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"))
    return readers.lines_of(text.select(F.concat("log_file", F.lit("/"), "part").alias("path"), "text"))


@query
def book_files(spark, d):
    """An EPUB of each book's chapters by tens, and what its entries hold when it is read again."""
    s = reshape.merge_chapters(segments(spark, d), ["book"]).select("book", "chapter", "title", T.clean_text(F.col("content")).alias("content"))
    part = F.concat("book", F.lit("_"), F.expr("chapter div 10"))
    books = writers.epubs(s.select(part.alias("part"), F.col("book").alias("book_title"), "title", "content", F.col("chapter").alias("position")), "part")
    return readers.epub_texts(books).select("epub", "entry", "title", F.size("paragraphs").alias("n_paragraphs"), F.md5(F.array_join("paragraphs", "\n")).alias("hash"))


@query
def interleaved_books(spark, d):
    """Bilingual chapters as EPUB entries with faded paragraphs, and the paragraphs read again."""
    b = table(spark, d, "bilingual").where("content is not null")
    return readers.epub_chapters(writers.interleaved_epubs(b.select("bil_id", "lang", "content"))).select("epub", "entry", F.size("paragraphs").alias("n"), F.md5(F.array_join(F.transform("paragraphs", lambda p: F.concat(p["text"], F.lit("|"), p["style"])), "\n")).alias("hash"))


@query
def crawl_text(spark, d):
    """The blocks of each book's crawl text."""
    return writers.crawl_blocks(table(spark, d, "crawl_pages").select("page_id", "book", "chapter_num", "title", "volume", "content"), "book", ["chapter_num", "page_id"])


@query
def crawl_file_order(spark, d):
    return writers.crawl_order(table(spark, d, "crawl_pages").select("page_id", "book", "chapter_num"), "book", ["page_id"])


@query
def sequential_text(spark, d):
    """The blocks of each site's pages, numbered as they came."""
    return writers.sequential_blocks(table(spark, d, "crawl_pages").select("page_id", "site", "title", "content"), "site", ["page_id"])


@query
def log_text(spark, d):
    """A log written from its parsed lines: header, lines, summary."""
    p = quality.parse_log(table(spark, d, "request_log"))
    ts = F.coalesce(F.to_timestamp("ts"), F.to_timestamp(F.lit("2025-01-01 00:00:00")))
    line = writers.log_line(ts, F.coalesce("id", F.lit("?")), F.coalesce(F.col("status") == "ok", F.lit(False)), F.col("in_tokens"), F.col("out_tokens"), F.col("error"))
    b = writers.log_blocks("=== log ===", p.select("log_id", line.alias("line"), (F.col("status") == "ok").alias("ok"), "in_tokens", "out_tokens"), ["log_id"])
    return b.select("part", F.col("at.log_id").alias("log_id"), "block")


@query
def backup_names(spark, d):
    return table(spark, d, "books").select("book", writers.backup_name(F.concat("book", F.lit(".yaml")), F.col("added_at")).alias("name"))


@query
def all_texts(spark, d):
    """Segments and translations, one list after the other."""
    return reshape.together(segments(spark, d).select(F.col("row_id").alias("n"), "book", "id"), table(spark, d, "translations").select(F.col("tr_id").alias("n"), "id", "book"))


def queries() -> dict[str, Query]:
    return dict(FOUND)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in (SQL | SQL_IO).items() if k in FOUND}
