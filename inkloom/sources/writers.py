"""Writers: segment files, chapter texts and JSON, EPUB books, crawl texts, logs.

Files of a key are written by the task that holds it: under a temporary name
first, then renamed, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Callable
from html import escape

import pandas as pd
import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.functions.text import paragraphs_html, xml_clean
from inkloom.operators.ranks import beside, positions, previous
from inkloom.runtime import shared_dir
from inkloom.sources.blocks import dump_segments


def _put(folder: str, name: str, data: bytes) -> str:
    """Writes a file through the file system that the folder's address names."""
    fs, base = FileSystem.from_uri(re.sub("^s3a:", "s3:", folder) if "://" in folder else f"file://{os.path.abspath(folder)}")
    fs.create_dir(base, recursive=True)
    path = f"{base.rstrip('/')}/{re.sub(r'[^\w\-.]', '_', name)}"
    part = f"{path}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(part) as f:
        f.write(data)
    fs.move(part, path)
    return path


def _shared(spark: SparkSession, folder: str) -> str:
    """``folder``, unless it is a machine's own in a session of several machines."""
    own = folder.startswith("file:") or "://" not in folder
    if own and not spark.sparkContext.master.startswith("local") and not folder.startswith(shared_dir(spark)):
        raise ValueError(f"{folder} isn't a folder that all executors share: give the address of one (hdfs://, s3a://, gs://)")
    return folder


def grouped_files(df: DataFrame, keys: list[str], folder: str, name: Callable[[tuple], str], make: Callable[[pd.DataFrame], bytes]) -> DataFrame:
    """Writes one file for each group of ``keys`` into a shared folder: file, status, reason, n_rows. Lazy, like any DataFrame.

    A group is one file, so it must fit into a task: choose keys of bounded groups, such as a chapter or a batch.
    """
    folder = _shared(df.sparkSession, folder)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            path, status, reason = _put(folder, name(key), make(pdf)), "success", None
        except Exception as e:  # a group that fails doesn't end the others
            path, status, reason = name(key), "error", str(e)
        return pd.DataFrame({"file": [path], "status": [status], "reason": [reason], "n_rows": [len(pdf)]})

    return df.groupBy(*keys).applyInPandas(run, "file string, status string, reason string, n_rows long")


def encoded(text: Column, encoding: Column) -> Column:
    """The bytes of a text in a named encoding, in UTF-8 where that lacks one of its characters; null stays null."""

    @F.arrow_udf("binary")
    def made(texts: pa.Array, names: pa.Array) -> pa.Array:
        out = []
        for t, e in zip(texts.to_pylist(), names.to_pylist()):
            try:
                out.append(None if t is None else t.encode(e))
            except UnicodeEncodeError:
                out.append(t.encode("utf-8"))
        return pa.array(out, pa.binary())

    return made.asNondeterministic()(text, encoding)


def segment_yaml(*columns: str) -> Column:
    """A row as an entry of a segment file: its columns as keys, in order. A file is its entries, one after another."""

    @F.arrow_udf("string")
    def dumped(*cols: pa.Array) -> pa.Array:
        return pa.array([dump_segments([dict(zip(columns, row))]) for row in zip(*(c.to_pylist() for c in cols))], pa.string())

    return dumped.asNondeterministic()(*columns)


def write_segments(df: DataFrame, keys: list[str], folder: str, order: str = "ord") -> DataFrame:
    """A YAML file of id, title and content for each key."""
    def make(pdf: pd.DataFrame) -> bytes:
        rows = pdf.sort_values(order)[["id", "title", "content"]].astype(object).where(lambda x: x.notna(), None).to_dict("records")
        return dump_segments(rows).encode()

    return grouped_files(df.select(*dict.fromkeys([*keys, order, "id", "title", "content"])), keys, folder, lambda k: "_".join(map(str, k)) + ".yaml", make)


def write_chapter_texts(chapters: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """A text file with header and text for each chapter of reshape.text_chapters."""
    named = chapters.withColumn("_f", F.format_string("%05d", "position"))
    return grouped_files(named.select(*keys, "_f", "header", "text"), [*keys, "_f"], folder, lambda k: "_".join(map(str, k)) + ".txt", lambda p: f"{p['header'].iloc[0]}\n\n{p['text'].iloc[0]}\n\n".encode())


def chapter_json(nested: DataFrame) -> DataFrame:
    """keys of the nested chapters, filename, json; write it partitioned, or as one text file each."""
    keys = [c for c in nested.columns if c not in ("chapter_number", "chapter_title", "total_segments", "segments")]
    return nested.select(*keys, F.format_string("chapter_%03d.json", "chapter_number").alias("filename"), F.to_json(F.struct("chapter_number", "chapter_title", "total_segments", "segments")).alias("json"))


def write_json_files(chapters: DataFrame, keys: list[str], folder: str) -> DataFrame:
    return grouped_files(chapter_json(chapters), [*keys, "filename"], folder, lambda k: "_".join(map(str, k)), lambda p: p["json"].iloc[0].encode())


STYLE = "body{margin:5%;line-height:1.6} h1{text-align:center} p{text-indent:1.5em;margin:.4em 0}"


def _epub(key: str, language: str) -> Callable[[pd.DataFrame], bytes]:
    def make(pdf: pd.DataFrame) -> bytes:
        pdf = pdf[pdf["body"].fillna("") != ""].sort_values("position")
        if pdf.empty:
            raise ValueError("no chapter has text")
        name = escape(str(pdf["book_title"].iloc[0] or pdf[key].iloc[0]))
        ids = [f"c{i:05d}" for i in range(1, len(pdf) + 1)]
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(zipfile.ZipInfo("mimetype"), "application/epub+zip")
            z.writestr("META-INF/container.xml", '<?xml version="1.0"?><container version="1.0" xmlns="urn:oasis:names:tc:opendocument:xmlns:container"><rootfiles><rootfile full-path="OEBPS/book.opf" media-type="application/oebps-package+xml"/></rootfiles></container>')
            items = "".join(f'<item id="{i}" href="{i}.xhtml" media-type="application/xhtml+xml"/>' for i in ids)
            spine = "".join(f'<itemref idref="{i}"/>' for i in ids)
            z.writestr("OEBPS/book.opf", f'<?xml version="1.0" encoding="utf-8"?><package xmlns="http://www.idpf.org/2007/opf" version="3.0" unique-identifier="id"><metadata xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:identifier id="id">{escape(str(pdf[key].iloc[0]))}</dc:identifier><dc:title>{name}</dc:title><dc:language>{language}</dc:language></metadata><manifest><item id="nav" href="nav.xhtml" media-type="application/xhtml+xml" properties="nav"/><item id="css" href="style.css" media-type="text/css"/>{items}</manifest><spine>{spine}</spine></package>')
            links = "".join(f'<li><a href="{i}.xhtml">{escape(t)}</a></li>' for i, t in zip(ids, pdf["title"]))
            page = '<?xml version="1.0" encoding="utf-8"?><html xmlns="http://www.w3.org/1999/xhtml" xmlns:epub="http://www.idpf.org/2007/ops"><head><title>{t}</title><link rel="stylesheet" href="style.css"/></head><body>{b}</body></html>'
            z.writestr("OEBPS/nav.xhtml", page.format(t=name, b=f'<nav epub:type="toc"><ol>{links}</ol></nav>'))
            z.writestr("OEBPS/style.css", STYLE)
            for i, t, b in zip(ids, pdf["title"], pdf["body"]):
                z.writestr(f"OEBPS/{i}.xhtml", page.format(t=escape(t), b=f"<h1>{escape(t)}</h1>{b}"))
        return out.getvalue()

    return make


def _epub_rows(chapters: DataFrame, key: str) -> DataFrame:
    body = paragraphs_html(xml_clean(F.col("content")))
    return chapters.select(key, "book_title", F.coalesce(xml_clean(F.col("title")), F.lit("")).alias("title"), body.alias("body"), "position")


def epubs(chapters: DataFrame, key: str, language: str = "vi") -> DataFrame:
    """path, content of an EPUB for each key from book_title, title, content, position; a book without text has none.

    A book is one file, so it must fit into a task; give volumes of bounded size as keys.
    """
    make = _epub(key, language)

    def run(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        found = [] if (pdf["body"].fillna("") == "").all() else [(f"{k[0]}.epub", make(pdf))]
        return pd.DataFrame({"path": pd.Series([p for p, _ in found], dtype=object), "content": pd.Series([c for _, c in found], dtype=object)})

    return _epub_rows(chapters, key).groupBy(key).applyInPandas(run, "path string, content binary")


def write_epub(chapters: DataFrame, key: str, folder: str, language: str = "vi") -> DataFrame:
    """An EPUB file for each key from book_title, title, content, position; a book without text is an error."""
    return grouped_files(_epub_rows(chapters, key), [key], folder, lambda k: f"{k[0]}.epub", _epub(key, language))


def interleaved_epubs(chapters: DataFrame) -> DataFrame:
    """path, content of an EPUB for each chapter (bil_id, lang, content): its lines as paragraphs, Chinese faded."""

    @F.arrow_udf("binary")
    def zipped(langs: pa.Array, texts: pa.Array) -> pa.Array:
        out = []
        for lang, text in zip(langs.to_pylist(), texts.to_pylist()):
            style = ' style="opacity:0.4"' if lang == "zh" else ""
            lines = "".join(f"<p{style}>{escape(x)}</p>" for x in (text or "").split("\n"))
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("item/xhtml/p-002.xhtml", f'<html><body><p>out</p><div class="main"><div>{lines}</div></div></body></html>')
                z.writestr("item/nav.xhtml", "<p>x</p>")
            out.append(raw.getvalue())
        return pa.array(out, pa.binary())

    return chapters.select(F.concat(F.col("bil_id").cast("string"), F.lit(".epub")).alias("path"), zipped.asNondeterministic()("lang", "content").alias("content"))


# Fixed value: what stands in place of a chapter without text.
NO_TEXT = "(Không có nội dung)"


def crawl_blocks(chapters: DataFrame, key: str, order: list[str], start: int = 1) -> DataFrame:
    """key, position, block of a crawl's text: a header (position 0) when it begins at 1, the volume where it changes, each chapter with its heading.

    ``order`` tells rows of a key apart. Positions and changes are found on slim
    rows; contents are joined to them and never sorted in one task.
    """
    slim = chapters.select(key, *order, F.nullif(F.trim(F.coalesce("volume", F.lit(""))), F.lit("")).alias("_v"))
    at = positions(slim.drop("_v"), [key], order)
    new = previous(slim.where("_v is not null"), [key], order, "_v", "_last").where(~F.col("_v").eqNullSafe(F.col("_last"))).select(key, *order, F.concat(F.lit("\n"), "_v", F.lit(":\n")).alias("_mark"))
    rows = beside(beside(chapters, at, [key, *order]), new, [key, *order], "left")
    head = F.concat(F.lit("\nChương "), F.coalesce(F.col("chapter_num").cast("string"), F.lit("")), F.when(F.coalesce("title", F.lit("")) != "", F.concat(F.lit(": "), "title")).otherwise(":"))
    body = F.when(F.coalesce("content", F.lit("")) != "", F.concat(F.lit("\n"), "content", F.lit("\n"))).otherwise("")
    blocks = rows.select(key, "position", F.concat(F.coalesce("_mark", F.lit("")), head, body).alias("block"))
    if start != 1:
        return blocks
    return chapters.select(key).distinct().select(key, F.lit(0).alias("position"), F.concat(F.lit("=== "), F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(" ===\n\n")).alias("block")).unionByName(blocks)


def crawl_order(chapters: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of a crawl's segment file with their position: by chapter number, then as they came."""
    at = positions(chapters.select(key, "chapter_num", *order), [key], ["chapter_num", *order])
    return beside(chapters, at if "chapter_num" in order else at.drop("chapter_num"), [key, *order])


def sequential_blocks(chapters: DataFrame, key: str, order: list[str]) -> DataFrame:
    """key, position, block: chapters numbered in order, each with its heading, NO_TEXT for those without text."""
    at = positions(chapters.select(key, *order), [key], order)
    body = F.when(F.coalesce("content", F.lit("")) == "", NO_TEXT).otherwise(F.col("content"))
    return beside(chapters, at, [key, *order]).select(key, "position", F.concat(F.lit("Chapter "), "position", F.lit(": "), F.coalesce("title", F.lit("")), F.lit("\n"), body, F.lit("\n\n")).alias("block"))


def text_of_blocks(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, text of blocks: for texts that fit into a row. Larger ones are written by write_blocks."""
    return blocks.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "block"))), lambda x: x["block"]), "").alias("text"))


def write_blocks(blocks: DataFrame, keys: list[str], folder: str, start: int = 1) -> None:
    """Writes texts of any size: sorted by range of (keys, position), a folder for each key, whose part files in order are the text.

    A block that doesn't end in a line feed gets one. A run that begins above 1 is appended.
    """
    ready = blocks.withColumn("value", F.regexp_replace("block", r"\n\z", ""))  # the writer ends each row with a line feed
    parts = ready.repartitionByRange(*keys, "position").sortWithinPartitions(*keys, "position")
    parts.select(*keys, "value").write.mode("append" if start > 1 else "overwrite").partitionBy(*keys).text(folder)


def log_line(ts: Column, segment: Column, ok: Column, tokens_in: Column, tokens_out: Column, error: Column) -> Column:
    """One line of a request log."""
    head = F.concat(F.lit("["), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("] "), segment, F.lit(": "))
    used = F.concat(F.lit(" | Tokens: In="), F.coalesce(tokens_in, F.lit(0)), F.lit(", Out="), F.coalesce(tokens_out, F.lit(0)))
    return F.concat(head, F.when(ok, F.concat(F.lit("THÀNH CÔNG"), used)).otherwise(F.concat(F.lit("THẤT BẠI - Lỗi: "), F.coalesce(error, F.lit("")))))


def backup_name(name: Column, ts: Column) -> Column:
    """The name under which a file is kept before it is written anew."""
    return F.concat(F.date_format(ts, "ddMMyy_HHmm"), F.lit("_backup_"), name)


def log_blocks(header: str, lines: DataFrame, order: list[str]) -> DataFrame:
    """part, at, block of a log: its header (part 0), its lines (part 1, in order) and a summary of its requests (part 2).

    lines: ``order`` columns, line, ok, in_tokens, out_tokens. Nothing is gathered; sort by part and at to write it.
    """
    body = lines.select(F.lit(1).alias("part"), F.struct(*order).alias("at"), F.concat("line", F.lit("\n")).alias("block"))
    kind = body.schema["at"].dataType.simpleString()
    none = F.lit(None).cast(kind)
    head = lines.sparkSession.range(1).select(F.lit(0).alias("part"), none.alias("at"), F.lit(header + "\n").alias("block"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    end = lines.agg(F.concat(F.lit("\nRequests: "), F.count("*"), F.lit(", failed: "), F.count_if(~F.coalesce("ok", F.lit(False))), F.lit(", tokens in: "), count("in_tokens"), F.lit(", out: "), count("out_tokens"), F.lit("\n")).alias("block"))
    return head.unionByName(body).unionByName(end.select(F.lit(2).alias("part"), none.alias("at"), "block"))
