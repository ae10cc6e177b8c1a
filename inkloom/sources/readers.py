"""Readers: raw texts in any of five encodings, segment files, EPUB archives, catalogs, logs."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkloom.operators.classify import content_type
from inkloom.sources.blocks import parse_segments

# Encodings in the order in which they are tried.
ENCODINGS = ("utf-16", "utf-8", "utf-8-sig", "gbk", "big5")


def decode(raw: bytes | None) -> tuple[str | None, str | None]:
    """(text, encoding) by the first encoding that takes all bytes; UTF-16 only with its mark. (None, None) if none does."""
    if raw is None:
        return None, None
    for e in ENCODINGS:
        if e == "utf-16" and raw[:2] not in (b"\xff\xfe", b"\xfe\xff"):
            continue
        try:
            return raw.decode(e), e
        except UnicodeDecodeError:
            continue
    return None, None


def files(spark: SparkSession, folder: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """path, modificationTime, length, content of files. Select only what is needed: content is read on demand."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", pattern).load(folder)


def pruned(found: DataFrame, root: str, exclude_folders: tuple[str, ...] = (), exclude_files: tuple[str, ...] = (), least: int = 0, patterns: tuple[str, ...] = ("*",), subfolders: dict[str, str] | None = None) -> DataFrame:
    """With rel_path and content_type; without files in excluded folders, excluded names, those of no pattern and those smaller than ``least``.

    ``subfolders`` names the folder of each content type.
    """
    base = F.lit("/" + root.removeprefix("file:").strip("/") + "/")
    path = F.regexp_replace("path", "^file:/+", "/")
    out = found.withColumn("rel_path", F.when(path.startswith(base), F.substring(path, F.length(base) + 1, F.length(path))).otherwise(path)).where(F.col("length") >= least)
    name = F.element_at(F.split("rel_path", "/"), -1)
    for x in exclude_folders:
        out = out.where(~F.array_contains(F.slice(F.split("rel_path", "/"), F.lit(1), F.size(F.split("rel_path", "/")) - 1), x))
    kept = F.lit(False)
    for x in patterns:
        kept = kept | name.rlike("^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in x) + "$")
    return out.where(kept & ~name.isin(*exclude_files) if exclude_files else kept).withColumn("content_type", content_type(F.col("rel_path"), subfolders or {}))


def texts(found: DataFrame) -> DataFrame:
    """path, text, encoding of raw files; text is null where no encoding fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t for t, _ in got], pa.string()), pa.array([e for _, e in got], pa.string())], names=["path", "text", "encoding"])

    return found.select("path", "content").mapInArrow(run, "path string, text string, encoding string")


def segments(found: DataFrame, strict: bool = True) -> DataFrame:
    """path, ord, id, title, content of segment files (YAML lists). Strict: a row without a key, or a file that isn't a list, fails; else it is skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    rows = parse_segments(decode(raw)[0] or "")
                except ValueError:
                    if strict:
                        raise
                    continue
                for i, r in enumerate(rows):
                    lacks = [k for k in ("id", "title", "content") if k not in r]
                    if lacks and strict:
                        raise ValueError(f"{path}: row {i} has no {lacks[0]}")
                    for c, v in zip(cols, (path, i, r.get("id"), r.get("title"), r.get("content"))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), *(pa.array(c, pa.string()) for c in cols[2:])], names=["path", "ord", "id", "title", "content"])

    return found.select("path", "content").mapInArrow(run, "path string, ord long, id string, title string, content string")


class _Paragraphs(HTMLParser):
    """The p elements inside div.main with their styles."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.depth, self.inside, self.out = 0, False, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "div":
            self.depth = self.depth + 1 if self.depth else int("main" in (a.get("class") or "").split())
        elif tag == "p" and self.depth:
            self.inside = True
            self.out.append(["", a.get("style") or ""])

    def handle_endtag(self, tag):
        if tag == "div" and self.depth:
            self.depth -= 1
        elif tag == "p":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.out[-1][0] += data


def paragraphs(xhtml: str) -> list[dict]:
    p = _Paragraphs()
    p.feed(xhtml)
    return [{"text": t.strip(), "style": s} for t, s in p.out if t.strip()]


# Names of entries that hold no chapter.
NO_CHAPTER = ("toc", "nav", "cover", "copyright")


def epub_chapters(found: DataFrame) -> DataFrame:
    """epub, entry, position, paragraphs (text, style) of the XHTML entries of EPUB files, in order of their names."""
    schema = pa.schema([("epub", pa.string()), ("entry", pa.string()), ("position", pa.int32()), ("paragraphs", pa.list_(pa.struct([("text", pa.string()), ("style", pa.string())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    names = sorted(n for n in z.namelist() if n.endswith(".xhtml") and not n.endswith("p-001.xhtml") and not any(w in n.rsplit("/", 1)[-1].lower() for w in NO_CHAPTER))
                    yield pa.RecordBatch.from_pylist([{"epub": path, "entry": n, "position": i, "paragraphs": paragraphs(z.read(n).decode("utf-8", "replace"))} for i, n in enumerate(names)], schema=schema)

    return found.select("path", "content").mapInArrow(run, "epub string, entry string, position int, paragraphs array<struct<text: string, style: string>>")


class _Chapter(HTMLParser):
    """The h1 and the p elements of an entry."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.at, self.title, self.out = "", "", []

    def handle_starttag(self, tag, attrs):
        if tag in ("h1", "p"):
            self.at = tag
            self.out += [""] * (tag == "p")
        elif tag == "br" and self.at == "p":
            self.out[-1] += "\n"

    def handle_endtag(self, tag):
        if tag == self.at:
            self.at = ""

    def handle_data(self, data):
        if self.at == "h1":
            self.title += data
        elif self.at == "p":
            self.out[-1] += data


def epub_texts(found: DataFrame) -> DataFrame:
    """epub, entry, title, paragraphs of the chapters of EPUB files (path, content) that writers.epubs makes."""
    schema = pa.schema([("epub", pa.string()), ("entry", pa.string()), ("title", pa.string()), ("paragraphs", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                rows = []
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    for n in sorted(n for n in z.namelist() if n.endswith(".xhtml") and not any(w in n.rsplit("/", 1)[-1].lower() for w in NO_CHAPTER)):
                        c = _Chapter()
                        c.feed(z.read(n).decode("utf-8", "replace"))
                        rows.append({"epub": path, "entry": n, "title": c.title, "paragraphs": c.out})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return found.select("path", "content").mapInArrow(run, "epub string, entry string, title string, paragraphs array<string>")


def json_files(spark: SparkSession, path: str) -> DataFrame:
    """path, text of JSON files, one row a file."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), F.col("value").alias("text"))


def _entries(found: DataFrame, fields: str) -> DataFrame:
    return found.select("path", F.posexplode(F.from_json("text", f"array<struct<{fields}>>")).alias("at", "e")).select("path", (F.col("at") + 1).alias("position"), "e.*")


def catalog(found: DataFrame) -> DataFrame:
    """path, index, title, url of JSON catalogs (path, text), the last entry of an index; malformed files give no rows."""
    df = _entries(found, "index:int,title:string,url:string").where("index is not null")
    return df.groupBy("path", "index").agg(F.max_by(F.struct("title", "url"), "position").alias("v")).select("path", "index", "v.title", "v.url")


def ground_truth(found: DataFrame) -> DataFrame:
    """path, position (from 1), title of JSON catalogs (path, text) in file order; malformed files give no rows."""
    return _entries(found, "title:string").select("path", "position", "title")


def catalog_links(entries: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """keys, at, link of each entry's addresses: those in ``urls``, else its ``url``, in order."""
    urls = F.filter(F.coalesce(F.when(F.size("urls") > 0, F.col("urls")), F.array("url")), lambda u: u.isNotNull() & (u != ""))
    return entries.select(*keys, *order, F.posexplode(urls).alias("at", "link"))


def catalog_by_title(entries: DataFrame, keys: list[str], order: str) -> DataFrame:
    """keys, number, title, url by the number that the title begins with (第n章); the last entry of a number."""
    n = F.nullif(F.regexp_extract("title", r"^第(\d+)章", 1), F.lit("")).try_cast("int")
    return entries.withColumn("number", n).where("number is not null").groupBy(*keys, "number").agg(F.max_by(F.struct("title", "url"), F.col(order)).alias("v")).select(*keys, "number", "v.title", "v.url")


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """log_file, line of text logs."""
    return spark.read.text(path).select(F.input_file_name().alias("log_file"), F.col("value").alias("line"))


def lines_of(found: DataFrame) -> DataFrame:
    """path, line_no (from 1), line of texts (path, text); a line feed at the end opens no line."""
    return found.select("path", F.posexplode(F.split(F.regexp_replace("text", r"\n\z", ""), "\n")).alias("i", "line")).select("path", (F.col("i") + 1).alias("line_no"), "line")


def latest(found: DataFrame, explicit: str | None = None, but: Column | None = None) -> DataFrame:
    """The path of the newest file, or ``explicit`` unless that is LATEST or empty."""
    if explicit and explicit.upper() != "LATEST":
        return found.sparkSession.createDataFrame([(explicit,)], "path string")
    return (found if but is None else found.where(~but)).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))
