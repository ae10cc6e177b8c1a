"""Title, text and links of site pages given as HTML: a parsed tree for the sites, string functions for plain text."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from inkloom.functions.text import WS, split_lines, strip_u

# Entities as the sites write them.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))
ZERO_WIDTH = r"[\x{200b}\x{200c}\x{200d}\x{feff}]"


def without(html: Column, *tags: str) -> Column:
    """Without these elements and what they hold."""
    return F.regexp_replace(html, f"(?is)<({'|'.join(tags)})\\b[^>]*>.*?</\\1\\s*>", "")


def breaks(html: Column) -> Column:
    return F.regexp_replace(html, r"(?i)<br\s*/?>", "\n")


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<[^>]*>", "")


def entities(text: Column) -> Column:
    for name, c in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(c))
    return text


def element(html: Column, tag: str, attr: str = "") -> Column:
    """What the first element of a tag holds whose start holds ``attr`` (a pattern); '' without one."""
    return F.regexp_extract(html, f"(?is)<{tag}\\b[^>]*{attr}[^>]*>(.*?)</{tag}\\s*>", 1)


def elements(html: Column, tag: str, attr: str = "") -> Column:
    return F.regexp_extract_all(html, F.lit(f"(?is)<{tag}\\b[^>]*{attr}[^>]*>(.*?)</{tag}\\s*>"), F.lit(1))


def text_of(html: Column) -> Column:
    """Script and style removed first (they may hold tags), then breaks, tags and entities; the filled lines, stripped."""
    body = entities(strip_tags(breaks(without(html, "script", "style"))))
    return F.array_join(filled(body), "\n")


def filled(text: Column) -> Column:
    """The lines that aren't blank, stripped."""
    return F.filter(F.transform(split_lines(text), strip_u), lambda x: x != "")


# Elements without an end, and those that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Node:
    """An element with its attributes and what it holds: elements and texts."""

    __slots__ = ("tag", "attrs", "kids")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.kids = tag, attrs, []

    def walk(self) -> Iterator[Node | str]:
        """What the element holds, at any depth, in order."""
        stack = list(reversed(self.kids))
        while stack:
            x = stack.pop()
            yield x
            if isinstance(x, Node):
                stack.extend(reversed(x.kids))

    def select(self, tag: str | None = None, cls: str | None = None, id: str | None = None, has: dict[str, tuple[str, ...]] | None = None) -> Iterator[Node]:
        """The elements inside with this tag, class and id whose attributes hold the given parts."""
        for x in self.walk():
            if isinstance(x, Node) and (tag is None or x.tag == tag) and (cls is None or cls in x.attrs.get("class", "").split()) and (id is None or x.attrs.get("id") == id):
                if all(p in x.attrs.get(k, "") for k, parts in (has or {}).items() for p in parts):
                    yield x

    def first(self, *args, **kw) -> Node | None:
        return next(self.select(*args, **kw), None)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open = [Node("", {})]

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK and any(x.tag == "p" for x in self.open):
            self.handle_endtag("p")
        if tag == "li" and any(x.tag == "li" for x in self.open[-2:]):
            self.handle_endtag("li")
        node = Node(tag, {k: v or "" for k, v in reversed(attrs)})
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data):
        self.open[-1].kids.append(data)


def tree(html: str) -> Node:
    """The elements of a page, by depth; an end tag closes what is open inside its element."""
    b = _Builder()
    b.feed(html)
    b.close()
    return b.open[0]


def shown(node: Node | None) -> str:
    """The text of an element as a browser shows it: white space collapsed, breaks and blocks on lines of their own."""
    if node is None:
        return ""
    out: list[str] = []
    stack: list = list(reversed(node.kids))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(re.sub(r"[ \t\n\r\f]+", " ", x))
        elif x.__class__ is tuple:
            out.append(x[0])
        elif x.tag == "br":
            out.append("\n")
        elif x.tag not in ("script", "style"):
            edge = [("\n",)] if x.tag in BLOCK or x.tag == "li" else []
            stack += [*edge, *reversed(x.kids), *edge]
    return re.sub(r" *\n *", "\n", re.sub(r" {2,}", " ", "".join(out))).strip()


def written(nodes: list, skip: Callable[[Node], bool] = lambda n: False) -> str:
    """The texts of nodes as the page's source has them: breaks as line feeds, markup characters and hard spaces escaped."""
    out: list[str] = []
    stack = list(reversed(nodes))
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            out.append(x.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace("\xa0", "&nbsp;"))
        elif x.tag == "br":
            out.append("\n")
        elif x.tag not in ("script", "style") and not skip(x):
            stack.extend(reversed(x.kids))
    return "".join(out)


def _decoded(text: str) -> str:
    return text.replace("&nbsp;", " ").replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")


def _tidy(text: str, chars: str = "\u200b\u200c\u200d\ufeff") -> str:
    """Without zero-width characters, gaps of more than one blank line closed."""
    return re.sub(r"\n\s*\n\s*\n+", "\n\n", text.translate(dict.fromkeys(map(ord, chars))))


# Fixed value: the title of a page that has none.
UNTITLED = "Không có tiêu đề"


def _title(node: Node | None) -> str:
    return UNTITLED if node is None else shown(node)


def _record(title: str, content: str, next_url: str | None = None, volume: str = "", success: bool = True) -> dict:
    return {"title": title, "volume": volume, "content": content, "next_url": next_url or None, "success": success}


def _filled(texts) -> list[str]:
    return [t for t in (x.strip() for x in texts) if t]


# The styles of two sites' text blocks, words of an advertising first paragraph, a line that links to the book.
HJWZW_STYLE, ZHSWX_STYLE = ("font-size: 20px", "line-height: 30px", "width: 750px"), ("font-size: 20px", "width: 700px", "text-indent: 2em")
HJWZW_ADS, HJWZW_BOOK = ("請記住本站域名", "黃金屋"), "我的超能力每周刷新"


def hjwzw(root: Node, url: str, strict: bool) -> dict:
    """Paragraphs of the styled block, but those with a link, an advertisement at the top and lines that name the book."""
    box = root.first("div", has={"style": HJWZW_STYLE})
    kept = []
    for i, p in enumerate(box.select("p") if box else ()):
        text = shown(p)
        if not any("href" in a.attrs for a in p.select("a")) and not (i == 0 and any(w in text for w in HJWZW_ADS)) and not text.startswith(HJWZW_BOOK):
            kept.append(text)
    return _record(_title(root.first("h1")), _tidy("\n\n".join(_filled(kept))))


def linovelib(root: Node, url: str, strict: bool) -> dict:
    """Title and paragraphs by their ids; the first h3 is the volume when it says so."""
    box, h3 = root.first(id="acontent"), shown(root.first("h3"))
    text = "\n\n".join(_filled(shown(p) for p in box.select("p"))) if box else ""
    return _record(_title(root.first(id="atitle")), _tidy(text).strip(), volume=h3 if "卷" in h3 or "Vol" in h3 else "")


def quanben(root: Node, url: str, strict: bool) -> dict:
    """Paragraphs of the content block in the article; hard spaces become spaces, long gaps are closed."""
    article = root.first("div", "articlebody")
    box = article.first(id="content") if article else None
    text = "\n\n".join(_filled(shown(p) for p in box.select("p"))) if box else ""
    text = text.translate({0x200B: None, 0xFEFF: None, 0xA0: " "})
    return _record(shown(root.first("h1", "headline")), re.sub(r"\n{3,}", "\n\n", re.sub(r"<!--PAGE \d+-->", "", text)).strip())


def zhswx(root: Node, url: str, strict: bool) -> dict:
    """The font elements of the styled block, else its filled lines."""
    box = root.first("div", has={"style": ZHSWX_STYLE})
    parts = (_filled(shown(f) for f in box.select("font")) or _filled(shown(box).split("\n"))) if box else []
    return _record(_title(root.first("h1")), _tidy("\n\n".join(parts)).strip())


def dxmwx(root: Node, url: str, strict: bool, source: str = "") -> dict:
    """The paragraphs of the text block whose id begins with txt_, else its lines; strict takes up to three digits off their ends."""
    title = shown(root.first(id="ChapterTitle"))
    if not title:
        m = re.search(r'var\s+ChapterTitle\s*=\s*"([^"]+)"', source)
        title = m[1].strip() if m else UNTITLED
    box = root.first(id="Lab_Contents")
    parts = [shown(p) for p in box.select("p") if p.attrs.get("id", "").startswith("txt_")] if box else []
    parts = _filled(parts if parts else shown(box).split("\n"))
    if strict:
        for _ in range(2):
            parts = [x for x in (re.sub(r"[ \u3000]*\d{1,3}$", "", x.strip()) for x in parts) if x]
    return _record(title, _tidy("\n\n".join(parts)).strip())


# Words of navigation lines and of the site's own name, links to the next page.
PIAOTIA_LINES, PIAOTIA_NEXT = ("上一章", "下一章", "目录", "www.piaotia.com", "飘天文学"), ("下一章", "下一页")


def piaotia(root: Node, url: str, strict: bool) -> dict:
    """The content block after its first break, up to the first of three end marks that it holds. It always succeeds."""
    head = shown(root.first("h1"))
    title = head.split(" ", 1)[1].strip() if " " in head else head if root.first("h1") else UNTITLED
    box, text = root.first(id="content"), ""
    flat = list(box.walk()) if box else []
    start = next((i for i, x in enumerate(flat) if isinstance(x, Node) and x.tag == "br"), None)
    if start is not None:
        rest = flat[start:]
        marks = (
            lambda x: x.tag == "div" and x.attrs == {"class": "bottomlink"},
            lambda x: x.tag == "center" and bool(x.kids) and isinstance(x.kids[0], Node) and x.kids[0].tag == "script",
            lambda x: x.tag == "div" and next(iter(reversed(x.attrs.items())), None) == ("id", "Commenddiv"),
        )
        for mark in marks:
            at = next((i for i, x in enumerate(rest) if isinstance(x, Node) and mark(x)), None)
            if at is not None:
                rest = rest[:at]
                break
        hidden = {id(k) for x in rest if isinstance(x, Node) and x.tag in ("script", "style") for k in x.kids}
        text = written([x if isinstance(x, str) else Node(x.tag, {}) for x in rest if id(x) not in hidden])
    lines = [x for x in _filled(_decoded(text).split("\n")) if not any(w in x for w in PIAOTIA_LINES)]
    text = re.sub(r"\n\s*\n\s*\n+", "\n\n", re.sub(r"[ \t]+", " ", _decoded("\n\n".join(lines)))).strip()
    link = next((a.attrs["href"] for a in root.select("a") if a.attrs.get("href") and any(w in shown(a) for w in PIAOTIA_NEXT)), None)
    return _record(title, text, urljoin(url, link) if link else None)


def _shuba_skips(n: Node) -> bool:
    c = n.attrs.get("class", "")
    return (n.tag == "h1" and c == "hide720") or (n.tag == "div" and (c.startswith("txtinfo") or c in ("bottom-ad", "contentadv") or n.attrs.get("id") == "txtright"))


def shuba(root: Node, url: str, strict: bool, source: str = "") -> dict:
    """The text block without heading, notes, advertisements and scripts; a first line equal to the title goes; the next page is in a script."""
    head = root.first("h1", "hide720")
    m = re.search(r"chaptername:\s*['\"]([^'\"]+)['\"]", source)
    title = shown(head) if head else m[1] if m else UNTITLED
    box = root.first("div", "txtnav")
    lines = written(box.kids, _shuba_skips).split("\n") if box else []
    if lines and lines[0].strip() == title.strip():
        lines = lines[1:]
    text = "\n\n".join(_filled(lines))
    text = re.sub("　+", "　　", _tidy(f"'{text}")).strip() if text else ""
    m = re.search(r"next_page:\s*['\"]([^'\"]+)['\"]", source)
    found = m[1] if m and m[1] != "index.html" else None
    if found and not re.match("https?://", found):
        found = f"{url.rpartition('/')[0]}/{found}"
    return _record(title, text, found, success=bool(text))


# Words of lines that the site adds.
STO55_LINES = ("本章節來源於", "STO55.COM", "sto55.com", "𝕊𝕋𝕆𝟝𝟝", "ℂ𝕆𝕄", "ADVERTISEMENT")


def _sto55_skips(n: Node) -> bool:
    return n.tag == "iframe" or (n.tag == "ins" and n.attrs.get("class") == "adsbygoogle") or (n.tag == "div" and (n.attrs.get("class") == "ADVERTISEMENT" or n.attrs.get("style") == "text-align:center;"))


def sto55(root: Node, url: str, strict: bool) -> dict:
    """The text block without advertisements, frames and the site's lines; a link to the catalog is no next page."""
    box = root.first("div", "readcotent")
    lines = [x for x in _filled(_decoded(written(box.kids, _sto55_skips)).split("\n")) if not any(w in x for w in STO55_LINES)] if box else []
    text = "\n\n".join(lines)
    text = re.sub(r"[ \t]+", " ", f"'{text}".translate(dict.fromkeys(map(ord, "\u200b\u200c\u200d\ufeff")))) if text else ""
    text = re.sub(r"\n\s*\n\s*\n+", "\n\n", text).strip()
    a = root.first(id="linkNext")
    link = urljoin(url, a.attrs["href"]) if a and a.attrs.get("href") else None
    if link and "/book/" in link and link.count("/") == 4 and not link.endswith(".html"):
        link = None
    return _record(_title(root.first("h1", "pt10")), text, link, success=bool(text))


def czbooks(root: Node, url: str, strict: bool) -> dict:
    """By class names; without a content block the page failed."""
    box, name = root.first(cls="content"), _title(root.first(cls="name"))
    if box is None:
        return _record(name, "", success=False)
    a = root.first("a", "next-chapter")
    text = re.sub(r"\n\s*\n", "\n\n", written(box.kids)).strip()
    return _record(name, text, urljoin(url, a.attrs["href"]) if a and a.attrs.get("href") else None)


PARSERS: dict[str, Callable[..., dict]] = {"hjwzw": hjwzw, "tw": linovelib, "quanben": quanben, "zhswx": zhswx, "dxmwx": dxmwx, "piaotia": piaotia, "shuba": shuba, "sto55": sto55, "czbooks": czbooks}
PAGE = "struct<title:string,volume:string,content:string,next_url:string,success:boolean>"
_PAGE = pa.struct([("title", pa.string()), ("volume", pa.string()), ("content", pa.string()), ("next_url", pa.string()), ("success", pa.bool_())])


def parse_page(source: str | None, url: str | None, parser: str | None, strict: bool = False) -> dict | None:
    f = PARSERS.get(parser or "")
    if f is None or source is None:
        return None
    more = {"source": source} if parser in ("shuba", "dxmwx") else {}
    return f(tree(source), url or "", strict, **more)


def _mapped(kind: str, type_: pa.DataType, f: Callable) -> Callable[..., Column]:
    """A column function that applies ``f`` to each row of its columns, batch by batch."""

    @F.arrow_udf(kind)
    def run(*cols: pa.Array) -> pa.Array:
        return pa.array([f(*row) for row in zip(*(c.to_pylist() for c in cols))], type_)

    return run.asNondeterministic()  # it is deterministic, but is parsed once however often it is used


def extract(html: Column, url: Column, parser: Column, strict_compat: bool = False) -> Column:
    """(title, volume, content, next_url, success) of a page by the parser that the router names.

    Null for unknown parsers and null pages; an empty page gives an empty
    record. Scripts and styles are never text. Elements are matched by depth,
    so nested blocks stay whole and what follows a block is not part of it.
    """
    return _mapped(PAGE, _PAGE, lambda h, u, p: parse_page(h, u, p, strict_compat))(html, url, parser)


INFO = "struct<title:string,cover:string,author:string,tags:array<string>,synopsis:string>"
_INFO = pa.struct([("title", pa.string()), ("cover", pa.string()), ("author", pa.string()), ("tags", pa.list_(pa.string())), ("synopsis", pa.string())])


def _info(source: str | None, url: str | None) -> dict | None:
    if source is None:
        return None
    root = tree(source)
    nav, image, about = root.first(cls="booknav2"), root.first("div", "bookimg2"), root.first("div", "navtxt")
    img = image.first("img") if image else None
    links = [(a.attrs.get("href", ""), shown(a)) for p in (nav.select("p") if nav else ()) for a in p.select("a")]
    m = re.search(r"tags:\s*'([^']+)'", source)
    tags = _filled(m[1].split("|")) if m else []
    tags += [t for h, t in links if "/class/" in h]
    top = next((t for h, t in links if "top" in h), None)
    return {
        "title": shown(nav.first("h1")) if nav and nav.first("h1") else None, "cover": urljoin(url or "", img.attrs["src"]) if img and img.attrs.get("src") else None,
        "author": next((t for h, t in links if "author" in h), None), "tags": [top] if top is not None else tags, "synopsis": "\n".join(_filled(shown(about).split("\n"))),
    }


def novel_info(html: Column, url: Column) -> Column:
    """(title, cover, author, tags, synopsis) of a book's page: tags from its script and class links, or its one category link."""
    return _mapped(INFO, _INFO, _info)(html, url)


CHAPTERS = "array<struct<id:int,volume:int,title:string,url:string>>"
_CHAPTERS = pa.list_(pa.struct([("id", pa.int32()), ("volume", pa.int32()), ("title", pa.string()), ("url", pa.string())]))


def _chapters(source: str | None, url: str | None, per_volume: int) -> list[dict] | None:
    if source is None:
        return None
    box = tree(source).first("div", id="catalog")
    links = [a for ul in (box.select("ul") if box else ()) for li in ul.select("li") if (a := li.first("a"))]
    return [{"id": i + 1, "volume": i // per_volume + 1, "title": shown(a), "url": urljoin(url or "", a.attrs.get("href", ""))} for i, a in enumerate(links)]


def novel_chapters(html: Column, url: Column, per_volume: int = 100) -> Column:
    """(id, volume, title, url) of the links in a book's catalog, ``per_volume`` chapters a volume."""
    return _mapped(CHAPTERS, _CHAPTERS, lambda h, u: _chapters(h, u, per_volume))(html, url)


RESULTS = "array<struct<title:string,url:string,info:string>>"
_RESULTS = pa.list_(pa.struct([("title", pa.string()), ("url", pa.string()), ("info", pa.string())]))


def _results(source: str | None, url: str | None) -> list[dict] | None:
    if source is None:
        return None
    out = []
    for li in (li for box in tree(source).select("div", "newbox") for ul in box.select("ul") for li in ul.select("li")):
        name = next((a for h in li.select("h3") for a in h.select("a") if "imgbox" not in a.attrs), None)
        a, latest = li.first("a"), li.first("div", "zxzj")
        out.append({"title": shown(name).title(), "url": urljoin(url or "", a.attrs.get("href", "")) if a else None, "info": f"Latest: {shown(latest.first('p')) if latest and latest.first('p') else ''}"})
    return out


def search_results(html: Column, url: Column) -> Column:
    """(title, url, info) of each entry of a search page."""
    return _mapped(RESULTS, _RESULTS, _results)(html, url)


def _bare(source: str | None) -> str | None:
    box = tree(source).first("div", "txtnav") if source is not None else None
    return None if box is None else "\n".join(_filled(_decoded(written(box.kids, lambda n: n.tag == "h1" or "txtinfo" in n.attrs.get("class", "").split() or n.attrs.get("id") == "txtright")).split("\n")))


def chapter_body(html: Column) -> Column:
    """The lines of a chapter's text block without its heading, notes and right column; null without a block."""
    return _mapped("string", pa.string(), _bare)(html)
