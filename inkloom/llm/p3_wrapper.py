"""Main body of web pages by wrappers inferred from the pages of a host."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.p5_encoding import repair
from inkloom.runtime import broadcast_if, materialize, spread, stored_bytes

# Chapter headings and openings of authors' remarks.
HEADING = regex.compile(r"(?:第\s*[0-9０-９零〇一二两三四五六七八九十百千]+\s*[章回话節节卷]|(?:chapter|chap\.?|chương|volume|vol\.|quyển)\s*\d+)", regex.IGNORECASE)
REMARK = regex.compile(r"^[\s　（(\[【]*(?:作者(?:的话|有话说|说|留言)?\s*[:：]|PS\b|P\.S\.?|ps[:：]|author['’]?s? note|a/n\b|tác giả\s*[:：]|lời tác giả|ghi chú của tác giả)", regex.IGNORECASE)
ENDING = regex.compile(r"[。！？!?.…”’」』\"】\]—~～]['”’」』\")）]*$")
TRAIL = regex.compile(r"\s[/»>›→|·]\s|\s«\s")
NUMBER = regex.compile(r"\d+")

# A title or name in front of a sentence, as lists of other works and comments have it.
LABELLED = regex.compile(r"^\s*(?:《[^》]{1,40}》\s*[:：]|[^\s:：。！？.!?“\"「][^:：。！？.!?“\"「]{0,60}(?:\s[—–]\s|:\s|：))")

TEXT, SENTENCE, HEAD, PATH, ITEM = 0, 1, 2, 3, 4  # kinds of a line that isn't the host's
HOSTS, HOSTS_BYTES = 500, 16 << 20  # hosts and compressed bytes up to which frames and wrappers are broadcast
SALTS = 16  # parts of a site beyond that
FAN = 8  # wrappers that are aligned with each other in one task
SLOT = "\x01"  # in tokens, the host's name
BODY = "\x00body"
OTHER = "\x00text"


def brand_of(site: str | None) -> str:
    return (site or "").split(".")[0].lower()


SHORT = 200  # characters of a line up to which its token and kind are remembered: hosts print the same lines on many pages


def token(line: str, site: str | None, names: tuple[str, ...] = ()) -> str:
    """A line as a token of the host's stream: numbers and the host's names are slots."""
    return (_token if len(line) <= SHORT else _token.__wrapped__)(line, site, names)


@lru_cache(maxsize=1 << 15)
def _token(line: str, site: str | None, names: tuple[str, ...]) -> str:
    t = " ".join(line.split()).lower()
    for name in (site, brand_of(site), *names):
        if name and len(name) > 1:
            t = t.replace(name.lower(), SLOT)
    return NUMBER.sub("#", t)


def kind(line: str) -> int:
    return (_kind if len(line) <= SHORT else _kind.__wrapped__)(line)


@lru_cache(maxsize=1 << 15)
def _kind(line: str) -> int:
    t = line.strip().lstrip("'")
    if HEADING.match(t):
        return HEAD
    if TRAIL.search(t) and not ENDING.search(t):
        return PATH
    if LABELLED.match(t) and not REMARK.match(t):
        return ITEM
    return SENTENCE if ENDING.search(t) or line.startswith("　　") else TEXT


def block(tokens: list[str], kinds: list[int], frame: set[str]) -> tuple[int, int]:
    """The run of lines with the most text and the fewest tokens of the host: a first guess of the body."""
    best, at, total, start = (0.0, 0, 0), 0, 0.0, 0
    for at, (t, k) in enumerate(zip(tokens, kinds)):
        v = 0.0 if not t else -1.5 if t in frame else {SENTENCE: 1.0, HEAD: 0.6, TEXT: -0.4, ITEM: 0.2, PATH: -2.0}[k]
        if total <= 0:
            total, start = 0.0, at
        total += v
        if total > best[0]:
            best = (total, start, at + 1)
    return best[1], best[2]


def skeleton(tokens: list[str], kinds: list[int], frame: set[str]) -> tuple[list[str], list[str]]:
    """(symbols of the page: host tokens, the body, other text), (host tokens inside the body)."""
    a, b = block(tokens, kinds, frame)
    out: list[str] = []
    inside = [t for t in tokens[a:b] if t in frame]
    for i, t in enumerate(tokens):
        s = BODY if a <= i < b else t if t in frame else OTHER if t else None
        if s and not (out and s == out[-1]):
            out.append(s)
    return out, inside


def align(wrapper: list[list], symbols: list[tuple[str, int]]) -> list[list]:
    """``wrapper`` (nodes [symbol, count]) aligned with another stream.

    A longest common subsequence matches the nodes; what only one side holds
    becomes an optional node in its place. A node whose count is below that of
    the body is optional, one that follows itself in a stream is repeated.
    """
    n, m = len(wrapper), len(symbols)
    score = [[0.0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        for j in range(m - 1, -1, -1):
            same = score[i + 1][j + 1] + (8.0 if wrapper[i][0] == BODY else 0.5 if wrapper[i][0] == OTHER else 1.0) if wrapper[i][0] == symbols[j][0] else -1.0
            score[i][j] = max(same, score[i + 1][j], score[i][j + 1])
    out, i, j = [], 0, 0
    while i < n or j < m:
        if i < n and j < m and wrapper[i][0] == symbols[j][0] and score[i][j] > max(score[i + 1][j], score[i][j + 1]):
            out.append([wrapper[i][0], wrapper[i][1] + symbols[j][1]])
            i, j = i + 1, j + 1
        elif j == m or (i < n and score[i + 1][j] >= score[i][j + 1]):
            out.append(wrapper[i])
            i += 1
        else:
            out.append([symbols[j][0], symbols[j][1]])
            j += 1
    return out


def infer(streams: list[tuple[list[str], int]], wrapper: list[list] | None = None) -> list[list]:
    """The wrapper of a host's streams with their counts, the most frequent first."""
    wrapper = wrapper or []
    for symbols, times in sorted(streams, key=lambda x: (-x[1], len(x[0]), x[0])):
        wrapper = align(wrapper, [(s, times) for s in symbols])
    return wrapper


def roles(wrapper: list[list]) -> dict[str, list[float]]:
    """For each token of a wrapper, its counts before, inside and after the body slot."""
    bodies = [i for i, (s, _) in enumerate(wrapper) if s == BODY]
    out: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0])
    at = max(bodies, key=lambda i: wrapper[i][1]) if bodies else len(wrapper)
    for i, (s, c) in enumerate(wrapper):
        if s not in (BODY, OTHER):
            out[s][0 if i < at else 2] += c
    return out


def label(tokens: list[str], kinds: list[int], remarks: list[bool], role: dict[str, tuple[float, float, float]]) -> list[bool]:
    """For each line, whether it is of the main body: the likeliest header, body and footer."""
    cost = []
    for t, k, r in zip(tokens, kinds, remarks):
        if not t:
            cost.append((0.0, 0.0, 0.0))
        elif r:
            cost.append((-2.0, 0.0, -2.0))
        elif SLOT in t and t not in role:
            cost.append((0.0, -0.5, 0.0))
        elif t in role:
            c = role[t]
            total = sum(c) + 0.3
            cost.append(tuple(max(-4.0, math.log((x + 0.1) / total)) for x in c))
        else:
            cost.append({SENTENCE: (-2.5, 0.0, -3.5), HEAD: (-3.0, 0.0, -1.5), TEXT: (-0.7, -1.4, -0.7), ITEM: (-1.0, -0.8, -0.2), PATH: (-0.2, -4.0, -0.7)}[k])
    n = len(cost)
    head, body, foot = 0.0, -1e9, -1e9
    back = []
    for c in cost:
        # the body begins after the head, the foot after either
        to_body = 1 if body >= head else 0
        top = body if to_body else head
        to_foot = 2 if foot >= top else to_body
        back.append((0, to_body, to_foot))
        head, body, foot = head + c[0], top + c[1], (foot if to_foot == 2 else top) + c[2]
    s = 0 if head >= body and head >= foot else 1 if body >= foot else 2
    state = [0] * n
    for i in range(n - 1, -1, -1):
        state[i] = s
        s = back[i][s]
    own = [state[i] == 1 and bool(tokens[i]) and ((tokens[i] not in role and SLOT not in tokens[i]) or remarks[i]) for i in range(n)]
    if not any(own[i] and kinds[i] in (SENTENCE, HEAD) and not remarks[i] for i in range(n)):
        return [False] * n
    return own


SEPARATOR = regex.compile(r"\s+[-–—|·»]\s+|[_|｜]|\s*[（(【\[]")


def title_parts(title: str) -> tuple[str, bool]:
    """(chapter heading, whether the title holds more than it)."""
    t = title.strip().lstrip("'").strip()
    m = HEADING.search(t)
    if not m:
        cut = SEPARATOR.search(t)
        return (t[: cut.start()].strip(), True) if cut and cut.start() > 0 else (t, False)
    head = t[m.start() :]
    after = regex.compile(r"\s*[-–—:：.、]?\s*").match(head, m.end() - m.start()).end()
    cut = SEPARATOR.search(head, after)
    own = head[: cut.start()].strip() if cut else head
    return own, m.start() > 0 or cut is not None


def inner(kinds: list[int], tokens: list[str]) -> list[bool]:
    """For each line, whether sentences stand among the three lines before and the three after it."""
    full = [i for i, t in enumerate(tokens) if t]
    out = [False] * len(tokens)
    for k, i in enumerate(full):
        out[i] = any(kinds[j] == SENTENCE for j in full[max(0, k - 3) : k]) and any(kinds[j] == SENTENCE for j in full[k + 1 : k + 4])
    return out


def host_names(pages: DataFrame, share: float = 0.03) -> DataFrame:
    """site, own: what the host calls itself, from what its titles hold beside the heading: the most frequent name and those at least half as frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            site, name = [], []
            for s, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = HEADING.search(t or "")
                if not m:
                    continue
                parts = [t[: m.start()].strip().rstrip(":：").strip()] if t[: m.start()].rstrip().endswith((":", "：")) else []
                cut = SEPARATOR.search(t, m.end() + 3)
                if cut and t[cut.start() : cut.end()].strip() not in ("（", "(", "【", "["):
                    parts.append(regex.split(r"[-–—|·»_｜]", t)[-1].strip())
                for p in parts:
                    if len(p) > 1:
                        site.append(s or "")
                        name.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(site, pa.string()), pa.array(name, pa.string())], names=["site", "name"])

    n = pages.groupBy(F.coalesce("site", F.lit("")).alias("site")).agg(F.count("*").alias("pages"))
    found = pages.select("site", "title").mapInArrow(run, "site string, name string").groupBy("site", "name").agg(F.count("*").alias("n"))
    return found.join(n, "site").where((F.col("n") >= 2) & (F.col("n") >= share * F.col("pages"))).groupBy("site").agg(F.collect_list(F.struct("n", "name")).alias("own")).select("site", F.transform(F.filter("own", lambda x: 2 * x["n"] >= F.array_max("own")["n"]), lambda x: x["name"]).alias("own"))  # at most 2 / share of them


def with_host(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """``pages`` with what ``hosts`` (one row a site) says of their site: broadcast while it is small, else joined in salted parts, as a site may hold a third of the pages."""
    h = materialize(hosts, "hosts")
    if stored_bytes(h) <= HOSTS_BYTES and h.limit(HOSTS + 1).count() <= HOSTS:
        return pages.join(F.broadcast(h), "site", "left")
    many = h.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return pages.withColumn("_salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(many, ["site", "_salt"], "left").drop("_salt")


def streams(pages: DataFrame) -> DataFrame:
    """page_id, site, title, content, tokens, kinds and inner flags of each page, garbled text restored first."""
    names = host_names(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                ids, site, title, content, own = (b.column(k) for k in range(5))
                texts, tokens, kinds, inside = [], [], [], []
                for s, t, names in zip(site.to_pylist(), content.to_pylist(), own.to_pylist()):
                    lines = [x.rstrip("\r") for x in (repair(t)[0] or "").replace("\ufeff", "").replace("\u200b", "").split("\n")] if t is not None else []
                    known = tuple(sorted(names or (), key=lambda x: (-len(x), x)))
                    ts, ks = [token(x, s, known) for x in lines], [kind(x) for x in lines]
                    texts.append("\n".join(lines) if t is not None else None)
                    tokens.append(ts)
                    kinds.append(ks)
                    inside.append(inner(ks, ts))
                yield pa.RecordBatch.from_arrays([ids, site, pa.array([repair(t)[0] for t in title.to_pylist()], pa.string()), pa.array(texts, pa.string()), pa.array(tokens, pa.list_(pa.string())), pa.array(kinds, pa.list_(pa.int32())), pa.array(inside, pa.list_(pa.bool_()))], names=["page_id", "site", "title", "content", "tokens", "kinds", "inner"])

    return (
        with_host(spread(pages.select("page_id", F.coalesce("site", F.lit("")).alias("site"), "title", "content")), names)
        .select("page_id", "site", "title", "content", "own")
        .mapInArrow(run, "page_id long, site string, title string, content string, tokens array<string>, kinds array<int>, inner array<boolean>")
    )


def frames(stream: DataFrame, share: float = 0.02, sentence_share: float = 0.08, outer_share: float = 0.005) -> DataFrame:
    """site, frame: the tokens that the host itself prints.

    A token is the host's when it is on ``share`` of its pages (sentences:
    ``sentence_share``, or ``outer_share`` when they mostly stand beside other
    sentences on one side at most) and on three at least, or when three hosts
    print it on a quarter of ``share`` of all pages. Openings of authors'
    remarks and chapter headings never are. Counting is a pre-aggregated groupBy; a host has at most
    lines-per-page / share tokens.
    """
    n = stream.groupBy("site").agg(F.count("*").alias("pages"))
    seen = (
        stream.select("site", F.explode(F.array_distinct(F.arrays_zip("tokens", "kinds", "inner"))).alias("t"))
        .where((F.col("t.tokens") != "") & (F.col("t.kinds") != HEAD))
        .groupBy("site", F.col("t.tokens").alias("token"))
        .agg(F.count("*").alias("df"), F.max(F.col("t.kinds") == SENTENCE).alias("sentence"), F.sum(F.col("t.inner").cast("int")).alias("inside"))
        .where("df >= 2")
    )
    seen = materialize(seen, "tokens")
    all_pages = n.agg(F.sum("pages").alias("all_pages"))
    wide = seen.groupBy("token").agg(F.sum("df").alias("all_df"), F.count("*").alias("hosts"), F.sum("inside").alias("all_inside"), F.max("sentence").alias("wide_sentence"))
    wide = wide.where("hosts >= 3 and (not wide_sentence or 2 * all_inside < all_df)").crossJoin(F.broadcast(all_pages))  # one row
    wide = wide.where(F.col("all_df") >= F.when(F.col("wide_sentence"), outer_share / 4).otherwise(share / 4) * F.col("all_pages")).select("token", F.lit(True).alias("wide"))
    need = F.when(~F.col("sentence"), share).when(2 * F.col("inside") < F.col("df"), outer_share).otherwise(sentence_share)
    return (
        seen.join(n, "site").join(wide, "token", "left")
        .where(((F.col("df") >= need * F.col("pages")) & (F.col("df") >= 3)) | F.col("wide"))
        .groupBy("site").agg(F.collect_set("token").alias("frame"))
    )


def wrappers(stream: DataFrame, frame: DataFrame, each: int = 2000) -> DataFrame:
    """site, roles: what the wrapper inferred for each host says of its tokens.

    Equal skeletons are counted first. A host's skeletons are aligned in parts
    of about ``each``, and the parts' wrappers, which are as long as the host's
    template, are aligned with each other.
    """

    def skeletons(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            cache: dict[str, set[str]] = {}
            for r in b.to_pylist():
                f = cache.get(r["site"])
                if f is None:
                    f = cache[r["site"]] = set(r["frame"] or ())
                symbols, inside = skeleton(r["tokens"], r["kinds"], f)
                rows.append({"site": r["site"], "symbols": symbols, "inside": inside})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("site", pa.string()), ("symbols", pa.list_(pa.string())), ("inside", pa.list_(pa.string()))]))

    sk = materialize(with_host(stream.select("page_id", "site", "tokens", "kinds"), frame).mapInArrow(skeletons, "site string, symbols array<string>, inside array<string>"), "skeletons")
    inside = sk.select("site", F.explode("inside").alias("token")).groupBy("site", "token").agg(F.count("*").alias("n"))
    inside = inside.groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("token", F.col("n").cast("double")))).alias("inside"))

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        w = infer([(list(s), int(n)) for s, n in zip(pdf["symbols"], pdf["n"])])
        return pd.DataFrame({"site": [pdf["site"].iloc[0]], "salt": [int(pdf["salt"].iloc[0])], "symbols": [[s for s, _ in w]], "counts": [[int(c) for _, c in w]]})

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        w: list[list] = []
        for s, c in sorted(zip(pdf["symbols"], pdf["counts"]), key=lambda x: (-sum(x[1]), list(x[0]))):
            w = align(w, list(zip(s, [int(x) for x in c])))
        return pd.DataFrame({"site": [pdf["site"].iloc[0]], "salt": [int(pdf["next"].iloc[0])], "symbols": [[s for s, _ in w]], "counts": [[int(c) for _, c in w]]})

    def told(pdf: pd.DataFrame) -> pd.DataFrame:
        r = roles(list(zip(pdf["symbols"].iloc[0], map(int, pdf["counts"].iloc[0]))))
        return pd.DataFrame({"site": [pdf["site"].iloc[0]], "token": [list(r)], "before": [[r[t][0] for t in r]], "after": [[r[t][2] for t in r]]})

    counted = materialize(sk.groupBy("site", "symbols").agg(F.count("*").alias("n")), "counted")
    parts_of = materialize(counted.groupBy("site").agg(F.ceil(F.count("*") / each).alias("parts")), "parts")
    most = parts_of.agg(F.max("parts")).first()[0] or 1
    counted = counted.join(broadcast_if(parts_of), "site").withColumn("salt", F.pmod(F.xxhash64("symbols"), F.col("parts")).cast("int"))
    wrapper = counted.groupBy("site", "salt").applyInPandas(part, "site string, salt int, symbols array<string>, counts array<int>")
    while most > 1:  # a tree: FAN wrappers become one in a task
        wrapper = wrapper.withColumn("next", F.expr(f"salt div {FAN}").cast("int")).groupBy("site", "next").applyInPandas(merged, "site string, salt int, symbols array<string>, counts array<int>")
        most = -(-most // FAN)
    done = wrapper.groupBy("site").applyInPandas(told, "site string, token array<string>, before array<double>, after array<double>")
    return done.join(inside, "site", "left")


def main_bodies(pages: DataFrame) -> DataFrame:
    """For each page: page_id, own (for each line, whether it is of the body), body, heading, title_extra.

    ``own`` has an entry for each piece of ``content`` between line feeds; blank
    lines are never of the body and never boilerplate. Null content gives an
    empty list, a page without a body only false entries. A null title is no
    case; a null site is a host of its own. Repeated pages are judged alike.
    """
    stream = materialize(streams(pages), "streams")
    frame = materialize(frames(stream), "frames")
    wrapper = materialize(wrappers(stream, frame), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, dict[str, tuple[float, float, float]]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                cols = {name: b.column(name) for name in ("page_id", "site", "title", "content", "tokens", "kinds")}
                owns, blanks, bodies, heads, extras = [], [], [], [], []
                rows = zip(*(cols[name].to_pylist() for name in ("site", "title", "content", "tokens", "kinds")))
                for i, (site, title, content, tokens, kinds) in enumerate(rows):
                    role = cache.get(site)
                    if role is None:
                        role = cache[site] = _role(*(b.column(name)[i].as_py() for name in ("token", "before", "after", "inside")))
                    lines = content.split("\n") if content is not None else []
                    own = label(tokens, kinds, [bool(REMARK.match(x)) for x in lines], role)
                    heading, extra = title_parts(title) if title is not None else (None, False)
                    owns.append(own)
                    blanks.append([not t for t in tokens])
                    bodies.append("\n".join(x for x, o in zip(lines, own) if o))
                    heads.append(heading)
                    extras.append(extra)
                yield pa.RecordBatch.from_arrays([cols["page_id"], pa.array(owns, pa.list_(pa.bool_())), pa.array(blanks, pa.list_(pa.bool_())), pa.array(bodies, pa.string()), pa.array(heads, pa.string()), pa.array(extras, pa.bool_())], names=["page_id", "own", "blank", "body", "heading", "title_extra"])

    return with_host(stream.select("page_id", "site", "title", "content", "tokens", "kinds"), wrapper).mapInArrow(run, "page_id long, own array<boolean>, blank array<boolean>, body string, heading string, title_extra boolean")


def _role(token: list[str] | None, before: list[float] | None, after: list[float] | None, inside: list[tuple[str, float]] | None) -> dict[str, tuple[float, float, float]]:
    """For each token of a host, how often it stands before, inside and after the body."""
    role = {t: (x, 0.0, y) for t, x, y in zip(token or (), before or (), after or ())}
    for t, n in inside or ():
        x = role.get(t, (0.0, 0.0, 0.0))
        role[t] = (x[0], n, x[2])
    return role


def boilerplate_lines(bodies: DataFrame) -> DataFrame:
    """page_id, line_no of each line outside the body, and line 0 for titles with more than the heading."""
    lines = F.transform(F.arrays_zip("own", "blank"), lambda x, i: F.when(~x["own"] & ~x["blank"], i + 1))
    found = F.filter(F.concat(F.array(F.when(F.col("title_extra"), 0)), lines), lambda n: n.isNotNull())
    return bodies.select("page_id", F.explode(found).alias("line_no"))
