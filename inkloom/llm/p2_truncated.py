"""Texts that were cut off: near copies that end early, and endings that don't close."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.grams import DIGIT, HAN, LETTER, LINE, MARK, U64, Tokens, bands, classes, mix, shingles, tokens
from inkloom.runtime import materialize, spread

SLOTS, LENGTHS = 1 << 20, (1, 2)  # of the closing-word table, whatever the input
CHUNK = 1 << 13
SHINGLE, BANDS, ROWS = 5, 8, 3
HOT, FEW = 256, 1_000_000  # texts in a band that is joined by what follows too; pairs whose ids are broadcast
FAN = 16  # texts of a hot band that a text is verified against at once
ENDS = 4  # words before a text's last that a copy must hold

# Signs put in place of a lost rest, and constructs that were left unfinished.
PUT_IN = regex.compile(r"(?:\[\s*\+?\s*\d+\s*(?:chars?|characters|字|ký tự)\s*\]|\[\s*(?:\.{3}|…+|truncated|cut)\s*\]|[(（]\s*(?:read more|more|continue reading|阅读全文|查看全文|展开全文|xem thêm|đọc tiếp|đọc thêm)\s*[)）]|<(?:truncated|cut)>)\s*$", regex.IGNORECASE)
UNFINISHED = regex.compile(r"(?:&#?[0-9A-Za-z]{0,8}|\\u[0-9a-fA-F]{0,3}|\\x[0-9a-fA-F]?|\\|</?(?:[A-Za-z][^<>]{0,200})?|%[0-9A-F]?|�+)$")
CLOSERS = "”’」』】》〉）)]}\"'»"
STOPS = "。！？!?.…"
BLANK = " \t\n\r\x0b\x0c\x85\xa0　​‌‍﻿  "
MAY_GO_ON = "10 * length >= 9 * size and 5 * size >= 4 * length and other <> rep"  # by their words
COMPLETE, CUT, OPEN, ELLIPSIS = 0, 1, 2, 3  # OPEN: no stop, or a closing mark; ELLIPSIS: stops in one


def ending(text: str) -> int:
    """How a text ends, by its last characters alone."""
    t = text[-400:].rstrip(BLANK)
    if not t:
        return COMPLETE
    if PUT_IN.search(t):
        return CUT
    if UNFINISHED.search(t[-210:]):
        return CUT
    line = t[max(t.rfind("\n"), t.rfind("\r")) + 1 :]
    if line.rfind("“") > line.rfind("”") or line.rfind("「") > line.rfind("」") or line.rfind("『") > line.rfind("』"):
        return CUT
    if t.endswith(('."', '。"')):
        return COMPLETE
    if t[-1] in "”」』\"":  # an utterance of more than one sentence, or begun lines before, is whole
        inner = line[line[:-1].rfind("“「『\""["”」』\"".index(t[-1])]) + 1 : -1]
        if inner == line[:-1] or inner.endswith(("。", ".")) or any(c in STOPS for c in inner.rstrip(STOPS)):
            return COMPLETE
    if t[-1] == "…" or t.endswith(".."):
        return ELLIPSIS
    return COMPLETE if t[-1] in STOPS else OPEN


def last_line(text: str) -> int:
    """A hash of a text's last line, its numbers left out."""
    line = text[max(text.rfind("\n"), text.rfind("\r")) + 1 :]
    return xxhash.xxh64_intdigest(regex.sub(r"\d+", "#", line.strip(BLANK))) - (1 << 63)


def closing_ngrams(t: Tokens) -> dict[str, np.ndarray]:
    """Tokens for closings: names and numbers are one each, runs of names one together."""
    h = np.where(t.kind == DIGIT, U64(11), np.where(t.cap & (t.kind == LETTER), U64(13), t.hash))
    if len(h) > 1:  # marks after a Han character are other marks than those after a word
        h[1:] = np.where((t.kind[1:] == MARK) & (t.kind[:-1] == HAN), h[1:] ^ U64(0x5DEECE66D), h[1:])
    keep = np.ones(len(h), dtype=bool)
    if len(h) > 1:
        keep[:-1] = ~((h[1:] == U64(13)) & (h[:-1] == U64(13)) & (t.doc[1:] == t.doc[:-1]))  # the last of a run of names stays
    h, doc, kind, end = h[keep], t.doc[keep], t.kind[keep], t.end[keep]
    if len(h) > 2:  # names and numbers say little: they carry the two tokens before them
        vague = (h[2:] == U64(11)) | (h[2:] == U64(13))
        same = doc[2:] == doc[:-2]
        h = np.concatenate([h[:2], np.where(vague & same, mix(h[2:] * U64(31) + h[1:-1] * U64(0x100000001B3) + h[:-2]), h[2:])])
    cls, _ = classes()
    n = len(t.codes)
    # what follows: over spaces, a line end (or the text's), or marks with a stop
    following = np.minimum(end, n - 1)
    for _ in range(3):
        blank = cls[t.codes[following]] == 0
        following = np.where(blank, np.minimum(following + 1, n - 1), following)
    line_end = cls[t.codes[following]] == LINE
    nxt_mark = cls[t.codes[np.minimum(end, n - 1)]] == MARK
    last = np.ones(len(h), dtype=bool)
    last[:-1] = doc[1:] != doc[:-1]
    near = last.copy()  # the last token of a text, or the one before its last marks
    near[:-1] |= last[1:] & (kind[1:] == MARK) & (doc[1:] == doc[:-1])
    stop = nxt_mark & np.isin(t.codes[np.minimum(end, n - 1)], np.array([ord(c) for c in STOPS], dtype=np.uint32))
    grams = []
    s = h.copy()
    grams.append(mix(s + U64(1)))
    for k in range(1, max(LENGTHS)):
        prev = np.zeros(len(h), dtype=U64)
        prev[k:] = np.where(doc[k:] == doc[:-k], h[:-k], U64(0)) if len(h) > k else prev[k:]
        s = s * U64(0x100000001B3) + prev
        grams.append(mix(s + U64(k + 1)))
    # ends of texts say nothing of what closes one: they are counted for marks alone
    stop = np.where(kind == MARK, last, stop & ~near)
    return {"doc": doc, "kind": kind, "inside": ~near, "line": line_end & ~near, "stop": stop, "slots": [(g % U64(SLOTS)).astype(np.int64) for g in grams]}


_ROW = pa.schema([("row_id", pa.int64()), ("source", pa.string()), ("how", pa.int32()), ("size", pa.int32()), ("text_hash", pa.int64()), ("last_line", pa.int64()), ("tail", pa.list_(pa.int32())), ("bands", pa.list_(pa.int64())), ("last_words", pa.int32()), ("going_on", pa.list_(pa.int32())), ("chunk", pa.int32()), ("counts", pa.binary())])
_ROW_DDL = "row_id long, source string, how int, size int, text_hash long, last_line long, tail array<int>, bands array<long>, last_words int, going_on array<int>, chunk int, counts binary"


def end_words(h: np.ndarray, doc: np.ndarray, docs: int) -> tuple[pa.Array, pa.Array]:
    """For each text a hash of the ENDS words before its last one, and of all such runs in it that a text of 0.8 of its words could end in."""
    n = np.bincount(doc, minlength=docs)
    first = np.cumsum(n) - n
    run = np.zeros(max(0, len(h) - ENDS + 1), dtype=U64)
    for j in range(ENDS):
        run = run * U64(0x100000001B3) + h[j : len(h) - ENDS + 1 + j]
    run = (mix(run) >> U64(32)).astype(np.uint32).view(np.int32)
    has = n > ENDS
    last = pa.array(run[np.where(has, first + n - 1 - ENDS, 0)] if len(run) else np.zeros(docs, np.int32), pa.int32(), mask=~has)
    # runs that end before word i, which is followed by another
    lo, hi = first + np.maximum(0, n * 18 // 25 - 1 - ENDS), first + n - 1 - ENDS
    size = np.where(n > ENDS + 1, np.maximum(0, hi - lo), 0)
    at = np.arange(size.sum()) + np.repeat(lo - np.cumsum(size) + size, size)
    return last, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(run[at], pa.int32()))


def features(df: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """One row for each text (ending, closing n-grams, band keys), and each task's closing counts in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros((len(LENGTHS), 3, SLOTS), dtype=np.int32)
        held: dict[tuple[int, int], list[np.ndarray]] = {(k, j): [] for k in range(len(LENGTHS)) for j in range(3)}
        many = 0

        def count() -> None:
            for (k, j), slots in held.items():
                if slots:
                    table[k, j] += np.bincount(np.concatenate(slots), minlength=SLOTS).astype(np.int32)
                    slots.clear()

        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                texts = [x.rstrip(BLANK) for x in b.column(2).to_pylist()]
                t = tokens(texts)
                c = closing_ngrams(t)
                for k, slots in enumerate(c["slots"]):
                    for j, w in enumerate((c["inside"], c["line"], c["stop"])):
                        held[k, j].append(slots[w])
                many += len(c["doc"])
                if many > SLOTS:
                    count()
                    many = 0
                how = [ending(x) for x in texts]
                last = np.full(len(texts), -1, dtype=np.int64)
                last[c["doc"]] = np.arange(len(c["doc"]))  # the last of each text wins
                before = np.where((last >= 0) & (np.array(how) == ELLIPSIS) & (c["kind"][last] == MARK) if len(c["kind"]) else False, last - 1, last)
                tails = [[int(s[i]) for s in c["slots"]] + [int(c["slots"][0][last[d]]), int(i > 0 and c["kind"][i] == HAN)] if i >= 0 and c["doc"][i] == d else [] for d, i in enumerate(before)]
                word = t.kind != MARK
                s, doc = shingles(t.hash[word], t.doc[word], SHINGLE)
                keys = bands(s, doc, len(texts), BANDS, ROWS).astype(np.int64)
                size = np.bincount(t.doc[word], minlength=len(texts))
                sums = np.zeros(len(texts), dtype=U64)
                np.add.at(sums, t.doc[word], mix(t.hash[word] + np.arange(word.sum(), dtype=U64) - np.repeat(np.cumsum(size) - size, size).astype(U64)))
                last_words, on = end_words(t.hash[word], t.doc[word], len(texts))
                m = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(how, pa.int32()), pa.array(size.astype(np.int32)), pa.array(sums.astype(np.int64)), pa.array([last_line(x) if e in (OPEN, ELLIPSIS) else None for x, e in zip(texts, how)], pa.int64()), pa.array(tails, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.reshape(-1))), last_words, on, pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                    schema=_ROW,
                )
        count()
        flat = table.reshape(-1)
        for i in range(0, len(flat), CHUNK):
            part = flat[i : i + CHUNK]
            if part.any():
                at = np.flatnonzero(part)
                packed = np.concatenate([at.astype("<i4"), part[at].astype("<i4")]).tobytes()
                yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in list(_ROW)[:10]] + [pa.array([i // CHUNK], pa.int32()), pa.array([packed], pa.binary())], schema=_ROW)

    cols = [F.col(key).cast("long").alias("row_id"), F.col(source).alias("source"), F.col(text).alias("text")]
    return spread(df.where(F.col(text).isNotNull()).select(*cols)).mapInArrow(run, _ROW_DDL)


def closing_table(feats: DataFrame) -> np.ndarray:
    """The closing counts of all texts: SLOTS x lengths x 3 numbers, however large the input."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, dtype=np.int64)
        for raw in pdf["counts"]:
            a = np.frombuffer(raw, dtype="<i4").reshape(2, -1)
            total[a[0]] += a[1]
        at = np.flatnonzero(total)
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "counts": [np.concatenate([at, np.minimum(total[at], 2**31 - 1)]).astype("<i4").tobytes()]})

    flat = np.zeros(len(LENGTHS) * 3 * SLOTS, dtype=np.int32)
    for r in feats.where("chunk is not null").select("chunk", "counts").groupBy("chunk").applyInPandas(add, "chunk int, counts binary").collect():
        a = np.frombuffer(r.counts, dtype="<i4").reshape(2, -1)
        flat[r.chunk * CHUNK + a[0]] = a[1]
    return flat.reshape(len(LENGTHS), 3, SLOTS)


def open_share(table: np.ndarray, how: int, tail: list[int], least: int = 4) -> float | None:
    """How often the longest known closing n-gram closes a line (ELLIPSIS: a sentence) inside the texts.

    None when no text holds it inside. An ellipsis that hardly ever stands
    inside a text, unlike the corpus's own, was put in place of a lost rest: 0.
    """
    if how == ELLIPSIS:
        inside, at_end = int(table[0, 0, tail[-1]]), int(table[0, 2, tail[-1]])
        if inside < at_end:
            return 0.0
    for k in range(len(LENGTHS) - 1, -1, -1):
        every = int(table[k, 0, tail[k]])
        if every >= least:
            return int(table[k, 2 if how == ELLIPSIS else 1, tail[k]]) / every
    return None


def judged(feats: DataFrame, close: float = 0.3, stop: float = 0.04, han_stop: float = 0.002, formula: float = 0.004) -> DataFrame:
    """row_id, source, how, size, text_hash, cut: from the ending and its closing word.

    A closing word that no text holds inside, half a word for the most part, is
    cut. A last line that is the last of ``formula`` of all open endings, or of
    those in an ellipsis (250 lines each at most, so they are sent to all tasks), is a formula, not a loss.
    Texts are counted for that, not rows: copies of one text say nothing of how usual its last line is.
    """
    table = closing_table(feats)
    spark = feats.sparkSession
    rows = feats.where("chunk is null")
    last = rows.where("last_line is not null").select("how", "last_line", "text_hash", "size").distinct().groupBy("how", "last_line").agg(F.count("*").alias("n"))
    least = last.groupBy("how").agg(F.greatest(F.lit(5), formula * F.sum("n")).alias("least"))
    formulas = {r.last_line for r in last.join(F.broadcast(least), "how").where("n >= least").select("last_line").collect()}
    shared = spark.sparkContext.broadcast((table, formulas))  # its size is fixed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, usual = shared.value
        for b in batches:
            cut = []
            for how, tail, line in zip(b.column(2).to_pylist(), b.column(5).to_pylist(), b.column(6).to_pylist()):
                if how in (OPEN, ELLIPSIS) and tail:
                    s = open_share(t, how, tail[:-1])
                    lost = not (how == ELLIPSIS and tail[-1]) if s is None else s < (close if how == OPEN else han_stop if tail[-1] else stop)
                    cut.append(lost and line not in usual)
                else:
                    cut.append(how == CUT)
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(cut, pa.bool_())], names=["row_id", "source", "how", "size", "text_hash", "cut"])

    return rows.select("row_id", "source", "how", "size", "text_hash", "tail", "last_line").mapInArrow(run, "row_id long, source string, how int, size int, text_hash long, cut boolean")


def copies_that_go_on(feats: DataFrame, df: DataFrame, key: str, text: str) -> DataFrame:
    """row_id of texts with an open ending that a near copy continues.

    Equal texts are one node. Each node with an open ending is verified on the
    texts against every member, of 0.9 to 1.25 times its words, of each band it
    shares that holds its last words and goes on after them: aligned with the
    other, it must be (but for a tenth of its words) the other's beginning. Members of
    hot bands are joined by these words, in slots of FAN texts; a node tries
    more slots until a copy continues it or none is left.
    """
    nodes = feats.where(F.col("chunk").isNull() & (F.col("size") > 0)).groupBy("text_hash", "size").agg(F.min("row_id").alias("rep"), F.min("how").alias("how"), F.min_by("bands", "row_id").alias("bands"), F.min_by("last_words", "row_id").alias("last_words"))
    keyed = nodes.select("rep", "size", "last_words", F.col("how").isin(OPEN, ELLIPSIS).alias("open"), F.explode(F.array_distinct("bands")).alias("band"))
    shared = keyed.groupBy("band").agg(F.count("*").alias("n"), F.count_if("open").alias("n_open")).where("n > 1 and n_open > 0").drop("n_open")
    near = materialize(keyed.join(shared, "band"), "near")
    ends = near.where("open and last_words is not null").drop("open")
    others = near.select("band", "n", F.col("rep").alias("other"), F.col("size").alias("length"))
    rest = feats.where("chunk is null").select(F.col("row_id").alias("other"), "going_on")

    def of_ids(table: DataFrame, ids: DataFrame, name: str) -> DataFrame:
        few = ids.count() <= FEW  # the ids are then 8 MB at most; beyond that the rows are shuffled
        return table.join(F.broadcast(ids) if few else ids, name, "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = b.to_pydict()
            yield pa.RecordBatch.from_arrays([pa.array([r for r, s, x in zip(d["rep"], d["short"], d["long"]) if ends_early(s, x)], pa.int64())], names=["rep"])

    def continued(pairs: DataFrame) -> DataFrame:
        pairs = materialize(pairs.distinct(), "pairs")
        texts = of_ids(df.select(F.col(key).cast("long").alias("rep"), F.col(text).alias("short")), pairs.select(F.explode(F.array("rep", "other")).alias("rep")).distinct(), "rep")
        both = pairs.join(texts, "rep").join(texts.select(F.col("rep").alias("other"), F.col("short").alias("long")), "other")
        return both.select("rep", "short", "long").mapInArrow(run, "rep long").distinct()

    usual = materialize(ends.where(F.col("n") <= HOT).join(others.where(F.col("n") <= HOT).drop("n"), "band").where(MAY_GO_ON).select("rep", "last_words", "other").distinct(), "usual")
    early = materialize(continued(usual.join(of_ids(rest, usual.select("other").distinct(), "other"), "other").where("array_contains(going_on, last_words)").select("rep", "other")), "early")

    hot, many = ends.where(F.col("n") > HOT), others.where(F.col("n") > HOT).drop("n")
    if not hot.isEmpty():
        runs = many.join(of_ids(rest, many.select("other").distinct(), "other"), "other").select("band", "other", "length", F.explode("going_on").alias("last_words"))
        runs = materialize(runs.join(hot.select("band", "last_words").distinct(), ["band", "last_words"], "left_semi"), "runs")
        slots = runs.groupBy("band", "last_words").agg(F.ceil(F.count("*") / FAN).cast("int").alias("slots"))
        placed = materialize(runs.join(slots, ["band", "last_words"]).withColumn("slot", F.pmod(F.xxhash64("other"), "slots").cast("int")).drop("slots"), "placed")
        left, tried, width = materialize(hot.drop("n").join(slots, ["band", "last_words"]), "left"), 0, 1
        while not (left := left.where(F.col("slots") > tried).join(early, "rep", "left_anti")).isEmpty():
            at = left.withColumn("slot", F.explode(F.sequence(F.lit(tried), F.least(F.col("slots"), F.lit(tried + width)) - 1)))
            pairs = at.join(placed, ["band", "last_words", "slot"]).where(MAY_GO_ON).select("rep", "other")
            early = materialize(early.unionByName(continued(pairs)).distinct(), "early")
            tried, width = tried + width, 4 * width
    members = feats.where("chunk is null").select("row_id", "text_hash", "size")
    return early.join(nodes.select("rep", "text_hash", "size"), "rep").join(members, ["text_hash", "size"]).select("row_id")


@lru_cache(maxsize=64)  # pairs come in the order of their other text
def words(text: str) -> list[int]:
    t = tokens([text.rstrip(BLANK)])
    return t.hash[t.kind != MARK].tolist()


def ends_early(short: str, long: str) -> bool:
    """Whether the first text, aligned with the second, ends inside it: nine in ten of the words match on either side."""
    a, b = words(short), words(long)
    m = len(a) - 1  # the last word may be cut itself
    if m < ENDS or len(a) < 0.8 * len(b) or len(b) < 0.9 * m:
        return False
    end = a[m - ENDS : m]
    at = [j for j in range(max(ENDS, int(0.9 * m)), len(b)) if b[j - 1] == end[-1] and b[j - ENDS : j] == end]
    if not at or at[0] > len(b) - 2 or sum((Counter(a[:m]) & Counter(b[: at[-1]])).values()) < 0.9 * m:
        return False
    # the longest common subsequence of a[:m] and of each beginning of b, a bit for each word of a
    where: dict[int, int] = {}
    for i, x in enumerate(a[:m]):
        where[x] = where.get(x, 0) | 1 << i
    full = rows = (1 << m) - 1
    ends, best = set(at), None
    for j, x in enumerate(b[: at[-1]], 1):
        hit = rows & where.get(x, 0)
        rows = ((rows + hit) | (rows - hit)) & full
        if j in ends:
            same = m - rows.bit_count()
            score = (2 * same - m - j, j)  # words left over; of equal ones the later
            if best is None or score > best[0]:
                best = score, same >= 0.9 * max(m, j)
    return best[1] and best[0][1] <= len(b) - 2  # the longer goes on


def truncated(df: DataFrame, key: str = "row_id", text: str = "content", source: str = "source") -> DataFrame:
    """row_id, source, cut for each row whose text isn't null.

    Texts that are empty or hold no words are not cut. Repeated rows are judged
    alike. A null source is a source of its own.
    """
    feats = materialize(features(df, key, text, source), "features")
    by_ending = judged(feats)
    going_on = copies_that_go_on(feats, df.where(F.col(text).isNotNull()), key, text).distinct().withColumn("early", F.lit(True))
    return by_ending.join(going_on, "row_id", "left").select("row_id", "source", (F.col("cut") | F.coalesce("early", F.lit(False))).alias("cut"))


def rates(judged_rows: DataFrame) -> DataFrame:
    """For each source: its rows with text, cut rows and their share."""
    return judged_rows.groupBy("source").agg(F.count("*").alias("n_rows"), F.count_if("cut").alias("n_cut")).withColumn("cut_share", F.round(F.col("n_cut") / F.col("n_rows"), 6))
