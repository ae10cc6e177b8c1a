"""Sentence alignment of bilingual chapters by a translation model and competitive linking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.llm.p4_pairs import language
from inkloom.runtime import materialize, spread

BITS = 15
BUCKETS = 1 << BITS  # of words on either side, whatever the input
LEAST = 0.01  # a translation below this probability both ways is dropped: at most 2 * BUCKETS / LEAST entries
BAND = 1.6  # lines around the diagonal from which translations are first counted
TILE = 4096  # words of a side that are laid against all words of the other at once
HAN_DIGITS = {c: i for i, c in enumerate("零一二三四五六七八九")} | {"〇": 0, "两": 2}
HAN_UNITS = {"十": 10, "百": 100, "千": 1000, "万": 10000}
WORDS = regex.compile(r"\d+|[零〇一二两三四五六七八九十百千万]+|\p{Han}|[^\W\d_]+")


def han_number(s: str) -> int:
    """The value of a plain Chinese numeral."""
    total = section = digit = 0
    for c in s:
        if c in HAN_DIGITS:
            digit = HAN_DIGITS[c]
        elif c == "万":
            total, section, digit = total + (section + digit) * 10000, 0, 0
        else:
            section, digit = section + (digit or 1) * HAN_UNITS[c], 0
    return total + section + digit


@lru_cache(maxsize=1 << 16)
def buckets(w: str) -> tuple[int, ...]:
    """The buckets of a word: Han numerals and digits by their value, a single numeral also as itself."""
    forms = [w]
    if w[0].isdigit():
        forms = ["#" + w.lstrip("0")]
    elif (w[0] in HAN_DIGITS or w[0] in HAN_UNITS) and w not in ("百", "千", "万"):
        forms = ["#" + str(han_number(w)), *([w] if len(w) == 1 else [])]
    return tuple(xxhash.xxh32_intdigest(x) & (BUCKETS - 1) for x in forms)


def words(line: str) -> list[int]:
    """The distinct words of a line as buckets: Han characters, words, and numbers by their value."""
    return sorted({x for w in set(WORDS.findall(line.lower())) for x in buckets(w)})


def lines_of(content: str | None) -> list[str]:
    return [x for x in (content or "").split("\n") if x.strip()]


@dataclass
class Model:
    """Translation probabilities in both directions, by the word of a, and how informative each word is."""

    start: np.ndarray  # where the translations of each word of a begin
    b: np.ndarray
    forward: np.ndarray  # p(b | a)
    backward: np.ndarray  # p(a | b)
    info_a: np.ndarray  # -log of the relative frequency
    info_b: np.ndarray

    def look(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(p(b|a), p(a|b)) for all pairs of two lists of distinct words."""
        f, r = np.zeros((len(a), len(b)), dtype=np.float32), np.zeros((len(a), len(b)), dtype=np.float32)
        column = np.full(BUCKETS, -1, dtype=np.int32)
        column[b] = np.arange(len(b))
        n = self.start[a + 1] - self.start[a]
        row = np.repeat(np.arange(len(a)), n)
        at = np.arange(len(row)) + np.repeat(self.start[a] - np.cumsum(n) + n, n)
        col = column[self.b[at]]
        hit = col >= 0
        row, col, at = row[hit], col[hit], at[hit]
        f[row, col], r[row, col] = self.forward[at], self.backward[at]
        return f, r


def _find(m: Model, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(p(b|a), p(a|b)) of pairs of words, by their place among the sorted keys."""
    keys = (np.repeat(np.arange(BUCKETS), np.diff(m.start)).astype(np.int64) << BITS) | m.b
    order = np.argsort(keys)
    want = (a.astype(np.int64) << BITS) | b
    at = np.minimum(np.searchsorted(keys, want, sorter=order), max(0, len(keys) - 1))
    at = order[at] if len(keys) else at
    hit = keys[at] == want if len(keys) else np.zeros(len(want), dtype=bool)
    return np.where(hit, m.forward[at], np.float32(0)), np.where(hit, m.backward[at], np.float32(0))


def build_model(packed: tuple[np.ndarray, ...]) -> Model:
    """A model from (a, b, fwd, bwd, frequencies of a's words, of b's)."""
    a, b, fwd, bwd, freq_a, freq_b = packed
    order = np.argsort(a, kind="stable")
    start = np.concatenate([[0], np.cumsum(np.bincount(a, minlength=BUCKETS))]).astype(np.int64)
    info = lambda n: (-np.log((n + 0.5) / (n.sum() + 0.5 * len(n)))).astype(np.float32)
    return Model(start, b[order], fwd[order], bwd[order], info(freq_a), info(freq_b))


@dataclass
class Side:
    """The words of a text's lines, the lines without words left out."""

    words: np.ndarray
    of: np.ndarray  # the line of each word
    start: np.ndarray  # the first word of each line
    lines: np.ndarray  # the number of each such line
    kinds: np.ndarray  # the distinct words
    kind: np.ndarray  # which of them each word is


def side(words: np.ndarray, sizes: np.ndarray) -> Side | None:
    if not len(words):
        return None
    lines = np.flatnonzero(sizes)
    n = sizes[lines]
    kinds, kind = np.unique(words, return_inverse=True)
    return Side(words, np.repeat(np.arange(len(lines)), n), np.cumsum(n) - n, lines, kinds, kind)


def sides(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(words, words in each line) of each text of a column of lists of lists."""
    inner = column.values
    outer, edges, flat = column.offsets.to_numpy(), inner.offsets.to_numpy(), inner.values.to_numpy(zero_copy_only=False)
    for x, y in zip(outer[:-1], outer[1:]):
        e = edges[x : y + 1]
        yield flat[e[0] : e[-1]] if len(e) else flat[:0], np.diff(e)


def explained(model: Model, a: Side, b: Side, f: np.ndarray | None = None, r: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct words of a x lines of b, lines of a x distinct words of b): what each word's best partner in a line explains of it.

    Words of a are taken in tiles, so a long chapter needs no table of all its word pairs.
    """
    ia, ib = model.info_a[a.kinds], model.info_b[b.kinds]
    ea, eb = np.empty((len(a.kinds), len(b.lines)), dtype=np.float32), np.zeros((len(a.lines), len(b.kinds)), dtype=np.float32)
    for lo in range(0, len(a.kinds), TILE):
        if f is None or len(a.kinds) > TILE:
            f, r = model.look(a.kinds[lo : lo + TILE], b.kinds)
        ea[lo : lo + TILE] = _most(r, b)
        if len(a.kinds) <= TILE:
            eb = _most(f.T, a).T
        else:  # lines of a that have words of this tile
            inside = np.flatnonzero((a.kind >= lo) & (a.kind < lo + TILE))
            rows, first = np.unique(a.of[inside], return_index=True)
            eb[rows] = np.maximum(eb[rows], np.maximum.reduceat(f[a.kind[inside] - lo], first, axis=0))
    return np.clip(ia[:, None] + np.log(ea + 1e-9), 0, ia[:, None]), np.clip(ib[None, :] + np.log(eb + 1e-9), 0, ib[None, :])


def _most(table: np.ndarray, s: Side) -> np.ndarray:
    """For each row of a table over a side's distinct words, the highest value in each line."""
    return np.maximum.reduceat(table[:, s.kind], s.start, axis=1)


def line_sums(values: np.ndarray, s: Side) -> np.ndarray:
    """(rows, lines): sums over the words of each line, of values by (row, distinct word)."""
    return np.add.reduceat(values[:, s.kind], s.start, axis=1)


def chapters(bilingual: DataFrame, tasks: int) -> DataFrame:
    """Pairs of the rows of each (book, id), the languages in a fixed order.

    Columns: bil_id_a < bil_id_b, swapped (whether a's language comes second),
    pair (the two languages), words_a and words_b (the words of each line). Of
    more than two rows each is paired with each in another language (a chapter
    delivered k times has these pairs; texts in one language translate nothing).
    """
    rows = bilingual.where("book is not null and id is not null").select("bil_id", "book", "id", "lang", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                found = [lines_of(x) for x in b.column(4).to_pylist()]
                langs = [guess(x, n) for x, n in zip(found, b.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(langs, pa.string()), pa.array([[words(x) for x in ls] for ls in found], pa.list_(pa.list_(pa.int32())))], names=["bil_id", "book", "id", "lang", "words"])

    texts = materialize(spread(rows).mapInArrow(read, "bil_id long, book string, id string, lang string, words array<array<int>>"), "lines")
    one, other = texts.select("book", "id", F.col("bil_id").alias("id_a"), F.col("lang").alias("la"), F.col("words").alias("wa")), texts.select("book", "id", F.col("bil_id").alias("id_b"), F.col("lang").alias("lb"), F.col("words").alias("wb"))
    both = one.join(other, ["book", "id"]).where("id_a < id_b and la <> lb")
    swap = F.col("la") > F.col("lb")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return both.select("id_a", "id_b", swap.alias("swapped"), F.concat_ws("-", pick("la", "lb"), pick("lb", "la")).alias("pair"), pick("wa", "wb").alias("words_a"), pick("wb", "wa").alias("words_b")).repartition(tasks)


def guess(lines: list[str], named: str | None) -> str:
    """A text's language: by all its lines, or as it is named."""
    votes: dict[str, int] = {}
    for x in lines:
        lang = language(x)
        if lang:
            votes[lang] = votes.get(lang, 0) + 1
    return max(votes, key=lambda k: (votes[k], k)) if votes else (named or "?").strip().lower()[:2]


def _sum_counts(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key = np.concatenate([p[0] for p in parts])
    if not len(key):
        return key, np.zeros(0, np.float32), np.zeros(0, np.float32)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    total = lambda k: np.add.reduceat(np.concatenate([p[k] for p in parts])[order], first)
    return key[first], total(1), total(2)


def line_pairs(weight: np.ndarray, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word of a, word of b, weight) of all word pairs of the line pairs that have a weight; words by their place."""
    i, j = np.nonzero(weight)
    na, nb = np.diff(np.append(a.start, len(a.words))), np.diff(np.append(b.start, len(b.words)))
    n = na[i] * nb[j]
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    wide = np.repeat(nb[j], n)
    return np.repeat(a.start[i], n) + at // wide, np.repeat(b.start[j], n) + at % wide, np.repeat(weight[i, j], n)


def chapter_counts(a: Side, b: Side, model: Model | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys of word pairs, expected counts a to b, b to a) of a chapter; with a model, of pairs that it holds."""
    n, m = int(a.lines[-1]) + 1, int(b.lines[-1]) + 1
    off = np.abs((a.lines[:, None] + 0.5) / n * m - 0.5 - b.lines[None, :])
    if model is None:
        weight = np.where(off <= max(BAND, off.min() + 0.01), np.exp(-off), 0.0)
    else:
        f, r = model.look(a.kinds, b.kinds) if len(a.kinds) <= TILE else (None, None)
        ea, eb = explained(model, a, b, f, r)
        ia = np.add.reduceat(model.info_a[a.words], a.start)
        ib = np.add.reduceat(model.info_b[b.words], b.start)
        s = 0.5 * (line_sums(ea.T, a).T / (ia[:, None] + 1e-9) + line_sums(eb, b) / (ib[None, :] + 1e-9))
        weight = np.where(off <= 4 * BAND, s**3, 0.0)
    weight = weight / (weight.sum(1, keepdims=True) + 1e-12)
    weight[weight < 0.05] = 0.0
    x, y, w = line_pairs(weight.astype(np.float32), a, b)
    if model is None:
        key = (a.words[x].astype(np.int64) << BITS) | b.words[y]
        size_a, size_b = np.bincount(a.of), np.bincount(b.of)
        return key, w / size_a[a.of[x]].astype(np.float32), w / size_b[b.of[y]].astype(np.float32)
    fx, rx = (f[a.kind[x], b.kind[y]], r[a.kind[x], b.kind[y]]) if f is not None else _find(model, a.words[x], b.words[y])
    hit = np.flatnonzero((fx > 0) | (rx > 0))
    x, y, w, fx, rx = x[hit], y[hit], w[hit], fx[hit], rx[hit]
    # a word of b shares its count among the words of the line of a, and the other way round
    by_a, by_b = _shares(a.of[x] * len(b.words) + y, fx), _shares(b.of[y] * len(a.words) + x, rx)
    return (a.words[x].astype(np.int64) << BITS) | b.words[y], w * fx / (by_a + np.float32(1e-3)), w * rx / (by_b + np.float32(1e-3))


def _shares(group: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each value the sum of its group."""
    if not len(group):
        return values
    _, at = np.unique(group, return_inverse=True)
    return np.bincount(at, values).astype(np.float32)[at]


GROUP = 9  # bits of a word below those that name its group: translations are summed by group


def _packed(*arrays: np.ndarray) -> bytes:
    return b"".join(x.tobytes() for x in arrays)


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(raw) // 16
    return np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.float32, n, 8 * n), np.frombuffer(raw, np.float32, n, 12 * n)


_COUNTS = pa.schema([("pair", pa.string()), ("part", pa.int32()), ("counts", pa.binary())])


def expectations(chapter: DataFrame, packed: dict[str, tuple] | None) -> DataFrame:
    """pair, part, counts: each task's expected translation counts by group of words of a, and (part -1) their sums by words of b.

    Without a model, words of lines near the diagonal count alike; with one,
    lines count by how well they translate each other, words by their share.
    """
    shared = chapter.sparkSession.sparkContext.broadcast(packed)  # its size is bounded by BUCKETS and LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = shared.value
        known = {k: build_model(v) for k, v in (tables or {}).items()}
        held: dict[str, list] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for pair, x, y in zip(batch.column(0).to_pylist(), sides(batch.column(1)), sides(batch.column(2))):
                if tables is not None and pair not in known:
                    continue
                a, b = side(*x), side(*y)
                if a is None or b is None:
                    continue
                counts = chapter_counts(a, b, known.get(pair))
                held.setdefault(pair, []).append(counts)
                size[pair] = size.get(pair, 0) + len(counts[0])
                if size[pair] > 2_000_000:
                    held[pair] = [_sum_counts(held[pair])]
                    size[pair] = len(held[pair][0][0]) // 2
        for pair, parts in held.items():
            key, f, g = _sum_counts(parts)
            rows = [{"pair": pair, "part": -1, "counts": np.bincount(key & (BUCKETS - 1), g, minlength=BUCKETS).tobytes()}]
            edges = np.searchsorted(key, np.arange((BUCKETS >> GROUP) + 1, dtype=np.int64) << (BITS + GROUP))
            rows += [{"pair": pair, "part": i, "counts": _packed(key[x:y], f[x:y].astype(np.float32), g[x:y].astype(np.float32))} for i, (x, y) in enumerate(zip(edges[:-1], edges[1:])) if y > x]
            yield pa.RecordBatch.from_pylist(rows, schema=_COUNTS)

    return chapter.select("pair", "words_a", "words_b").mapInArrow(run, "pair string, part int, counts binary")


def maximise(counts: DataFrame) -> dict[str, tuple[np.ndarray, ...]]:
    """For each pair of languages the translations (a, b, p(b|a), p(a|b)) that the counts give, without what is below LEAST both ways."""

    def columns(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"pair": [pdf["pair"].iloc[0]], "total": [sum(np.frombuffer(x) for x in pdf["counts"]).tobytes()]})

    by_b = {r.pair: np.frombuffer(r.total) for r in counts.where("part = -1").groupBy("pair").applyInPandas(columns, "pair string, total binary").collect()}  # BUCKETS numbers each
    shared = counts.sparkSession.sparkContext.broadcast(by_b)

    def likely(pdf: pd.DataFrame) -> pd.DataFrame:
        key, f, g = _sum_counts([_unpacked(x) for x in pdf["counts"]])
        pair = pdf["pair"].iloc[0]
        a, b = key >> BITS, key & (BUCKETS - 1)
        f, g = f / (np.bincount(a, f, minlength=BUCKETS)[a] + 1e-12), g / (shared.value[pair][b] + 1e-12)
        keep = (f >= LEAST) | (g >= LEAST)
        return pd.DataFrame({"pair": [pair], "part": [pdf["part"].iloc[0]], "counts": [_packed(key[keep], f[keep].astype(np.float32), g[keep].astype(np.float32))]})

    got: dict[str, list] = {}
    for r in counts.where("part >= 0").groupBy("pair", "part").applyInPandas(likely, "pair string, part int, counts binary").orderBy("pair", "part").collect():  # at most 2 * BUCKETS / LEAST entries for a pair
        got.setdefault(r.pair, []).append(_unpacked(r.counts))
    out = {}
    for pair, parts in got.items():
        key, f, g = (np.concatenate(x) for x in zip(*parts))
        out[pair] = ((key >> BITS).astype(np.int32), (key & (BUCKETS - 1)).astype(np.int32), f, g)
    return out


def frequencies(chapter: DataFrame) -> dict[tuple[str, str], np.ndarray]:
    """For each pair of languages and side how many lines hold each word."""
    out: dict[tuple[str, str], np.ndarray] = {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, str], np.ndarray] = {}
        for batch in batches:
            for k, name in ((1, "a"), (2, "b")):
                for pair, (ws, _) in zip(batch.column(0).to_pylist(), sides(batch.column(k))):
                    np.add.at(total.setdefault((pair, name), np.zeros(BUCKETS, dtype=np.int64)), ws, 1)
        for (pair, name), t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([pair] * len(at)), pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(t[at])], names=["pair", "side", "w", "n"])

    seen = chapter.select("pair", "words_a", "words_b").mapInArrow(count, "pair string, side string, w int, n long").groupBy("pair", "side", "w").agg(F.sum("n").alias("n"))
    for r in seen.collect():  # at most BUCKETS rows for each pair of languages and side
        out.setdefault((r.pair, r.side), np.zeros(BUCKETS))[r.w] = r.n
    return out


def train(chapter: DataFrame, rounds: int = 3) -> dict[str, tuple]:
    """A packed model for each pair of languages, by expectation-maximisation over all chapters."""
    freq = frequencies(chapter)
    chapter = chapter.where(F.col("pair").isin(sorted({p for p, _ in freq if (p, "a") in freq and (p, "b") in freq})))
    packed: dict[str, tuple] = {}
    for _ in range(rounds):
        tables = maximise(materialize(expectations(chapter, packed or None), "counts"))
        packed = {p: (*t, freq[p, "a"], freq[p, "b"]) for p, t in sorted(tables.items())}
        if not packed:
            break
    return packed


def link(model: Model, A: tuple[np.ndarray, np.ndarray], B: tuple[np.ndarray, np.ndarray], least: float = 0.3, longest: int = 3) -> list[tuple[int, int]]:
    """(line of a, line of b), from 0, by competitive linking.

    Candidates are pairs of lines, and of a line with 2 to ``longest`` adjacent
    lines of the other side, anywhere. Each line of a span must be explained
    itself and add to what is explained of the single line. The best candidate
    is accepted if its lines are free, and so on down to ``least``; lines near
    the diagonal count a little more.
    """
    a, b = side(*A), side(*B)
    if a is None or b is None:
        return []
    n, m = len(a.lines), len(b.lines)
    ea, eb = explained(model, a, b)
    ia = np.add.reduceat(model.info_a[a.words], a.start) + 1e-9
    ib = np.add.reduceat(model.info_b[b.words], b.start) + 1e-9
    part_a = line_sums(ea.T, a).T  # lines of a x lines of b: what is explained of a's line
    part_b = line_sums(eb, b)  # of b's line
    share_a, share_b = part_a / ia[:, None], part_b / ib[None, :]
    single = 0.5 * (share_a + share_b)
    drift = 0.06 * np.abs((a.lines[:, None] + 0.5) / len(A[1]) - (b.lines[None, :] + 0.5) / len(B[1]))
    score = single - drift
    words_a = [a.kind[x:y] for x, y in zip(a.start, [*a.start[1:], len(a.words)])]
    words_b = [b.kind[x:y] for x, y in zip(b.start, [*b.start[1:], len(b.words)])]
    found = []
    I, J = np.nonzero(single >= 0.15)
    wide = {(int(i), int(j)) for i, j in zip(*np.nonzero((share_a[:-1] >= 0.35) & (share_a[1:] >= 0.35)))} if longest > 1 and n > 1 else set()
    tall = {(int(i), int(j)) for i, j in zip(*np.nonzero((share_b[:, :-1] >= 0.35) & (share_b[:, 1:] >= 0.35)))} if longest > 1 and m > 1 else set()
    for i, j, s in zip(I.tolist(), J.tolist(), score[I, J].tolist()):
        found.append((s, (i,), (j,)))
        if (i, j) in wide:
            best = eb[i, words_b[j]]
            for k in range(1, longest):
                if i + k >= n or a.lines[i + k] != a.lines[i] + k or share_a[i + k, j] < 0.35:
                    break
                more = np.maximum(best, eb[i + k, words_b[j]])
                if more.sum() - max(best.sum(), part_b[i + k, j]) < 0.12 * ib[j]:
                    break
                best = more
                found.append((0.5 * float(part_a[i : i + k + 1, j].sum() / ia[i : i + k + 1].sum() + best.sum() / ib[j]) - float(drift[i, j]), tuple(range(i, i + k + 1)), (j,)))
        if (i, j) in tall:
            best = ea[words_a[i], j]
            for k in range(1, longest):
                if j + k >= m or b.lines[j + k] != b.lines[j] + k or share_b[i, j + k] < 0.35:
                    break
                more = np.maximum(best, ea[words_a[i], j + k])
                if more.sum() - max(best.sum(), part_a[i, j + k]) < 0.12 * ia[i]:
                    break
                best = more
                found.append((0.5 * float(part_b[i, j : j + k + 1].sum() / ib[j : j + k + 1].sum() + best.sum() / ia[i]) - float(drift[i, j]), (i,), tuple(range(j, j + k + 1))))
    used_a, used_b, out = set(), set(), []
    for s, ii, jj in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
        if s < least:
            break
        if used_a.isdisjoint(ii) and used_b.isdisjoint(jj):
            used_a.update(ii)
            used_b.update(jj)
            out += [(int(a.lines[i]), int(b.lines[j])) for i in ii for j in jj]
    return sorted(out)


def align(bilingual: DataFrame, rounds: int = 3) -> DataFrame:
    """bil_id_a, line_a, bil_id_b, line_b of the lines that translate each other.

    Lines are the non-blank pieces of content between line feeds, from 1. Null
    or empty content has no lines; a chapter in one language has no pairs; of
    more than two rows each is paired with each in another language. Null
    languages are recognised from the text.
    """
    spark = bilingual.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism  # little data, much work
    chapter = materialize(chapters(bilingual, tasks), "chapters")
    shared = spark.sparkContext.broadcast(train(chapter, rounds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = {k: build_model(v) for k, v in shared.value.items()}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            rows = zip(*(batch.column(k).to_pylist() for k in range(4)), sides(batch.column(4)), sides(batch.column(5)))
            for id_a, id_b, swapped, pair, A, B in rows:
                model = models.get(pair)
                if model is None:
                    continue
                for i, j in link(model, A, B):
                    x, y = (j, i) if swapped else (i, j)
                    for c, v in zip(out, (id_a, x + 1, id_b, y + 1)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32())], names=["bil_id_a", "line_a", "bil_id_b", "line_b"])

    return chapter.select("id_a", "id_b", "swapped", "pair", "words_a", "words_b").mapInArrow(run, "bil_id_a long, line_a int, bil_id_b long, line_b int")
