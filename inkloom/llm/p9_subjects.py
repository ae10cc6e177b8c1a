"""Subjects of documents by one-versus-rest linear classifiers on hashed word n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkloom.runtime import spread
from inkloom.llm.grams import LINE, MARK, U64, classes, mix, tokens

HASH_BITS = 18
NGRAMS = 3
SAMPLE = 3000  # labelled documents that the classifiers are fitted on, at most
SHRINK = 40  # labelled documents that the threshold common to all subjects weighs against a subject's own
STOPS = "。！？!?…."


@dataclass
class Features:
    """Hashed n-grams with the sentence each is in, and the text of each sentence."""

    slot: np.ndarray
    sentence: np.ndarray
    doc: np.ndarray
    sentences: int


def features(texts: list[str], known: np.ndarray | None = None) -> Features:
    """The n-grams of 1 to NGRAMS words or Han characters within sentences; with ``known``, only those it marks."""
    t = tokens([x.lower() for x in texts])
    cls, _ = classes()
    first_code = t.codes[t.start]
    stop = (t.kind == MARK) & np.isin(first_code, np.array([ord(c) for c in STOPS], dtype=np.uint32))
    # a sentence begins after a stop, after a line end, and with each text
    lines = np.cumsum(cls[t.codes] == LINE)
    n = len(t.hash)
    begin = np.ones(n, dtype=bool)
    if n > 1:
        begin[1:] = (t.doc[1:] != t.doc[:-1]) | stop[:-1] | (lines[t.start[1:]] != lines[t.start[:-1]])
    sent = np.cumsum(begin) - 1
    doc_of = t.doc[begin] if n else np.array([], dtype=np.int64)
    word = t.kind != MARK
    h, s = t.hash[word], sent[word]
    slots, sents = [], []
    g = np.zeros(len(h), dtype=U64)
    for k in range(NGRAMS):
        if len(h) <= k:
            break
        g = g[: len(h) - k] * U64(0x100000001B3) + h[k:] if k else h.copy()
        at = (mix(g + U64(k + 1)) >> U64(64 - HASH_BITS)).astype(np.int64)
        keep = s[k:] == s[: len(s) - k] if k else np.ones(len(h), dtype=bool)
        if known is not None:
            keep &= known[at]
        slots.append(at[keep])
        sents.append(s[k:][keep])
    slot = np.concatenate(slots) if slots else np.array([], dtype=np.int64)
    sentence = np.concatenate(sents) if sents else np.array([], dtype=np.int64)
    return Features(slot, sentence, doc_of, len(doc_of))


def _unique(row: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((row.astype(np.int64) << HASH_BITS) | slot)
    return key >> HASH_BITS, key & ((1 << HASH_BITS) - 1)


def _scores(row: np.ndarray, slot: np.ndarray, rows: int, weight: np.ndarray) -> np.ndarray:
    """(rows, classes) sums of the weights of each row's slots; weight: (classes, slots)."""
    return np.stack([np.bincount(row, w[slot], minlength=rows) for w in weight], axis=1)


def _logistic(row: np.ndarray, slot: np.ndarray, rows: int, y: np.ndarray, weight_of: np.ndarray, cols: int, rounds: int = 50, rate: float = 0.5, decay: float = 2e-5) -> tuple[np.ndarray, np.ndarray]:
    """One-versus-rest logistic regression by full-batch adaptive gradients: (classes x columns weights, biases)."""
    k = y.shape[1]
    w, b = np.zeros((k, cols)), np.full(k, -2.0)
    gw, gb = np.full((k, cols), 1e-8), np.full(k, 1e-8)
    size = np.sqrt(np.maximum(1, np.bincount(row, minlength=rows)))  # rows count alike, whatever their length
    scale = 1.0 / size
    total = weight_of.sum(0) + 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(_scores(row, slot, rows, w) * scale[:, None] + b, -30, 30)))
        e = (p - y) * weight_of / total
        for c in range(k):
            g = np.bincount(slot, (e[:, c] * scale)[row], minlength=cols) + decay * w[c]
            gw[c] += g * g
            w[c] -= rate * g / np.sqrt(gw[c])
        g = e.sum(0)
        gb += g * g
        b -= rate * g / np.sqrt(gb)
    return w, b


@dataclass
class Model:
    subjects: list[str]
    known: np.ndarray  # slots with a weight
    weight: np.ndarray  # subjects x slots
    bias: np.ndarray
    cut: np.ndarray  # score from which a sentence deals with the subject
    least: np.ndarray  # sentences that make a document's subject


def fit(texts: list[str], labels: list[list[str]], subjects: list[str], seed: int = 5) -> Model:
    """Classifiers from documents with weak labels.

    n-grams that tell a subject from the rest (log-odds with z above 3) are
    kept. Classifiers of documents give first scores to sentences; the
    sentences that score in documents with the label, against all sentences of
    documents without it, train the classifiers of sentences. Last, for each
    subject the score from which a sentence counts and the number of such
    sentences that makes a subject are those with the best F1 on documents that
    were held out from training, shrunk to those that are best for all subjects
    together, as a subject has few of these documents.
    """
    k = len(subjects)
    n = len(texts)
    y = np.zeros((n, k))
    at = {s: i for i, s in enumerate(subjects)}
    for i, ls in enumerate(labels):
        for s in ls:
            if s in at:
                y[i, at[s]] = 1
    f = features(texts)
    empty = Model(subjects, np.zeros(1 << HASH_BITS, dtype=bool), np.zeros((k, 1 << HASH_BITS), dtype=np.float32), np.full(k, -9.0), np.zeros(k), np.full(k, 2))
    if not len(f.slot) or not y.any():
        return empty
    rng = np.random.default_rng(seed)
    held = rng.random(n) < (0.3 if n >= 300 else 0.0)
    train = ~held
    row, slot = _unique(f.doc[f.sentence], f.slot)
    on = train[row]
    pos = np.stack([np.bincount(slot[on & (y[row, c] > 0)], minlength=1 << HASH_BITS) for c in range(k)])
    every = np.bincount(slot[on], minlength=1 << HASH_BITS)
    have = (y[train] > 0).sum(0)[:, None] + 1e-9
    rest = max(1, train.sum()) - have
    a, b = (pos + 0.1) / (have + 0.2), (every - pos + 0.1) / (rest + 0.2)
    z = (np.log(a) - np.log(b)) / np.sqrt(1 / (pos + 0.1) + 1 / (every - pos + 0.1))
    useful = ((z > 3) & (pos >= 3)).any(0)
    if useful.sum() < 50:
        useful = ((z > 1.5) & (pos >= 2)).any(0)
    col = np.cumsum(useful) - 1
    cols = int(useful.sum())
    if not cols:
        return empty
    # documents
    keep = useful[slot]
    dr, dc = row[keep], col[slot[keep]]
    use = train[dr]
    newid = np.cumsum(train) - 1
    w, _ = _logistic(newid[dr[use]], dc[use], int(train.sum()), y[train], np.ones((int(train.sum()), k)), cols)
    # sentences
    keep = useful[f.slot]
    sr, sc = f.sentence[keep], col[f.slot[keep]]
    sy = y[f.doc]
    for rounds in (25, 60):
        s = _scores(sr, sc, f.sentences, np.maximum(w, 0))
        best = np.zeros((n, k))
        np.maximum.at(best, f.doc, s)
        # in a document with the label, the sentences that score well against its best one
        target = (sy > 0) & (s >= 0.35 * best[f.doc]) & (s > 0)
        unsure = (sy > 0) & ~target & (s > 0)
        weight_of = np.where(unsure, 0.0, 1.0) * train[f.doc][:, None]
        live = np.zeros(f.sentences, dtype=bool)
        live[sr] = True
        weight_of *= live[:, None]
        w, bias = _logistic(sr, sc, f.sentences, target.astype(float), weight_of, cols, rounds=rounds)
    size = np.sqrt(np.maximum(1, np.bincount(sr, minlength=f.sentences)))
    s = _scores(sr, sc, f.sentences, w) / size[:, None] + bias
    s[np.bincount(sr, minlength=f.sentences) == 0] = -30
    # thresholds, on held-out documents where there are enough: one for all first, then each subject's own where that is better
    judge = held if held.sum() >= 80 else train
    yj = y[judge]
    tries = [(cut, least) for cut in (-1.5, -1.0, -0.5, 0.0, 0.5, 1.0) for least in (1, 2, 3, 4, 5)]
    tp, said = np.zeros((len(tries), k)), np.zeros((len(tries), k))
    for i, (cut, least) in enumerate(tries):
        if least == 1:
            count = np.stack([np.bincount(f.doc, (s[:, c] > cut), minlength=n) for c in range(k)], axis=1)[judge]
        p = count >= least
        tp[i], said[i] = (p & (yj > 0)).sum(0), p.sum(0)
    true = yj.sum(0)
    f1 = lambda hits, out, have: 2 * hits / (out + have + 1e-9)
    common = max(range(len(tries)), key=lambda i: (round(f1(tp[i].sum(), said[i].sum(), true.sum()), 4), -abs(tries[i][0]), tries[i][1]))
    best = []
    for c in range(k):
        # the common threshold weighs as much as SHRINK labelled documents of average quality
        rate_tp, rate_said = tp[:, c] + SHRINK * tp.sum(1) / max(1, true.sum()), said[:, c] + SHRINK * said.sum(1) / max(1, true.sum())
        score = f1(rate_tp, rate_said, true[c] + SHRINK)
        own = int(np.argmax(np.round(score, 4) - 1e-6 * np.abs(np.array([t[0] for t in tries]))))
        best.append(tries[own if score[own] > score[common] + 1e-3 else common])
    weight = np.zeros((k, 1 << HASH_BITS), dtype=np.float32)
    weight[:, useful] = w
    return Model(subjects, useful, weight, bias, np.array([b[0] for b in best]), np.array([float(b[1]) for b in best]))


def pack(m: Model) -> bytes:
    at = np.flatnonzero(m.known).astype("<i4")
    head = np.array([len(at), len(m.subjects)], dtype="<i4").tobytes()
    return head + at.tobytes() + m.weight[:, m.known].astype("<f4").tobytes() + m.bias.astype("<f8").tobytes() + m.cut.astype("<f8").tobytes() + m.least.astype("<f8").tobytes() + "\n".join(m.subjects).encode()


def unpack(raw: bytes) -> Model:
    n, k = np.frombuffer(raw, dtype="<i4", count=2)
    pos = 8
    at = np.frombuffer(raw, dtype="<i4", count=n, offset=pos)
    pos += 4 * n
    w = np.frombuffer(raw, dtype="<f4", count=n * k, offset=pos).reshape(k, n)
    pos += 4 * n * k
    rest = [np.frombuffer(raw, dtype="<f8", count=k, offset=pos + 8 * k * i) for i in range(3)]
    known = np.zeros(1 << HASH_BITS, dtype=bool)
    known[at] = True
    weight = np.zeros((k, 1 << HASH_BITS), dtype=np.float32)
    weight[:, at] = w
    return Model(raw[pos + 24 * k :].decode().split("\n"), known, weight, *rest)


def predict(m: Model, texts: list[str]) -> list[list[str]]:
    f = features(texts, m.known)
    if not f.sentences:
        return [[] for _ in texts]
    sr, sc = f.sentence, f.slot
    size = np.bincount(sr, minlength=f.sentences)
    s = _scores(sr, sc, f.sentences, m.weight) / np.sqrt(np.maximum(1, size))[:, None] + m.bias
    s[size == 0] = -30
    count = np.stack([np.bincount(f.doc, s[:, c] > m.cut[c], minlength=len(texts)) for c in range(len(m.subjects))], axis=1)
    return [[m.subjects[c] for c in np.flatnonzero(row >= m.least)] for row in count]


def train(documents: DataFrame, labels: DataFrame, subjects: DataFrame, sample: int = SAMPLE) -> bytes:
    """Packed classifiers, fitted in one task on at most ``sample`` labelled documents (the lowest hashes of doc_id)."""
    names = [r.subject for r in subjects.where("subject is not null").select("subject").distinct().orderBy("subject").collect()]  # the list of subjects: a weight vector each is fitted in one task
    own = F.lower(F.trim("subject"))
    tagged = labels.where("subject is not null and doc_id is not null").groupBy("doc_id").agg(F.collect_set(own).alias("subjects"))
    some = tagged.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(sample)
    rows = documents.where("text is not null and text <> ''").select("doc_id", "text").join(some, "doc_id").dropDuplicates(["doc_id"]).withColumn("one", F.lit(1))
    lower = [x.strip().lower() for x in names]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id")
        m = fit(list(pdf["text"]), [list(x) for x in pdf["subjects"]], lower)
        m.subjects = names
        return pd.DataFrame({"model": [pack(m)]})

    got = rows.groupBy("one").applyInPandas(run, "model binary").collect()
    return bytes(got[0].model) if got else pack(fit([""], [[]], lower) if not names else Model(names, np.zeros(1 << HASH_BITS, dtype=bool), np.zeros((len(names), 1 << HASH_BITS), dtype=np.float32), np.full(len(names), -9.0), np.zeros(len(names)), np.full(len(names), 2)))


def classify(documents: DataFrame, model: bytes) -> DataFrame:
    """doc_id, subject for each subject of each document. Null and empty texts have none; each copy is judged."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most subjects x 2^HASH_BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = unpack(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                ids, out = part.column(0).to_pylist(), predict(m, [t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([pa.array([i for i, s in zip(ids, out) for _ in s], pa.int64()), pa.array([x for s in out for x in s], pa.string())], names=["doc_id", "subject"])

    return spread(documents.select("doc_id", "text")).mapInArrow(run, "doc_id long, subject string")


def subjects_of(documents: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """doc_id, subject of all documents, by classifiers fitted on the labelled ones."""
    return classify(documents, train(documents, labels, subjects))
