"""Vectorised tokens, shingles and min-hashes over a batch of texts."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACE, LINE, LETTER, DIGIT, HAN, MARK = range(6)
U64 = np.uint64
_P = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(64)], dtype=U64)


@lru_cache(maxsize=1)
def classes() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its class, and whether it is an upper-case letter."""
    cls = np.full(0x110000, MARK, dtype=np.uint8)
    upper = np.zeros(0x110000, dtype=bool)
    for i in range(0x20000):  # beyond lie Han characters, marks and code points without a character
        c = chr(i)
        cat = unicodedata.category(c)
        if c in "\n\r\x0b\x0c\x85\u2028\u2029":
            cls[i] = LINE
        elif c.isspace() or cat in ("Cf", "Cc"):
            cls[i] = SPACE
        elif cat == "Nd":
            cls[i] = DIGIT
        elif cat == "Lo" and (0x2E80 <= i <= 0x9FFF or 0xF900 <= i <= 0xFAFF):
            cls[i] = HAN
        elif cat[0] in "LM":
            cls[i] = LETTER
            upper[i] = cat == "Lu"
    cls[0x20000:0x32000] = HAN
    return cls, upper


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


@dataclass
class Tokens:
    """Words, Han characters, numbers and runs of marks of all texts, in order."""

    hash: np.ndarray
    kind: np.ndarray
    cap: np.ndarray  # starts with an upper-case letter
    doc: np.ndarray
    start: np.ndarray  # in code points of all texts, one line end after each
    end: np.ndarray
    codes: np.ndarray
    docs: int


def tokens(texts: list[str]) -> Tokens:
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    cls, upper = classes()
    k = cls[codes]
    new = np.empty(len(k), dtype=bool)
    new[0] = True
    np.not_equal(k[1:], k[:-1], out=new[1:])
    new |= k == HAN
    doc_start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    new[doc_start] = True
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(k)))
    kind = k[at]
    word = kind >= LETTER
    offset = np.arange(len(k), dtype=np.int64) - np.repeat(at, length)
    factor = _P[np.minimum(offset, 63)]
    far = np.flatnonzero(offset > 63)
    factor[far] = mix(offset[far].astype(U64)) | U64(1)
    h = np.add.reduceat(mix(codes.astype(U64) + U64(1)) * factor, at)
    doc = np.repeat(np.arange(len(texts)), np.diff(np.append(np.searchsorted(at, doc_start), len(at))))
    return Tokens(h[word], kind[word], upper[codes[at[word]]], doc[word], at[word], at[word] + length[word], codes, len(texts))


def shingles(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` tokens, and their text. A shorter text is one shingle."""
    n = len(h)
    if not n:
        return h, doc
    s = np.zeros(n, dtype=U64)
    whole = np.zeros(n, dtype=bool)
    if n >= size:
        np.equal(doc[size - 1 :], doc[: n - size + 1], out=whole[: n - size + 1])
    for j in range(size):
        s *= U64(0x100000001B3)
        # the last token stands in for those beyond all texts
        s[: n - j] += np.where(doc[j:] == doc[: n - j], h[j:], U64(0))
        s[n - j :] += np.where(doc[n - j :] == doc[-1], h[-1], U64(0))
    first = np.ones(n, dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    keep = whole | first
    return mix(s[keep]), doc[keep]


def bands(s: np.ndarray, doc: np.ndarray, docs: int, count: int, rows: int) -> np.ndarray:
    """(docs, count) band keys of the min-hash signatures; texts without shingles get their own keys of 0."""
    out = np.zeros((docs, count), dtype=U64)
    if not len(s):
        return out
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    who = doc[starts]
    for b in range(count):
        key = np.full(len(starts), U64(b + 1))
        for r in range(rows):
            a = _P[(b * rows + r) % 64]
            key = mix(key * U64(0x9E3779B97F4A7C15) + np.minimum.reduceat((s ^ _P[(b * rows + r + 7) % 64]) * a, starts))
        out[who, b] = key
    return out
