"""Finding and restoring text that was decoded with the wrong character encoding."""

from __future__ import annotations

import codecs
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from inkloom.runtime import spread

# Encodings that text is stored in, and those it is wrongly read with.
STORED_UTF8, STORED_GB, STORED_BIG5 = "utf-8", "gb2312", "big5"
READ_ONE_BYTE = ("cp1252", "latin-1", "iso8859-2", "cp1250", "iso8859-9", "cp1254", "iso8859-15", "cp1258", "mac-roman", "cp437", "cp850", "cp852", "koi8-r", "koi8-u", "cp866", "cp1251", "iso8859-5", "iso8859-7", "cp1253")
READ_MANY_BYTES = ("gb18030", "big5", "cp932", "cp949", "euc_jp")
# Code pages whose letters are Western: a run of them where a word has none is no text of theirs.
WESTERN = ("cp1252", "latin-1", "iso8859-2", "cp1250", "iso8859-9", "cp1254", "iso8859-15", "cp1258")

# Letters of Vietnamese and the onsets and codas of its syllables.
VOWELS = "aăâeêioôơuưy"
TONES = "̣́̀̉̃"
ONSET = "ngh|ng|nh|ch|gh|gi|kh|ph|qu|th|tr|b|c|d|đ|g|h|k|l|m|n|p|r|s|t|v|x"
CODA = "ng|nh|ch|c|m|n|p|t|i|y|o|u"


def _vietnamese() -> set[str]:
    out = {"đ", "Đ"}
    for v in VOWELS:
        for t in ("", *TONES):
            c = unicodedata.normalize("NFC", v + t)
            out |= {c, c.upper()}
    return {c for c in out if ord(c) > 127}


def _gb2312() -> set[str]:
    out = set()
    for a in range(0xA1, 0xF8):
        for b in range(0xA1, 0xFF):
            try:
                out.add(bytes([a, b]).decode("gb2312"))
            except UnicodeDecodeError:
                pass
    return out


@lru_cache(maxsize=1)
def alphabets() -> tuple[set[str], set[str], set[str]]:
    """(characters of sound text, Vietnamese letters, common Han characters)."""
    vi, gb = _vietnamese(), _gb2312()
    common = {bytes([a, b]).decode("gb2312") for a in range(0xB0, 0xD7) for b in range(0xA1, 0xFF)}
    han = {c for c in gb if "一" <= c <= "鿿"}
    signs = set("“”‘’…—–·•«»©®™§¶°£€¥、。，！？；：（）《》〈〉【】「」『』〔〕〖〗※★☆●○◆◇■□→←↑↓～　\xa0№×÷±½¼¾²³")
    latin = {chr(c) for c in range(0xC0, 0x180)} - {"×", "÷"}
    full = {chr(c) for c in range(0xFF01, 0xFF5F)}
    twice = {chr(c) for c in range(0x80, 0xC0)} | set("€‚ƒ„†‡ˆ‰Š‹ŒŽ˜š›œžŸ")  # what text garbled twice holds after one step
    letters = {chr(c) for r in ((0x370, 0x530), (0x2190, 0x2300), (0x3040, 0x3100), (0xFF61, 0xFFA0)) for c in range(*r)} | {"′", "″", "‐", "‰"}
    return twice | letters | han | vi | signs | latin | full | {"﻿", "​"}, vi, common | signs | full


@lru_cache(maxsize=1)
def traditional() -> set[str]:
    """The frequent Han characters of the code that traditional texts are stored in."""
    return {bytes([a, b]).decode("big5") for a in range(0xA4, 0xC7) for b in (*range(0x40, 0x7F), *range(0xA1, 0xFF)) if (a, b) <= (0xC6, 0x7E)}


@lru_cache(maxsize=4)
def common_of(stored: str) -> frozenset[str]:
    """The characters that texts in a stored encoding mostly hold."""
    common = alphabets()[2]
    return frozenset((common - {c for c in common if "一" <= c <= "鿿"}) | traditional() if stored == STORED_BIG5 else common)


@lru_cache(maxsize=1)
def usual_characters() -> frozenset[str]:
    """What sound Chinese, Vietnamese and English text holds."""
    sound, vi, _ = alphabets()
    signs = set("“”‘’…—–·•«»©、。，！？；：（）《》〈〉【】「」『』※★☆→←～　​﻿")
    return frozenset({c for c in sound if "一" <= c <= "鿿"} | vi | signs | {chr(c) for c in range(0xFF01, 0xFF5F)} | {chr(c) for c in range(0x80)})


WIDE = regex.compile(r"[\u2e80-\uffef]")  # text garbled by an encoding of several bytes a character holds some of these
HAN_IN_LATIN = regex.compile(r"(?<=[A-Za-z])[\u4e00-\u9fff](?=[a-z])")


def odd_positions(text: str) -> set[int]:
    """Positions of characters that aren't usual, and of single Han characters inside Latin words."""
    usual = usual_characters()
    out = {m.start() for m in HAN_IN_LATIN.finditer(text)}
    return out | {i for i, c in enumerate(text) if c not in usual} if not usual.issuperset(text) else out


@lru_cache(maxsize=1)
def automata():
    """For each stored encoding, an automaton of the byte sequences of all characters of sound text.

    They are matched against the bytes that a text has in an encoding of more
    than one byte a character, whose characters span the sequences.
    """
    sound, _, _ = alphabets()
    out = {}
    for stored in (STORED_UTF8, STORED_GB, STORED_BIG5):
        a = ahocorasick.Automaton()
        for c in sound | traditional() if stored == STORED_BIG5 else sound:
            raw = _bytes(c, stored)
            if raw:
                a.add_word(raw.decode("latin-1"), (len(raw), c))
        a.make_automaton()
        out[stored] = a
    return out


def _bytes(c: str, stored: str) -> bytes | None:
    """A character's bytes in a stored encoding, if they are more than one."""
    try:
        raw = c.encode(stored)
    except UnicodeEncodeError:
        return None
    return raw if len(raw) > 1 else None


@lru_cache(maxsize=32)
def characters(read: str) -> list[str]:
    """The character of each byte of a one-byte encoding; undefined bytes are read as themselves."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(read))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(maxsize=1)
def garbles():
    """An automaton of what each character of sound text is garbled into by each pair of a stored and a one-byte encoding.

    A sequence holds its length and, for each pair that has it, the pair and the character.
    """
    sound, _, _ = alphabets()
    found: dict[str, list[tuple[int, str]]] = {}
    for p, (stored, read) in enumerate(PAIRS):
        table = characters(read)
        for c in sound | traditional() if stored == STORED_BIG5 else sound:
            raw = _bytes(c, stored)
            if raw:
                found.setdefault("".join(table[x] for x in raw), []).append((p, c))
    a = ahocorasick.Automaton()
    for g, pairs in found.items():
        a.add_word(g, (len(g), pairs))
    a.make_automaton()
    return a


PAIRS = tuple((stored, read) for stored in (STORED_UTF8, STORED_GB, STORED_BIG5) for read in READ_ONE_BYTE)
MANY_PAIRS = tuple((STORED_UTF8, read) for read in READ_MANY_BYTES) + ((STORED_GB, "big5"), (STORED_BIG5, "gb18030"))


def _unread(e: UnicodeEncodeError) -> tuple[bytes, int]:
    """Characters that an encoding lacks: bytes read as themselves, others are none of its bytes."""
    return b"".join(bytes([ord(c)]) if "\x80" <= c < "\xa0" else b"\0" for c in e.object[e.start : e.end]), e.end


codecs.register_error("inkloom-unread", _unread)


def _spans_of_many(text: str, stored: str, read: str) -> list[tuple[int, int, str]]:
    """(start, end, original) of the garbled runs of a pair whose reading takes several bytes a character."""
    raw = text.encode(read, "inkloom-unread").decode("latin-1")
    found = list(automata()[stored].iter_long(raw))
    if not found:
        return []
    owner: list[int] = []
    for i, c in enumerate(text):
        owner += [i] * (1 if c < "\x80" else len(c.encode(read, "inkloom-unread")))
    runs: list[tuple[int, int, str]] = []
    for last, (n, c) in found:
        a, b = last - n + 1, last + 1
        if runs and runs[-1][1] == a:
            runs[-1] = (runs[-1][0], b, runs[-1][2] + c)
        else:
            runs.append((a, b, c))
    out = []
    for a, b, s in runs:
        # bytes of a character that the run holds in part: ASCII stays, others are lost
        while a > 0 and owner[a - 1] == owner[a]:
            a, s = a - 1, (raw[a - 1] if raw[a - 1] < "\x80" else "\ufffd") + s
        while b < len(owner) and owner[b] == owner[b - 1]:
            s, b = s + (raw[b] if raw[b] < "\x80" else "\ufffd"), b + 1
        if out and owner[a] < out[-1][1]:
            continue
        out.append((owner[a], owner[b - 1] + 1, s))
    return out


def _spans(text: str) -> dict[int, list[tuple[int, int, str]]]:
    """For each pair of PAIRS that has any the (start, end, original) of its garbled runs."""
    out: dict[int, list[tuple[int, int, str]]] = {}
    for last, (n, pairs) in garbles().iter(text):
        a, b = last - n + 1, last + 1
        for p, c in pairs:
            runs = out.get(p)
            if runs is None:
                out[p] = [(a, b, c)]
            elif runs[-1][1] == a:
                runs[-1] = (runs[-1][0], b, runs[-1][2] + c)
            elif runs[-1][1] < a:
                runs.append((a, b, c))
    return out


def _signs(s: str) -> int:
    """Characters that stand in no word: signs, and capitals right after small letters."""
    return sum(not c.isalpha() or (c.isupper() and p.islower()) for p, c in zip(" " + s, s))


def _accept(text: str, stored: str, read: str, spans: list[tuple[int, int, str]], odd: set[int]) -> list[tuple[int, int, str]]:
    """The spans of a pair that are garbled, judged by what they become."""
    vi, common = alphabets()[1], common_of(stored)
    # of what could be other characters as well, half is frequent; foreign letters say nothing
    usual = lambda s: 2 * sum(c in common for c in s) >= sum(c in common or "一" <= c <= "鿿" for c in s) > 0
    if stored in (STORED_GB, STORED_BIG5):
        if read in READ_MANY_BYTES:  # such text is garbled into Han characters; a foreign script is none
            spans = [x for x in spans if any("一" <= c <= "鿿" for c in text[x[0] : x[1]])]
            # text that was written in the code it is read in holds that code's frequent characters
            han, own = [c for a, b, _ in spans for c in text[a:b] if "一" <= c <= "鿿"], common_of(STORED_BIG5 if read == "big5" else STORED_GB)
            if 10 * sum(c in own for c in han) >= 9 * len(han):
                return []
        elif read not in WESTERN:  # letters of another script make words; garbled text is strewn with signs
            spans = [x for x in spans if 8 * _signs(text[x[0] : x[1]]) >= x[1] - x[0] >= 8]
        sure = [x for x in spans if len(x[2]) >= 2]
        if not sure or not usual("".join(x for _, _, x in spans)):
            return []
        # runs that hold nearly all of the line that isn't ASCII, else those that no word of their own holds
        held, strange = sum(b - a for a, b, _ in spans), sum(i in odd for a, b, _ in spans for i in range(a, b))
        if read in READ_MANY_BYTES and strange < 0.3 * held:
            return []
        if held >= 0.6 * sum(c > "\x7f" for c in text):
            return spans
        if read in READ_MANY_BYTES:
            return []
        return [x for x in spans if len(x[2]) >= 3 and usual(x[2]) and any(i in odd for i in range(x[0], x[1]))]
    if read in READ_MANY_BYTES:
        strange = lambda c: not ("\u0370" <= c < "\u0530" or c.isascii())  # a foreign word in a script of its own is no garble
        return [(a, b, s) for a, b, s in spans if any(i in odd and strange(text[i]) for i in range(a, b)) and 2 * sum(c in common or c in vi or c < "\x80" for c in s) >= len(s)]
    return [(a, b, s) for a, b, s in spans if any(i in odd for i in range(a, b))]


@lru_cache(maxsize=1)
def vni_table() -> dict[str, str]:
    """Sequences of the two-byte Vietnamese font code read as a Western code page, to letters."""
    # The code's mark letters after a vowel.
    marks = {"ù": "́", "ø": "̀", "û": "̉", "õ": "̃", "ï": "̣"}
    hats = {"á": "́", "à": "̀", "å": "̉", "ã": "̃", "ä": "̣", "â": ""}
    bows = {"é": "́", "è": "̀", "ú": "̉", "ü": "̃", "ë": "̣", "ê": ""}
    table = {"ñ": "đ", "ö": "ư", "ô": "ơ", "æ": "ỉ", "ó": "ĩ", "ò": "ị", "î": "ỵ"}
    for v, base in {"a": "a", "e": "e", "o": "o", "u": "u", "y": "y", "ô": "ơ", "ö": "ư"}.items():
        table |= {v + m: unicodedata.normalize("NFC", base + t) for m, t in marks.items()}
        if v in "aeo":
            table |= {v + m: unicodedata.normalize("NFC", v + "̂" + t) for m, t in hats.items()}
    table |= {"a" + m: unicodedata.normalize("NFC", "ă" + t) for m, t in bows.items()}
    table |= {k.upper(): v.upper() for k, v in table.items()} | {k[0].upper() + k[1:]: v.upper() for k, v in table.items() if len(k) == 2}
    return table


READINGS = READ_ONE_BYTE + READ_MANY_BYTES
SHORT = 160  # characters of a line up to which its restoration is remembered


@lru_cache(maxsize=1)
def _vni():
    a = ahocorasick.Automaton()
    for k, v in vni_table().items():
        a.add_word(k, (len(k), v))
    a.make_automaton()
    syllable = regex.compile(rf"(?:{ONSET})?[{''.join(sorted({c.lower() for c in _vietnamese() if c not in 'đĐ'} | set('aeiouy')))}]{{1,3}}(?:{CODA})?", regex.IGNORECASE)
    return a, syllable


def _vni_spans(text: str) -> list[tuple[int, int, str]]:
    a, syllable = _vni()
    out, other, telling = [], 0, 0
    for m in regex.finditer(r"[^\W\d_]+", text):
        w = m.group()
        if w.isascii():
            continue
        at, parts = 0, []
        for last, (n, v) in a.iter_long(w):
            parts += [w[at : last - n + 1], v]
            at = last + 1
        fixed = "".join([*parts, w[at:]])
        if fixed == w:
            continue
        if syllable.fullmatch(fixed):
            out.append((m.start(), m.end(), fixed))
            telling += any(c in "öñïøûåäëüæÖÑÏØÛÅÄËÜÆ" for c in w)
        else:
            other += 1
    return out if telling and len(out) > 2 * other else []


def _once(line: str) -> tuple[str, list[tuple[int, int]]]:
    odd = odd_positions(line)
    if not odd:
        return line, []
    best: tuple[tuple, list[tuple[int, int, str]]] | None = None
    found = [(*PAIRS[p], spans) for p, spans in _spans(line).items()] + [(stored, read, _spans_of_many(line, stored, read)) for stored, read in MANY_PAIRS if WIDE.search(line)]
    for stored, read, spans in found:
        got = _accept(line, stored, read, spans, odd) if spans else []
        if got:
            covered = sum(i in odd for a, b, _ in got for i in range(a, b))
            value = (covered, sum(b - a for a, b, _ in got), -sum(len(s) for _, _, s in got), stored == STORED_UTF8, stored == STORED_GB, -READINGS.index(read))
            if best is None or value > best[0]:
                best = (value, got)
    vni = _vni_spans(line)
    if vni and (best is None or sum(b - a for a, b, _ in vni) > 2 * sum(b - a for a, b, _ in best[1])):
        best = ((0,), vni)
    if best is None:
        return line, []
    out, at = [], 0
    for a, b, s in best[1]:
        out += [line[at:a], s]
        at = b
    return "".join([*out, line[at:]]), [(a, b) for a, b, _ in best[1]]


def repair_line(line: str) -> tuple[str, bool]:
    """(restored line, whether it was garbled). Text garbled more than once is restored step by step."""
    return _repeated(line) if len(line) <= SHORT else _restored(line)


@lru_cache(maxsize=1 << 14)  # sites print the same lines on many pages
def _repeated(line: str) -> tuple[str, bool]:
    return _restored(line)


def _restored(line: str) -> tuple[str, bool]:
    garbled = "�" in line
    for _ in range(3):
        fixed, spans = _once(line)
        if not spans or fixed == line:
            break
        line, garbled = fixed, True
    return line, garbled


def repair(text: str | None) -> tuple[str | None, bool, bool]:
    """(text with garbled spans restored, whether any was garbled, whether some remains)."""
    if not text:
        return text, False, False
    if usual_characters().issuperset(text) and not HAN_IN_LATIN.search(text):
        return text, False, False
    lines, garbled = [], False
    for line in text.split("\n"):
        fixed, bad = repair_line(line)
        garbled |= bad
        lines.append(fixed)
    out = "\n".join(lines)
    return out, garbled, garbled and "�" in out


def repair_fields(df: DataFrame, key: str, fields: tuple[str, ...] = ("title", "content")) -> DataFrame:
    """For each garbled field of ``df``: key, field_name, original (restored), complete (all restored).

    Null and empty fields are never garbled. Characters that were replaced on
    the way (U+FFFD) can't be restored; such fields come out with what can.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, names, texts, complete = [], [], [], []
            ids = b.column(0)
            for k, f in enumerate(fields, 1):
                for i, t in enumerate(b.column(k).to_pylist()):
                    fixed, bad, left = repair(t)
                    if bad:
                        keys.append(ids[i].as_py())
                        names.append(f)
                        texts.append(fixed)
                        complete.append(not left)
            yield pa.RecordBatch.from_arrays([pa.array(keys, ids.type), pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(complete, pa.bool_())], names=[key, "field_name", "original", "complete"])

    return spread(df.select(key, *fields)).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, field_name string, original string, complete boolean")
