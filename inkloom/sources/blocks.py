"""The YAML subset of segment files: a list of maps with string values, block or quoted."""

from __future__ import annotations

import json
import re


_ODD = re.compile("[\\x00-\\x08\\x0b-\\x1f\\x7f-\\x9f\\u2028\\u2029\\ufeff\\ufffe\\uffff\\ud800-\\udfff]")


def _quoted(value: str) -> str:
    """A double-quoted scalar; characters that YAML doesn't print are escaped."""
    return _ODD.sub(lambda m: f"\\u{ord(m[0]):04x}", json.dumps(value, ensure_ascii=False))


def dump_value(key: str, value: str | None, indent: str) -> str:
    """One key of a segment: block style for texts with line breaks, quoted otherwise."""
    if value is None:
        return f"{indent}{key}: null\n"
    first = value.lstrip("\n")
    block = "\n" in value and first and first[0] not in " \t" and not value.startswith("\n") and not _ODD.search(value) and not re.search(r"[^\S\n]\n|[^\S\n]$", value)
    if not block:
        return f"{indent}{key}: {_quoted(value)}\n"
    body = value.rstrip("\n")
    tail = len(value) - len(body)
    mark = "|-" if tail == 0 else "|" if tail == 1 else "|+"
    lines = "".join(f"{indent}  {x}\n" if x else "\n" for x in body.split("\n"))
    return f"{indent}{key}: {mark}\n{lines}" + "\n" * max(0, tail - 1)


def dump_segments(rows: list[dict]) -> str:
    """Segments as YAML: keys in order, Unicode kept."""
    out = []
    for r in rows:
        text = "".join(dump_value(k, v, "  ") for k, v in r.items())
        out.append("- " + text[2:])
    return "".join(out)


_KEY = re.compile(r"^(\s*)(?:- )?\s*([A-Za-z_]\w*):(?: (.*))?$")


def _scalar(raw: str) -> str | None:
    raw = raw.strip()
    if raw in ("null", "~", ""):
        return None if raw != "" else ""
    if raw[0] == '"':
        return json.loads(raw)
    if raw[0] == "'":
        return raw[1:-1].replace("''", "'")
    return raw


def parse_segments(text: str) -> list[dict]:
    """The maps of a segment file. PyYAML reads it where installed; else this reads what dump_segments writes.

    Anything that isn't a list of maps raises ValueError.
    """
    text = text.removeprefix("﻿")
    try:
        import yaml
    except ImportError:
        return _parse_plain(text)
    try:
        got = yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))
    except yaml.YAMLError as e:
        raise ValueError(str(e)) from e
    if got is None:
        return []
    if not isinstance(got, list) or not all(isinstance(x, dict) for x in got):
        raise ValueError("not a list of maps")
    return [{str(k): None if v is None else str(v) for k, v in x.items()} for x in got]


def _parse_plain(text: str) -> list[dict]:
    lines = text.split("\n")
    if lines and lines[0].strip() == "---":
        lines = lines[1:]
    rows: list[dict] = []
    i = 0
    while i < len(lines):
        line = lines[i]
        if not line.strip():
            i += 1
            continue
        m = _KEY.match(line)
        if not m:
            raise ValueError(f"line {i + 1} isn't a key")
        if line.lstrip().startswith("- "):
            rows.append({})
        if not rows:
            raise ValueError("not a list of maps")
        key, raw = m[2], (m[3] or "").strip()
        if raw in ("|", "|-", "|+"):
            i += 1
            block: list[str] = []
            indent = None
            while i < len(lines) and (not lines[i].strip() or len(lines[i]) - len(lines[i].lstrip(" ")) >= (indent or 3)):
                if lines[i].strip() and indent is None:
                    indent = len(lines[i]) - len(lines[i].lstrip(" "))
                block.append(lines[i][indent or 0 :])
                i += 1
            at_end = 0
            while block and not block[-1].strip():
                block.pop()
                at_end += 1
            body = "\n".join(block)
            rows[-1][key] = body + ("" if raw == "|-" else "\n" if raw == "|" else "\n" * max(1, at_end + (i < len(lines))))
            continue
        rows[-1][key] = _scalar(raw)
        i += 1
    return rows
